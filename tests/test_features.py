"""Point-in-time features and labels."""

from datetime import datetime

import pytest
from conftest import SMALL, plan_text
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.functions.stamps import parse_window, window_months
from ebbline.operators.features import enriched_orders, feature_matrix, payments_per_order, visible_orders
from ebbline.operators.labels import (
    check_maturity,
    future_targets,
    labelled_features,
    matured_labels,
    training_table,
)
from ebbline.sources.lake import ORDER_STAMPS
from ebbline.sources.star import Commerce, commerce

START, END = "2023-01-01", "2023-06-01"


def by_key(df, key="customer_unique_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_toy_features(toy):
    rows = by_key(feature_matrix(*toy, START, END))
    assert set(rows) == {"u1", "u2"}
    assert rows["u1"] == {
        "customer_unique_id": "u1", "customer_state": "SP", "recency_days": 1, "tenure_days": 151,
        "frequency": 2, "monetary_total": 35.0, "aov": 17.5, "max_delivery_delay_days": -2,
        "has_undelivered_order": 0, "total_canceled_orders": 0, "snapshot_date": END,
    }
    assert rows["u2"] == {
        "customer_unique_id": "u2", "customer_state": "RJ", "recency_days": 12, "tenure_days": 120,
        "frequency": 2, "monetary_total": 7.5, "aov": 3.75, "max_delivery_delay_days": None,
        "has_undelivered_order": 1, "total_canceled_orders": 1, "snapshot_date": END,
    }


def test_column_types(toy):
    types = dict(feature_matrix(*toy, START, END).dtypes)
    assert types["recency_days"] == types["tenure_days"] == types["frequency"] == "bigint"
    assert types["monetary_total"] == types["aov"] == "double"
    assert types["has_undelivered_order"] == "int" and types["total_canceled_orders"] == "bigint"


def test_masks_at_the_cutoff(toy):
    rows = by_key(visible_orders(toy.orders, START, END), "order_id")
    assert rows["o2"]["act_delivery_ts"] is not None and rows["o2"]["order_status"] == "delivered"
    assert rows["o3"]["act_delivery_ts"] is None and rows["o3"]["order_status"] == "processing"
    assert rows["o4"]["order_status"] == "canceled"
    assert "o5" not in rows and "o8" not in rows


def test_toy_labels(toy):
    rows = by_key(training_table(*toy, START, END))
    assert (rows["u1"]["target_is_churn"], rows["u1"]["target_180d_ltv"]) == (0, 30.0)
    assert (rows["u2"]["target_is_churn"], rows["u2"]["target_180d_ltv"]) == (1, 0.0)
    assert rows["u1"]["ingested_at_utc"] is not None
    targets = by_key(future_targets(*toy, END))
    assert targets["u3"]["future_orders"] == 1 and targets["u3"]["future_ltv"] == 9.0


def test_status_list_and_names(toy):
    rows = by_key(labelled_features(*toy, START, END, statuses=["delivered"],
                                    churn_column="gone", ltv_column="worth"))
    assert rows["u1"]["gone"] == 1 and rows["u1"]["worth"] == 0.0


def test_minimum_orders(toy):
    assert by_key(feature_matrix(*toy, START, END, min_orders=3)) == {}


def test_a_repeated_customer_id_multiplies_money_and_not_orders(toy):
    twice = toy.customers.union(toy.customers.where("customer_id = 'c-o1'"))
    rows = by_key(feature_matrix(toy.orders, twice, toy.payments, START, END))
    assert rows["u1"]["frequency"] == 2 and rows["u1"]["monetary_total"] == 50.0


def test_null_payments(toy, spark):
    pays = spark.createDataFrame([("o1", None), ("o2", None), ("o2", 3.0)], "order_id string, payment_value double")
    totals = {r.order_id: r.order_payment_value for r in payments_per_order(pays).collect()}
    assert totals == {"o1": None, "o2": 3.0}
    assert by_key(feature_matrix(toy.orders, toy.customers, pays, START, END))["u1"]["monetary_total"] == 3.0


def test_typed_and_text_timestamps_agree(toy):
    for kind in ("timestamp_ntz", "timestamp"):
        typed = toy.orders.withColumns({c: F.col(c).try_cast(kind) for c in ORDER_STAMPS})
        assert by_key(feature_matrix(typed, toy.customers, toy.payments, START, END)) == by_key(
            feature_matrix(*toy, START, END)
        )


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    late=st.datetimes(min_value=datetime(2023, 6, 1), max_value=datetime(2024, 1, 1)),
    status=st.sampled_from(["delivered", "canceled", "shipped"]),
)
def test_nothing_after_the_cutoff_leaks(spark, toy, late, status):
    text = late.strftime("%Y-%m-%d %H:%M:%S")
    more = toy.orders.union(
        spark.createDataFrame([("x", "c-x", status, text, text, None)], toy.orders.schema)
    )
    customers = toy.customers.union(spark.createDataFrame([("c-x", "u1", "ZZ")], toy.customers.schema))
    payments = toy.payments.union(spark.createDataFrame([("x", 999.0)], toy.payments.schema))
    moved = more.withColumn(
        "order_delivered_customer_date",
        F.when(F.col("order_id") == "o3", F.lit("2023-12-31 00:00:00")).otherwise(F.col("order_delivered_customer_date")),
    )
    assert by_key(feature_matrix(moved, customers, payments, START, END)) == by_key(feature_matrix(*toy, START, END))


def test_result_does_not_depend_on_partitioning(spark):
    tables = commerce(spark, SMALL)
    shuffled = Commerce(*(t.repartition(7).sortWithinPartitions(F.rand(1)) for t in tables))
    window = ("1996-01-01", "2000-01-01")
    assert by_key(labelled_features(*shuffled, *window)) == by_key(labelled_features(*tables, *window))


def test_a_hot_customer_and_a_hot_order(spark):
    """A third of all rows hang on one person; another third of the payments on one order."""
    tables = commerce(spark, SMALL)
    hot = tables.customers.withColumn(
        "customer_unique_id", F.when(F.col("customer_id") % 3 == 0, -1).otherwise(F.col("customer_unique_id"))
    )
    payments = tables.payments.withColumn(
        "order_id", F.when(F.col("order_id") % 3 == 1, 7).otherwise(F.col("order_id"))
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    try:
        ours = by_key(feature_matrix(tables.orders, hot, payments, "1996-01-01", "2000-01-01"))
    finally:
        for key in ("autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionThresholdInBytes",
                    "adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.{key}")
    rows = enriched_orders(tables.orders, hot, payments, "1996-01-01", "2000-01-01").toPandas()
    assert ours[-1]["frequency"] == rows[rows.customer_unique_id == -1].order_id.nunique()
    money = sum(r["monetary_total"] for r in ours.values())
    assert abs(money - float(rows.payment_value.sum())) < 1e-3


def test_plan_prunes_and_shuffles_detail_rows_twice(spark):
    tables = commerce(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(feature_matrix(*tables, "1996-01-01", "2000-01-01"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00), LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    # The join on order_id feeds the distinct count without another exchange.
    top = plan[: plan.index("SortMergeJoin [order_id")]
    assert top.count("Exchange hashpartitioning") == 1
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_matured_labels_and_maturity(spark):
    scores = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "customer_unique_id string, predicted_probability double")
    later = spark.createDataFrame([("b", 1, 5.0), ("c", 2, 1.0)], "customer_unique_id string, future_orders int, future_ltv double")
    assert sorted(tuple(r) for r in matured_labels(scores, later).collect()) == [("a", 1), ("b", 0)]
    check_maturity(180, 180)
    with pytest.raises(ValueError):
        check_maturity(30, 180)


@pytest.mark.parametrize(
    "start, end, months",
    [
        ("2023-01-15", "2023-03-10", [(2023, 1), (2023, 2), (2023, 3)]),
        ("2023-12-25", "2024-02-05", [(2023, 12), (2024, 1), (2024, 2)]),
        ("2023-06-01 10:00:00", "2023-06-01 12:00:00", [(2023, 6)]),
        ("2023-01-31", "2023-01-31", [(2023, 1)]),
    ],
)
def test_window_months(start, end, months):
    assert window_months(start, end) == months


def test_window_guards():
    with pytest.raises(ValueError):
        parse_window("2023-06-01", "2023-06-01")
    with pytest.raises(ValueError):
        parse_window("01/06/2023", "2023-06-02")
    # Compared as moments and not as text.
    parse_window("2023-06-01", "2023-06-01 00:00:01")
