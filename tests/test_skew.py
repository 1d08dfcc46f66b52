"""One key with a third of all rows: plans split it, results stay whole."""

from contextlib import contextmanager

import pytest
from conftest import SMALL, plan_text
from pyspark.sql import functions as F

from ebbline.operators import drift, profiles
from ebbline.operators.features import feature_matrix
from ebbline.operators.labels import labelled_features
from ebbline.session import pin, store
from ebbline.sources import lake
from ebbline.sources.star import Commerce, commerce

WINDOW = ("1996-01-01", "2000-01-01")


@contextmanager
def small_partitions(spark):
    """Sizes at which a few kilobytes count as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the orders share one customer id; its person has one row."""
    tables = commerce(spark, SMALL)
    orders = tables.orders.repartition(8).withColumn(
        "customer_id", F.when(F.col("order_id") % 3 == 0, 0).otherwise(F.col("customer_id"))
    )
    # Many small blocks, which is what a skewed partition is split along.
    return Commerce(store(orders), tables.customers, tables.payments)


def by_person(df):
    return {r.customer_unique_id: r for r in df.collect()}


def test_a_hot_customer_is_split_in_the_join(spark, hot):
    plain = by_person(labelled_features(*hot, *WINDOW))
    with small_partitions(spark):
        df = feature_matrix(*hot, *WINDOW)
        df.collect()
        assert "skew=true" in plan_text(df)
        assert by_person(labelled_features(*hot, *WINDOW)) == plain
    person = max(plain.values(), key=lambda r: r.frequency)
    visible = hot.orders.where("order_purchase_timestamp >= '1996-01-01' and order_purchase_timestamp < '2000-01-01'")
    owned = visible.join(hot.customers, "customer_id").where(F.col("customer_unique_id") == person.customer_unique_id)
    assert person.frequency == owned.select("order_id").distinct().count() > 250


def test_a_hot_day_is_written_in_pieces(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.md5(F.col("id").cast("string")).alias("text"),
        F.lit("2023").alias("year"),
        F.lit("01").alias("month"),
        F.when(F.col("id") % 3 == 0, "01").otherwise(F.format_string("%02d", F.col("id") % 28 + 1)).alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        lake.write_by_day(rows.repartition(8), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "t").glob("*/*/day=*")}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000
    assert len(files) == 28 and files["day=01"] > 1
    assert sorted(files.values())[14] <= 2  # a usual day stays in one or two files


def test_a_hot_value_in_drift(spark):
    live = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 9_000).cast("string")).alias("c"),
    )
    profile = pin(profiles.binned_profile(live, ["x"], ["c"]))
    with small_partitions(spark):
        rows = {r.feature: r.psi for r in drift.stability_index(live, profile, ["x", "c"]).collect()}
    assert rows["x"] == pytest.approx(0, abs=1e-12)
    # Rare categories are raised to epsilon on both sides alike.
    assert rows["c"] == pytest.approx(0, abs=1e-12)


def test_stored_frames_keep_rows_and_types(spark):
    df = spark.range(5).select("id", F.array("id").alias("a"), F.lit(None).cast("double").alias("d"))
    for keep in (store, pin):
        kept = keep(df)
        assert kept.dtypes == df.dtypes and sorted(kept.collect()) == sorted(df.collect())
    assert store(df.where("false")).count() == 0
