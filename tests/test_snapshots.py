"""Many snapshots at once against one feature matrix for each."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_text

from ebbline.operators.features import feature_matrix
from ebbline.operators.snapshots import feature_snapshots
from ebbline.sources import lake

CUTOFFS = ["2023-03-01", "2023-02-10 12:00:00", "2023-03-01", "2023-06-01", "2023-02-11", "2024-01-01"]


def drawn(spark, seed, by_day):
    """Orders that are bought, paid and delivered around the cutoffs, some repeated, some without a delivery."""
    draw, begin = random.Random(seed), datetime(2023, 1, 1)
    moment = lambda: begin + timedelta(hours=draw.randrange(24 * 200))
    orders, customers, payments = [], [], []
    for i in range(250):
        bought = draw.choice([moment(), datetime(2023, 2, 10, 12), datetime(2023, 3, 1)])
        done = draw.choice([None, bought + timedelta(days=draw.randrange(60)), datetime(2023, 3, 1), datetime(2023, 2, 10, 12)])
        order = (f"o{i}", f"c{i % 180}", draw.choice(["delivered", "canceled", "shipped"]), str(bought), None if done is None else str(done), str(bought + timedelta(days=9)))
        orders += [order] * draw.choice([1, 1, 1, 2])
        customers.append((f"c{i % 180}", f"u{draw.randrange(40)}", draw.choice(["SP", "RJ", None])))
        payments += [(f"o{i}", draw.choice([10.0, 2.5, None])) for _ in range(draw.randrange(4))]
    names = "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_delivered_customer_date string, order_estimated_delivery_date string"
    tables = [
        spark.createDataFrame(orders, names),
        spark.createDataFrame(customers[:180], "customer_id string, customer_unique_id string, customer_state string"),
        spark.createDataFrame(payments, "order_id string, payment_value double"),
    ]
    if by_day:
        tables = [lake.orders_by_day(tables[0]), lake.customers_by_day(tables[1], tables[0]), lake.payments_by_day(tables[2], tables[0])]
    return tables


@pytest.mark.parametrize(("seed", "by_day", "least"), [(1, False, 1), (2, True, 1), (3, False, 3)])
def test_equals_a_matrix_for_each(spark, seed, by_day, least):
    tables = drawn(spark, seed, by_day)
    found = feature_snapshots(*tables, "2023-01-05", CUTOFFS, least)
    for cutoff in sorted(set(CUTOFFS)):
        one = feature_matrix(*tables, "2023-01-05", cutoff, least)
        assert one.columns == found.columns
        want = sorted(map(str, one.collect()))
        assert sorted(map(str, found.where(found.snapshot_date == cutoff).select(one.columns).collect())) == want and (want or least > 1)


def test_repeats_do_not_add_rows(spark):
    tables = drawn(spark, 4, False)
    once = feature_snapshots(*tables, "2023-01-05", ["2023-06-01"])
    assert feature_snapshots(*tables, "2023-01-05", ["2023-06-01"] * 3).count() == once.count()
    assert feature_snapshots(*tables, "2023-01-05", []).count() == 0
    assert feature_snapshots(*[t.limit(0) for t in tables], "2023-01-05", CUTOFFS).count() == 0


def test_the_tables_are_read_once(spark):
    """No more scans for thirty snapshots than for two."""
    tables = drawn(spark, 5, False)
    days = [f"2023-04-{d:02d}" for d in range(1, 31)]
    few, many = (plan_text(feature_snapshots(*tables, "2023-01-05", some)) for some in (days[:2], days))
    assert few.count("Scan") == many.count("Scan") and few.count("Exchange") == many.count("Exchange")
