from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ebbline.session import local_session
from ebbline.sources.star import Commerce

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, partitions=4)
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")  # plans in full
    yield session
    session.stop()


@pytest.fixture(scope="session")
def toy(spark) -> Commerce:
    """Orders around the boundaries of a window that ends on 2023-06-01."""
    placed = [
        ("o1", "u1", "2023-01-01 00:00:00", "2023-01-09 00:00:00", "delivered"),
        ("o2", "u1", "2023-05-31 23:59:59", "2023-06-01 00:00:00", "delivered"),
        ("o3", "u2", "2023-05-20 10:00:00", "2023-06-01 00:00:01", "delivered"),
        ("o4", "u2", "2023-02-01 08:00:00", None, "canceled"),
        ("o5", "u3", "2023-06-01 00:00:00", None, "shipped"),
        ("o6", "u1", "2023-11-27 23:59:59", None, "shipped"),
        ("o7", "u2", "2023-11-28 00:00:00", None, "shipped"),
        ("o8", "u4", "not a date", None, "delivered"),
    ]
    orders = spark.createDataFrame(
        [(o, f"c-{o}", status, when, done) for o, _, when, done, status in placed],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
        "order_delivered_customer_date string",
    )
    planned = F.col("order_purchase_timestamp").try_cast("timestamp_ntz") + F.expr("interval 10 days")
    frame = orders.select(
        *orders.columns[:4],
        planned.cast("string").alias("order_estimated_delivery_date"),
        "order_delivered_customer_date",
    )
    states = {"u1": "SP", "u2": "RJ", "u3": "SP", "u4": "MG"}
    customers = spark.createDataFrame(
        [(f"c-{o}", u, states[u]) for o, u, *_ in placed],
        "customer_id string, customer_unique_id string, customer_state string",
    )
    payments = spark.createDataFrame(
        [("o1", 10.0), ("o1", 5.0), ("o2", 20.0), ("o4", 7.5), ("o5", 9.0), ("o6", 30.0), ("o7", 30.0),
         ("o8", 1.0)],
        "order_id string, payment_value double",
    )
    return Commerce(frame, customers, payments)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
