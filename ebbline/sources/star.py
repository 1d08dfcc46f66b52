"""Commerce tables (orders, customers, order_payments) over a star schema.

Each order gets its own ``customer_id``, which points to the person
(``customer_unique_id``); payments are one row per order line.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.values import exact_cents, round_half_up


class Commerce(NamedTuple):
    orders: DataFrame
    customers: DataFrame
    payments: DataFrame


# The columns read from each table. Naming them spares the reader
# a look into the files before the plan is made.
COLUMNS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_discount double",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _day_parts(df: DataFrame, name: str) -> DataFrame:
    return df.withColumns({"year": F.year(name), "month": F.month(name), "day": F.day(name)})


def star_orders(spark: SparkSession, folder: str) -> DataFrame:
    source = _table(spark, folder, "orders")
    key, placed, state = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    status = F.when(state == "F", "delivered").when(state == "O", "shipped").otherwise("canceled")
    arrives = placed + F.make_dt_interval(F.lit(3) + key % 23)
    delivered = F.when((state != "P") & (key % 11 != 0), arrives)
    shaped = source.select(
        key.alias("order_id"),
        key.alias("customer_id"),
        status.alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        (placed + F.make_dt_interval(F.lit(14))).alias("order_estimated_delivery_date"),
        delivered.alias("order_delivered_customer_date"),
    )
    return _day_parts(shaped, "order_purchase_timestamp")


def star_customers(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    people = _table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    states = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    shaped = (
        orders.join(people, orders.o_custkey == people.c_custkey)
        .join(states, people.c_nationkey == states.n_nationkey)
        .select(
            F.col("o_orderkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.col("n_name").alias("customer_state"),
            "o_orderdate",
        )
    )
    return _day_parts(shaped, "o_orderdate").drop("o_orderdate")


def star_payments(spark: SparkSession, folder: str) -> DataFrame:
    paid = round_half_up(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")), 2)
    return _table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), exact_cents(paid).alias("payment_value")
    )


def commerce(spark: SparkSession, folder: str) -> Commerce:
    return Commerce(
        star_orders(spark, folder), star_customers(spark, folder), star_payments(spark, folder)
    )
