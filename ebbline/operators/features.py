"""Point-in-time customer features: what was known at the cutoff and nothing later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.stamps import (
    instant,
    parse_instant,
    parse_window,
    stamp,
    within_days,
    within_window,
)


def visible_orders(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Orders placed in ``[start, end)`` as they looked at ``end``.

    A delivery later than the cutoff is hidden, and the status of such an order
    goes back to ``processing``. A delivery exactly at the cutoff is visible.
    """
    parse_window(start, end)
    placed = within_window(orders, "order_purchase_timestamp", start, end)
    delivered = stamp(placed, "order_delivered_customer_date")
    cutoff = instant(end, placed, "order_delivered_customer_date")
    return placed.select(
        "order_id",
        "customer_id",
        stamp(placed, "order_purchase_timestamp").alias("purchase_ts"),
        stamp(placed, "order_estimated_delivery_date").alias("est_delivery_ts"),
        F.when(delivered <= cutoff, delivered).alias("act_delivery_ts"),
        F.when(delivered > cutoff, F.lit("processing"))
        .otherwise(F.col("order_status"))
        .alias("order_status"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Payment total of each order, NULL where every payment is NULL."""
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("order_payment_value"))


def with_people_and_payments(
    placed: DataFrame, customers: DataFrame, payments: DataFrame, start: str, end: str
) -> DataFrame:
    """Attach the person, the state and the payment total to order rows.

    The customer join comes first and the payment join last, so the rows leave
    partitioned by ``order_id``: counting distinct orders per person then needs
    no further shuffle of detail rows. Payments are summed before they are
    joined. Both joins are plain equi-joins; adaptive execution splits hot keys.
    """
    people = within_days(customers, start, end).select(
        "customer_id", "customer_unique_id", "customer_state"
    )
    paid = payments_per_order(within_days(payments, start, end))
    details = [c for c in placed.columns if c not in ("order_id", "customer_id")]
    return (
        placed.join(people, "customer_id")
        .join(paid, "order_id", "left")
        .select(
            "customer_unique_id",
            "customer_state",
            "order_id",
            *details,
            F.coalesce("order_payment_value", F.lit(0)).alias("payment_value"),
        )
    )


def enriched_orders(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, start: str, end: str
) -> DataFrame:
    """Visible orders with the person, the state and the order's payment total."""
    placed = visible_orders(orders, start, end)
    return with_people_and_payments(placed, customers, payments, start, end)


def feature_matrix(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    start: str,
    end: str,
    min_orders: int = 1,
) -> DataFrame:
    """One row per person with at least ``min_orders`` orders in the window."""
    visible = visible_orders(orders, start, end)
    # Days and flags are worked out before the joins: they are all that has to be moved.
    placed = visible.select(
        "order_id",
        "customer_id",
        F.to_date("purchase_ts").alias("purchase_day"),
        F.datediff("act_delivery_ts", "est_delivery_ts").alias("delay_days"),
        F.col("act_delivery_ts").isNull().cast("int").alias("undelivered"),
        (F.col("order_status") == "canceled").cast("int").alias("canceled"),
    )
    rows = with_people_and_payments(placed, customers, payments, start, end)
    cutoff_day = F.lit(parse_instant(end).date())
    grouped = rows.groupBy("customer_unique_id").agg(
        F.max("customer_state").alias("customer_state"),
        F.datediff(cutoff_day, F.max("purchase_day")).cast("bigint").alias("recency_days"),
        F.datediff(cutoff_day, F.min("purchase_day")).cast("bigint").alias("tenure_days"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum("payment_value").cast("double").alias("monetary_total"),
        F.max("delay_days").cast("bigint").alias("max_delivery_delay_days"),
        F.max("undelivered").alias("has_undelivered_order"),
        F.coalesce(F.sum("canceled"), F.lit(0)).alias("total_canceled_orders"),
    )
    per_order = F.col("monetary_total") / F.nullif(F.col("frequency"), F.lit(0))
    return grouped.where(F.col("frequency") >= min_orders).select(
        "customer_unique_id",
        "customer_state",
        "recency_days",
        "tenure_days",
        "frequency",
        "monetary_total",
        per_order.alias("aov"),
        "max_delivery_delay_days",
        "has_undelivered_order",
        "total_canceled_orders",
        F.lit(end).alias("snapshot_date"),
    )
