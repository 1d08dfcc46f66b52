"""Labels that mature after the cutoff: churn and lifetime value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions.stamps import plus_days, within_days, within_window
from ebbline.names import KEY, TARGET
from ebbline.operators.features import feature_matrix, payments_per_order

ACTIVE_STATUSES = ("delivered", "shipped")


def future_targets(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    end: str,
    window_days: int = 180,
    statuses: Sequence[str] = ACTIVE_STATUSES,
    sides_by_order_day: bool = False,
) -> DataFrame:
    """Orders and money per person in ``[end, end + window_days)``.

    Summing payments per order before the join gives the same total as joining
    raw payment rows, without multiplying the detail rows. Customers and
    payments are read whole unless ``sides_by_order_day`` states that both are
    partitioned by the day of their order, as the lake writer does.
    """
    last = plus_days(end, window_days)
    active = (
        within_window(orders, "order_purchase_timestamp", end, last)
        .where(F.col("order_status").isin(list(statuses)))
        .select("order_id", "customer_id")
    )
    if sides_by_order_day:
        customers, payments = within_days(customers, end, last), within_days(payments, end, last)
    people = customers.select("customer_id", "customer_unique_id")
    return (
        active.join(people, "customer_id")
        .join(payments_per_order(payments), "order_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            F.count_distinct("order_id").alias("future_orders"),
            F.sum("order_payment_value").cast("double").alias("future_ltv"),
        )
    )


def with_labels(
    features: DataFrame,
    targets: DataFrame,
    churn_column: str = TARGET,
    ltv_column: str = "target_180d_ltv",
) -> DataFrame:
    """Attach the labels; a person without future orders has churned."""
    returned = F.coalesce("future_orders", F.lit(0)) > 0
    return (
        features.join(targets, "customer_unique_id", "left")
        .withColumns(
            {
                ltv_column: F.coalesce("future_ltv", F.lit(0.0)),
                churn_column: F.when(returned, 0).otherwise(1),
            }
        )
        .drop("future_orders", "future_ltv")
    )


def labelled_features(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    start: str,
    end: str,
    window_days: int = 180,
    statuses: Sequence[str] = ACTIVE_STATUSES,
    min_orders: int = 1,
    churn_column: str = TARGET,
    ltv_column: str = "target_180d_ltv",
    sides_by_order_day: bool = False,
) -> DataFrame:
    """Features at ``end`` with the labels of the window after it."""
    features = feature_matrix(orders, customers, payments, start, end, min_orders)
    targets = future_targets(
        orders, customers, payments, end, window_days, statuses, sides_by_order_day
    )
    return with_labels(features, targets, churn_column, ltv_column)


def training_table(orders: DataFrame, customers: DataFrame, payments: DataFrame, start: str,
                   end: str, **options) -> DataFrame:
    """:func:`labelled_features` with the UTC time of the build."""
    built = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    labelled = labelled_features(orders, customers, payments, start, end, **options)
    return labelled.withColumn("ingested_at_utc", built)


def check_maturity(lookback_days: int, window_days: int) -> None:
    """Labels of a snapshot are complete only once their whole window has passed."""
    if lookback_days < window_days:
        raise ValueError(
            f"a lookback of {lookback_days} days cannot hold labels that need {window_days} days"
        )


def matured_labels(
    telemetry: DataFrame, targets: DataFrame, target: str = TARGET,
    key: str = KEY,
) -> DataFrame:
    """Labels of the people scored in ``telemetry``, one row per scored row.

    The telemetry lists the people, so only the orders after the snapshot are
    needed: whoever has none in the window has churned.
    """
    returned = F.coalesce("future_orders", F.lit(0)) > 0
    return (
        telemetry.select(key)
        .join(targets.select(key, "future_orders"), key, "left")
        .select(key, F.when(returned, 0).otherwise(1).alias(target))
    )
