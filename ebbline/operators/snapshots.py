"""Features of many snapshot days in one pass over the tables.

An order is seen from the first snapshot after its purchase on, its delivery from the
first snapshot at or after it, a payment from its own. So an order adds to a person's
features at one or two of the snapshots, and not at each. What a person's orders add at a
snapshot is summed up, running totals over the snapshots give the features, and they
hold until the next snapshot at which something was added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.stamps import has_partition_days, instant, parse_instant, parse_window, partition_day, stamp, within_days, within_window
from ebbline.operators.features import feature_matrix
from ebbline.session import store

PURCHASE, DELIVERY, ESTIMATE = "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"


def feature_snapshots(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, start: str, cutoffs: Sequence[str], min_orders: int = 1
) -> DataFrame:
    """The rows of :func:`feature_matrix` for every cutoff, told apart by ``snapshot_date``.

    Cutoffs may come in any order and repeat. The tables are read and joined once,
    however many there are; per person no more rows than cutoffs are put in order.
    """
    ends = sorted(set(cutoffs), key=parse_instant)
    if not ends:
        return feature_matrix(orders, customers, payments, start, "9999-12-31").limit(0)
    parse_window(start, ends[0])
    last, never = ends[-1], len(ends)
    days = F.array(*[F.lit(parse_instant(e).date()) for e in ends])

    def since_day(df: DataFrame) -> Column:
        """The first snapshot whose day is not before the row's partition day."""
        return F.size(F.filter(days, lambda d: d < partition_day(df))) if has_partition_days(df) else F.lit(0)

    placed = within_window(orders, PURCHASE, start, last)
    bought, delivered = stamp(placed, PURCHASE), stamp(placed, DELIVERY)
    moments = {c: F.array(*[instant(e, placed, c) for e in ends]) for c in (PURCHASE, DELIVERY)}
    seen = F.size(F.filter(moments[PURCHASE], lambda e: e <= bought))
    arrived = F.coalesce(F.size(F.filter(moments[DELIVERY], lambda e: e < delivered)), F.lit(never))
    narrow = placed.select(
        "order_id",
        "customer_id",
        F.to_date(bought).alias("purchase_day"),
        F.datediff(delivered, stamp(placed, ESTIMATE)).alias("delay_days"),
        (F.col("order_status") == "canceled").cast("int").alias("canceled"),
        F.greatest(seen, since_day(placed)).alias("seen"),
        F.when(delivered.isNull(), never).otherwise(arrived).alias("arrived"),
        delivered.isNull().alias("is_open"),
    )
    known = within_days(customers, start, last)
    people = known.select("customer_id", "customer_unique_id", "customer_state", since_day(known).alias("known"))
    rows = store(
        narrow.join(people, "customer_id")
        .withColumn("step", F.greatest("seen", "known"))
        .where(F.col("step") < never)
        .drop("customer_id", "seen", "known")
    )
    paid = within_days(payments, start, last)
    paid = paid.select("order_id", "payment_value", since_day(paid).alias("paid")).groupBy("order_id", "paid").agg(F.sum("payment_value").alias("money"))

    who = "customer_unique_id"
    # From the purchase on the order counts as not delivered; an order without a delivery shows its status at once.
    placed_at = rows.select(
        who, "step", "customer_state", F.col("purchase_day").alias("first_day"), F.col("purchase_day").alias("last_day"),
        F.lit(1).alias("undelivered"), F.when(F.col("is_open"), F.col("canceled")).alias("canceled"),
    )
    delivered_at = rows.withColumn("step", F.greatest("step", "arrived")).where(F.col("step") < never).select(
        who, "step", F.lit(-1).alias("undelivered"), "canceled", "delay_days"
    )
    counted_at = rows.groupBy(who, "order_id").agg(F.min("step").alias("step")).select(who, "step", F.lit(1).alias("orders"))
    paid_at = rows.select(who, "order_id", "step").join(paid, "order_id").withColumn("step", F.greatest("step", "paid"))
    paid_at = paid_at.where(F.col("step") < never).select(who, "step", "money")
    changes = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [placed_at, delivered_at, counted_at, paid_at])

    how = {
        "customer_state": F.max, "first_day": F.min, "last_day": F.max, "undelivered": F.sum, "canceled": F.sum,
        "delay_days": F.max, "orders": F.sum, "money": F.sum,
    }
    upto = Window.partitionBy(who).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    added = changes.groupBy(who, "step").agg(*[f(c).alias(c) for c, f in how.items()])
    running = added.select(who, "step", F.lead("step").over(Window.partitionBy(who).orderBy("step")).alias("until"), *[f(c).over(upto).alias(c) for c, f in how.items()])
    held = running.withColumn("at", F.explode(F.sequence("step", F.coalesce("until", F.lit(never)) - 1)))
    day = F.get(days, F.col("at"))
    total = F.coalesce("money", F.lit(0)).cast("double")
    return held.where(F.col("orders") >= min_orders).select(
        who,
        "customer_state",
        F.datediff(day, "last_day").cast("bigint").alias("recency_days"),
        F.datediff(day, "first_day").cast("bigint").alias("tenure_days"),
        F.col("orders").alias("frequency"),
        total.alias("monetary_total"),
        (total / F.nullif("orders", F.lit(0))).alias("aov"),
        F.col("delay_days").cast("bigint").alias("max_delivery_delay_days"),
        (F.col("undelivered") > 0).cast("int").alias("has_undelivered_order"),
        F.coalesce("canceled", F.lit(0)).alias("total_canceled_orders"),
        F.get(F.array(*map(F.lit, ends)), F.col("at")).alias("snapshot_date"),
    )
