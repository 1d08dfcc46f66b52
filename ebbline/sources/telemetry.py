"""Scoring telemetry by day: today's scores and the matured look-back."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.stamps import parse_instant, partition_day, plus_days, within_days
from ebbline.functions.values import null_for_nan
from ebbline.names import KEY, PREDICTION, TARGET
from ebbline.operators.labels import check_maturity, matured_labels
from ebbline.sources.commits import day_folder, read_day
from ebbline.sources.lake import read_if_present

# The status words.
RESOLVED, NO_TRAFFIC = "CURRENT_TELEMETRY_RESOLVED", "SKIPPED_ZERO_TRAFFIC_DAY"
MATURED, IMMATURE = "MATURED_EVALUATION_READY", "SKIPPED_SYSTEM_IMMATURE"
# Our own: a day whose publication has not come to its end.
INCOMPLETE = "SKIPPED_INCOMPLETE_DAY"
NO_TELEMETRY = f"{KEY} string, {PREDICTION} double"
NO_LABELS = f"{KEY} string, {TARGET} int"


class Telemetry(NamedTuple):
    scores: DataFrame
    status: str


class Lookback(NamedTuple):
    scores: DataFrame
    labels: DataFrame
    status: str


def current_telemetry(spark: SparkSession, base: str, day: str) -> Telemetry:
    """The scores of ``day``; a day without traffic gives a typed frame of no rows.

    So does a day that was not published to its end: it has files, but no commit.
    """
    found = read_day(spark, base, day)
    if found is not None:
        return Telemetry(null_for_nan(found), RESOLVED)
    begun = read_if_present(spark, day_folder(base, day)) is not None
    return Telemetry(spark.createDataFrame([], NO_TELEMETRY), INCOMPLETE if begun else NO_TRAFFIC)


def lookback_day(day: str, lookback_days: int) -> str:
    return plus_days(day, -lookback_days)


def lookback_telemetry(
    spark: SparkSession,
    base: str,
    day: str,
    targets: DataFrame,
    lookback_days: int = 180,
    window_days: int = 180,
) -> Lookback:
    """The scores of ``day - lookback_days`` and the labels that matured since.

    ``targets`` holds the orders after the snapshot then scored, as of
    :func:`future_targets`.
    """
    check_maturity(lookback_days, window_days)
    past = current_telemetry(spark, base, lookback_day(day, lookback_days))
    if past.status != RESOLVED:
        status = IMMATURE if past.status == NO_TRAFFIC else past.status
        return Lookback(past.scores, spark.createDataFrame([], NO_LABELS), status)
    return Lookback(past.scores, matured_labels(past.scores, targets), MATURED)


def partition_statuses(table: DataFrame, first: str, last: str, lookback_days: int = 30) -> DataFrame:
    """Rows and status of every day from ``first`` to ``last`` and of its look-back day.

    One pass over the partitions concerned; days without a partition show up with
    zero rows.
    """
    spark = table.sparkSession
    start, stop = (F.lit(parse_instant(d).date()) for d in (first, last))
    days = spark.range(1).select(F.explode(F.sequence(start, stop)).alias("day"))
    calendar = days.withColumn("lookback_day", F.date_sub("day", lookback_days))
    kept = within_days(table, lookback_day(first, lookback_days), last)
    rows = kept.groupBy(partition_day(kept).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    then = rows.withColumnsRenamed({"day": "lookback_day", "n": "then_n"})
    today, past = F.coalesce("n", F.lit(0)), F.coalesce("then_n", F.lit(0))
    return (
        calendar.join(rows, "day", "left")
        .join(then, "lookback_day", "left")
        .select(
            "day",
            "lookback_day",
            today.alias("n_rows"),
            F.when(today > 0, RESOLVED).otherwise(NO_TRAFFIC).alias("status"),
            past.alias("n_lookback_rows"),
            F.when(past > 0, MATURED).otherwise(IMMATURE).alias("lookback_status"),
        )
    )
