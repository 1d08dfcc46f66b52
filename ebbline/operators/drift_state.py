"""Drift over any window from stored counts: telemetry is read once, on its own day.

What a day leaves behind is its number of rows per feature and cell of the frozen
profile, a table of bounded size whatever the traffic. Counts of days add up, so the
index of a window is that of the summed counts, exactly as if all its rows were counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.stamps import parse_instant, partition_day
from ebbline.operators.drift import PSI_EPSILON, cell_counts, index_of_counts, profile_cells
from ebbline.sources.commits import publish_day, read_days


def day_counts(telemetry: DataFrame, profile: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, cell, n) of one day of telemetry."""
    return cell_counts(telemetry, profile_cells(profile, features), features)


def publish_counts(telemetry: DataFrame, profile: DataFrame, features: Sequence[str], table: str, day: str, rerun: bool = False) -> bool:
    """Store the counts of a day; False if the day has them already. A rerun takes their place."""
    base, _, name = table.rstrip("/").rpartition("/")
    return publish_day({name: day_counts(telemetry, profile, features)}, base, day, rerun=rerun)


def window_counts(counts: DataFrame, ends: Sequence[str], width: int) -> DataFrame:
    """(window_end, feature, cell, n): counts of the ``width`` days up to and including each end.

    ``counts`` has year, month and day. A day is added to every window that holds it;
    a window without any day has no rows.
    """
    last = F.explode(F.array(*[F.lit(parse_instant(e).date()) for e in ends])).alias("window_end")
    rows = counts.select(partition_day(counts).alias("of_day"), "feature", "cell", "n", last)
    inside = (F.col("of_day") <= F.col("window_end")) & (F.col("of_day") > F.date_sub("window_end", width))
    return rows.where(inside).groupBy("window_end", "feature", "cell").agg(F.sum("n").alias("n"))


def window_stability(
    spark: SparkSession,
    table: str,
    profile: DataFrame,
    features: Sequence[str],
    ends: Sequence[str],
    width: int = 30,
    epsilon: float = PSI_EPSILON,
) -> DataFrame:
    """(window_end, feature, psi) of every window from the stored counts of its days."""
    counts = window_counts(read_days(spark, table), ends, width)
    return index_of_counts(counts, profile_cells(profile, features), ["window_end"], epsilon)
