"""Timestamps, cutoffs and partition days."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMNS = ("year", "month", "day")


def parse_instant(text: str) -> datetime:
    """Read ``YYYY-MM-DD`` or ``YYYY-MM-DD HH:MM:SS``."""
    for pattern in ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S"):
        try:
            return datetime.strptime(text, pattern)
        except ValueError:
            continue
    raise ValueError(f"not a date or timestamp: {text!r}")


def parse_window(start: str, end: str) -> tuple[datetime, datetime]:
    """Both bounds of a half-open window; the start must come first."""
    first, last = parse_instant(start), parse_instant(end)
    if first >= last:
        raise ValueError(f"start {start!r} must come before end {end!r}")
    return first, last


def plus_days(text: str, days: int) -> str:
    return (parse_instant(text) + timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")


def stamp(df: DataFrame, name: str) -> Column:
    """A timestamp column; text that does not parse becomes NULL.

    Typed columns are passed through untouched, so that comparisons with
    :func:`instant` still reach the Parquet reader.
    """
    kind = df.schema[name].dataType
    column = df[name]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column
    if isinstance(kind, T.DateType):
        return column.cast("timestamp_ntz")
    return column.try_cast("timestamp_ntz")


def instant(text: str, df: DataFrame, name: str) -> Column:
    """A timestamp literal of the type :func:`stamp` gives for ``name``."""
    moment = parse_instant(text).strftime("%Y-%m-%d %H:%M:%S")
    zoned = isinstance(df.schema[name].dataType, T.TimestampType)
    return F.lit(moment).cast("timestamp" if zoned else "timestamp_ntz")


def has_partition_days(df: DataFrame) -> bool:
    return set(PARTITION_COLUMNS) <= set(df.columns)


def partition_day(df: DataFrame) -> Column:
    return F.make_date(*(df[c].cast("int") for c in PARTITION_COLUMNS))


def within_days(df: DataFrame, start: str, end: str) -> DataFrame:
    """Keep the partition days from ``start`` to ``end``, both included.

    Only dates are compared. On a Hive table the predicate touches nothing but
    partition columns and therefore prunes directories. A table without
    partition columns is returned as it is.
    """
    if not has_partition_days(df):
        return df
    first, last = parse_instant(start).date(), parse_instant(end).date()
    return df.where(partition_day(df).between(F.lit(first), F.lit(last)))


def within_window(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    """Keep ``start <= name < end`` after pruning the partition days."""
    pruned = within_days(df, start, end)
    when = stamp(pruned, name)
    return pruned.where((when >= instant(start, pruned, name)) & (when < instant(end, pruned, name)))


def with_partition_keys(df: DataFrame, name: str) -> DataFrame:
    """Add zero-padded ``year``, ``month`` and ``day`` taken from a timestamp."""
    when = stamp(df, name)
    return df.withColumns(
        {
            "year": F.date_format(when, "yyyy"),
            "month": F.date_format(when, "MM"),
            "day": F.date_format(when, "dd"),
        }
    )


def window_months(start: str, end: str) -> list[tuple[int, int]]:
    """(year, month) pairs touched by the days from ``start`` to ``end``, both included."""
    first, last = parse_instant(start), parse_instant(end)
    span = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [(n // 12, n % 12 + 1) for n in span]
