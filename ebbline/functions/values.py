"""Numbers: missing values, money, stable hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HASH_RANGE = float(1 << 32)


def is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def null_for_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column."""
    fixes = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema if is_float(f.dataType)
    }
    return df.withColumns(fixes) if fixes else df


def number(df: DataFrame, name: str) -> Column:
    """A column as double: text that is no number and NaN are NULL."""
    kind = df.schema[name].dataType
    column = df[name].try_cast("double") if isinstance(kind, T.StringType) else df[name].cast("double")
    return F.when(~F.isnan(column), column)


def round_half_up(value: Column, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d``: one plain formula any SQL engine repeats exactly."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def exact_cents(value: Column) -> Column:
    """Money as a decimal, so that its sum does not depend on row order."""
    return value.cast("decimal(18,2)")


def unit_hash(seed: int | str, key: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the seed and the key.

    Unlike ``rand`` it gives a row the same draw whatever its partition, its
    place in the scan or the number of retries of its task.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_HASH_RANGE)
