"""Quality gates on the bronze tables and the contract check before scoring."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.stamps import instant, parse_window, plus_days, stamp, within_days, within_window

# The columns each table cannot do without.
CRITICAL_COLUMNS = {
    "orders": ("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
    "customers": ("customer_id", "customer_unique_id"),
    "order_payments": ("order_id", "payment_value"),
}

VIOLATION = "table_name string, check_name string, column_name string, n bigint, severity string, message string"


class GateError(ValueError):
    """A table failed a quality gate."""


class GatePolicy(NamedTuple):
    schema_checks: bool = True
    null_checks: bool = True
    strict: bool = True
    fail_fast: bool = True


def missing_columns(name: str, df: DataFrame) -> list[str]:
    return [c for c in CRITICAL_COLUMNS.get(name, ()) if c not in df.columns]


def in_window(name: str, df: DataFrame, start: str, end: str) -> DataFrame:
    """Orders by day and exact time; the other tables by day only."""
    if name == "orders":
        return within_window(df, "order_purchase_timestamp", start, end)
    return within_days(df, start, end)


def audit_table(name: str, df: DataFrame, start: str, end: str) -> DataFrame:
    """Row count and NULL counts of one table's window in a single scan.

    The row count is the row without a column name.
    """
    parse_window(start, end)
    columns = [c for c in CRITICAL_COLUMNS.get(name, ()) if c in df.columns]
    counts = in_window(name, df, start, end).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)),
    )
    entries = [F.struct(F.lit(None).cast("string").alias("column_name"), F.col("rows").alias("n"))]
    entries += [
        F.struct(F.lit(c).alias("column_name"), F.col(f"null_{i}").alias("n"))
        for i, c in enumerate(columns)
    ]
    return counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*entries)))


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def window_counts(tables: Mapping[str, DataFrame], start: str, end: str) -> DataFrame:
    """Rows of each table inside the window."""
    audits = _union(audit_table(name, df, start, end) for name, df in tables.items())
    return audits.where(F.col("column_name").isNull()).select("table_name", F.col("n").alias("n_rows"))


def null_counts(tables: Mapping[str, DataFrame], start: str, end: str) -> DataFrame:
    """NULLs of each critical column inside the window."""
    audits = _union(audit_table(name, df, start, end) for name, df in tables.items())
    return audits.where(F.col("column_name").isNotNull()).select(
        "table_name", "column_name", F.col("n").alias("n_null")
    )


def table_violations(
    name: str, df: DataFrame, start: str, end: str, policy: GatePolicy = GatePolicy()
) -> DataFrame:
    """Broken rules of one table; NULLs are errors only under a strict policy."""
    spark = df.sparkSession
    missing = missing_columns(name, df) if policy.schema_checks else []
    if missing:
        message = f"{name}: no column {', '.join(missing)}"
        rows = [(name, "schema", c, None, "ERROR", message) for c in missing]
        return spark.createDataFrame(rows, VIOLATION)
    is_count = F.col("column_name").isNull()
    empty = is_count & (F.col("n") == 0)
    nulls = ~is_count & (F.col("n") > 0) if policy.null_checks else F.lit(False)
    empty_text = F.lit(f"{name}: no rows from {start} up to {end}")
    null_text = F.format_string(f"{name}: %2$d NULLs in %1$s", "column_name", "n")
    return audit_table(name, df, start, end).where(empty | nulls).select(
        "table_name",
        F.when(is_count, "empty_window").otherwise("nulls").alias("check_name"),
        "column_name",
        "n",
        F.when(is_count | F.lit(policy.strict), "ERROR").otherwise("WARN").alias("severity"),
        F.when(is_count, empty_text).otherwise(null_text).alias("message"),
    )


def violations(
    tables: Mapping[str, DataFrame], start: str, end: str, policy: GatePolicy = GatePolicy()
) -> DataFrame:
    return _union(table_violations(name, df, start, end, policy) for name, df in tables.items())


def enforce_gates(
    tables: Mapping[str, DataFrame], start: str, end: str, policy: GatePolicy = GatePolicy()
) -> list:
    """Raise :class:`GateError` on broken rules; return the warnings.

    Fail-fast stops at the first bad table. Otherwise the first error of every
    bad table goes into one message.
    """
    def errors_of(found: list) -> list[str]:
        worst: dict[str, str] = {}
        for row in found:
            if row.severity == "ERROR":
                worst.setdefault(row.table_name, row.message)
        return list(worst.values())

    if policy.fail_fast:
        seen = []
        for name, df in tables.items():
            found = table_violations(name, df, start, end, policy).collect()
            errors = errors_of(found)
            if errors:
                raise GateError(errors[0])
            seen += found
        return seen
    found = violations(tables, start, end, policy).collect()
    errors = errors_of(found)
    if errors:
        raise GateError("; ".join(errors))
    return found


# --- checks on the labels' ground ------------------------------------------------------


def censoring_warning(orders: DataFrame, end: str, window_days: int = 180) -> DataFrame:
    """One WARN row where the data stop before the label window does.

    A single order at or after the window's end settles it, so only later days are
    looked at, and no further than the first such order.
    """
    name, last = "order_purchase_timestamp", plus_days(end, window_days)
    later = within_days(orders, last, "9999-12-31")
    found = later.where(stamp(later, name) >= instant(last, later, name)).limit(1)
    return found.agg(F.count(F.lit(1)).alias("found")).where(F.col("found") == 0).select(
        F.lit("orders").alias("table_name"),
        F.lit("right_censored").alias("check_name"),
        F.lit(name).alias("column_name"),
        F.lit(None).cast("bigint").alias("n"),
        F.lit("WARN").alias("severity"),
        F.lit(f"no order at or after {last}: the label window is cut short").alias("message"),
    )


def repeated_keys_warning(df: DataFrame, name: str = "customers", key: str = "customer_id") -> DataFrame:
    """One WARN row where a join key repeats and would multiply money."""
    repeats = df.groupBy(key).count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("n"))
    return repeats.where(F.col("n") > 0).select(
        F.lit(name).alias("table_name"),
        F.lit("repeated_key").alias("check_name"),
        F.lit(key).alias("column_name"),
        "n",
        F.lit("WARN").alias("severity"),
        F.format_string(f"%d values of {key} repeat", "n").alias("message"),
    )


# --- contract before scoring -----------------------------------------------------------


def observed_schema(df: DataFrame) -> DataFrame:
    """Column names and types of a table as rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "name string, physical_type string")


def contract_missing(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Names the contract asks for and the table does not have. Types are not compared."""
    return expected.select("name").distinct().join(actual.select("name"), "name", "left_anti")


class ContractResult(NamedTuple):
    passed: bool
    missing: list[str]

    @property
    def status(self) -> str:
        return "PASSED" if self.passed else "FAILED"


def check_contract(
    matrix: DataFrame, features: Iterable[str], system_columns: Iterable[str] = ()
) -> ContractResult:
    """Compare column names; only names travel, so no job runs."""
    missing = sorted((set(features) | set(system_columns)) - set(matrix.columns))
    return ContractResult(not missing, missing)


def require_contract(
    matrix: DataFrame, features: Iterable[str], system_columns: Iterable[str] = ()
) -> None:
    result = check_contract(matrix, features, system_columns)
    if not result.passed:
        raise GateError(f"Scoring halted, the matrix lacks {result.missing}")


def require_rows(matrix: DataFrame) -> None:
    if matrix.isEmpty():
        raise GateError("there is nobody to score")


def fingerprint(df: DataFrame, start: str, end: str) -> DataFrame:
    """Row count, window and a short hash of the column names in their order.

    Only names count, and they are joined without a separator.
    """
    names = F.lit("".join(df.columns))
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.substring(F.md5(names), 1, 10).alias("columns_hash"),
        "row_count",
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
    )


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a stored table, answered without reading a column."""
    return spark.read.parquet(path).count()
