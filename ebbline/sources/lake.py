"""The partitioned lake: ingest, layout by day, availability."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbline.functions.stamps import (
    PARTITION_COLUMNS,
    parse_window,
    stamp,
    window_months,
    with_partition_keys,
)
from ebbline.functions.values import null_for_nan
from ebbline.sources.records import read_records

log = logging.getLogger(__name__)

ORDER_STAMPS = (
    "order_purchase_timestamp",
    "order_estimated_delivery_date",
    "order_delivered_customer_date",
)
# Fixed value: what is said of a table without a month of the window.
NO_OVERLAP = "(No temporal overlap)"
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


# --- reading ---------------------------------------------------------------------------


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A Parquet table; its Hive partition columns become ordinary columns."""
    return null_for_nan(spark.read.parquet(f"{base}/{name}"))


def read_if_present(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """The Parquet data under ``path``, or None where nothing has been written."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return null_for_nan(reader.parquet(path))
    except AnalysisException as problem:
        if problem.getCondition() in ABSENT:
            return None
        raise


# --- CSV ingest ------------------------------------------------------------------------


def csv_files(spark: SparkSession, folder: str) -> list[str]:
    """Every ``*.csv`` below ``folder``; only the listing is read, not the contents."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select("path")
    )
    return sorted(row.path for row in found.collect())


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """One CSV file with a header row; quotes inside a field are doubled.

    A large file is split among tasks, with ``multi_line`` also one whose fields hold
    line breaks. A row with too few or too many fields is an error unless ``mode`` is
    PERMISSIVE, which fills up the short and cuts off the long ones.
    """
    if multi_line:
        return read_records(spark, path, schema, mode)
    reader = spark.read.option("header", "true").option("escape", '"').option("mode", mode)
    return (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(path)


def _below(path: str, folder: str) -> str:
    """The part of a file's path below a folder, whatever scheme either is written with."""
    tail = folder.split("://", 1)[-1].removeprefix("file:").strip("/")
    return path.split(f"/{tail}/", 1)[-1] if f"/{tail}/" in path else path.rsplit("/", 1)[-1]


def ingest_csv(
    spark: SparkSession,
    folder: str,
    out: str,
    schemas: Mapping[str, StructType] | None = None,
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> dict[str, bool]:
    """Write ``<out>/raw_data/<path of the file>`` as Parquet for every CSV file found.

    Tables are named by the file's path below ``folder`` without its ending, so
    files of one name in two folders are two tables. A file that cannot be read is
    logged and skipped: it is first written aside, and only a whole copy replaces
    the table of an earlier run. The result says which files were written.
    """
    written = {}
    for path in csv_files(spark, folder):
        name = _below(path, folder).removesuffix(".csv")
        schema = (schemas or {}).get(name) or (schemas or {}).get(name.rsplit("/", 1)[-1])
        try:
            table = read_csv(spark, path, schema, multi_line, mode)
            if not table.columns:
                raise ValueError("no header row")
            aside = f"{out}/_incoming/{name}"
            table.write.mode("overwrite").option("compression", "snappy").parquet(aside)
            whole = spark.read.schema(table.schema).parquet(aside)
            whole.write.mode("overwrite").option("compression", "snappy").parquet(f"{out}/raw_data/{name}")
            written[name] = True
        except Exception as problem:  # one bad file must not stop the others
            log.warning("skipped %s: %s", path, problem)
            written[name] = False
    return written


# Values are written as they are: by default the writer trims them.
CSV_OUT = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OUT).csv(path)


# --- layout by day ---------------------------------------------------------------------


def orders_by_day(orders: DataFrame) -> DataFrame:
    """Orders with typed timestamps and the partition keys of their purchase day."""
    typed = orders.withColumns({c: stamp(orders, c) for c in ORDER_STAMPS if c in orders.columns})
    return with_partition_keys(typed, "order_purchase_timestamp")


def _order_days(orders: DataFrame, key: str) -> DataFrame:
    days = with_partition_keys(orders.select(key, "order_purchase_timestamp"), "order_purchase_timestamp")
    return days.select(key, *PARTITION_COLUMNS)


def customers_by_day(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with the day of each of their orders; without an order they vanish."""
    plain = customers.drop(*PARTITION_COLUMNS)
    return plain.join(_order_days(orders, "customer_id"), "customer_id")


def payments_by_day(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments with the day of their order; orphans vanish."""
    plain = payments.drop(*PARTITION_COLUMNS)
    return plain.join(_order_days(orders, "order_id"), "order_id")


def write_by_day(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a table partitioned by ``year``/``month``/``day``.

    The rebalance hint groups rows by day before the write, so a day gets few
    files of a sensible size, and lets adaptive execution split a day that holds
    far more rows than the others.
    """
    (
        df.hint("rebalance", *PARTITION_COLUMNS)
        .write.partitionBy(*PARTITION_COLUMNS)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")  # other days stay
        .mode(mode)
        .parquet(path)
    )


def write_lake(orders: DataFrame, customers: DataFrame, payments: DataFrame, base: str) -> None:
    """Write the three tables by the day of the order."""
    write_by_day(orders_by_day(orders), f"{base}/orders")
    write_by_day(customers_by_day(customers, orders), f"{base}/customers")
    write_by_day(payments_by_day(payments, orders), f"{base}/order_payments")


def write_run_table(df: DataFrame, store: str, run_id: str, name: str = "dataset") -> str:
    """Write a table of one run; a run is never overwritten."""
    path = f"{store}/{run_id}/{name}"
    df.write.option("compression", "snappy").mode("errorifexists").parquet(path)
    return path


# --- availability ----------------------------------------------------------------------


def months_present(df: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct (year, month) of the table within the months the window touches."""
    months = window_months(start, end)
    number = F.col("year").cast("int") * 12 + F.col("month").cast("int")
    first, last = (y * 12 + m for y, m in (months[0], months[-1]))
    return (
        df.where(number.between(first, last))
        .select(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
        .distinct()
    )


def missing_datasets(
    spark: SparkSession, base: str, names: Iterable[str], start: str, end: str
) -> list[str]:
    """Tables that do not exist or hold no month of the window.

    The month test reads at most one row: its predicate prunes directories.
    """
    parse_window(start, end)
    months = window_months(start, end)
    first, last = (y * 12 + m for y, m in (months[0], months[-1]))
    missing = []
    for name in names:
        table = read_if_present(spark, f"{base}/{name}")
        if table is None:
            missing.append(name)
            continue
        number = F.col("year").cast("int") * 12 + F.col("month").cast("int")
        if table.where(number.between(first, last)).isEmpty():
            missing.append(f"{name} {NO_OVERLAP}")
    return missing


def require_datasets(
    spark: SparkSession, base: str, names: Iterable[str], start: str, end: str
) -> None:
    missing = missing_datasets(spark, base, names, start, end)
    if missing:
        raise FileNotFoundError(f"not in the lake: {', '.join(missing)}")
