"""Days of tables published by commit: readers follow a table of commits, never a folder as it stands.

Every publication writes its files into a folder of its own below the day
(``version=<id>``) and then appends one row to the table ``commits`` beside the tables.
That row, a single file that appears at once, makes all tables of the day visible
together. A publication that dies before it leaves files nobody reads; the day stays as
it was committed before.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbline.functions.stamps import PARTITION_COLUMNS, parse_instant
from ebbline.sources.lake import CSV_OUT, read_if_present

log = logging.getLogger(__name__)

LOG = "commits"
COMMIT = "day date, number bigint, version string, kinds map<string,string>, schemas map<string,string>"


def _date(day: str | date) -> date:
    day = day if isinstance(day, (date, datetime)) else parse_instant(day)
    return day.date() if isinstance(day, datetime) else day


def day_folder(base: str, day: str | date) -> str:
    day = _date(day)
    return f"{base}/year={day.year}/month={day.month:02d}/day={day.day:02d}"


def _split(table: str) -> tuple[str, str]:
    base, _, name = table.rstrip("/").rpartition("/")
    return base, name


def commits(spark: SparkSession, base: str) -> DataFrame:
    """All commits of the tables below ``base``."""
    found = read_if_present(spark, f"{base}/{LOG}", COMMIT)
    return spark.createDataFrame([], COMMIT) if found is None else found


def current_commits(spark: SparkSession, table: str) -> DataFrame:
    """The last commit of every day of one table: one row a day."""
    base, name = _split(table)
    mine = commits(spark, base).where(F.array_contains(F.map_keys("kinds"), name))
    last = mine.groupBy("day").agg(F.max_by(F.struct("version", "kinds", "schemas"), F.struct("number", "version")).alias("last"))
    return last.select("day", "last.*")


def _commit_of(spark: SparkSession, table: str, day: str | date):
    return current_commits(spark, table).where(F.col("day") == F.lit(_date(day))).first()


def day_is_complete(spark: SparkSession, table: str, day: str | date) -> bool:
    """Whether the day of a table has been committed."""
    return _commit_of(spark, table, day) is not None


def write_day(df: DataFrame, table: str, day: str | date, kind: str = "parquet", version: str | None = None) -> str:
    """Write a version of a day, which nobody reads before it is committed; its id."""
    version = version or uuid.uuid4().hex
    writer = df.drop(*PARTITION_COLUMNS).write.mode("errorifexists")
    folder = f"{day_folder(table, day)}/version={version}"
    if kind == "csv":
        writer.options(**CSV_OUT).csv(folder)
    else:
        writer.option("compression", "snappy").parquet(folder)
    return version


def commit_day(tables: Mapping[str, DataFrame], base: str, day: str | date, version: str, kinds: Mapping[str, str] | None = None) -> None:
    """Make a written version of a day of these tables the one that is read."""
    spark = next(iter(tables.values())).sparkSession
    before = commits(spark, base).where(F.col("day") == F.lit(_date(day))).agg(F.max("number")).first()[0]
    kind_of = {name: (kinds or {}).get(name, "parquet") for name in tables}
    schemas = {name: df.drop(*PARTITION_COLUMNS).schema.json() for name, df in tables.items()}
    row = (_date(day), (before or 0) + 1, version, kind_of, schemas)
    spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("append").parquet(f"{base}/{LOG}")


def publish_day(
    tables: Mapping[str, DataFrame],
    base: str,
    day: str | date,
    kinds: Mapping[str, str] | None = None,
    rerun: bool = False,
) -> bool:
    """Publish one day of several tables together; False where it was committed before.

    A ``rerun`` replaces the day: its old version is read until the new one has been
    written whole, for all tables.
    """
    names = list(tables)
    spark = tables[names[0]].sparkSession
    if not rerun and day_is_complete(spark, f"{base}/{names[0]}", day):
        log.info("day %s is committed, nothing to do", day)
        return False
    version = uuid.uuid4().hex
    for name in names:
        write_day(tables[name], f"{base}/{name}", day, (kinds or {}).get(name, "parquet"), version)
    commit_day(tables, base, day, version, kinds)
    return True


def _reader(spark: SparkSession, kind: str, schema: StructType):
    reader = spark.read.schema(schema)
    return reader.format("csv").option("header", "true").option("escape", '"') if kind == "csv" else reader.format("parquet")


def read_day(spark: SparkSession, table: str, day: str | date) -> DataFrame | None:
    """A day of a table as last committed, or None; only the files of that version are listed."""
    last = _commit_of(spark, table, day)
    if last is None:
        return None
    name = _split(table)[1]
    schema = StructType.fromJson(json.loads(last.schemas[name]))
    return _reader(spark, last.kinds[name], schema).load(f"{day_folder(table, day)}/version={last.version}")


def read_days(spark: SparkSession, table: str) -> DataFrame:
    """All committed days of a Parquet table, with year, month and day.

    The versions to read are one row a day; Spark prunes the other folders at run time.
    """
    last = current_commits(spark, table).select(F.col("version").alias("of"))
    rows = spark.read.parquet(table)
    return rows.join(last, F.col("version").cast("string") == F.col("of"), "left_semi").drop("version")
