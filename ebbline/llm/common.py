"""What the operators of this folder share: tables, folds, batches, size-checked broadcasts, the driver's memory."""

from __future__ import annotations

import ctypes
from collections.abc import Sequence
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ebbline.session import store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows of one Arrow batch. Documents differ in size by factors of thousands, so
# a batch is kept to few rows and a Python worker holds little at a time.
BATCH_ROWS = 1024
BATCH_BYTES = "4m"

# A table is broadcast only if its rows, written down, were found to be below this.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


# What stands between words of letters, digits and characters beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced_words(name: str) -> Column:
    """The words of a text in lower case, each between two blanks: " a b "; " " without any."""
    return F.concat(F.lit(" "), F.ltrim(F.regexp_replace(F.concat(lower_ascii(F.col(name)), F.lit(" ")), SEPARATORS, " ")))


def text_keys(docs: DataFrame) -> list[Column]:
    """Two hashes that name a document and its text together; never null."""
    return [F.xxhash64(docs["doc_id"], docs["text"]).alias("key1"), F.xxhash64(F.lit("text"), docs["text"], docs["doc_id"]).alias("key2")]


def carried(docs: DataFrame, keep: Sequence[str]) -> Column:
    """The columns that travel through a Python step untouched, whatever their names."""
    return F.struct(*[docs[f"`{name}`"].alias(name) for name in keep]).alias("row")


def added(rows: DataFrame, **columns: str) -> StructType:
    """Schema of a Python step that returns `row` and these columns."""
    own = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in columns.items()))
    return StructType([StructField("row", rows.schema["row"].dataType), *own.fields])


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds."""
    return F.crc32(key.cast("string")) % folds


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A table written once, with a broadcast hint only if it was counted to be small.

    Beyond the bound the plan is an ordinary shuffled join with the same rows.
    """
    kept = store(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def give_back() -> None:
    """Memory that Python has freed goes back to the system.

    Arrow and the C library keep it for later arrays; in the driver, which fits a model once
    and then waits for jobs, it would stay beside the JVM's. Other C libraries have no such call.
    """
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)
