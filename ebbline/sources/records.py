"""CSV whose fields hold line breaks, read by many tasks.

Spark splits a file among tasks at line ends, which may lie inside a quoted field.
Whether a line begins inside one depends on nothing but the number of quotes before it:
odd is inside. So one pass counts the quotes of every split, running sums over the
splits of a file say how each begins, and a second pass joins the lines of records.
What a record has in other splits than its first, at most one piece a split, is put
together at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

QUOTE = '"'
WHOLE, BEGUN, CARRIED = 0, 1, 2  # a record; the beginning of one; what an earlier split's record goes on with
PIECES = "path string, start bigint, nth bigint, kind int, is_header boolean, text string"
# Types that a column without a schema may turn out to have, the narrowest first.
TYPES = ("int", "bigint", "double", "timestamp", "boolean")


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    meta = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    return spark.read.option("lineSep", "\n").text(paths).select("value", *meta)


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(QUOTE), F.lit("")))


def splits(lines: DataFrame) -> DataFrame:
    """(path, start, is_open): every split of every file, and whether it begins inside a quoted field."""
    counted = lines.groupBy("path", "start").agg((F.sum(_quotes("value")) % 2).alias("odd"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("path", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("is_open"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("nth", pa.int64()), ("kind", pa.int32()), ("is_header", pa.bool_()), ("text", pa.string())])
    split: tuple | None = None
    held: list[str] = []
    inside, kind, nth = False, WHOLE, 0
    out: list[tuple] = []

    def close(kind: int) -> None:
        nonlocal nth
        out.append((*split, nth, kind, split[1] == 0 and nth == 0, "\n".join(held)))
        nth += 1
        held.clear()

    for batch in batches:
        for value, path, start, is_open in zip(*(c.to_pylist() for c in batch.columns)):
            if split != (path, start):
                if held:
                    close(CARRIED if kind == CARRIED else BEGUN)
                split, inside, nth = (path, start), is_open, 0
                kind = CARRIED if is_open else WHOLE
            held.append(value)
            inside ^= value.count(QUOTE) % 2 == 1
            if not inside:
                close(kind)
                kind = WHOLE
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
    if held:
        close(CARRIED if kind == CARRIED else BEGUN)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, is_header, text): every record of CSV files, whatever line breaks its quoted fields hold.

    Blank lines are no records. The first record of a file is its header.
    """
    lines = _lines(spark, paths)
    # One row a split, so a row for some hundred megabytes; a broadcast keeps the lines of a split in order.
    at = splits(lines).select(F.col("path").alias("of"), F.col("start").alias("at"), "is_open")
    marked = lines.join(F.broadcast(at), (F.col("path") == F.col("of")) & (F.col("start") == F.col("at")))
    pieces = marked.select("value", "path", "start", "is_open").mapInArrow(_pieces, PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("path", "is_header", "text")
    order = Window.partitionBy("path").orderBy("start", "nth")
    apart = pieces.where(F.col("kind") != WHOLE).withColumn("record", F.sum((F.col("kind") == BEGUN).cast("int")).over(order))
    joined = apart.groupBy("path", "record").agg(
        F.bool_or("is_header").alias("is_header"), F.array_sort(F.collect_list(F.struct("start", "nth", "text"))).alias("parts")
    )
    both = whole.unionByName(joined.select("path", "is_header", F.array_join("parts.text", "\n").alias("text")))
    return both.withColumn("text", F.rtrim("text", F.lit("\r"))).where(F.trim("text") != "")


def _narrowed(rows: DataFrame) -> StructType:
    """The narrowest type that every value of a text column can be read as; text if none can."""
    misses = [
        F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull()).alias(f"{k}_{t}")
        for k, c in enumerate(rows.columns)
        for t in TYPES
    ]
    found = rows.agg(*misses, *[F.count(f"`{c}`").alias(f"{k}_n") for k, c in enumerate(rows.columns)]).first()
    kind = lambda k: next((t for t in TYPES if found[f"{k}_n"] and not found[f"{k}_{t}"]), "string")
    return StructType.fromDDL(", ".join(f"`{c}` {kind(k)}" for k, c in enumerate(rows.columns)))


def read_records(spark: SparkSession, paths: str | list[str], schema: StructType | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Files of one schema as one table; the files' first records name the columns where no schema is given.

    A record with too few or too many fields, or a value that its type does not take, is an
    error unless ``mode`` is PERMISSIVE. Without a schema the narrowest types are taken
    that hold every value, which takes one more pass.
    """
    found = records(spark, paths)
    options = {"escape": QUOTE, "mode": mode}

    def parsed(kinds: StructType) -> DataFrame:
        rows = found.where(~F.col("is_header")).select(F.from_csv("text", _ddl(kinds), options).alias("row"))
        return rows.select("row.*")

    if schema is None:
        header = found.where("is_header").agg(F.min("text")).first()[0]
        if header is None:
            raise ValueError("no header row")
        line = spark.createDataFrame([(header,)], "text string")
        width = header.count(",") + 1
        names = line.select(F.from_csv("text", ", ".join(f"c{i} string" for i in range(width)), {"escape": QUOTE}).alias("row")).first().row
        text = StructType([StructField(n, StringType()) for n in names if n is not None])
        schema = _narrowed(parsed(text))
    return parsed(schema)


def _ddl(kinds: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
