"""Long texts as overlapping chunks, each a row of its own, and the junctions between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def in_order() -> WindowSpec:
    """The chunks of one text."""
    return Window.partitionBy("key").orderBy("nth")


def text_key() -> Column:
    """Names a text; equal texts share the work and the result."""
    return F.sha2(F.col("text"), 256).alias("key")


def overlapping(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, text) to (key, nth, start, part): chunk `nth` starts at nth * chunk and
    reaches `overlap` characters into the next one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for nth, start in enumerate(range(0, max(1, len(text)), chunk)):
                    part = text[start : start + chunk + overlap]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([nth], pa.int64()), pa.array([start], pa.int64()), pa.array([part])], names=["key", "nth", "start", "part"]
                    )

    cut_up = texts.select("key", "text").mapInArrow(cut, "key string, nth bigint, start bigint, part string")
    # Chunks of one text go to many tasks.
    return cut_up.repartition("key", "nth")


def agreed(tail: str, head: str) -> Column:
    """First position of the overlap that this chunk and the next both call a boundary."""
    return F.array_min(F.array_intersect(F.col(tail), F.lead(head).over(in_order())))
