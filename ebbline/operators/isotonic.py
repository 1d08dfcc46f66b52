"""Isotonic regression at any size: pool adjacent violators by ranges of the score.

Equal scores are one point. Points are dealt over tasks by ranges of the score, and
each range reduces to its stack of blocks with rising means. Then neighbouring ranges
are merged in order, two by two: only blocks of the left one above the least mean of
the right one, and of the right one below the greatest of the left one, can be pooled,
so only those meet in a task. All others stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.names import PREDICTION
from ebbline.session import store

# A score looks for its block among those of its cell; there are this many cells between 0 and 1.
CELLS = 1 << 16
BLOCKS = "range bigint, low double, high double, total double, weight double"
SCHEMA = pa.schema([("range", pa.int64()), *((c, pa.float64()) for c in ("low", "high", "total", "weight"))])


Block = tuple[float, float, float, float]


def pool(rows: Iterable[Block], stack: list[Block]) -> list[Block]:
    """The stack with blocks (low, high, total, weight) put on it in order, pooled until the means rise."""
    for low, high, total, weight in rows:
        while stack and stack[-1][2] * weight >= total * stack[-1][3]:
            before = stack.pop()
            low, total, weight = before[0], before[2] + total, before[3] + weight
        stack.append((low, high, total, weight))
    return stack


def _stacks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stack of the range that a task was dealt."""
    held: list[Block] = []
    for batch in batches:
        pool(zip(*(c.to_pylist() for c in batch.columns)), held)
    yield _batch(TaskContext.get().partitionId(), held)


def _batch(number: int, blocks: list[Block]) -> pa.RecordBatch:
    columns = list(zip(*blocks)) if blocks else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array([number] * len(blocks), pa.int64()), *(pa.array(c, pa.float64()) for c in columns)], schema=SCHEMA)


def _merged(table: pa.Table) -> pa.Table:
    blocks = sorted(zip(*(table.column(c).to_pylist() for c in ("low", "high", "total", "weight"))))
    return pa.Table.from_batches([_batch(table.column("range")[0].as_py(), pool(blocks, []))])


def isotonic_blocks(scored: DataFrame, score: str = PREDICTION, label: str = "label", ranges: int | None = None) -> DataFrame:
    """(low, high, weight, value): the isotonic fit of the label as blocks of equal value.

    Rows without a score or a label (NULL or NaN) are left out; without any there are no
    blocks. ``ranges`` sets how many ranges are dealt; the fit does not depend on it.
    """
    x, y = F.col(score).cast("double"), F.col(label).cast("double")
    there = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    points = scored.where(there).groupBy(x.alias("low")).agg(F.sum(y).alias("total"), F.count(F.lit(1)).cast("double").alias("weight"))
    points = points.select("low", F.col("low").alias("high"), "total", "weight")
    dealt = points.repartitionByRange("low") if ranges is None else points.repartitionByRange(ranges, "low")
    blocks = store(dealt.sortWithinPartitions("low").mapInArrow(_stacks, BLOCKS))
    last = blocks.agg(F.max("range")).first()[0] or 0
    for level in range(int(last).bit_length()):
        blocks = store(_merge_pairs(blocks, level))
    return blocks.select("low", "high", "weight", (F.col("total") / F.col("weight")).alias("value"))


def _merge_pairs(blocks: DataFrame, level: int) -> DataFrame:
    """Merge ranges 2k and 2k + 1, counted in groups of 2 ** level."""
    pair, mean = F.shiftright("range", level + 1), F.col("total") / F.col("weight")
    is_left = F.shiftright("range", level) % 2 == 0
    marked = blocks.select("*", pair.alias("pair"), is_left.alias("is_left"), mean.alias("mean"))
    edges = marked.groupBy(F.col("pair").alias("of")).agg(
        F.max(F.when(F.col("is_left"), F.col("mean"))).alias("top"), F.min(F.when(~F.col("is_left"), F.col("mean"))).alias("bottom")
    )
    met = F.when(F.col("is_left"), F.col("mean") >= F.col("bottom")).otherwise(F.col("mean") <= F.col("top"))
    joined = marked.join(edges, F.col("pair") == F.col("of"), "left").withColumn("met", F.coalesce(met, F.lit(False)))
    plain = ["range", "low", "high", "total", "weight"]
    kept = joined.where(~F.col("met")).select(*plain)

    def merge(table: pa.Table) -> pa.Table:
        return _merged(table)

    pooled = joined.where("met").select(F.shiftleft("pair", level + 1).alias("range"), *plain[1:]).groupBy("range").applyInArrow(merge, BLOCKS)
    return kept.unionByName(pooled)


def _cell(x: Column) -> Column:
    # NULL stays NULL, which least and greatest would pass over.
    return F.when(x.isNotNull(), F.least(F.greatest(F.floor(x * CELLS), F.lit(0)), F.lit(CELLS - 1))).cast("int")


def curve(blocks: DataFrame) -> DataFrame:
    """(low, high, value, next_low, next_value): every block and the one behind it, which values rise towards.

    Blocks are put in order by cell; what follows a cell comes from a table of one row per cell.
    """
    rows = store(blocks.select("low", "high", "value", _cell(F.col("low")).alias("cell")))
    within = Window.partitionBy("cell").orderBy("low")
    first = rows.groupBy("cell").agg(F.min(F.struct("low", "value")).alias("first"))
    behind = first.select(F.col("cell").alias("of"), F.lead("first").over(Window.orderBy("cell")).alias("behind"))
    rows = rows.withColumn("next", F.lead(F.struct("low", "value")).over(within)).join(behind, F.col("cell") == F.col("of"))
    follow = F.coalesce("next", "behind")
    return rows.select("low", "high", "value", follow["low"].alias("next_low"), follow["value"].alias("next_value"))


def fit_isotonic(scored: DataFrame, score: str = PREDICTION, label: str = "label") -> DataFrame:
    """The curve of the isotonic fit, as a stored table."""
    return store(curve(isotonic_blocks(scored, score, label)))


def apply_curve(df: DataFrame, table: DataFrame, score: str, name: str) -> DataFrame:
    """Add the value of a curve at a score: constant within blocks and beyond the ends, linear between.

    Blocks are listed for every cell that they reach into, which makes at most one row
    per cell; scores are joined by cell. NULL and NaN scores have no value, as has
    everything where the curve has no blocks.
    """
    begin = table.agg(F.min("low")).first()[0]
    cells = F.sequence(F.when(F.col("low") == begin, 0).otherwise(_cell(F.col("low"))), F.coalesce(_cell(F.col("next_low")), F.lit(CELLS - 1)))
    row = F.struct("low", "high", "value", "next_low", "next_value")
    listed = table.select(row.alias("block"), F.explode(cells).alias("__cell"))
    listed = listed.groupBy("__cell").agg(F.array_sort(F.collect_list("block")).alias("__blocks"))
    x = F.col(score).cast("double")
    joined = df.withColumn("__at", F.when(~F.isnan(x), _cell(x))).join(listed, F.col("__at") == F.col("__cell"), "left")
    below = F.filter("__blocks", lambda b: b["low"] <= x)
    block = F.coalesce(F.get(below, F.size(below) - 1), F.get(F.col("__blocks"), 0))
    slope = (block["next_value"] - block["value"]) / (block["next_low"] - block["high"])
    value = F.when((x > block["high"]) & block["next_low"].isNotNull(), block["value"] + (x - block["high"]) * slope).otherwise(block["value"])
    return joined.select(*df.columns, value.alias(name))
