"""Near-duplicate vectors by spherical-cap filters.

Filters are directions of a random product code: after a random rotation the
coordinates are cut into parts, each part has its own random codewords, and a
direction is one codeword of each part. A vector passes the filters whose cosine
with it reaches a height that lets `PASSED` of them pass on average. They are found by
list-decoding: partial sums over the parts are kept only if the best codewords of the
other parts could still lift them to the height. Vectors of one label that pass a
filter in common are compared in double precision, each pair in the least filter it
shares. Every link is verified; a pair at the threshold shares some twenty filters on
average, so nearly none is missed.

Equal vectors are one row with a multiplicity. A filter with more than `BLOCK` vectors
is compared block by block, each pair of blocks in a task of its own. Pairs are counted
where they are found; what leaves a task is a count and one link for each vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.components import components
from ebbline.session import store

THRESHOLD = 0.93
PASSED = 200
# Filters for each distinct vector.
DENSITY = 256
WIDEST_CODE = 4096
BLOCK = 512
# Below this many coordinates caps do not tell vectors apart; all share one filter.
LEAST_SIZE = 8


# Codes and heights made so far; a plain dictionary, as that travels with the functions that use it.
_MADE: dict[tuple, object] = {}


def _code(size: int, parts: int, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rotation and codewords of each part, the same in every task."""
    key = ("code", size, parts, words)
    if key not in _MADE:
        _MADE[key] = _make_code(size, parts, words)
    return _MADE[key]


def _make_code(size: int, parts: int, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    draw = np.random.default_rng([size, parts, words, 17])
    rotation, _ = np.linalg.qr(draw.normal(size=(size, size)))
    codes = []
    for part in np.array_split(np.arange(size), parts):
        code = draw.normal(size=(words, len(part)))
        codes.append(code / np.linalg.norm(code, axis=1, keepdims=True) / math.sqrt(parts))
    return rotation, codes


def code_shape(vectors: int) -> tuple[int, int]:
    """Parts and codewords of a part for that many vectors."""
    filters = max(4096, DENSITY * vectors)
    parts = 2
    while filters ** (1 / parts) > WIDEST_CODE:
        parts += 1
    return parts, math.ceil(filters ** (1 / parts))


def height(size: int, parts: int, words: int, passed: int = PASSED) -> float:
    """Cosine that `passed` of all filters reach on average.

    The coordinate of a random unit vector along a direction has the density
    (1 - t^2)^((size - 3) / 2), whose tail is summed up here.
    """
    key = ("height", size, parts, words, passed)
    if key not in _MADE:
        t = np.linspace(1, -1, 400_001)
        tail = np.cumsum(np.maximum(1 - t * t, 1e-300) ** ((size - 3) / 2))
        _MADE[key] = float(t[np.searchsorted(tail / tail[-1], min(0.5, passed / words**parts))])
    return _MADE[key]


def decode(vectors: np.ndarray, parts: int, words: int) -> list[np.ndarray]:
    """Sorted numbers of the filters that each unit vector passes, its best one at least."""
    size = vectors.shape[1]
    if size < LEAST_SIZE:
        return [np.zeros(1, np.int64)] * len(vectors)
    rotation, codes = _code(size, parts, words)
    turned = vectors @ rotation
    cuts = np.array_split(np.arange(size), parts)
    scores = [turned[:, cut] @ code.T for cut, code in zip(cuts, codes)]
    best = np.array([s.max(axis=1) for s in scores])
    goal = np.minimum(height(size, parts, words), best.sum(axis=0) - 1e-12)
    out = []
    for i in range(len(vectors)):
        sums, ids = np.zeros(1), np.zeros(1, np.int64)
        for k in range(parts):
            least = goal[i] - best[k + 1 :, i].sum()
            s = scores[k][i]
            able = np.flatnonzero(s >= least - sums.max())
            both = sums[:, None] + s[able][None, :]
            a, b = np.nonzero(both >= least)
            sums, ids = both[a, b], ids[a] * words + able[b]
        out.append(np.sort(ids))
    return out


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable vectors as (label, size, vector, first, copies), and (vec_id, label, vector) of every usable row.

    A vector is usable if its label is not null, it has coordinates, all are finite
    and not null, and not all are zero.
    """
    floats = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "float" if floats else "double"
    rows = vectors.select("vec_id", "label", F.col("embedding").cast(f"array<{kind}>").alias("vector")).filter(_usable("vector"))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast(kind)))  # -0.0 is 0.0
    kinds = rows.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    return kinds.withColumn("size", F.size("vector")), rows


def units(vectors: pd.Series) -> np.ndarray:
    """Vectors of one size at length one, in double precision."""
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def passed_filters(kinds: DataFrame, parts: int, words: int) -> DataFrame:
    """(label, size, first, filter): each filter that each distinct vector passes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size in batch["size"].unique():
                part = batch[batch["size"] == size]
                yield part.assign(filters=decode(units(part["vector"]), parts, words)).drop(columns="vector")

    label, first = (kinds.schema[c].dataType.simpleString() for c in ("label", "first"))
    coded = kinds.select("label", "size", "first", "vector").mapInPandas(run, f"label {label}, size int, first {first}, filters array<bigint>")
    return coded.select("label", "size", "first", F.explode("filters").alias("filter"))


def _compare(ids: np.ndarray, copies: np.ndarray, unit: np.ndarray, filters: list, here: int, block: np.ndarray, across: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of a filter how many it links to here, and the least vector linked here.

    Where vectors of two blocks meet, only pairs across the blocks are new.
    """
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    if across:
        near &= block[:, None] != block[None, :]
    if near.any():
        # A pair that shares an earlier filter was counted there.
        length = np.array([len(f) for f in filters])
        flat, owner = np.concatenate(filters), np.repeat(np.arange(len(ids)), length)
        early = flat < here
        names, place, shared = np.unique(flat[early], return_inverse=True, return_counts=True)
        keep = shared[place] > 1
        if keep.any():
            number = np.cumsum(shared > 1) - 1
            holds = np.zeros((len(ids), int((shared > 1).sum())), np.float32)
            holds[owner[early][keep], number[place[keep]]] = 1
            before = holds @ holds.T > 0
        else:
            before = np.zeros_like(near)
        near &= ~before
    count = near @ copies
    root = np.arange(len(ids))
    while True:  # the least number reached over the links found here
        reach = np.where(near, root[None, :], len(ids)).min(axis=1, initial=len(ids))
        new = np.minimum(root, reach)
        new = new[new]
        if (new == root).all():
            return count, ids[root]
        root = new


def _edges(keys: pd.DataFrame) -> np.ndarray:
    """Where groups of sorted rows begin, and where the last one ends."""
    values = [keys[c].to_numpy() for c in keys.columns]
    new = np.zeros(len(keys) - 1, bool)
    for v in values:
        new |= v[1:] != v[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(keys)]])


def _linked(frame: pd.DataFrame, edges: np.ndarray, threshold: float, few: int = 8) -> pd.DataFrame:
    """Links found in whole groups of members: vector, how many others, and the least linked one."""
    sizes, unit = frame["size"].to_numpy(), np.empty(len(frame), object)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        made = units(frame["vector"].iloc[at])
        for i, v in zip(at, made):
            unit[i] = v
    length, group = np.diff(edges), np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    # Most groups are two or three vectors that are not near: their pairs are looked at all at once.
    worth = length > few
    if len(np.unique(sizes)) == 1 and len(frame) > 1:
        x = np.stack(unit)
        for step in range(1, few):
            same = group[step:] == group[:-step]
            close = np.einsum("ij,ij->i", x[step:], x[:-step]) >= threshold - 1e-9
            worth[group[step:][same & close]] = True
    else:
        worth[:] = True
    found = []
    for k in np.flatnonzero(worth & (length > 1)):
        part = frame.iloc[edges[k] : edges[k + 1]]
        order = np.argsort(part["first"].to_numpy())
        ids, copies, block = (part[c].to_numpy()[order] for c in ("first", "copies", "block"))
        here = np.stack(unit[edges[k] : edges[k + 1]][order])
        count, root = _compare(ids, copies, here, list(part["filters"].to_numpy()[order]), int(part["filter"].iloc[0]), block, part["low"].iloc[0] != part["high"].iloc[0], threshold)
        found.append(pd.DataFrame({"first": ids[count > 0], "links": count[count > 0], "root": root[count > 0]}))
    return pd.concat(found) if found else pd.DataFrame({"first": [], "links": [], "root": []})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    n_links counts the other rows linked directly, equal vectors among them;
    component_id is the smallest vec_id that links reach. An unusable vector links
    with nothing. Rows of one vec_id are one node: equal vectors count as copies, and
    different ones link it wherever any of them does.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    kinds, rows = distinct_vectors(vectors)
    kinds = store(kinds)
    node, bucket = ["label", "size", "first"], ["label", "size", "filter"]
    passed = store(passed_filters(kinds, *code_shape(kinds.count())))
    shared = passed.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1")
    there = store(passed.join(shared.select(*bucket, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), bucket))
    # What a vector brings along: itself and those of its filters that it shares, at most all it passes.
    known = there.groupBy(*node).agg(F.array_sort(F.collect_list("filter")).alias("filters")).join(kinds, node)
    mine = F.pmod(F.xxhash64("first"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least("block", other).alias("low"), F.greatest("block", other).alias("high"))
    )
    spread = there.withColumn("block", mine).select(*bucket, "first", "block", F.explode(pairs).alias("pair"))
    group = [*bucket, "low", "high"]
    members = spread.select(*bucket, "pair.low", "pair.high", "first", "block").join(known, node)
    dealt = members.repartition(*group).sortWithinPartitions(*group)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            edges = _edges(frame[group])
            rest = frame.iloc[edges[-2] :]
            if len(edges) > 2:
                yield _linked(frame.iloc[: edges[-2]], edges[:-1], threshold)
        if rest is not None and len(rest):
            yield _linked(rest, np.array([0, len(rest)]), threshold)

    kind = kinds.schema["first"].dataType.simpleString()
    found = store(dealt.mapInPandas(compare, f"first {kind}, links bigint, root {kind}"))
    counts = found.groupBy("first").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("first").alias("a"), F.col("root").alias("b")))
    whole = (
        kinds.join(counts, "first", "left")
        .join(classes.withColumnRenamed("node", "first"), "first", "left")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    )
    usable = rows.join(whole, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    bad = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v")).filter(~_usable("v"))
    alone = bad.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
