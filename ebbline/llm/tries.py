"""Near-duplicate texts by an exact Jaccard join of word n-gram sets over prefix trees.

A text's set is its distinct n-grams of lower-case words (64-bit hashes). Shingles
that no other text has cannot be shared, and the rest are put in one global order,
rarest first. If two sets reach the threshold, the first shingle in this order that
they share lies in the prefix of both, the first n - need(n) + 1 of each; so a text
most of whose shingles are its own has an empty prefix and leaves early.

A group is the texts with one prefix shingle. Its sets, as paths in the global order,
form a trie, kept as the sorted list of paths: of each the part behind what it shares
with the one before, and the part that hangs from. A query goes through the trie once,
all parts together and then level by level from where they hang, so paths with a common
beginning share the work for it; it ends behind the last path that could reach the
threshold by its length and whose text is not in the query's class, and is left out when
there is none.

Every text first joins the group of one of its prefix shingles, in blocks around one
text that all blocks of a group have in common. After that classes are formed, and
only shingles whose texts are in several classes are left; their groups are joined
whole, every pair of blocks in a task of its own. So copies by the thousand cost what
they weigh, and no pair that could be linked is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import small, small_batches
from ebbline.llm.components import components
from ebbline.llm.words import bytes_of, hashes, mix, spans
from ebbline.session import store

WORDS = 5
PERCENT = 75
# Texts of a group that one task joins at a time.
BLOCK = 256
# Shingles that share one key range while they are counted.
RANGE_SHINGLES = 1_000_000
# Bytes with A-Z as a-z, which no other character in UTF-8 has.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# Shingles a task holds before it packs and hands them on.
PACKED_SHINGLES = 1_000_000


def need(size: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of this size with any set that it links to."""
    return -(-percent * size // 100)


def least_overlap(a: int, b: int, percent: int) -> int:
    """Least overlap at which sets of these sizes link: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        total = mix(total * np.uint64(0xD1342543DE82EF95) + words[i : len(words) - k + 1 + i])
    return total


def _name(shingles: np.ndarray) -> int:
    """64-bit name of a set; equal sets have one name."""
    return int(mix(np.array([(mix(shingles + np.uint64(77)).sum(dtype=np.uint64) ^ np.uint64(len(shingles)))], np.uint64)).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, column: int, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; the whole of a text of fewer than n words is one."""
    data, ends = bytes_of(batch.column(column))
    data = LOWER[data]
    start, stop, many = spans(data, ends)
    words, upto = hashes(data, start, stop), np.cumsum(many)
    every = _grams(words, n)  # those across two texts are never looked at
    for m, b in zip(many.tolist(), upto.tolist()):
        yield np.unique(every[b - m : b - n + 1]) if m >= n else _grams(words[b - m : b], m) if m else words[:0]


def _packed(names: list[int], sets: list[np.ndarray], ranges: int) -> Iterator[pa.RecordBatch]:
    """Rows (range, keys, names): every shingle with the name of its set, by key range."""
    keys, owner = np.concatenate(sets), np.repeat(np.array(names, np.int64), [len(s) for s in sets])
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    edge = np.append(np.searchsorted(keys, np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)), len(keys))
    low = 0
    for k, high in enumerate(edge):
        if high > low:
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([keys[low:high].tobytes()]), pa.array([owner[low:high].tobytes()])], names=["range", "keys", "names"])
        low = high


def set_names(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, name, size) of every row; an empty set has no name."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch, 1, n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_name(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())],
                names=["doc_id", "name", "size"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, f"doc_id {kind}, name bigint, size bigint")


def _dealt(docs: DataFrame, n: int, percent: int, ranges: int, prefix_only: bool) -> DataFrame:
    """Packed shingles of the texts, all of them or the first ones by hash of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sets, held, seen = [], [], 0, set()
        for batch in batches:
            for s in _sets(batch, 0, n):
                name = _name(s) if len(s) else None
                if name is None or name in seen:  # an equal set adds nothing
                    continue
                seen.add(name)
                names.append(name)
                # Copied, as a part of an array keeps all of it.
                sets.append(s[: len(s) - int(need(np.array(len(s)), percent)) + 1].copy() if prefix_only else s)
                held += len(sets[-1])
                if held >= PACKED_SHINGLES:
                    yield from _packed(names, sets, ranges)
                    names, sets, held, seen = [], [], 0, set()
        if names:
            yield from _packed(names, sets, ranges)

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "range bigint, keys binary, names binary")


def _numbers(group: pa.Table, name: str, kind: type) -> np.ndarray:
    """The numbers packed in a binary column, one row after the other, read where they lie."""
    parts = [np.frombuffer(bytes_of(c)[0], kind) for c in group.column(name).chunks]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _gathered(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, set) of a key range, sorted, and how many sets have each one's shingle."""
    keys, names = _numbers(group, "keys", np.uint64), _numbers(group, "names", np.int64)
    order = np.lexsort((names, keys))
    keys, names = keys[order], names[order]
    del order
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    keys, names = keys[new], names[new]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    held = np.diff(np.append(first, len(keys)))
    return keys, names, np.repeat(held, held)


def _sharing(group: pa.Table) -> pa.Table:
    """Sets that share a shingle of this range."""
    _, names, held = _gathered(group)
    return pa.table({"name": np.unique(names[held > 1])})


def _shared(group: pa.Table, buckets: int) -> pa.Table:
    """The shingles of this range that several sets have, how many have them, and whose they are,
    packed by bucket of the set."""
    keys, names, held = _gathered(group)
    several = held > 1
    keys, names, held = keys[several], names[several], held[several].astype(np.uint32)
    bucket = (mix(names.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, names, held = keys[order], names[order], held[order]
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(edge))
    packed = ([c[edge[k] : edge[k + 1]].tobytes() for k in some] for c in (names, keys, held))
    return pa.table([pa.array(some, pa.int64()), *(pa.array(c, pa.binary()) for c in packed)], names=["bucket", "names", "keys", "held"])


def _paths(group: pa.Table) -> pa.Table:
    """Each set of a bucket with all of its shared shingles in the global order."""
    names, keys, held = _numbers(group, "names", np.int64), _numbers(group, "keys", np.uint64), _numbers(group, "held", np.uint32)
    order = np.lexsort((keys, held, names))
    names, keys, held = names[order], keys[order], held[order]
    edge = np.flatnonzero(np.append(np.append(True, names[1:] != names[:-1]), True))
    path, held = ([c[a:b].tobytes() for a, b in zip(edge, edge[1:])] for c in (keys, held))
    return pa.table([pa.array(names[edge[:-1]]), pa.array(path, pa.binary()), pa.array(held, pa.binary()), pa.array(np.diff(edge))], names=["name", "path", "held", "shared"])


def ordered_sets(docs: DataFrame, named: DataFrame, n: int, percent: int) -> DataFrame:
    """(name, size, path, prefix): the shared shingles of each set that has a prefix, in global order.

    The first pass looks at the first shingles of each set by hash, which sets that
    link share as well; only sets that share one of these are counted in full.
    """
    total = int(named.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    ranges = 1 + total // RANGE_SHINGLES
    some = _dealt(docs, n, percent, 1 + ranges // 4, True).groupBy("range").applyInArrow(_sharing, "name bigint").distinct()
    some = store(some)
    keep = small(named.join(some, "name", "left_semi").groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size")))
    texts = docs.join(keep.select(F.col("doc_id").alias("kept")), docs["doc_id"].eqNullSafe(F.col("kept")), "left_semi")

    def shared(group: pa.Table) -> pa.Table:
        return _shared(group, ranges)

    # From key ranges to buckets of sets: packed both ways, so rows do not grow with the texts of a range.
    parts = _dealt(texts, n, percent, ranges, False).groupBy("range").applyInArrow(shared, "bucket bigint, names binary, keys binary, held binary")
    paths = parts.groupBy("bucket").applyInArrow(_paths, "name bigint, path binary, held binary, shared bigint")
    least = F.ceil(F.lit(percent) * F.col("size") / 100)
    sized = paths.join(keep.select("name", "size"), "name").withColumn("prefix", (F.col("shared") - least + 1).cast("bigint"))
    return store(sized.filter("prefix > 0").select("name", "size", "path", "held", "prefix"))


class Trie:
    """Sets as paths in the global order, sorted, with the length each shares with the one before.

    A place in the order is (number of sets that have the shingle, shingle); here it is a
    number in the list of the group's shingles.
    """

    def __init__(self, paths: list[np.ndarray], held: list[np.ndarray], sizes: np.ndarray):
        keys, counts = np.concatenate(paths), np.concatenate(held)
        order = np.lexsort((keys, counts))
        listed = keys[order]
        _, first = np.unique(listed, return_index=True)
        listed = listed[np.sort(first)]
        back = np.argsort(listed)
        place = [back[np.searchsorted(listed, p, sorter=back)] for p in paths]
        self.line = np.array(sorted(range(len(place)), key=lambda i: place[i].tolist()))
        self.paths = [place[i] for i in self.line]
        self.sizes = sizes[self.line]
        self.length = np.array([len(p) for p in self.paths])
        self.universe = len(listed)
        self._edges()

    def _edges(self) -> None:
        """Each path's part of the trie: the places behind what it shares with the one before, and where that hangs."""
        n = len(self.paths)
        self.common, self.above, level, cut = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        chain: list[int] = []  # the parts that the current path runs through
        at = np.zeros(n + 1, np.int64)
        for i, path in enumerate(self.paths):
            if i:
                before = self.paths[i - 1]
                k = min(len(before), len(path))
                differ = np.flatnonzero(before[:k] != path[:k])
                self.common[i] = differ[0] if len(differ) else k
            while chain and self.common[chain[-1]] >= self.common[i]:
                chain.pop()
            if chain:
                j = self.above[i] = chain[-1]
                level[i] = level[j] + 1
                cut[i] = at[j] + self.common[i] - self.common[j]
            chain.append(i)
            at[i + 1] = at[i] + len(path) - self.common[i]
        self.nodes = np.concatenate([path[k:] for path, k in zip(self.paths, self.common.tolist())]).astype(np.int32)
        # Sums run from cut to cut: where parts begin, and behind the places that others hang from.
        cuts = np.unique(np.concatenate([at, cut]))
        self.cuts = cuts[cuts < len(self.nodes)]
        self.at, self.begin, self.hangs = at, np.searchsorted(self.cuts, at), np.searchsorted(self.cuts, cut)
        self.levels = [np.flatnonzero(level == k) for k in range(1, int(level.max(initial=0)) + 1)]

    def overlaps(self, q: int, end: int, marks: np.ndarray) -> np.ndarray:
        """How much the paths behind q and before `end` share with q, whose places `marks` tells.

        A place that several paths have in common is looked at once. What a part behind q
        shares with a part up to q is a beginning of q as well, so q has all of it.
        """
        low, cut = self.at[q + 1], self.begin[q + 1]
        cuts = self.cuts[cut : self.begin[end]] - low
        upto = np.zeros(len(cuts) + 1, np.int64)
        if len(cuts):
            np.cumsum(np.add.reduceat(marks[self.nodes[low : self.at[end]]], cuts, dtype=np.int64), out=upto[1:])
        begin = self.begin[q + 1 : end + 1] - cut
        shared = self.common[q + 1 : end].copy()
        above = self.above[q + 1 : end] - q - 1
        for level in self.levels:
            some = level[np.searchsorted(level, q + 1) : np.searchsorted(level, end)] - q - 1
            some = some[above[some] >= 0]
            if len(some):
                over = above[some]
                shared[some] = shared[over] + upto[self.hangs[some + q + 1] - cut] - upto[begin[over]]
        return shared + upto[begin[1:]] - upto[begin[:-1]]

    def links(self, across: np.ndarray, classes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
        """Pairs of texts that link, with `classes` (a number for each) united on the way.

        Texts of one class are not compared again. Where `across` says two blocks, only
        pairs of different blocks are.
        """
        mine = np.unique(classes, return_inverse=True)[1][self.line]
        side = across[self.line]
        both = side.min() != side.max() if len(side) else False
        marks = np.zeros(self.universe, np.uint8)
        for q in range(len(self.paths) - 1):
            goal = least_overlap(int(self.sizes[q]), self.sizes[q + 1 :], percent)
            open_ = (goal <= np.minimum(self.length[q + 1 :], self.length[q])) & (mine[q + 1 :] != mine[q])
            if both:
                open_ &= side[q + 1 :] != side[q]
            left = np.flatnonzero(open_)
            if not len(left):
                continue
            marks[self.paths[q]] = 1
            shared = self.overlaps(q, q + 2 + int(left[-1]), marks)
            marks[self.paths[q]] = 0
            for i in (left[shared[left] >= goal[left]] + q + 1).tolist():
                if mine[i] != mine[q]:
                    yield int(self.line[q]), int(self.line[i])
                    mine[mine == mine[i]] = mine[q]


def _joined(group: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    group = group.drop_duplicates("name")
    if len(group) < 2:
        return []
    trie = Trie(
        [np.frombuffer(p, np.uint64) for p in group["path"]], [np.frombuffer(h, np.uint32) for h in group["held"]], group["size"].to_numpy()
    )
    names = group["name"].tolist()
    to = {name: name for name in names}

    def root(name: int) -> int:
        while to[name] != name:
            to[name] = to[to[name]]
            name = to[name]
        return name

    # Links of a group leave as links to one text of each class found in it.
    for a, b in trie.links(group["side"].to_numpy(), group["class"].to_numpy(), percent):
        to[root(names[a])] = root(names[b])
    return [(name, root(name)) for name in names if root(name) != name]


def _join(groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within groups: rows (shingle, low, high, side, name, size, path, held, class)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_joined(group, percent), columns=["a", "b"])

    return groups.groupBy("shingle", "low", "high").applyInPandas(run, "a bigint, b bigint")


def _classed(sets: DataFrame, links: DataFrame) -> DataFrame:
    """(name, class) of every set."""
    found = components(links)
    return store(sets.select("name").join(found, sets["name"] == found["node"], "left").select("name", F.coalesce("component", "name").alias("class")))


def _several(places: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of `places` whose shingle has texts of more than one class, with their class."""
    known = store(places.join(classes, "name"))
    mixed = known.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n")).filter("low <> high")
    return known.join(mixed.select("shingle", "n"), "shingle")


def set_classes(sets: DataFrame, percent: int) -> DataFrame:
    """(name, class): sets that links reach are one class."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, path, prefix in zip(*(batch.column(k).to_pylist() for k in range(3))):
                keys = np.frombuffer(path, np.int64)[:prefix]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), name, np.int64))], names=["shingle", "name"])

    places = store(sets.select("name", "path", "prefix").mapInArrow(prefixes, "shingle bigint, name bigint"))
    # First round: the texts of the groups that some text chose, its shingle of the least rank
    # among those that other texts have in their prefix too, in blocks around one text.
    rank = F.struct(F.xxhash64("shingle").alias("rank"), F.col("shingle"))
    met = store(_several(places, sets.select("name", F.col("name").alias("class"))))
    chosen = met.groupBy("name").agg(F.min(rank).alias("least")).select(F.col("least.shingle").alias("shingle")).distinct()
    around = met.groupBy("shingle").agg(F.min(F.struct(F.xxhash64("name").alias("rank"), F.col("name"))).alias("centre"))
    first = met.join(chosen, "shingle").join(around.select("shingle", F.col("centre.name").alias("centre")), "shingle")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    spot = F.pmod(F.xxhash64("name"), blocks).cast("int")
    every = F.when(F.col("name") == F.col("centre"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(spot))
    dealt = first.select("shingle", "name", "class", F.explode(every).alias("low")).withColumn("high", F.col("low")).withColumn("side", F.lit(0))
    links = store(_join(dealt.join(sets.drop("prefix"), "name"), percent))
    classes = _classed(sets, links)
    # Second round: what is left, whole. A group that was one block in the first is done.
    done = chosen.join(met.select("shingle", "n").distinct(), "shingle").filter(F.col("n") <= BLOCK).select("shingle")
    left = _several(places.join(done, "shingle", "left_anti"), classes)
    left = left.join(_one_of_each(left), "shingle").withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    # Texts that chains of common prefix shingles connect are few as a rule; then they are one
    # group, which holds each of them once. Larger ones go by shingle, in pairs of blocks.
    hubs = left.groupBy("shingle").agg(F.min("name").alias("a"))
    near = components(left.join(hubs, "shingle").select("a", F.col("name").alias("b")))
    sized = near.join(near.groupBy("component").agg(F.count("*").alias("together")), "component")
    left = store(left.join(sized, left["name"] == sized["node"]))
    few = left.filter(F.col("together") <= BLOCK).select(F.col("component").alias("shingle"), "name", "class").distinct()
    few = few.select("*", F.lit(0).alias("side"), F.lit(-1).alias("low"), F.lit(-1).alias("high"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("side", o).alias("low"), F.greatest("side", o).alias("high")))
    many = left.filter(F.col("together") > BLOCK).select("shingle", "name", "class", "side", F.explode(pairs).alias("pair"))
    spread = few.unionByName(many.select("shingle", "name", "class", "side", "pair.low", "pair.high"))
    more = store(_join(spread.join(sets.drop("prefix"), "name"), percent))
    return _classed(sets, links.unionByName(more))


def _one_of_each(places: DataFrame) -> DataFrame:
    """One shingle of all those that lie in the prefixes of the same texts."""
    same = places.groupBy("shingle").agg(
        F.sum(F.xxhash64("name").cast("decimal(38,0)")).alias("s1"), F.sum(F.xxhash64(F.lit(1), "name").cast("decimal(38,0)")).alias("s2"), F.count("*").alias("m")
    )
    return same.groupBy("s1", "s2", "m").agg(F.min("shingle").alias("shingle")).select("shingle")


def near_duplicates(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Words are runs of characters other than blanks and the controls 9 to 13, after A-Z to
    a-z. A text of fewer than n words is one shingle; a null one, or one without a
    word, has none and links with nothing. Equal sets link. Rows of one doc_id are rows
    of their own with that id; component_id is the smallest doc_id that links reach.
    """
    named = store(set_names(docs.select("doc_id", "text"), n))
    sets = ordered_sets(docs.select("doc_id", "text"), named, n, percent)
    classes = set_classes(sets, percent)
    least = named.filter("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("doc_id"))
    both = least.join(classes, "name", "left").withColumn("class", F.coalesce("class", "name"))
    # A class holds one row for each of its sets, so its least id is an aggregate of those.
    ids = both.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    of = both.join(ids, "class").select("name", "component_id")
    return named.join(of, "name", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
