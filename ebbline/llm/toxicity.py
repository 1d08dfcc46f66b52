"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Fitting reads every labelled training document: it counts in how many documents,
and in how many toxic ones, each term occurs, and takes a bounded sample of
documents as examples. No term is left out: every term counts by its inverse
document frequency times one more than how far, in standard deviations, its share
of toxic documents departs from the general one, to either side (so the space is a
supervised reweighting of plain TF-IDF).

Examples stand in blocks of `BLOCK`. Of the terms that few examples hold an inverted
index gives the exact part of every cosine. Of the terms that most hold the index
keeps the greatest value of each block; with the first part they bound what any
example of a block can reach. The blocks of the greatest bounds are scored first, and
then only blocks whose bound is not below the k-th best cosine found in them; the
others are skipped. Bounds and sums run in short numbers; whatever they put within
their error of the k-th best is compared again in double precision, so the neighbours
are exact. They vote with weights that fall with distance, and a logistic map fitted
on the examples' own votes (each without itself) turns votes into probabilities.

A word that no example holds cannot be shared with one: it is not part of the
space, neither of the products nor of the length of a text's vector.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import added, carried, fold, give_back, small, small_batches
from ebbline.session import store

# Bounds of the fitted classifier: examples of each class, and examples whose
# votes calibrate the score.
EXAMPLES_PER_CLASS = 6000
CALIBRATION = 1500
# What makes a term a clear sign of toxic texts; such terms are listed apart.
LEAST_DOCUMENTS = 5
LEAST_DEVIATION = 6.0
NEIGHBOURS = 25
EVIDENCE = 3
# Terms held by most examples, whose greatest values are kept for each block of examples.
DENSE = 256
BLOCK = 64
# Examples whose frequent terms are put in order at a time.
SORTED = 1024
# Examples whose words are looked up together.
FETCHED = 256
# Blocks that are scored first, and texts that are searched together.
FIRST_BLOCKS = 3
TOGETHER = 64
# Terms that are looked up first.
COMMON = 32768
# Documents are dealt over so many buckets to choose the examples.
BUCKETS = 16384
# More than the short numbers of a cosine can be off by.
ERROR = 5e-5
WORD = r"[^\W_]+"
# Bytes of ASCII words and of all other characters as they are; what stands between ASCII words as blanks.
SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[str]:
    """The words of a text, those that `WORD` finds."""
    words = text.encode("utf-8", "surrogatepass").translate(SPACED).decode("utf-8", "surrogatepass").split()
    if text.isascii() or all(map(str.isalnum, words)):
        return words
    return [w for part in words for w in ([part] if part.isalnum() else re.findall(WORD, part))]


class Examples:
    """The examples as vectors, the index over them, and what turns their votes into scores."""

    def __init__(self, idf: dict[str, float], rest: dict[str, float] | None = None, without: float = 0.0):
        """Weights of the terms that are clear signs of toxic texts, and of all other terms."""
        every = idf | (rest or {})
        terms = sorted(every)
        self._hold(pa.array(terms, pa.string()), np.array([every[t] for t in terms], float), np.array([t in idf for t in terms], bool), without)

    @classmethod
    def over(cls, terms: pa.Array, scale: np.ndarray, clear: np.ndarray, without: float) -> Examples:
        """The same from terms in order and their weights, without a second copy of them."""
        made = cls.__new__(cls)
        made._hold(terms, scale, clear, without)
        return made

    def _hold(self, terms: pa.Array, scale: np.ndarray, clear: np.ndarray, without: float) -> None:
        self.terms, self.scale, self.clear = terms, scale, clear
        self.without = without  # score of a text that shares no term with any example
        self.ids: list = []
        self.toxic = self.weight = np.zeros(0)
        self.slope = self.shift = 0.0
        self.visited = self.offered = 0  # blocks scored, and blocks there were, over all searches
        self.index([])

    @cached_property
    def at(self) -> dict[str, int]:
        """The place of every term. Tasks look words up in it; fitting does without, as it weighs far more than the terms."""
        return {t: i for i, t in enumerate(self.terms.to_pylist())}

    @cached_property
    def common(self) -> dict[str, int]:
        """The same of the terms that most examples hold: most words of a text are in it, and it stays in the processor's cache."""
        held = np.where(self.place >= 0, len(self.same), np.diff(self.first))
        most = np.argsort(-held, kind="stable")[:COMMON]
        return dict(zip(self.terms.take(pa.array(most)).to_pylist(), most.tolist()))

    @property
    def idf(self) -> dict[str, float]:
        return {self.terms[i].as_py(): float(self.scale[i]) for i in np.flatnonzero(self.clear)}

    @property
    def rest(self) -> dict[str, float]:
        return {self.terms[i].as_py(): float(self.scale[i]) for i in np.flatnonzero(~self.clear)}

    def sparse(self, counted: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Columns in order and values of the unit vector of counted words."""
        column = np.fromiter(map(self.common.get, counted, repeat(-1)), np.int32, len(counted))
        if len(other := np.flatnonzero(column < 0)):
            words, at = [*counted], self.at
            column[other] = [at.get(words[k], -1) for k in other.tolist()]
        return self._known(column, np.fromiter(counted.values(), float, len(counted)))

    def sparse_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of a text's words, counted by their columns."""
        column = np.fromiter(map(self.common.get, words, repeat(-1)), np.int32, len(words))
        if len(other := np.flatnonzero(column < 0)):
            column[other] = [*map(self.at.get, map(words.__getitem__, other.tolist()), repeat(-1))]
        column, times = np.unique(column[column >= 0], return_counts=True)
        return self._unit(column, times.astype(float))

    def sparse_each(self, held: list[tuple[list[str], list[int]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for many texts at once, each given by its distinct words and their counts."""
        edge = np.cumsum([0, *(len(words) for words, _ in held)])
        place = pc.index_in(pa.array([w for words, _ in held for w in words], pa.string()), value_set=self.terms)
        place = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        for k, (_, times) in enumerate(held):
            yield self._known(place[edge[k] : edge[k + 1]], np.array(times, float))

    def _known(self, column: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of counted words by their columns, -1 for words that are not terms."""
        known = np.flatnonzero(column >= 0)
        order = known[np.argsort(column[known])]
        return self._unit(column[order], times[order])

    def _unit(self, column: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = (1 + np.log(times)) * self.scale[column]
        norm = math.sqrt(float(value @ value))
        return (column, value / norm) if norm else (column[:0], value[:0])

    def vector(self, words: Sequence[str]) -> dict[str, float]:
        """Unit vector over the terms of the words."""
        column, value = self.sparse(Counter(words))
        return {self.terms[int(c)].as_py(): float(v) for c, v in zip(column, value)}

    def columns(self, vector: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        found = sorted((self.at[t], v) for t, v in vector.items())
        return np.array([c for c, _ in found], np.int32), np.array([v for _, v in found], float)

    def build(self, vectors: list[dict[str, float]]) -> None:
        self.index([self.columns(v) for v in vectors])

    def index(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """The index over the vectors; the list is emptied, as the driver holds them once."""
        n, width = len(vectors), len(self.terms)
        self.starts = np.concatenate([[0], np.cumsum([len(c) for c, _ in vectors])]).astype(np.int64)
        # Examples of equal vectors are compared once.
        first: dict[bytes, int] = {}
        self.same = np.array([first.setdefault(hashlib.sha256(c.tobytes() + v.tobytes()).digest(), i) for i, (c, v) in enumerate(vectors)], np.int64)
        self.column, self.value = np.zeros(self.starts[-1], np.int32), np.zeros(self.starts[-1])
        for i in reversed(range(n)):
            self.column[self.starts[i] : self.starts[i + 1]], self.value[self.starts[i] : self.starts[i + 1]] = vectors.pop()
        give_back()  # the vectors
        held = np.zeros(width, np.int64)
        for some in self._pieces(n):
            held += np.bincount(self.column[some], minlength=width)
        often = np.argsort(-held, kind="stable")[:DENSE]
        self.place = np.full(width, -1, np.int32)
        self.place[often] = np.arange(len(often))
        self._into_blocks(n)
        held[often] = 0
        self.first = np.concatenate([[0], np.cumsum(held)]).astype(np.int64)
        self._into_lists(n)

    def _pieces(self, n: int) -> Iterator[slice]:
        """The entries of some examples at a time: what is worked out over all at once weighs more than the index."""
        for low in range(0, n, SORTED):
            yield slice(self.starts[low], self.starts[min(n, low + SORTED)])

    def _into_lists(self, n: int) -> None:
        """For every term that few examples hold the places of its examples and their values, by the number of the example."""
        # Place and amount of an entry stand beside each other, so that a list is one piece.
        self.posted = np.empty((self.first[-1], 2), np.int32)
        filled = self.first[:-1].copy()
        for low, some in zip(range(0, n, SORTED), self._pieces(n)):
            column = self.column[some]
            order = np.argsort(column, kind="stable")
            order = order[self.place[column[order]] < 0]
            column = column[order]
            begins = np.flatnonzero(np.append(True, column[1:] != column[:-1])[: len(column)])
            many = np.diff(np.append(begins, len(column)))
            to = np.arange(len(column)) + np.repeat(filled[column[begins]] - begins, many)
            filled[column[begins]] += many
            position = np.repeat(self.position[low : low + SORTED], np.diff(self.starts[low : low + SORTED + 1]))
            self.posted[to, 0] = position[order]
            self.posted[to, 1] = self.value[some][order].astype(np.float32).view(np.int32)

    def _into_blocks(self, n: int) -> None:
        """Examples beside others with the same heaviest frequent terms: `position` of each."""
        heavy = np.zeros((n, min(3, int((self.place >= 0).sum()))), np.int32)
        for low in range(0, n, SORTED):
            number, spot, value = self._frequent(low, min(n, low + SORTED))
            rows = np.zeros((min(n, low + SORTED) - low, int((self.place >= 0).sum())), np.float32)
            rows[number - low, spot] = value
            heavy[low : low + SORTED] = np.argsort(-rows, axis=1, kind="stable")[:, :3]
        order = np.lexsort(heavy.T[::-1]) if heavy.size else np.arange(n)
        self.position = np.empty(n, np.int32)
        self.position[order] = np.arange(n)
        self.dense = None

    def _frequent(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, place and value of the frequent terms of some examples."""
        first, last = self.starts[low], self.starts[high]
        spot = self.place[self.column[first:last]]
        kept = np.flatnonzero(spot >= 0)
        number = np.repeat(np.arange(low, high, dtype=np.int32), np.diff(self.starts[low : high + 1]))
        return number[kept], spot[kept], self.value[first:last][kept]

    def spread(self) -> None:
        """The matrix of the frequent terms in the order of `position`, and the greatest values of its blocks."""
        n, width = len(self.same), int((self.place >= 0).sum())
        many = -(-n // BLOCK)
        self.dense = np.zeros((many, BLOCK, width), np.float32)
        flat = self.dense.reshape(many * BLOCK, width)
        for low in range(0, n, SORTED):
            number, spot, value = self._frequent(low, min(n, low + SORTED))
            flat[self.position[number], spot] = value
        self.greatest = self.dense.max(axis=1) if many else np.zeros((0, width), np.float32)
        self.placed = np.zeros(many * BLOCK, np.int64)
        self.placed[self.position] = np.arange(n)

    def __getstate__(self) -> dict:
        """What travels with the tasks: what follows from the rest is made again there."""
        return {k: v for k, v in self.__dict__.items() if k not in ("at", "common", "greatest", "placed", "clear")} | {"dense": None}

    def short(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Cosines of vectors and examples by `position`, to within ERROR, -1 in blocks that hold none of the k + 1
        best; and for each vector what its k + 1 best reach at least."""
        if self.dense is None:
            self.spread()
        m, many = len(vectors), len(self.dense)
        entries = self.posted.view(np.int64).reshape(-1)  # place and amount as one number
        asked = np.zeros((m, self.dense.shape[2]), np.float32)
        rare = np.zeros((m, many, BLOCK), np.float32)
        for n, (column, value) in enumerate(vectors):
            row = self.place[column]
            asked[n, row[row >= 0]] = value[row >= 0]
            start, stop = self.first[column], self.first[column + 1]
            some = np.flatnonzero(stop > start)
            if len(some):
                start, many_in = start[some], (stop - start)[some]
                upto = np.cumsum(many_in)
                at = np.repeat(start - upto + many_in, many_in)
                at += np.arange(len(at))
                posted = entries.take(at).view(np.int32).reshape(-1, 2)
                amount = posted[:, 1].view(np.float32) * np.repeat(value[some], many_in)
                rare[n] = np.bincount(posted[:, 0], amount, many * BLOCK).reshape(many, BLOCK)
        bound = rare.max(axis=2, initial=0) + asked @ self.greatest.T
        got = np.full((m, many, BLOCK), -1, np.float32)

        def score(wanted: np.ndarray) -> None:
            for block in np.flatnonzero(wanted.any(axis=0)):
                texts = np.flatnonzero(wanted[:, block])
                got[texts, block] = rare[texts, block] + asked[texts] @ self.dense[block].T
            self.visited += int(wanted.sum())

        # One more than k, as a text may have to be left out of its own neighbours.
        first = min(many, max(FIRST_BLOCKS, -(-(k + 1) // BLOCK) + 1))
        wanted = np.zeros((m, many), bool)
        begun = np.argpartition(-bound, first - 1, axis=1)[:, :first] if many else np.zeros((m, 0), int)
        np.put_along_axis(wanted, begun, True, axis=1)
        score(wanted)
        found = got[np.arange(m)[:, None], begun].reshape(m, first * BLOCK)
        least = np.partition(found, -(k + 1), axis=1)[:, -(k + 1)] if found.shape[1] > k else np.full(m, -1, np.float32)
        score((bound >= least[:, None] - 4 * ERROR) & (bound > 0) & ~wanted)
        self.offered += m * many
        return got.reshape(m, many * BLOCK), least

    def closest(self, vector: tuple[np.ndarray, np.ndarray], short: np.ndarray, floor: float, k: int, skip: int, room: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if skip >= 0:
            short[self.position[skip]] = 0
        # The k-th best is not below the floor, so it is looked for among these alone.
        spot = np.flatnonzero((short >= floor - ERROR) & (short > 0))
        if len(spot) > k:
            reached = short[spot]
            spot = spot[reached >= np.partition(reached, -k)[-k] - ERROR]
        if not len(spot):
            return np.zeros(0, np.int64), np.zeros(0)
        number = np.sort(self.placed[spot])
        column, value = vector
        room[column], mark[column] = value, True
        own, which = self.same[number], slice(None)
        if len(own) > 2 * k:  # fewer are not worth it
            own, which = np.unique(own, return_inverse=True)
        start, stop = self.starts[own], self.starts[own + 1]
        lists = [*map(slice, start.tolist(), stop.tolist())]
        theirs = np.concatenate([*map(self.column.__getitem__, lists)])
        # The marks fit the processor's cache, and few terms are shared.
        shared = np.flatnonzero(mark.take(theirs))
        met = np.zeros(len(theirs))
        met[shared] = room.take(theirs.take(shared))
        mark[column] = False
        edge = np.cumsum(stop - start).tolist()
        cosine = np.array([self.value[x].dot(met[low:high]) for x, low, high in zip(lists, [0, *edge], edge)])[which]
        best = np.lexsort((number, -np.round(cosine, 12)))[:k]
        return number[best], cosine[best]

    def search(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, skip: Sequence[int] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers and cosines of the k most similar examples of each vector; ties go to the smaller number."""
        room, mark = np.zeros(len(self.terms)), np.zeros(len(self.terms), bool)
        for lo in range(0, len(vectors), TOGETHER):
            some = vectors[lo : lo + TOGETHER]
            for i, (vector, short, floor) in enumerate(zip(some, *self.short(some, k)), lo):
                yield self.closest(vector, short, floor, k, skip[i] if len(skip) else -1, room, mark)

    def nearest(self, vector: dict[str, float], k: int = NEIGHBOURS, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        return next(self.search([self.columns(vector)], k, [skip]))

    def vote(self, number: np.ndarray, cosine: np.ndarray) -> float:
        """Share of toxic among the neighbours, the nearer the heavier."""
        w = self.weight[number] / (1.05 - np.minimum(cosine, 1.0))
        return float((w * self.toxic[number]).sum() / w.sum())

    def scores(self, texts: list[list[str]]) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """Score, neighbours and cosines of texts given by their words."""
        for number, cosine in self.search([self.sparse_of(words) for words in texts]):
            if not len(number):
                yield self.without, number, cosine
            else:
                yield float(1 / (1 + np.exp(-(self.slope * self.vote(number, cosine) + self.shift)))), number, cosine

    def calibrate(self, limit: int) -> None:
        """Logistic map of the votes of every so-manieth example, each left out of its own vote."""
        votes, said, weight = [], [], []
        taken, at = range(0, len(self.ids), max(1, len(self.ids) // limit)), self.starts
        for n, near in zip(taken, self.search([(self.column[at[n] : at[n + 1]], self.value[at[n] : at[n + 1]]) for n in taken], skip=taken)):
            if len(near[0]):
                votes.append(self.vote(*near))
                said.append(self.toxic[n])
                weight.append(self.weight[n])
        x = np.column_stack([votes, np.ones(len(votes))]) if votes else np.zeros((0, 2))
        y, w, b = np.array(said), np.array(weight), np.array([8.0, -4.0])
        ridge = np.diag([0.02, 0.02])
        for _ in range(25 if votes else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            slope = x.T @ (w * (p - y)) + ridge @ (b - [8.0, -4.0])
            b = b - np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, slope)
        self.slope, self.shift = map(float, b)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the labelled documents whose crc32 is not divisible by 5.

    Of several labels of a document the greatest counts; null labels and null texts do not.
    """
    known = labels.filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), 5) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(small(known), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES_PER_CLASS) -> Examples:
    """The index and its calibration, from all labelled training documents."""
    small_batches(docs.sparkSession)
    rows = training_rows(docs, labels).withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    counted = (
        rows.select(F.explode(words).alias("term"), "toxic")
        .filter("term <> ''")
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("bad"))
    )
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    if not total.n:
        return Examples({})
    share = min(max(total.bad / total.n, 1e-9), 1 - 1e-9)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [Counter(words_of(t)) for t in batch.column(1).to_pylist()]
            words, times = [list(c) for c in held], [list(c.values()) for c in held]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32())), batch.column(2), batch.column(3)], names=["doc_id", "words", "times", "toxic", "key1"])

    rows = rows.withColumns({"has": F.col("text").rlike(r"[\p{L}\p{N}]"), "key1": F.xxhash64("doc_id", "text"), "key2": F.xxhash64(F.lit("text"), "text", "doc_id")})
    sizes = {(r.toxic, r.has): r.n for r in rows.groupBy("toxic", "has").agg(F.count("*").alias("n")).collect()}
    empty = sizes.get((0, False), 0), sizes.get((1, False), 0)
    without = empty[1] / sum(empty) if sum(empty) else share
    # The lowest buckets of the keys that hold enough documents of each class; rows that repeat an id and its text are one.
    bucket = F.col("key1").bitwiseAND(BUCKETS - 1)
    spread = rows.filter("has").select("toxic", "key1", "key2").distinct().groupBy("toxic", bucket.alias("bucket")).agg(F.count("*").alias("n")).collect()
    enough = {}
    for toxic in (0, 1):
        found = 0
        for r in sorted((r for r in spread if r.toxic == toxic), key=lambda r: r.bucket):
            if found < examples:
                found, enough[toxic] = found + r.n, r.bucket
    below = F.when(F.col("toxic") == 1, enough.get(1, -1)).otherwise(enough.get(0, -1))
    taken = rows.filter("has").filter(bucket <= below).groupBy("toxic", "key1", "key2").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, words array<string>, times array<int>, toxic int, key1 bigint"
    sample = store(taken.select("doc_id", F.lower("text"), "toxic", "key1").mapInArrow(reduce, schema))
    # What was counted of the words that examples hold: only they can be shared with one.
    held = sample.select(F.explode("words").alias("term")).distinct()
    n, bad = F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0))
    departs = F.when(n > 0, (bad - n * share) / F.sqrt(n * share * (1 - share))).otherwise(0.0)
    terms = held.join(counted, "term", "left").select("term", n.alias("n"), departs.alias("departs")).toArrow()
    terms = terms.sort_by("term").combine_chunks()
    n, departs = terms.column("n").to_numpy(), terms.column("departs").to_numpy()
    scale = (np.log((1 + total.n) / (1 + n)) + 1) * (1 + np.abs(departs))
    clear = (n >= LEAST_DOCUMENTS) & (departs >= LEAST_DEVIATION)
    listed = terms.column("term")
    made = Examples.over(pa.concat_arrays(listed.chunks) if listed.num_chunks else pa.array([], pa.string()), scale, clear, without)
    del spread, terms, listed, n, departs
    told = []
    rows = sample.toLocalIterator()
    while some := list(islice(rows, FETCHED)):
        vectors = made.sparse_each([(r.words, r.times) for r in some])
        told += [(r.key1 & (BUCKETS - 1), r.key1, str(r.doc_id), r.doc_id, r.toxic, v) for r, v in zip(some, vectors)]
    told.sort(key=lambda x: x[:3])
    seen: Counter = Counter()
    for n, x in enumerate(told):
        seen[x[4]] += 1
        if seen[x[4]] > examples:
            told[n] = None
    told = [x for x in told if x]
    if not told:
        return made
    made.ids = [x[3] for x in told]
    made.toxic = np.array([float(x[4]) for x in told])
    here = Counter(x[4] for x in told)
    # A sampled class stands for all its documents.
    made.weight = np.array([sizes[x[4], True] / here[x[4]] for x in told])
    vectors = [x[5] for x in told]
    del told
    made.index(vectors)
    made.calibrate(CALIBRATION)
    made.dense = None
    give_back()  # what the index and the calibration took beside what stays
    return made


def score(docs: DataFrame, made: Examples, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`row`, score, predicted and evidence (neighbour, cosine, label) of every text.

    A text that shares no word with any example, empty and null texts among them,
    gets the share of toxic documents among the training documents without a word,
    or among all if there are none. Without training documents that is 0. Repeated
    rows are scored each.
    """
    small_batches(docs.sparkSession)
    near = pa.struct([("doc_id", pa.string()), ("cosine", pa.float64()), ("toxic", pa.int32())])

    # Written to a file once; inside of the function the driver would hold it in bytes as well.
    sent = docs.sparkSession.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = sent.value
        for batch in batches:
            scores, evidence = [], []
            for lo in range(0, batch.num_rows, TOGETHER):
                for value, number, cosine in made.scores([words_of(t) for t in batch.column(1)[lo : lo + TOGETHER].to_pylist()]):
                    scores.append(value)
                    evidence.append([{"doc_id": str(made.ids[n]), "cosine": float(c), "toxic": int(made.toxic[n])} for n, c in zip(number[:EVIDENCE], cosine)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(near))], names=["row", "score", "evidence"])

    rows = docs.select(carried(docs, keep), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    said = rows.mapInArrow(run, added(rows, score="double", evidence="array<struct<doc_id:string,cosine:double,toxic:int>>"))
    return said.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
