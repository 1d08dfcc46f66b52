"""Language-model scores by deleted interpolation over n-gram counts of the whole corpus.

P(w | v) = a[b] c(vw) / c(v) + m[b] c(w) / N + u[b] (c(w) + 0.1) / (N + 0.1 (V + 1)),
where b is the bucket of the context's frequency c(v), by powers of two. The weights
of a bucket are learned by expectation-maximisation on counts held out from the
training documents: one in ten of all documents. The counts that score are those of
all training documents.

Documents are turned once into blocks: the distinct words of some thousand documents
as 64-bit keys, and the texts as places in that list. A block asks for the counts of
its distinct words and pairs, packed by key range; a range adds up what the blocks
counted and answers each in the order of its keys. Rows are never more than the
distinct keys of the blocks, however many blocks and ranges there are, and no
range, block or answer depends on how frequent a word is. Nothing but the held-out
histogram, whose cells are bounded, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import carried, fold, lower_ascii, small_batches
from ebbline.llm.words import bytes_of, hashes, mix, spans
from ebbline.session import store

# Tokens of a block; a longer document continues in further blocks.
BLOCK_TOKENS = 3_000_000
# Keys of the tokens of this many places go to one key range.
RANGE_TOKENS = 1_000_000
END = np.uint64(0x5851F42D4C957F2D)
FOLDS = 10
SCORED, HELD_OUT, COUNTED = 0, 1, 2  # roles of documents: only scored; weights; counts
BUCKETS = 48
PER_OCTAVE = 4
ROUNDS = 60


def blocks(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Blocks of documents of one role: block, role, rows, lengths, words, places, before.

    `before` is the context of the block's first token. `ends` says of each row
    whether its text ends here, and `whole` whether it also began here.
    """
    small_batches(docs.sparkSession)
    part = fold(F.col("doc_id"), FOLDS)
    role = F.when(part == 0, SCORED).when(part == 1, HELD_OUT).otherwise(COUNTED)
    rows = docs.select(carried(docs, keep), lower_ascii(F.col("text")).alias("text"), role.cast("int").alias("role"))
    row_type = rows.schema["row"].dataType

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_ = {role: _Open(role) for role in (SCORED, HELD_OUT, COUNTED)}
        for batch in batches:
            data, ends = bytes_of(batch.column(1))
            start, stop, many = spans(data, ends)
            keys, upto = hashes(data, start, stop), np.cumsum(many)
            roles = batch.column(2).to_numpy()
            for i in range(batch.num_rows):
                text = np.append(keys[upto[i] - many[i] : upto[i]], END)
                held = open_[roles[i]]
                before, name = END, None if len(text) <= BLOCK_TOKENS else f"{number}-{i}-{len(text)}"
                for k in range(0, len(text), BLOCK_TOKENS):
                    some = text[k : k + BLOCK_TOKENS]
                    if held.tokens and held.tokens + len(some) > BLOCK_TOKENS or name and held.tokens:
                        yield held.close(number)
                        number += 1
                    held.add(batch.column(0).slice(i, 1), some, before, name)
                    before = some[-1]
        for held in open_.values():
            if held.tokens:
                yield held.close(number)
                number += 1

    kind = f"block bigint, role int, rows array<{row_type.simpleString()}>, names array<string>, lengths array<bigint>, words binary, places binary, before bigint, tokens bigint"
    return rows.mapInArrow(gather, kind)


class _Open:
    """A block while documents are added to it."""

    def __init__(self, role: int):
        self.role = role
        self.clear()

    def clear(self) -> None:
        self.rows, self.texts, self.names, self.tokens, self.before = [], [], [], 0, END

    def add(self, row: pa.Array, text: np.ndarray, before: np.uint64, name: str | None) -> None:
        if not self.tokens:
            self.before = before
        self.rows.append(row)
        self.texts.append(text)
        self.names.append(name)
        self.tokens += len(text)

    def close(self, number: int) -> pa.RecordBatch:
        words, places = np.unique(np.concatenate(self.texts), return_inverse=True)
        rows = pa.concat_arrays(self.rows)
        made = pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([self.role], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                pa.array([self.names], pa.list_(pa.string())),
                pa.array([list(map(len, self.texts))], pa.list_(pa.int64())),
                pa.array([words.tobytes()], pa.binary()),
                pa.array([places.astype(np.int32).tobytes()], pa.binary()),
                pa.array([int(self.before.view(np.int64))], pa.int64()),
                pa.array([self.tokens], pa.int64()),
            ],
            names=["block", "role", "rows", "names", "lengths", "words", "places", "before", "tokens"],
        )
        self.clear()
        return made


def _opened(words: bytes, places: bytes, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, place of each token's word, place of each token's context (in the
    words with the block's own first context behind them), and the keys of the pairs."""
    own, at = np.frombuffer(words, np.uint64), np.frombuffer(places, np.int32)
    known = np.append(own, np.array([before], np.int64).view(np.uint64))
    ahead = np.empty_like(at)
    ahead[0], ahead[1:] = len(own), at[:-1]
    return known, at, ahead, mix(known[ahead] * np.uint64(0xD1342543DE82EF95) + known[at] + np.uint64(1))


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Ends of the key ranges in sorted keys."""
    edge = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
    return np.append(np.searchsorted(keys, edge), len(keys))


def asks(made: DataFrame, ranges: int) -> DataFrame:
    """(n, range, block, role, keys, counts): the distinct words and pairs of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, role, words, places, before = (batch.column(k)[i].as_py() for k in range(5))
                known, at, _, pairs = _opened(words, places, before)
                order = np.unique(known)
                mine = np.bincount(np.searchsorted(order, known[at]), minlength=len(order))
                for n, keys, counts in ((1, order, mine), (2, *np.unique(pairs, return_counts=True))):
                    low = 0
                    for k, high in enumerate(_ranges(keys, ranges)):
                        if high > low:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([n]), pa.array([k]), pa.array([block]), pa.array([role]), pa.array([keys[low:high].tobytes()]), pa.array([_packed(counts[low:high]) if role else b""])],
                                names=["n", "range", "block", "role", "keys", "counts"],
                            )
                        low = high

    columns = made.select("block", "role", "words", "places", "before")
    return columns.mapInArrow(run, "n bigint, range bigint, block bigint, role bigint, keys binary, counts binary")


def _packed(counts: np.ndarray) -> bytes:
    """Counts in four bytes each, or in eight where one does not fit, which the first byte says."""
    wide = 8 if len(counts) and int(counts.max()) >= 1 << 32 else 4
    return bytes([wide]) + counts.astype(f"<u{wide}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64) if data else np.zeros(0, np.int64)


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """To each block of a range the counts of its keys: those of the counted documents, and
    those with the held-out ones. The row of block -1 says how many keys have any."""
    keys = [np.frombuffer(k, np.uint64) for k in group["keys"]]
    every = np.unique(np.concatenate(keys))
    counted, all_ = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
    at = [np.searchsorted(every, k) for k in keys]
    for place, role, counts in zip(at, group["role"], group["counts"]):
        if role != SCORED:
            number = _unpacked(counts)
            all_[place] += number
            if role == COUNTED:
                counted[place] += number
    n, part = group["n"].iloc[0], group["range"].iloc[0]
    rows = [(block, n, part, _packed(counted[p]) if role == HELD_OUT else b"", _packed(all_[p]), 0) for p, block, role in zip(at, group["block"], group["role"])]
    rows.append((-1, n, part, b"", b"", int((all_ > 0).sum())))
    return pd.DataFrame(rows, columns=["block", "n", "range", "counted", "all", "distinct"])


def _told(answers: pd.DataFrame, column: str, known: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the known words and of each token's pair."""
    out = []
    for n, keys in ((1, known), (2, pairs)):
        mine = answers[answers["n"] == n].sort_values("range")
        counts = np.concatenate([np.zeros(0), *map(_unpacked, mine[column])])
        out.append(counts[np.unique(keys, return_inverse=True)[1]])
    return out[0], out[1]


def _parts(word: np.ndarray, pair: np.ndarray, context: np.ndarray, total: float, distinct: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The three estimates of each token, and the bucket of its context."""
    bucket = np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)
    return pair / np.maximum(context, 1), word / max(total, 1.0), (word + 0.1) / (total + 0.1 * (distinct + 1)), bucket


def _octave(p: np.ndarray) -> np.ndarray:
    """0 for nothing, else a step on a logarithmic scale; at most 60 octaves."""
    return np.where(p > 0, np.minimum(1 + (-PER_OCTAVE * np.log2(np.maximum(p, 2.0**-60))).astype(np.int64), 60 * PER_OCTAVE), 0)


def weights(cells: pd.DataFrame) -> np.ndarray:
    """Mixture weights (bucket, estimate) by expectation-maximisation on held-out tokens.

    A row stands for n tokens of a bucket with nearly equal estimates, and has their
    means. Each bucket leans on the weights of all buckets together as on 20 tokens.
    """
    shared = np.array([0.4, 0.4, 0.2])
    out = np.tile(shared, (BUCKETS, 1))
    if not len(cells):
        return _told_apart(out)
    p, n, b = cells[["s2", "s1", "s0"]].to_numpy() / cells[["n"]].to_numpy(), cells["n"].to_numpy(), cells["bucket"].to_numpy()

    def learn(p: np.ndarray, n: np.ndarray, prior: np.ndarray) -> np.ndarray:
        w = np.array([0.4, 0.4, 0.2])
        for _ in range(ROUNDS):
            part = p * w
            w = (part / part.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) + prior
            w /= w.sum()
        return w

    shared = learn(p, n, np.array([0.01, 0.01, 0.01]))
    for k in range(BUCKETS):
        here = b == k
        out[k] = learn(p[here], n[here], 20 * shared + 1e-3) if here.any() else shared
    return _told_apart(out)


def _told_apart(mixture: np.ndarray) -> np.ndarray:
    """A context never counted says nothing of its words: its part goes to the other two estimates."""
    mixture[0] = np.array([0.0, *mixture[0][1:]]) / mixture[0][1:].sum()
    return mixture


def score(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`row`, n_tokens, n_known, train_tokens, base_score and score of every text.

    Texts are lower-cased (A-Z); tokens are words and one end. A null text is an empty
    one and has its end alone. Repeated rows are scored, and counted, each.
    """
    made = store(blocks(docs, keep), compression="zstd")
    sizes = made.groupBy("role").agg(F.sum("tokens").alias("tokens")).collect()
    tokens = {r.role: r.tokens for r in sizes}
    total, counted = float(tokens.get(COUNTED, 0) + tokens.get(HELD_OUT, 0)), float(tokens.get(COUNTED, 0))
    ranges = 1 + sum(tokens.values()) // RANGE_TOKENS
    kind = "block bigint, n bigint, range bigint, counted binary, all binary, distinct bigint"
    answers = store(asks(made, ranges).groupBy("n", "range").applyInPandas(_answer, kind), compression="zstd")
    distinct = float(answers.filter("n = 1 AND block = -1").agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0])

    def histogram(block: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "b2", "b1", "n", "s2", "s1", "s0"]
        if not len(block):
            return pd.DataFrame(columns=columns)
        one = block.iloc[0]
        known, at, ahead, pairs = _opened(one["words"], one["places"], one["before"])
        word, pair = _told(told, "counted", known, pairs)
        p2, p1, p0, bucket = _parts(word[at], pair, word[ahead], counted, distinct)
        cells = pd.DataFrame({"bucket": bucket, "b2": _octave(p2), "b1": _octave(p1), "n": 1.0, "s2": p2, "s1": p1, "s0": p0})
        return cells.groupby(["bucket", "b2", "b1"], as_index=False).sum()[columns]

    asked = answers.filter("block >= 0")
    held = made.filter(f"role = {HELD_OUT}").select("block", "words", "places", "before")
    cells = (
        held.groupBy("block")
        .cogroup(asked.join(held.select("block"), "block", "left_semi").groupBy("block"))
        .applyInPandas(histogram, "bucket long, b2 long, b1 long, n double, s2 double, s1 double, s0 double")
        .groupBy("bucket", "b2", "b1")
        .agg(*[F.sum(c).alias(c) for c in ("n", "s2", "s1", "s0")])
    )
    mixture = weights(cells.toPandas())

    def apply(block: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        columns = ["nth", "n_tokens", "n_known", "base_score", "score"]
        if not len(block):
            return pd.DataFrame(columns=["block", *columns])
        one = block.iloc[0]
        known, at, ahead, pairs = _opened(one["words"], one["places"], one["before"])
        word, pair = _told(told, "all", known, pairs)
        p2, p1, p0, bucket = _parts(word[at], pair, word[ahead], total, distinct)
        w = mixture[bucket]
        p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0
        first = np.concatenate([[0], np.cumsum(one["lengths"])[:-1]]).astype(np.int64)
        sums = [np.add.reduceat(x, first) for x in (np.ones(len(at), np.int64), (word[at] > 0).astype(np.int64), np.log10(p0), np.log10(p))]
        return pd.DataFrame({"block": one["block"], **dict(zip(columns, [np.arange(len(first)), *sums]))})

    sums = (
        made.select("block", "words", "places", "before", "lengths")
        .groupBy("block")
        .cogroup(asked.groupBy("block"))
        .applyInPandas(apply, "block bigint, nth int, n_tokens bigint, n_known bigint, base_score double, score double")
    )
    rows = made.select("block", F.posexplode(F.arrays_zip("rows", "names")).alias("nth", "one"))
    joined = rows.select("block", "nth", "one.rows", "one.names").join(sums, ["block", "nth"])
    columns = ["n_tokens", "n_known", "base_score", "score"]
    whole = joined.filter("names IS NULL").select(F.col("rows").alias("row"), *columns)
    # A text longer than a block is the sum of its parts.
    long = joined.filter("names IS NOT NULL").groupBy("names").agg(F.first("rows").alias("row"), *[F.sum(c).alias(c) for c in columns])
    return whole.unionByName(long.drop("names")).withColumn("train_tokens", F.lit(int(total)).cast("bigint"))
