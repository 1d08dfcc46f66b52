"""Byte-level BPE over whole texts: ids by the ranks of a public vocabulary, and back to bytes.

A text up to `CHUNK` characters is encoded where it lies. A longer one becomes
overlapping chunks that are pre-tokenised in parallel. The pattern that cuts a
text into pre-tokens looks only ahead, so two chunks that have one boundary of
their overlap in common have all later ones in common: there the text is cut,
and the pieces are encoded in parallel. Where an overlap has no common boundary
the pieces on both sides stay one. Ids of the pieces, in order, are the ids of
the text; decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.chunks import agreed, in_order, overlapping, text_key
from ebbline.llm.common import added, carried, small_batches

CHUNK = 32_768
OVERLAP = 512


class Codec:
    """Ranks and pattern; small enough to travel with the tasks, built once in each."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.lines = lines.read()
        self.pattern = pattern

    def encoding(self) -> tiktoken.Encoding:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, self.lines.splitlines())}
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})


def encode(docs: DataFrame, codec: Codec, keep: Sequence[str] = ("doc_id",), chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`row`, piece and ids of every piece of every text; short texts are one piece.

    A null text is an empty one and has one piece without ids.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = codec.encoding()
        for batch in batches:
            ids = [encoding.encode_ordinary(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["row", "piece", "ids"])

    short, long = _by_length(docs, keep, chunk)
    short = short.select("row", F.lit(0).cast("bigint").alias("piece"), "text")
    some = long.select("row", text_key()).join(_pieces(long, codec.pattern, chunk, overlap), "key")
    rows = short.unionByName(some.select("row", "piece", "text"))
    return rows.mapInArrow(run, added(rows, piece="bigint", ids="array<int>"))


def decode(encoded: DataFrame, codec: Codec) -> DataFrame:
    """The bytes of every row of ids, beside the row's other columns; null ids have none.

    An id outside the vocabulary raises a KeyError.
    """
    others = [c for c in encoded.columns if c not in ("ids", "bytes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = codec.encoding()
        for batch in batches:
            raw = [encoding.decode_bytes(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["row", "bytes"])

    rows = encoded.select(carried(encoded, others), "ids")
    return rows.mapInArrow(run, added(rows, bytes="binary")).select("row.*", "bytes")


def digests(docs: DataFrame, codec: Codec, keep: Sequence[str] = ("doc_id",), chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`row`, n_tokens, and the SHA-256 of the ids and of the decoded bytes of every text.

    Ids are hashed as decimals joined by one space. The digest of one text is
    sequential, so the pieces of a long text meet again in one task, in order and
    one at a time in the hash; no text is longer than a cell of its table.
    """
    small_batches(docs.sparkSession)
    short, long = _by_length(docs, keep, chunk)
    kinds = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = codec.encoding()
        number = [str(i) for i in range(encoding.n_vocab)].__getitem__
        for batch in batches:
            n, ids_hash, raw_hash = [], [], []
            for text in batch.column(1).to_pylist():
                ids = encoding.encode_ordinary(text)
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(" ".join(map(number, ids)).encode()).hexdigest())
                raw_hash.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(raw_hash)], names=["row", *kinds])

    def piecewise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = codec.encoding()
        for batch in batches:
            ids = [encoding.encode_ordinary(t) for t in batch.column(2).to_pylist()]
            said = [" ".join(map(str, i)).encode() for i in ids]
            raw = [encoding.decode_bytes(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(map(len, ids)), pa.int64()), pa.array(said, pa.binary()), pa.array(raw, pa.binary())],
                names=["key", "piece", "n", "said", "raw"],
            )

    pieces = _pieces(long, codec.pattern, chunk, overlap)
    encoded = pieces.mapInArrow(piecewise, "key string, piece bigint, n bigint, said binary, raw binary")
    hashed = encoded.groupBy("key").applyInPandas(_in_order, "key string, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    there = long.select("row", text_key()).join(hashed, "key").select("row", *kinds)
    return short.select("row", "text").mapInArrow(whole, added(short, **kinds)).unionByName(there)


def _in_order(pieces: pd.DataFrame) -> pd.DataFrame:
    ids_hash, raw_hash, n = hashlib.sha256(), hashlib.sha256(), 0
    for part in pieces.sort_values("piece").itertuples():
        if n and part.n:
            ids_hash.update(b" ")
        ids_hash.update(part.said)
        raw_hash.update(part.raw)
        n += part.n
    return pd.DataFrame({"key": [pieces["key"].iloc[0]], "n_tokens": [n], "ids_sha256": [ids_hash.hexdigest()], "decoded_sha256": [raw_hash.hexdigest()]})


def _by_length(docs: DataFrame, keep: Sequence[str], chunk: int) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(carried(docs, keep), F.coalesce("text", F.lit("")).alias("text"))
    return rows.filter(F.length("text") <= chunk), rows.filter(F.length("text") > chunk)


def _pieces(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, piece, text): the pieces of every distinct long text."""
    texts = long.select(text_key(), "text").dropDuplicates(["key"])
    chunks = overlapping(texts, chunk, overlap)

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for start, part in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                head, tail = _edges(regex.compile(pattern).finditer, part, chunk, overlap)
                heads.append([start + p for p in head])
                tails.append([start + p for p in tail])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, kind), pa.array(tails, kind)], names=[*batch.schema.names, "head", "tail"])

    seen = chunks.mapInArrow(pretokenise, "key string, nth bigint, start bigint, part string, head array<bigint>, tail array<bigint>")
    cut = seen.withColumn("end", agreed("tail", "head")).withColumn("begin", F.lag("end").over(in_order()))
    # Without an agreed boundary a chunk hands over where the next one starts, and both stay in one piece.
    own = (
        cut.withColumn("piece", F.sum(F.col("begin").isNotNull().cast("bigint")).over(in_order().rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("last", F.lead("nth").over(in_order()).isNull())
        .withColumn("from", F.coalesce(F.col("begin") - F.col("start"), F.lit(0)))
        .withColumn("to", F.when(F.col("last"), F.length("part")).otherwise(F.coalesce(F.col("end") - F.col("start"), F.lit(chunk))))
        .withColumn("part", F.col("part").substr((F.col("from") + 1).cast("int"), (F.col("to") - F.col("from")).cast("int")))
    )
    parts = own.groupBy("key", "piece").agg(F.array_sort(F.collect_list(F.struct("nth", "part"))).alias("parts"))
    return parts.select("key", "piece", F.array_join(F.col("parts.part"), "").alias("text"))


def _edges(matches: Callable, part: str, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Starts of pre-tokens in the first `overlap` characters, and behind the first `chunk` ones.

    The last pre-token may be cut off by the end of the chunk, so only its start counts.
    """
    starts = [m.start() for m in matches(part)]
    return [p for p in starts if p < overlap], [p for p in starts if p >= chunk]
