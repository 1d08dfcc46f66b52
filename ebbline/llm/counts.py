"""Token counts of whole texts under a word-level BPE with its own normaliser.

White space is dropped by this kind of tokenizer and no token reaches across it,
so the count of a text is the sum of the counts of its words, and a task counts
each distinct word once. Texts of more than `CHUNK` characters become
overlapping chunks, encoded in parallel with offsets. Neighbours are spliced at
the first token start of their overlap that both report and that follows white
space: there the encodings are proven to agree from then on. A text with a
junction that has none is cut anew with overlaps and chunks four times as wide,
until all its junctions hold or it is one chunk.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbline.llm.chunks import in_order, overlapping, text_key
from ebbline.llm.common import added, carried, small_batches
from ebbline.session import store

CHUNK = 32_768
OVERLAP = 512
# Words a task remembers; beyond that it starts afresh, which changes nothing but time.
REMEMBERED = 400_000
BLANK = " \t\n\r"


class Vocabulary:
    """The tokenizer's file, small enough to travel with the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.text = file.read()

    def tokenizer(self) -> Tokenizer:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        made = Tokenizer.from_str(self.text)
        made.no_truncation()
        made.no_padding()
        return made


def count(docs: DataFrame, words: Vocabulary, keep: Sequence[str] = ("doc_id",), chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """`row`, n_bytes and n_tokens of every text; null counts as empty, repeated rows count each."""
    small_batches(docs.sparkSession)
    rows = docs.select(carried(docs, keep), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    short, long = rows.filter(F.length("text") <= chunk), rows.filter(F.length("text") > chunk)

    def by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = words.tokenizer()
        known: dict[str, int] = {}
        for batch in batches:
            split = [text.replace("\n", " ").split(" ") for text in batch.column(1).to_pylist()]
            if len(known) > REMEMBERED:
                known.clear()
            fresh = list({word for text in split for word in text} - known.keys())
            known.update(zip(fresh, map(len, tokenizer.encode_batch_fast(fresh, add_special_tokens=False))))
            n = [sum(map(known.__getitem__, text)) for text in split]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names=["row", "n_bytes", "n_tokens"])

    counted = short.select("row", "text", "n_bytes").mapInArrow(by_word, added(short, n_bytes="bigint", n_tokens="bigint"))
    spliced = _spliced(long.select(text_key(), "text").dropDuplicates(["key"]), words, chunk, overlap)
    return counted.unionByName(long.select("row", "n_bytes", text_key()).join(spliced, "key").select("row", "n_bytes", "n_tokens"))


def _spliced(texts: DataFrame, words: Vocabulary, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of long texts."""
    done: DataFrame | None = None
    while True:
        tried = store(_junctions(texts, words, chunk, overlap))
        held = tried.filter("held").select("key", "n_tokens")
        done = held if done is None else done.unionByName(held)
        failed = tried.filter(~F.col("held")).select("key")
        if failed.isEmpty():
            return done
        texts = texts.join(failed, "key", "left_semi")
        overlap, chunk = overlap * 4, max(chunk, overlap * 8)


def _junctions(texts: DataFrame, words: Vocabulary, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens, held): the count of a text, right if all its junctions held."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = words.tokenizer()
        pairs = pa.map_(pa.int64(), pa.int64())
        for batch in batches:
            heads, tails, totals = [], [], []
            for start, part in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                starts = [s for s, _ in tokenizer.encode(part, add_special_tokens=False).offsets]
                stable = [(start + s, n) for n, s in enumerate(starts) if s and part[s - 1] in BLANK and s != starts[n - 1]]
                heads.append([x for x in stable if x[0] < start + overlap])
                tails.append([x for x in stable if x[0] >= start + chunk])
                totals.append(len(starts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, pairs), pa.array(tails, pairs), pa.array(totals, pa.int64())],
                names=["key", "nth", "head", "tail", "total"],
            )

    kind = "map<bigint,bigint>"
    seen = overlapping(texts, chunk, overlap).mapInArrow(encode, f"key string, nth bigint, head {kind}, tail {kind}, total bigint")
    shared = F.array_intersect(F.map_keys("tail"), F.map_keys(F.lead("head").over(in_order())))
    cut = (
        seen.withColumn("end", F.array_min(shared))
        .withColumn("begin", F.lag("end").over(in_order()))
        .withColumn("last", F.lead("nth").over(in_order()).isNull())
    )
    own = F.coalesce(F.col("tail")[F.col("end")], F.col("total")) - F.coalesce(F.col("head")[F.col("begin")], F.lit(0))
    return cut.groupBy("key").agg(F.sum(own).alias("n_tokens"), F.bool_and(F.col("last") | F.col("end").isNotNull()).alias("held"))
