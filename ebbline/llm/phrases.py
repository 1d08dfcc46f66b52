"""Phrases whose words occur together, by exact counts of all n-grams in counting quotient filters.

Texts become blocks: the distinct words of some million tokens with their counts, and the
tokens as places in that list. A block sends its words to ranges of their hashes, where they
are counted as text; a range numbers those that are frequent enough and answers every block,
and blocks go on as lists of the frequent phrases at each place. A phrase of
n + 1 words can be frequent only if its first n and its last n words are, so a block packs,
for every place where both are, the number of the first n words and the number of the last
word into one key, and counts its keys in quotient filters, one for each range of keys.
A range merges the filters of all blocks, numbers the keys that are frequent, and answers
every block in the order of its keys. No key is dropped, estimated or folded with another.

What is frequent is then a table for each length, and cuts, scores, phrases within longer
ones and ranks are joins and groupings of it. Scores are worked out in decimals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import lower_ascii, small_batches
from ebbline.llm.quotient import counted, merged, packed, permuted, restored, unpacked
from ebbline.llm.words import bytes_of, hashes, mix, spans
from ebbline.session import store

LONGEST = 4
LEAST = 30  # occurrences of a candidate
TOP = 2000
SHARE = 80  # percent of a phrase's occurrences that a longer one has to hold to take its place
FACTOR = 2_000_000

# Tokens of a block; a longer text continues in further blocks.
BLOCK_TOKENS = 4_000_000
# Key ranges, at least, and tokens a range.
RANGES = 256
RANGE_TOKENS = 4_000_000
# Rows of a language are first ranked in so many parts.
PARTS = 64

# What ends a piece: . , ; : ! ? and the controls 10 to 13. Blank and tab stand between words.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
# Bytes of texts, with what ends a piece as a blank.
SPACED = np.where(ENDS, 32, np.arange(256)).astype(np.uint8)


def squeezed(numbers: np.ndarray, kind: str = "<u8") -> bytes:
    raw = numbers.astype(kind).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def loosened(data: bytes, kind: str = "<u8") -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), kind)


def blocks(docs: DataFrame, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(block, own, langs, words, counts, places): tokens of texts as places in a list of words.

    Place 0 stands between pieces, place k for word k - 1. Of the places the first `own` are
    the block's; up to three more, of a text that goes on, say only what follows.
    """
    small_batches(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("key"), lower_ascii(F.col("text")).alias("text"))
    return rows.mapInArrow(partial(_gather, limit=tokens), "block bigint, own bigint, langs array<string>, words array<string>, counts array<bigint>, places binary")


def _gather(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    many = 0
    for batch in batches:
        part = _tokens(batch)
        if held and many + len(part[0]) > limit:
            yield _block(held, number, many)
            held, many, number = [], 0, number + 1
        keys, *rest = part
        if len(keys) <= limit:
            held.append((keys, *rest))
            many += len(keys)
            continue
        for low in range(0, len(keys), limit):
            yield _block([(keys[low : low + limit + LONGEST - 1], *rest)], number, min(limit, len(keys) - low))
            number += 1
    if held:
        yield _block(held, number, many)


def _tokens(batch: pa.RecordBatch) -> tuple:
    """Keys of the words of a batch, 0 between pieces, and for each distinct key its word."""
    data, ends = bytes_of(batch.column(2))
    start, stop, many = spans(SPACED[data], ends)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), [], []
    doc = np.repeat(np.arange(len(ends)), many)
    lang = batch.column(1).to_numpy().astype(np.uint64)
    words = mix(hashes(data, start, stop) + lang[doc] * np.uint64(2)) | np.uint64(1)
    # A piece begins where a text does, or behind a byte that ends one.
    passed = np.cumsum(ENDS[data], dtype=np.int32)[start]
    begins = np.append(True, (passed[1:] != passed[:-1]) | (doc[1:] != doc[:-1]))
    keys = np.zeros(len(words) + int(begins.sum()), np.uint64)
    keys[np.arange(len(words)) + np.cumsum(begins)] = words
    distinct, first = np.unique(words, return_index=True)
    offsets = np.empty(2 * len(start), np.int64)
    offsets[::2], offsets[1::2] = start, stop
    between = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    said = between.take(pa.array(first * 2)).cast(pa.binary()).cast(pa.string())
    return keys, distinct, said, batch.column(0).take(pa.array(doc[first]))


def _block(parts: list[tuple], number: int, own: int) -> pa.RecordBatch:
    keys = np.concatenate([p[0] for p in parts])
    known, first = np.unique(np.concatenate([p[1] for p in parts]), return_index=True)
    distinct, places = np.unique(np.append(np.uint64(0), keys), return_inverse=True)
    counts = np.bincount(places[1 : own + 1], minlength=len(distinct))[1:]
    # The most frequent words come first, which packs better.
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order) + 1, np.int64)
    rank[0], rank[order + 1] = 0, np.arange(1, len(order) + 1)
    at = pa.array(first[np.searchsorted(known, distinct[1:])][order])
    lists = []
    for k in (3, 2):
        every = pa.concat_arrays([p[k] for p in parts if len(p[1])]) if len(order) else pa.array([], pa.string())
        every = every.take(at)
        lists.append(pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every))
    counted_ = pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), pa.array(counts[order], pa.int64()))
    columns = [pa.array([number], pa.int64()), pa.array([own], pa.int64()), *lists, counted_, pa.array([squeezed(rank[places[1:]], "<u4")], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["block", "own", "langs", "words", "counts", "places"])


LISTED = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("nth", pa.binary()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _ask_words(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    """Rows (range, block, nth, langs, words, counts) of the words of a block, by range of their hashes."""
    shift = np.uint64(64 - (ranges.bit_length() - 1))
    for batch in batches:
        for k, block in enumerate(batch.column(0).to_pylist()):
            langs, words, counts_ = (batch.column(c)[k].values for c in (1, 2, 3))
            data, stop = bytes_of(words)
            found = hashes(data, np.append(0, stop)[:-1], stop)
            of = (found >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(found), np.int64)
            order = np.argsort(of, kind="stable")
            edges = np.searchsorted(of[order], np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(edges))
            offsets = pa.array(np.append(edges[some], len(order)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, c.take(pa.array(order))) for c in (langs, words, counts_)]
            nth = [squeezed(order[edges[r] : edges[r + 1]], "<u4") for r in some]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array(nth, pa.binary()), *lists], schema=LISTED)


NUMBERED = "block bigint, ids array<struct<nth:binary,id:binary>>, words array<struct<id:bigint,lang:string,word:string,f:bigint>>, totals array<struct<lang:string,n:bigint>>"


def _number(table: pa.Table, ranges: int, least: int) -> pa.Table:
    """The frequent words of a range with numbers, the words there are in each language, and for every block
    where its frequent words are in its list and their numbers."""
    part = table.column("range")[0].as_py()
    langs, words, counts_ = (pc.list_flatten(table.column(c)).combine_chunks() for c in ("langs", "words", "counts"))
    langs, words, times = langs.dictionary_encode(), words.dictionary_encode(), counts_.to_numpy()
    many = len(langs.dictionary)
    pairs, of = np.unique(words.indices.to_numpy().astype(np.int64) * many + langs.indices.to_numpy(), return_inverse=True)
    f, n = np.zeros(len(pairs), np.int64), np.zeros(many, np.int64)
    np.add.at(f, of, times)
    np.add.at(n, pairs % many, f)
    often = np.flatnonzero(f >= least)
    lang, word = langs.dictionary.take(pa.array(pairs[often] % many)), words.dictionary.take(pa.array(pairs[often] // many))
    # The most frequent words have the least numbers, which pack better.
    order = pc.sort_indices(pa.table({"f": f[often], "lang": lang, "word": word}), [("f", "descending"), ("lang", "ascending"), ("word", "ascending")])
    often = often[order.to_numpy()]
    number = np.zeros(len(pairs), np.int64)
    number[often] = np.arange(len(often)) * ranges + part + 1
    said = pa.StructArray.from_arrays([pa.array(number[often]), lang.take(order), word.take(order), pa.array(f[often])], names=["id", "lang", "word", "f"])
    totals = pa.StructArray.from_arrays([langs.dictionary, pa.array(n)], names=["lang", "n"])

    ids = number[of]
    edges = np.cumsum(np.append(0, pc.list_value_length(table.column("words")).to_numpy())).tolist()
    answers = []
    for block, nth, low, high in zip(table.column("block").to_pylist(), table.column("nth").to_pylist(), edges, edges[1:]):
        if len(some := np.flatnonzero(ids[low:high])):
            answers.append((block, {"nth": squeezed(loosened(nth, "<u4")[some], "<u4"), "id": squeezed(ids[low:high][some])}))
    # One row for each block, and one for the range itself.
    rows = len(answers)
    kind = pa.struct([("nth", pa.binary()), ("id", pa.binary())])
    own = lambda values: pa.ListArray.from_arrays(pa.array([0] * (rows + 1) + [len(values)], pa.int32()), values)
    columns = [pa.array([*(b for b, _ in answers), None], pa.int64()), pa.array([*([a] for _, a in answers), []], pa.list_(kind)), own(said), own(totals)]
    return pa.Table.from_arrays(columns, names=["block", "ids", "words", "totals"])


def _numbering(ranges: int, least: int) -> Callable[[pa.Table], pa.Table]:
    """What a range does with the words that blocks sent it."""

    def number(table: pa.Table) -> pa.Table:
        return _number(table, ranges, least)

    return number


def _begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequent words of a block: where they stand and their numbers."""
    for batch in batches:
        for block, own, places, answers in zip(*(c.to_pylist() for c in batch.columns)):
            places = loosened(places, "<u4")
            number = np.zeros(int(places.max(initial=0)) + 1, np.uint64)
            for answer in answers:
                number[loosened(answer["nth"], "<u4") + np.uint32(1)] = loosened(answer["id"])
            words = number[places]
            at = np.flatnonzero(words)
            yield _state(block, own, at, words[at], None)


def _state(block: int, own: int, at: np.ndarray, phrase: np.ndarray, word: np.ndarray | None) -> pa.RecordBatch:
    cells = [squeezed(np.diff(at, prepend=0), "<u4"), squeezed(phrase), None if word is None else squeezed(word)]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([own], pa.int64()), *(pa.array([c], pa.binary()) for c in cells)], names=["block", "own", "at", "phrase", "word"]
    )


STATE = "block bigint, own bigint, at binary, phrase binary, word binary"


def _longer(at: bytes, phrase: bytes, word: bytes | None, word_bits: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where a phrase of one word more may stand, its permuted key and its last word."""
    places, phrases = np.cumsum(loosened(at, "<u4"), dtype=np.int64), loosened(phrase)
    words = phrases if word is None else loosened(word)
    i = np.flatnonzero(places[1:] == places[:-1] + 1)
    last = words[i + 1]
    return places[i], permuted(phrases[i] << np.uint64(word_bits) | last, bits), last


ASKED = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("filter", pa.binary())])


def _ask(batches: Iterator[pa.RecordBatch], word_bits: int, bits: int, ranges: int) -> Iterator[pa.RecordBatch]:
    """Rows (range, block, filter) of the keys of a block."""
    rest = bits - (ranges.bit_length() - 1)
    for batch in batches:
        for block, own, *cells in zip(*(c.to_pylist() for c in batch.columns)):
            places, found, _ = _longer(*cells, word_bits, bits)
            keys, counts = counted(found)
            for key in found[places >= own]:  # three at most, which another block counts
                counts[np.searchsorted(keys, key)] -= 1
            edges = np.searchsorted(keys, np.arange(1, ranges, dtype=np.uint64) << np.uint64(rest)).tolist()
            for k, (low, high) in enumerate(zip([0, *edges], [*edges, len(keys)])):
                if high > low:
                    within = keys[low:high] & np.uint64((1 << rest) - 1)
                    yield pa.RecordBatch.from_pylist([{"range": k, "block": block, "filter": packed(within, counts[low:high], rest)}], ASKED)


def _merging(word_bits: int, bits: int, ranges: int, least: int) -> Callable[[pa.Table], pa.Table]:
    """What a range does with the filters that blocks sent it."""

    def merge(table: pa.Table) -> pa.Table:
        return _merge(table, word_bits, bits, ranges, least)

    return merge


def _merge(table: pa.Table, word_bits: int, bits: int, ranges: int, least: int) -> pa.Table:
    """The frequent keys of a range, numbered, and for every block the numbers of its keys (0: not frequent)."""
    rest = bits - (ranges.bit_length() - 1)
    nth = table.column("range")[0].as_py()
    filters = [unpacked(f, rest) for f in table.column("filter").to_pylist()]
    keys, counts = merged(filters)
    often = counts >= least
    number = np.zeros(len(keys), np.uint64)
    number[often] = np.arange(often.sum(), dtype=np.uint64) * np.uint64(ranges) + np.uint64(nth + 1)
    full = restored(keys[often] | np.uint64(nth << rest), bits)
    columns = [number[often], full >> np.uint64(word_bits), full & np.uint64((1 << word_bits) - 1), counts[often]]
    phrases = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["id", "prefix", "last", "f"])
    kinds = pa.schema([("block", pa.int64()), ("range", pa.int32()), ("ids", pa.binary()), ("phrases", pa.list_(phrases.type))])
    answers = [squeezed(number[np.searchsorted(keys, asked)]) for asked, _ in filters]
    lists = pa.ListArray.from_arrays(pa.array([0] * (len(answers) + 1) + [len(phrases)], pa.int32()), phrases)
    columns = [pa.array([*table.column("block").to_pylist(), None], pa.int64()), pa.array([nth] * (len(answers) + 1), pa.int32()), pa.array([*answers, None], pa.binary()), lists]
    return pa.Table.from_arrays(columns, schema=kinds)


def _answered(batches: Iterator[pa.RecordBatch], word_bits: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The frequent longer phrases of a block."""
    for batch in batches:
        for block, own, *cells, answers in zip(*(c.to_pylist() for c in batch.columns)):
            places, found, last = _longer(*cells, word_bits, bits)
            ids = np.concatenate([loosened(a["ids"]) for a in sorted(answers, key=lambda a: a["range"])])
            phrase = ids[np.unique(found, return_inverse=True)[1]]
            kept = np.flatnonzero(phrase)
            yield _state(block, own, places[kept], phrase[kept], last[kept])


def _bits(ids: DataFrame) -> int:
    return int(ids.agg(F.max("id")).first()[0] or 0).bit_length()


def counts(docs: DataFrame, least: int = LEAST, tokens: int = BLOCK_TOKENS, ranges: int = RANGES) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all languages, and (lang, words, phrase, f) of all phrases of 1 to 4 words that occur `least` times.

    A null lang is `und`, a null text is empty; equal rows count each.
    """
    made = store(blocks(docs, tokens), compression="zstd")
    total = int(made.agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()[0] or 0)
    ranges = 1 << max((ranges - 1).bit_length(), int(total // RANGE_TOKENS).bit_length())
    asked = made.select("block", "langs", "words", "counts").mapInArrow(partial(_ask_words, ranges=ranges), "range int, block bigint, nth binary, langs array<string>, words array<string>, counts array<bigint>")
    answered = store(asked.groupBy("range").applyInArrow(_numbering(ranges, least), NUMBERED))
    totals = answered.filter("block IS NULL").select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("n"))
    words = store(answered.filter("block IS NULL").select(F.inline("words")))
    said = [words.select("lang", F.lit(1).alias("words"), F.col("word").alias("phrase"), "f")]
    word_bits = _bits(words)

    ids = answered.filter("block IS NOT NULL").groupBy("block").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    state = store(made.select("block", "own", "places").join(ids, "block").mapInArrow(_begun, STATE))
    before = words.select("id", "lang", F.col("word").alias("phrase"))
    phrase_bits = word_bits
    for n in range(2, LONGEST + 1):
        bits = max(phrase_bits + word_bits, ranges.bit_length())
        if bits > 64:
            raise ValueError(f"{n - 1} words and one more do not fit 64 bits")
        asked = state.mapInArrow(partial(_ask, word_bits=word_bits, bits=bits, ranges=ranges), "range int, block bigint, filter binary")
        answered = asked.groupBy("range").applyInArrow(
            _merging(word_bits, bits, ranges, least),
            "block bigint, range int, ids binary, phrases array<struct<id:bigint,prefix:bigint,last:bigint,f:bigint>>",
        )
        answered = store(answered)
        found = answered.filter("block IS NULL").select(F.inline("phrases"))
        first, last = before.withColumnRenamed("id", "prefix"), words.select(F.col("id").alias("last"), "word")
        found = store(found.join(first, "prefix").join(last, "last").select("id", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "f"))
        said.append(found.select("lang", F.lit(n).alias("words"), "phrase", "f"))
        if n < LONGEST:
            answers = answered.filter("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("range", "ids")).alias("answers"))
            state = store(state.join(answers, "block").mapInArrow(partial(_answered, word_bits=word_bits, bits=bits), STATE))
            before, phrase_bits = found.select("id", "lang", "phrase"), _bits(found)
    every_length = said[0]
    for some in said[1:]:
        every_length = every_length.unionByName(some)
    return totals, every_length


def _slice(phrase: str, begin: Column, many: Column) -> Column:
    return F.array_join(F.slice(F.split(F.col(phrase), " "), begin, many), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, tokens: int = BLOCK_TOKENS, ranges: int = RANGES) -> DataFrame:
    """The best phrases of 2 to 4 words of every language: lang, rank, phrase, a, l, r, n, score.

    A phrase is left out if a longer one holds it and occurs `share` percent as often. It
    scores by the cut whose parts are least bound; ties go to the higher count, then to the
    lesser phrase in the order of UTF-8. Documents without such phrases have no rows.
    """
    totals, phrases = counts(docs, least, tokens, ranges)
    candidates = phrases.filter("words > 1")
    of = phrases.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of"), F.col("f").alias("of_f"))
    part = lambda side, name: of.select(F.col("of_lang").alias(f"{side}_lang"), F.col("of").alias(side), F.col("of_f").alias(name))

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("front", _slice("phrase", F.lit(1), F.col("k"))).withColumn("back", _slice("phrase", F.col("k") + 1, F.col("words") - F.col("k")))
    front = (F.col("lang") == F.col("front_lang")) & (F.col("left_") == F.col("front"))
    cuts = cuts.join(part("front", "l").withColumnRenamed("front", "left_"), front)
    back = (F.col("lang") == F.col("back_lang")) & (F.col("right_") == F.col("back"))
    cuts = cuts.join(part("back", "r").withColumnRenamed("back", "right_"), back)
    # In decimals, as the product may pass 64 bits.
    score = F.expr(f"(CAST({FACTOR} AS DECIMAL(9,0)) * CAST(f AS DECIMAL(20,0))) div CAST(l + r AS DECIMAL(20,0))")
    scored = cuts.groupBy("lang", "phrase", "words", "f").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    begin = F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1))
    held = candidates.filter("words > 2").select("*", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    held = held.select(F.col("lang").alias("in_lang"), "f", "phrase", "size", begin.alias("begin")).withColumn("within", _slice("phrase", F.col("begin"), F.col("size")))
    longer = held.groupBy("in_lang", "within").agg(F.max("f").alias("longer"))
    joined = scored.join(longer, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("within")), "left")
    kept = joined.filter(f"longer IS NULL OR 100 * longer < {share} * f")

    # Ranked in parts first, so that no language passes whole through one task.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part"))
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("nth") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    of_all = totals.select(F.col("lang").alias("n_lang"), "n")
    return ranked.join(of_all, F.col("lang") == F.col("n_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
