"""Counting quotient filters against dictionaries, and phrases against counting every n-gram."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ebbline.llm import catalog, phrases, quotient

SCHEMA = "doc_id bigint, text string, lang string, words string, f int, n string"


def brute(rows, least=30, top=2000, share=80):
    """The contract, counted in dictionaries."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f.update((lang, *words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    often = {key: a for key, a in f.items() if len(key) > 2 and a >= least}
    longer = Counter()
    for (lang, *words), a in often.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                part = (lang, *words[k : k + size])
                longer[part] = max(longer[part], a)
    for (lang, *words), a in often.items():
        if 100 * longer[lang, *words] < share * a or (lang, *words) not in longer:
            cuts = [(2_000_000 * a // (f[lang, *words[:k]] + f[lang, *words[k:]]), k, f[lang, *words[:k]], f[lang, *words[k:]]) for k in range(1, len(words))]
            score, _, left, right = min(cuts)
            out.append((lang, " ".join(words), a, left, right, n[lang], score))
    ranked = []
    for lang in n:
        best = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(r[0], k, *r[1:]) for k, r in enumerate(best, 1)]
    return sorted(ranked)


def said(seed, many, longest=60):
    draw = random.Random(seed)
    words = ["a", "B", "of", "The", "cat", "sat", "ñu", " ", "x-y", "東京"]
    between = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", ":", "\x0b", "! ? ", ";"]
    texts = ["".join(w for _ in range(draw.randrange(longest)) for w in (draw.choice(words), draw.choice(between))) for _ in range(many)]
    return [*texts, None, "", " \n .", "a" * 500, *texts[:5], *texts[:1] * 20]


@pytest.mark.parametrize(("tokens", "ranges", "least"), [(4_000_000, 256, 5), (50, 4, 5), (7, 2, 3)])
def test_equals_dictionaries(spark, tokens, ranges, least):
    draw = random.Random(3)
    rows = [(t, draw.choice(["en", "en", "fr", None])) for t in said(1, 150)] + [(t, "long") for t in said(2, 3, 1500)[:3]]
    df = spark.createDataFrame([(k, t, lang, "clash", 1, "clash") for k, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    found = sorted(tuple(r) for r in phrases.collocations(df, least, tokens=tokens, ranges=ranges).collect())
    assert found == brute(rows, least) and len(found) > 50


def test_ties_and_the_top_of_a_language(spark):
    rows = [("p q. r s. t u. v w v w", "en")] * 5
    df = spark.createDataFrame([(k, t, lang, "", 1, "") for k, (t, lang) in enumerate(rows)], SCHEMA)
    found = sorted(tuple(r) for r in phrases.collocations(df, 2, top=2).collect())
    assert found == brute(rows, 2, top=2) and len(found) == 2


@pytest.mark.parametrize("text", [None, "", "only once said"])
def test_nothing_frequent(spark, text):
    df = spark.createDataFrame([(1, text, None, "", 1, "")], SCHEMA)
    assert phrases.collocations(df).collect() == []
    assert phrases.collocations(df.limit(0)).collect() == []


@pytest.mark.parametrize("bits", [1, 7, 8, 17, 33, 63, 64])
def test_keys_are_permuted_and_restored(bits):
    draw = random.Random(bits)
    keys = np.array(sorted({draw.randrange(1 << bits) for _ in range(2000)} | {0, (1 << bits) - 1}), np.uint64)
    moved = quotient.permuted(keys, bits)
    assert len(np.unique(moved)) == len(keys) and int(moved.max()) < 1 << bits
    assert (quotient.restored(moved, bits) == keys).all()


@pytest.mark.parametrize("bits", [3, 12, 16, 40, 64])
def test_filters_lose_nothing_and_merge(bits):
    draw = random.Random(bits)
    want, filters = Counter(), []
    for size in (0, 1, 5, 3000):
        some = Counter({draw.randrange(1 << bits): draw.choice([0, 1, 7, 254, 255, 256, 2**40]) for _ in range(size)})
        keys = np.array(sorted(some), np.uint64)
        counts = np.array([some[int(k)] for k in keys], np.int64)
        filters.append(quotient.unpacked(quotient.packed(keys, counts, bits), bits))
        assert (filters[-1][0] == keys).all() and (filters[-1][1] == counts).all()
        for k, c in some.items():
            want[k] += c
    keys, counts = quotient.merged(filters)
    assert dict(zip(keys.tolist(), counts.tolist())) == dict(want) and sorted(want) == keys.tolist()


def test_filters_take_few_bytes():
    keys = np.unique(quotient.permuted(np.arange(100_000, dtype=np.uint64) * np.uint64(977), 36))
    assert len(quotient.packed(keys, np.ones(len(keys), np.int64), 36)) < 5 * len(keys)


def test_words_of_blocks_are_not_joined_row_by_row(spark, monkeypatch):
    """Blocks get the numbers of their words in packed rows: no step lists the words of a block as rows."""
    plans = []
    store = phrases.store

    def noted(df, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df, **options)

    monkeypatch.setattr(phrases, "store", noted)
    rows = [(k, t, "en", "", 1, "") for k, t in enumerate(said(7, 40))]
    totals, every = phrases.counts(spark.createDataFrame(rows, SCHEMA).repartition(3), 3, tokens=40, ranges=4)
    plans.append(every._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) > 5 and not [p for p in plans if "posexplode" in p]
    n = Counter(w for _, t, *_ in rows for w in re.findall("[^\x20\x09-\x0d.,;:!?]+", (t or "").translate({c: c + 32 for c in range(65, 91)})))
    assert {r.phrase: r.f for r in every.filter("words = 1").collect()} == {w: f for w, f in n.items() if f >= 3}
    assert [tuple(r) for r in totals.collect()] == [("en", sum(n.values()))]


def test_numbers_of_words():
    """A range numbers frequent words from the most frequent, each by language, and answers each block."""
    lists = [(0, ["en", "fr", "en"], ["a", "a", "b"], [2, 1, 1]), (1, ["en", "en"], ["b", "c"], [4, 1]), (2, ["fr"], ["d"], [1])]
    columns = {"range": [1] * 3, "block": [b for b, *_ in lists], "nth": [phrases.squeezed(np.arange(len(w)) + 5, "<u4") for _, _, w, _ in lists]}
    columns |= {name: [x[k] for x in lists] for k, name in enumerate(("langs", "words", "counts"), 1)}
    *answers, own = phrases._number(pa.table(columns).cast(phrases.LISTED), 4, 2).to_pylist()
    assert [(w["id"], w["lang"], w["word"], w["f"]) for w in own["words"]] == [(2, "en", "b", 5), (6, "en", "a", 2)]
    assert {(t["lang"], t["n"]) for t in own["totals"]} == {("en", 8), ("fr", 2)} and own["block"] is None
    said_ = [(a["block"], phrases.loosened(a["ids"][0]["nth"], "<u4").tolist(), phrases.loosened(a["ids"][0]["id"]).tolist()) for a in answers]
    assert said_ == [(0, [5, 7], [6, 2]), (1, [5], [2])]


def test_query(spark):
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = sorted(tuple(r) for r in catalog.QUERIES["op11_phrases"](spark, "/root/testdata/sf0.001").collect())
    assert found == brute(rows)
