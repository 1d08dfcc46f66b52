"""Interpolated scores against dictionaries of counts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from ebbline.llm import lm

SCHEMA = "doc_id bigint, text string, score string, row string, block int"
END = "\0end"


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lower = lower.replace(blank, " ")
    return [w for w in lower.split(" ") if w] + [END]


def brute(texts):
    """The definition, one token at a time."""
    part = {i: zlib.crc32(str(i).encode()) % 10 for i, _ in texts}
    train = [tokens(t) for i, t in texts if part[i] != 0]
    inner = [tokens(t) for i, t in texts if part[i] > 1]

    def count(docs):
        one = Counter(w for d in docs for w in d)
        two = Counter(p for d in docs for p in zip([END, *d], d))
        return one, two, sum(one.values())

    def estimates(word, before, model, distinct):
        one, two, total = model
        context = one[before]
        base = (one[word] + 0.1) / (total + 0.1 * (distinct + 1))
        return two[before, word] / max(context, 1), one[word] / max(total, 1), base, min(int(math.log2(context + 1)), lm.BUCKETS - 1)

    every, part_model = count(train), count(inner)
    distinct = len(every[0])
    cells = defaultdict(lambda: np.zeros(4))
    for i, t in texts:
        if part[i] == 1:
            d = tokens(t)
            for before, word in zip([END, *d], d):
                p2, p1, p0, b = estimates(word, before, part_model, distinct)
                cells[b, int(lm._octave(np.array([p2]))[0]), int(lm._octave(np.array([p1]))[0])] += (1, p2, p1, p0)
    frame = pd.DataFrame([(*k, *v) for k, v in cells.items()], columns=["bucket", "b2", "b1", "n", "s2", "s1", "s0"])
    w = lm.weights(frame)
    out = {}
    for i, t in texts:
        d = tokens(t)
        base = score = known = 0
        for before, word in zip([END, *d], d):
            p2, p1, p0, b = estimates(word, before, every, distinct)
            base += math.log10(p0)
            score += math.log10(w[b] @ [p2, p1, p0])
            known += every[0][word] > 0
        out[i] = (len(d), known, every[2], base, score)
    return out


TEXTS = [(i, " ".join(f"{'aA'[i % 2]}b{(i * k * k + k) % (7 + i % 5)}" for k in range(i % 90))) for i in range(120)]
TEXTS += [(200, None), (201, ""), (202, " \t\r\n\x0b\x0c "), (203, "é\x85 E x unseen-" + "z" * 50), (204, "ab1 ab2 " * 400), (205, "same same"), (206, "same same")]


@pytest.mark.parametrize("block", [3_000_000, 150])
def test_equals_dictionaries(spark, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(lm, "RANGE_TOKENS", 500)
    docs = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in TEXTS], SCHEMA).repartition(3)
    rows = lm.score(docs).select("row.doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    want = brute(TEXTS)
    assert sorted(r.doc_id for r in rows) == sorted(want)
    for r in rows:
        assert tuple(r)[1:4] == want[r.doc_id][:3]
        assert tuple(r)[4:] == pytest.approx(want[r.doc_id][3:], rel=1e-9)


def test_estimates_add_up_to_one():
    """Over the words that occur and one unknown word, after contexts that occur and one that does not."""
    words = {"a": 50, "b": 9, "c": 1}
    pairs = {"a": {"a": 20, "b": 9, "c": 1, "a2": 0}, "b": {"a": 9}, "c": {"a": 1}, "never": {}}
    total, distinct = float(sum(words.values())), float(len(words))
    cells = pd.DataFrame([(b, 1, 1, 100.0, 30.0, 20.0, 10.0) for b in (0, 1, 3)], columns=["bucket", "b2", "b1", "n", "s2", "s1", "s0"])
    for w in (lm.weights(cells), lm.weights(cells[:0])):
        assert np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0
        for before, after in pairs.items():
            context = np.full(4, float(sum(after.values())))
            word = np.array([*words.values(), 0], float)
            pair = np.array([*(after.get(x, 0) for x in words), 0], float)
            p2, p1, p0, bucket = lm._parts(word, pair, context, total, distinct)
            assert (w[bucket] * np.stack([p2, p1, p0], axis=1)).sum() == pytest.approx(1)


def test_counts_beyond_four_bytes():
    for counts in ([], [0, 7], [2**32 - 1], [1, 2**32, 2**40]):
        assert lm._unpacked(lm._packed(np.array(counts, np.int64))).tolist() == counts
    keys = np.array([3, 5], np.uint64).tobytes()
    many = [(1, 0, b, lm.COUNTED, keys, lm._packed(np.array([3_000_000_000, 1]))) for b in (1, 2)]
    group = pd.DataFrame(many, columns=["n", "range", "block", "role", "keys", "counts"])
    told = lm._answer(group).set_index("block")["all"]
    assert lm._unpacked(told[1]).tolist() == lm._unpacked(told[2]).tolist() == [6_000_000_000, 2]


@pytest.mark.parametrize("texts", [[], [(0, "a b")], [(i, None) for i in range(30)]])
def test_little_to_learn_from(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in texts], SCHEMA)
    rows = lm.score(docs).collect()
    assert len(rows) == len(texts)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
