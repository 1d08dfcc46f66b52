"""The byte network: gradients, pooling over windows, held-out accuracy, awkward texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.llm import language

SCHEMA = "doc_id bigint, text string, lang string, score double, row string, languages int"
SYLLABLES = {"aa": ["ka", "lo", "mi", "tu", "né"], "bb": ["str", "eng", "olk", "üh", "and"], "cc": ["çe", "xi", "quo", "ba", "io"]}


def made(n=500):
    draw = random.Random(2)
    rows = []
    for i in range(n):
        lang = draw.choice(sorted(SYLLABLES))
        words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randrange(1, 4))) for _ in range(draw.randrange(3, 120))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_gradient():
    """Back-propagation through time against differences of the loss."""
    net = language.Network(["a", "b", "c"], hidden=4)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    draw = np.random.default_rng(1)
    x, y, inside = draw.integers(0, 256, (9, 5)), draw.integers(0, 3, 5), draw.random((9, 5)) < 0.8
    _, grown = net.gradient(x, y, inside)
    for name, w in net.weights.items():
        for _ in range(5):
            at = tuple(draw.integers(0, n) for n in w.shape)
            at = (at[0], x[2, 1]) if name.startswith("in_") else at
            old, losses = w[at], []
            for step in (1e-2, -1e-2):
                w[at] = old + step
                losses.append(net.gradient(x, y, inside)[0])
            w[at] = old
            assert grown[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-2, abs=2e-3, rel=0.05)


def test_pooling_counts_every_position_once():
    net = language.Network(["a", "b"])
    size = language.WINDOW
    texts = [b"", b"x", b"y" * size, bytes(range(65, 91)) * 17, b"z" * (size + 1)]
    ends = np.cumsum([len(t) for t in texts])
    begin = ends - [len(t) for t in texts]
    pooled, votes = language.pool(net, np.frombuffer(b"".join(texts), np.uint8), begin, ends, block=3)
    assert list(votes.sum(axis=1)) == [len(t) for t in texts]
    assert np.allclose(pooled.sum(axis=1), [len(t) for t in texts], atol=1e-3)
    text = texts[3]
    want = np.zeros(2)
    for k in range(0, len(text), size):
        first = min(k, len(text) - size)
        p = net.probabilities(np.frombuffer(text[first : first + size], np.uint8).astype(np.intp)[:, None])[:, :, 0]
        want += p[k - first :].sum(axis=0)
    assert np.allclose(pooled[3], want, atol=1e-3)


def test_held_out_accuracy_and_awkward_texts(spark):
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 -- !", "aa"), (1003, "kalomi " * 40_000, None), (1004, "str", "bb"), (1004, "str", "bb"), (None, "lomika kalo", None)]
    frame = spark.createDataFrame([(*r, 0.5, "clash", 1) for r in made() + odd], SCHEMA).repartition(4)
    rows = language.identify(frame, ["doc_id", "lang"]).select("row.*", "lang_pred", "score", "positions").collect()
    assert len(rows) == 507 and all(0 <= r.score <= 1 for r in rows)
    from zlib import crc32

    held = [r for r in rows if r.doc_id is not None and r.doc_id < 1000 and crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1000, 1001, 1002))
    assert by_id[1003].lang_pred == by_id[None].lang_pred == "aa"
    assert sum(by_id[1003].positions) == 7 * 40_000


@pytest.mark.parametrize("rows, want", [([], []), ([(0, "abc", None)], ["und"]), ([(2, "abc", "xx"), (3, "1", "xx")], ["und", "xx"])])
def test_little_to_learn_from(spark, rows, want):
    frame = spark.createDataFrame([(*r, 0.5, "clash", 1) for r in rows], SCHEMA)
    assert sorted(r.lang_pred for r in language.identify(frame).select(F.col("lang_pred")).collect()) == want
