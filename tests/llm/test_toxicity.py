"""Exact nearest examples, held-out scores, and texts without anything to go by."""

import random
import re
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from ebbline.llm import common, language, toxicity

DOCS = "doc_id bigint, text string, toxic int, score string, row string"
LABELS = "doc_id bigint, quality int, toxic int"
BAD = ["grum", "zark", "blöt", "vex9"]


def made(n=900):
    draw = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(1, 80))]
        toxic = draw.random() < 0.2
        if toxic:
            words += draw.choices(BAD, k=draw.randrange(2, 6))
        draw.shuffle(words)
        docs.append((i, " ".join(words).capitalize(), None, "clash", "clash"))
        if draw.random() < 0.8:
            labels.append((i, None, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = made()
    labels += [(labels[0][0], 1, labels[0][2]), (5000, 1, 1), (7, 1, None), (None, 1, 1)]
    frame = spark.createDataFrame(docs, DOCS).repartition(3)
    return frame, toxicity.fit(frame, spark.createDataFrame(labels, LABELS))


def test_terms_and_held_out_scores(fitted):
    frame, model = fitted
    assert set(BAD) <= set(model.idf) and len(model.idf) < 12
    truth = {i: any(b in t.lower() for b in BAD) for i, t, *_ in made()[0]}
    rows = toxicity.score(frame, model).select("row.doc_id", "score", "predicted").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(rows) == 900 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97


def test_search_equals_brute_force(fitted):
    """Block-max search finds what comparing with every example finds, ties and all."""
    draw = np.random.default_rng(1)
    terms = [f"t{k}" for k in range(30)]
    model = toxicity.Examples({t: 1 + k / 10 for k, t in enumerate(terms)})
    vectors = [model.vector(list(draw.choice(terms, draw.integers(1, 12)))) for _ in range(700)]
    vectors[100:110] = [vectors[0]] * 10
    model.build(vectors)
    for _ in range(60):
        query = model.vector(list(draw.choice(terms, draw.integers(1, 9))))
        cosine = np.array([sum(v * x.get(t, 0.0) for t, v in query.items()) for x in vectors])
        best = np.lexsort((np.arange(700), -np.round(cosine, 12)))[: toxicity.NEIGHBOURS]
        best = best[cosine[best] > 0]
        number, got = model.nearest(query)
        assert list(number) == list(best) and np.allclose(got, cosine[best])


def test_awkward_texts(spark, fitted):
    odd = [(1, None), (2, ""), (3, "\n\t"), (4, "grum " * 50_000), (4, "grum " * 50_000), (None, "GRUM zark")]
    frame = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in odd], DOCS)
    rows = toxicity.score(frame, fitted[1]).select("row.doc_id", "score", "predicted", "evidence").collect()
    assert len(rows) == 6
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {fitted[1].without}
    assert all(r.predicted == 1 and len(r.evidence) == toxicity.EVIDENCE for r in rows if r.doc_id not in (1, 2, 3))


@pytest.mark.parametrize("docs, labels", [([], []), ([(1, "a")], []), ([(1, "a")], [(1, 1, 1)]), ([(2, "a b")] * 8, [(2, 1, 0)])])
def test_little_to_learn_from(spark, docs, labels):
    frame = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in docs], DOCS)
    model = toxicity.fit(frame, spark.createDataFrame(labels, LABELS))
    rows = toxicity.score(frame, model).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)


def test_every_text_with_words_is_searched(spark, fitted):
    """Texts without a clear sign are compared too, over all their words; many clear signs are all kept."""
    frame, model = fitted
    assert len(model.idf) + len(model.rest) > 400
    rows = toxicity.score(frame, model).select("evidence").collect()
    assert all(r.evidence and r.evidence[0].cosine > 0 for r in rows)
    signs = [f"sign{k}" for k in range(600)]
    docs = [(i, " ".join(signs[i // 2 % 60 :: 60] + ["plain"]) if i % 2 else "plain text here") for i in range(1200)]
    many = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in docs], DOCS)
    wide = toxicity.fit(many, spark.createDataFrame([(i, 1, i % 2) for i, _ in docs], LABELS))
    every = {w for i, t in docs if zlib.crc32(str(i).encode()) % 5 for w in t.split()}
    assert every == set(wide.idf) | set(wide.rest) and len(every) > 512


def test_bound_of_examples(spark):
    """Rows that repeat an id do not outgrow the bound."""
    rows = [(1, f"word{i % 50} other{i}", 1, "c", "c") for i in range(600)] + [(2, "same text", 1, "c", "c")] * 300
    model = toxicity.fit(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, 1, 0), (2, 1, 1)], LABELS), examples=40)
    assert len(model.ids) == 41 and model.ids.count(2) == 1
    assert np.isclose(model.weight.sum(), 900)


def test_blocks_below_the_best_are_skipped():
    """Fewer blocks are scored than there are, and the neighbours are those of comparing with every example."""
    draw = np.random.default_rng(5)
    terms = [f"t{k:03d}" for k in range(900)]
    model = toxicity.Examples({t: 1 + k % 7 for k, t in enumerate(terms)})
    topics = [draw.choice(terms, 40, replace=False) for _ in range(30)]
    vectors = [model.vector(list(draw.choice(topics[i % 30], 30)) + list(draw.choice(terms[:5], 3))) for i in range(3000)]
    model.build(vectors)
    for i in range(90):
        query = model.vector(list(draw.choice(topics[i % 30], 25)))
        cosine = np.array([sum(v * x.get(t, 0.0) for t, v in query.items()) for x in vectors])
        best = np.lexsort((np.arange(3000), -np.round(cosine, 12)))[: toxicity.NEIGHBOURS]
        best = best[cosine[best] > 0]
        number, got = model.nearest(query)
        assert list(number) == list(best) and np.allclose(got, cosine[best])
    assert model.offered == 90 * -(-3000 // toxicity.BLOCK) and 0 < model.visited < model.offered / 2


def test_fitting_holds_terms_once(spark):
    """What a driver keeps of a fit has neither a second copy of its terms nor the matrix of the blocks."""
    texts = [(i, f"w{i % 7} w{i % 11} word{i} {'foul' if i % 3 == 0 else 'kind'} {'w3 ' * (i % 4)}") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, toxic int"))
    assert len(model.ids) > 100 and "at" not in vars(model) and model.dense is None
    held = [{"w1": 2, "foul": 1, "never": 3}, {}, {"never": 1}, {"kind": 1, "w3": 4, "w1": 1}]
    for one, (column, value) in zip(held, model.sparse_each([(list(h), list(h.values())) for h in held])):
        plain = model.sparse(one)
        assert column.tolist() == plain[0].tolist() and value.tolist() == plain[1].tolist()


def test_index_is_built_in_pieces(monkeypatch):
    """Building the index takes little beside it, and common words are found without the dictionary of all terms."""
    monkeypatch.setattr(toxicity, "SORTED", 256)
    draw = np.random.default_rng(8)
    terms = [f"t{k:04d}" for k in range(4000)]
    model = toxicity.Examples({t: 1.0 for t in terms})
    vectors = []
    for _ in range(4000):
        column = np.unique(np.minimum(draw.geometric(0.001, 250), 3999)).astype(np.int32)
        vectors.append((column, np.full(len(column), len(column) ** -0.5)))
    plain = [(c.copy(), v.copy()) for c, v in vectors]
    tracemalloc.start()
    model.index(vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.4 * (model.column.nbytes + model.value.nbytes)
    # A list has the examples of its term in the order of their numbers, each with its value.
    for column in (300, 700, 1500):
        lines = model.posted[model.first[column] : model.first[column + 1]]
        want = [(model.position[n], v[c == column][0]) for n, (c, v) in enumerate(plain) if column in c]
        assert model.place[column] >= 0 or lines[:, 0].tolist() == [p for p, _ in want]
        assert model.place[column] >= 0 or np.allclose(np.ascontiguousarray(lines[:, 1]).view(np.float32), [v for _, v in want])
    monkeypatch.setattr(toxicity, "COMMON", 500)
    assert model.sparse({"t0001": 1, "t0005": 2})[0].tolist() == [1, 5] and "at" not in vars(model)
    assert model.sparse({"t0001": 1, "t3999": 1, "never": 1, "t2500": 1})[0].tolist() == [1, 2500, 3999]


def test_words_are_found_by_translating():
    """Words are those of the pattern, whatever stands between them, and are counted by their columns."""
    for some in range(0, 0x110000, 64):
        text = "".join(f"a{chr(c)}bé{chr(c)}_{chr(c)}9 " for c in range(some, some + 64) if not 0xD800 <= c < 0xE000)
        assert toxicity.words_of(text) == re.findall(toxicity.WORD, text)
    assert toxicity.words_of("") == [] and toxicity.words_of(" _\n") == []
    model = toxicity.Examples({f"t{k}": 1.0 + k for k in range(50)})
    model.build([model.vector([f"t{k}", f"t{k + 1}"]) for k in range(40)])
    for words in ([], ["never"], ["t3", "t1", "t3", "never", "t49", "t3", "t49"]):
        for got, plain in zip(model.sparse_of(words), model.sparse(Counter(words))):
            assert got.dtype == plain.dtype and got.tolist() == plain.tolist()


def test_fits_give_memory_back(spark, monkeypatch):
    """What a fit took beside its model does not stay with the driver's Python, and windows of bytes are held as bytes."""
    resident = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * 4096
    held = [np.ones(8000) for _ in range(2000)]
    pin = np.ones(8000)  # memory below it is not at the end, which alone goes back by itself
    del held
    before = resident()
    common.give_back()
    assert len(pin) and before - resident() > 60e6
    calls, kinds = [], []
    for module in (toxicity, language):
        monkeypatch.setattr(module, "give_back", lambda name=module.__name__: calls.append(name))
    monkeypatch.setattr(language.Network, "train", lambda self, windows, *rest: kinds.append(windows.dtype))
    docs = spark.createDataFrame([(i, f"w{i % 7} word{i}", "ab"[i % 2]) for i in range(60)], "doc_id bigint, text string, lang string")
    toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int"))
    language.fit(docs)
    assert calls[-2:] == [toxicity.__name__, language.__name__] and kinds == [np.uint8]
