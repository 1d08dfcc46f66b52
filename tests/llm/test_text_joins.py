"""Licence scans, contamination and Jaccard classes against their SQL on awkward texts, and the
general forms of the operators against brute force."""

import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from compare import differences

from ebbline.llm import contamination, licenses, tries
from ebbline.llm.catalog import ORACLE

SCHEMA = "doc_id bigint, text string, n_words int, row string, score string, key1 int, window string, name int, size int"
WORDS = "the of mit license apache general public Licensed under BY NC 4 0 é Ünïcode x1".split()


def texts():
    draw = random.Random(3)
    some = [" ".join(draw.choices(WORDS, k=draw.randrange(1, 60))) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(30))
    long = [f"q{draw.randrange(900)}" for _ in range(300)]
    near = []
    for k in range(40):
        copy = list(long)
        for _ in range(draw.randrange(0, 12)):
            copy[draw.randrange(300)] = f"r{draw.randrange(900)}"
        near.append(" ".join(copy))
    fixed = [
        None, "", " \n\t", "...", "MIT License", "mit-license; MIT\nLICENSE mit license", "the General  Public\tLicense, version 3",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "released under mit license\r\n",
        "x " * 500 + "Released under the MIT License. " + "y " * 500, "a" * 5000, "one two three", "one two three", "one  two\nthree", "one two three four",
        f"before {passage} after", passage.upper(), " ".join(passage.split()[:9]), f"{passage} {passage}", "mitlicense éMIT License", "İMIT license",
    ]
    return fixed + some + near


def frames(spark):
    rows = list(enumerate(texts()))
    wide = spark.createDataFrame([(i, t, 1, "clash", "clash", 2, "clash", 3, 4) for i, t in rows], SCHEMA).repartition(4)
    return wide, pd.DataFrame(rows, columns=["doc_id", "text"])


ITEMS = [(1, " ".join(f"P{i}" for i in range(30))), (2, "one, two three"), (3, None), (4, ""), (5, "..."), (6, "of"), (7, "q" * 50), (6, "mit license"), (8, " ".join(f"p{i}" for i in range(30)))]


def in_sql(name, documents):
    con = duckdb.connect()
    con.register("documents", documents)
    con.register("benchmark", pd.DataFrame(ITEMS, columns=["item_id", "text"]))
    return con.execute(ORACLE[name]).fetchdf()


def test_licenses(spark):
    wide, plain = frames(spark)
    want = in_sql("op7_licenses", plain)
    got = licenses.scan(wide).select("row.doc_id", *[c for c in want.columns if c != "doc_id"]).toPandas()
    assert differences(got, want) is None
    assert want["labels"].str.contains("cc-by-nc").any()


def test_wrapped_licences(spark):
    """Templates wrapped over lines are found, wherever the lines break and whatever stands around them."""
    around = "filler text\n" * 40
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
    gpl = "This work is licensed under the GNU General Public\nLicense, version 3"
    mit = dict(licenses.TEMPLATES[:2])["mit"].replace(" ", "\n")
    rows = [(1, bsd), (2, gpl), (3, f"{around}{bsd}\n{around}"), (4, around + mit), (5, around)]
    rows += [(6 + k, "x " * k + "\n" + bsd) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs).select("row.doc_id", "labels", "score").collect()}
    assert got[2] == ("gpl", 1.0) and got[4] == ("mit", 1.0) and got[5] == ("", 0.0)
    assert {got[i] for i in (1, 3, *range(6, 36))} == {("bsd", 1.0)}


def test_contamination(spark):
    wide, plain = frames(spark)
    want = in_sql("op8_contamination", plain)
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id bigint, text string, terms string")
    got = contamination.contaminated(wide, items).select("row.doc_id", *[c for c in want.columns if c != "doc_id"]).toPandas()
    assert differences(got, want) is None
    assert want["contaminated"].sum() > 10


@pytest.mark.parametrize("block", [256, 4])
def test_jaccard_classes(spark, monkeypatch, block):
    """Small blocks send the groups through pairs of blocks."""
    monkeypatch.setattr(tries, "BLOCK", block)
    wide, plain = frames(spark)
    want = in_sql("op10_tries", plain)
    assert differences(tries.near_duplicates(wide).toPandas(), want) is None
    assert 5 < want["component_id"].nunique() < len(want) - 20


def test_repeated_rows_and_no_rows(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (2, "mit license"), (2, "apache license"), (None, "mit license")]
    twice = spark.createDataFrame([(i, t, 1, "c", "c", 2, "c", 3, 4) for i, t in rows], SCHEMA)
    items = spark.createDataFrame([(1, "two three four"), (2, "apache license")], "item_id bigint, text string")
    found = contamination.contaminated(twice, items).select("row.doc_id", "n_hit").collect()
    assert sorted((str(r[0]), r[1]) for r in found) == [("1", 3), ("1", 3), ("2", 0), ("2", 2), ("None", 0)]
    labels = licenses.scan(twice).select("row.doc_id", "labels").collect()
    assert sorted((str(r[0]), r[1]) for r in labels) == [("1", ""), ("1", ""), ("2", "apache"), ("2", "mit"), ("None", "mit")]
    classes = tries.near_duplicates(twice).collect()
    assert sorted((str(r[0]), str(r[2])) for r in classes) == [("1", "1"), ("1", "1"), ("2", "2"), ("2", "2"), ("None", "2")]
    none = twice.limit(0)
    assert licenses.scan(none).count() == contamination.contaminated(none, items).count() == tries.near_duplicates(none).count() == 0
    assert contamination.contaminated(twice, items.limit(0)).filter("contaminated").count() == 0


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e a x b y c"), (2, "c b a"), (3, None)], "doc_id bigint, text string")
    phrases = spark.createDataFrame([(1, "B c"), (2, "a c"), (3, "zz"), (4, "a b c d e a x b y c a")], "item_id bigint, text string")
    exact = contamination.phrase_matches(docs, phrases).collect()
    assert [(r.start, r.len, r.item_id) for r in exact] == [(1, 2, 1)]
    near = contamination.proximity_matches(docs, phrases.filter("item_id = 2"), 3).collect()
    keys = {r.key1: r for r in docs.select(contamination.text_keys(docs)[0], "doc_id").collect()}
    assert sorted((keys[r.key1].doc_id, r.start, r.end) for r in near) == [(1, 0, 3), (2, 0, 3)]


def jaccard(a, b):
    return 100 * len(a & b) >= 75 * len(a | b)


def test_trie_walk_equals_all_pairs():
    """The walk with pruning finds the classes that comparing all pairs finds."""
    import numpy as np

    draw = random.Random(8)
    for _ in range(60):
        base = [frozenset(draw.sample(range(60), draw.randrange(3, 30))) for _ in range(4)]
        sets = list({frozenset((set(draw.choice(base)) - set(draw.sample(range(60), draw.randrange(0, 8)))) | set(draw.sample(range(60), draw.randrange(0, 4)))) for _ in range(25)} - {frozenset()})
        held = {k: sum(k in s for s in sets) for k in range(60)}
        order = [sorted(s, key=lambda k: (held[k], k)) for s in sets]
        trie = tries.Trie(
            [np.array(o, np.uint64) for o in order], [np.array([held[k] for k in o], np.uint32) for o in order], np.array([len(s) for s in sets])
        )
        parent = list(range(len(sets)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in trie.links(np.zeros(len(sets), int), np.arange(len(sets)), 75):
            assert jaccard(sets[a], sets[b])
            parent[root(a)] = root(b)
        for i in range(len(sets)):
            for j in range(i):
                if jaccard(sets[i], sets[j]):
                    assert root(i) == root(j)


def test_trie_overlaps_and_work():
    """A query's overlaps with all paths behind it are exact, and places in common are looked at once."""
    import numpy as np

    draw = np.random.default_rng(3)
    for spread in (3, 40):
        # Long common beginnings, nested, and paths that are beginnings of others.
        paths = [np.arange(200)]
        while len(paths) < 120:
            old = paths[draw.integers(len(paths))]
            kept = old[: draw.integers(0, len(old) + 1)]
            more = np.unique(draw.integers(int(kept[-1]) + 1 if len(kept) else 0, 600, draw.integers(0, spread)))
            if len(kept) + len(more):
                paths.append(np.concatenate([kept, more]))
        held = [np.arange(600, dtype=np.uint32)[p] for p in paths]  # the order of the numbers
        trie = tries.Trie([p.astype(np.uint64) for p in paths], held, np.array([len(p) for p in paths]))
        sets = [set(paths[i].tolist()) for i in trie.line]
        assert len(trie.nodes) < sum(map(len, paths)) / 2 if spread == 3 else len(trie.nodes) < sum(map(len, paths))
        for q in range(len(paths) - 1):
            marks = np.zeros(trie.universe, np.uint8)
            marks[trie.paths[q]] = 1
            for end in {q + 2, (q + 2 + len(paths)) // 2, len(paths)}:
                assert trie.overlaps(q, end, marks).tolist() == [len(sets[q] & s) for s in sets[q + 1 : end]]


def test_a_query_asks_once_for_all_paths(monkeypatch):
    """Where nothing links, a text costs one look at the trie, and none if no size fits or all are of its class."""
    import numpy as np

    asked, overlaps = [], tries.Trie.overlaps
    monkeypatch.setattr(tries.Trie, "overlaps", lambda self, *a: asked.append(1) or overlaps(self, *a))
    paths = [np.array([0, *range(10 * k + 1, 10 * k + 9)], np.uint64) for k in range(50)]
    held = [np.array([1] + [2] * 8, np.uint32)] * 50
    trie = tries.Trie(paths, held, np.full(50, 9))
    assert not list(trie.links(np.zeros(50, int), np.arange(50), 75)) and len(asked) == 49
    assert not list(trie.links(np.zeros(50, int), np.zeros(50, int), 75)) and len(asked) == 49
    sizes = tries.Trie(paths, held, 9 * 2 ** np.arange(50))
    assert not list(sizes.links(np.zeros(50, int), np.arange(50), 75)) and len(asked) == 49


@pytest.mark.parametrize("texts", [["a b c"], ["a", None, "b c"], ["", "x", "y z"]])
def test_batches_of_few_words(spark, texts):
    """A batch whose texts have fewer words together than a shingle."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in tries.near_duplicates(docs).collect()}
    assert rows == {i: (int(bool(t)), i) for i, t in enumerate(texts)}


def test_wrapped_templates_in_sql(spark, tmp_path):
    """The query and its SQL agree on templates that no line holds whole."""
    import duckdb

    from ebbline.llm import catalog, licenses

    texts = [
        None, "", "no licence", *[text for _, text in licenses.TEMPLATES],
        *[text.replace(" ", "\n", k) for _, text in licenses.TEMPLATES for k in (1, 3, 6, 40)],
        "\n".join(["lorem ipsum " * 20] * 3) + "\n" + licenses.TEMPLATES[5][1].replace("without ", "without\n") + " dolor" * 60,
        " ".join(w for w in licenses.TEMPLATES[5][1].split() for _ in range(9)),
        "mit license\nmit\nlicense general public license",
    ]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ours = sorted(map(tuple, catalog.QUERIES["op7_licenses"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    theirs = sorted(con.execute(f"SELECT doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score FROM ({catalog.ORACLE['op7_licenses']}) q").fetchall())
    assert ours == theirs


def test_packed_shingles_are_read_where_they_lie():
    """A range and a bucket are read from the columns of their group, in one piece or several."""
    rows = [([5, 7, 9], [1, 1, 1]), ([5, 9], [2, 2]), ([9, 5], [3, 1]), ([], [])]
    packed = pa.table({"keys": [np.array(k, np.uint64).tobytes() for k, _ in rows], "names": [np.array(n, np.int64).tobytes() for _, n in rows]})
    for group in (packed, pa.concat_tables([packed[:1], packed[1:2], packed[2:]])):
        assert tries._sharing(group).to_pydict() == {"name": [1, 2, 3]}
        shared = tries._shared(group, 1)
        assert shared.column("bucket").to_pylist() == [0]
        paths = tries._paths(shared).to_pylist()
        assert [(r["name"], np.frombuffer(r["path"], np.uint64).tolist(), np.frombuffer(r["held"], np.uint32).tolist(), r["shared"]) for r in paths] == [
            (1, [5, 9], [2, 3], 2), (2, [5, 9], [2, 3], 2), (3, [9], [3], 1)]
    assert tries._numbers(packed, "keys", np.uint64).base is not None
