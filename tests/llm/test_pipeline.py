"""The pipeline keeps clean documents whole, drops what each stage names, and survives awkward tables."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from ebbline.llm import contamination, language, toxicity, tries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The small tables, and a few planted rows."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    passage = items.orderBy("item_id").first().text
    clean = "The and thing of that ention " + " ".join(f"er{i}onth" for i in range(60))
    planted = [(9000, clean, "en"), (9001, clean, "en"), (9002, clean + " more", "en"), (9003, f"{clean[::-1]} {passage}", "en"), (9004, "123 456", "en"), (9005, None, None)]
    rows = spark.createDataFrame([(i, t, lang, "planted", len(t or "")) for i, t, lang in planted], docs.schema)
    docs.unionByName(rows).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    start = docs
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, tables)
        if name != "tokens":
            assert kept.schema.simpleString() == start.schema.simpleString()
        path = f"{tables}/after_{name}"
        kept.write.parquet(path)
        after = spark.read.parquet(path)
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before
        if name == "toxicity":
            scored = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{tables}/labels.parquet")))
            assert ids == {r.doc_id for r in scored.filter("predicted = 0").select("row.doc_id").collect()}
        if name == "language":
            assert before - ids >= {9004, 9005} and not before - ids & {9000, 9001, 9002, 9003}
        if name == "near_duplicates":
            assert ids == {r.component_id for r in tries.near_duplicates(docs).collect()}
            assert ids & {9000, 9001, 9002} == {9000}
        if name == "decontamination":
            hit = contamination.contaminated(docs, spark.read.parquet(f"{tables}/benchmark.parquet")).filter("contaminated")
            assert before - ids == {r.doc_id for r in hit.select("row.doc_id").collect()}
            assert 9003 not in ids and 9000 in ids
        docs = after
    assert docs.count() == docs.select("doc_id").distinct().count() > 50
    same = docs.join(start.select("doc_id", F.col("text").alias("was")), "doc_id").filter("text <=> was").count()
    assert same == docs.count()


def test_run_equals_the_stages(spark, tables):
    ran = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, tables).collect()}
    assert ran == {r.doc_id: r.ids_sha256 for r in spark.read.parquet(f"{tables}/after_tokens").collect()}


def test_no_documents(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert language.fit(spark.read.parquet(f"{tmp_path}/documents.parquet")) is None


def test_columns_with_names_of_its_own(spark, tables):
    """Further columns go through every stage, whatever they are called; the last stage's own win."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(40)
    names = ["gone", "row", "n_tokens", "IDS_SHA256", "component_id", "a.b", "key1", "score"]
    wide = docs.withColumns({n: F.lit(f"own {n}") for n in names})
    for name, stage in corpus_pipeline.STAGES:
        if name in ("toxicity", "language"):
            continue  # their test texts are elsewhere; here every document is to stay in sight
        wide = stage(spark, wide, tables)
        if name != "tokens":
            assert wide.columns == [*docs.columns, *names]
    assert wide.columns == [*docs.columns, "gone", "row", "component_id", "a.b", "key1", "score", *corpus_pipeline.ADDED]
    rows = wide.collect()
    assert rows and all(r["gone"] == "own gone" and r["a.b"] == "own a.b" and r["n_tokens"] != "own n_tokens" for r in rows)
