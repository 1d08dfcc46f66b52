"""From documents to a clean, deduplicated, decontaminated and tokenised corpus, stage by stage.

Each stage takes (spark, docs, folder of the tables) and returns the documents that go
on, with the columns of documents; the last one adds what it found out. What a
stage decides is final: it works on all that the stage before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import bpe, contamination, language, toxicity, tries
from ebbline.llm.common import carried, small, table
from ebbline.session import store

# Texts whose language is less sure than this are rejected; four languages at random give 0.25.
LEAST_SURE = 0.4
# Columns that the last stage adds.
ADDED = ["n_tokens", "ids_sha256", "decoded_sha256"]


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that their nearest labelled examples call toxic go."""
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")), docs.columns)
    return scored.filter("predicted = 0").select("row.*")


def keep_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a letter, and those in no known language, go; with nothing to learn
    languages from, all stay."""
    net = language.fit(docs)
    if net is None:
        return docs
    said = language.predict(docs, net, docs.columns)
    return said.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SURE)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays.

    Documents without a word or without an id stay; rows of one id are one document.
    """
    classes = tries.near_duplicates(docs)
    gone = classes.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    # Columns of documents travel as one, so whatever their names, none is met twice.
    rows = docs.select(carried(docs, docs.columns))
    return rows.join(small(gone), F.col("row.doc_id") == F.col("gone"), "left_anti").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    checked = contamination.contaminated(docs, table(spark, folder, "benchmark"), keep=docs.columns)
    return checked.filter("NOT contaminated").select("row.*")


def tokenise(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with the number and digest of their ids; one that does not decode to its text goes.

    A column of documents that is named like one of the three added gives way to it.
    """
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe.digests(docs, codec, docs.columns)
    same = F.col("decoded_sha256") == F.sha2(F.coalesce("row.text", F.lit("")), 256)
    others = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ADDED]
    return coded.filter(same).select(*others, *ADDED)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("tokens", tokenise),
]

# Neither nearest labelled examples nor a trained network can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
