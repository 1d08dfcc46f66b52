"""Licence scans: phrases by place, and templates by an exact set-similarity join.

A block is a line of a text, or, of a line longer than twice the longest template,
each window of that length at half its steps. Of a text of several lines, the
windows over all its words are blocks too, so that a template wrapped over lines
stands whole in one. A template is found in a block that holds at least `THRESHOLD`
of its distinct words; as a block holds no word that its text does not, only texts
that hold as many of a template's words are cut into blocks. The join is exact: words are
ordered by the number of documents that hold them, rarest first; a block that
reaches the threshold holds one of the first |T| - need + 1 words of the template
T, so blocks meet templates only through those words, and the length of the
block's set and the places of the common word in both orders bound what the two
can share before anything is compared.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import SEPARATORS, carried, lower_ascii, small, spaced_words, text_keys
from ebbline.session import store

# Phrases and the labels they stand for.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Wording by which texts state their licence, and its label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)
THRESHOLD = 0.8


def template_words(text: str) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text))


def needed(size: int, threshold: float) -> int:
    return math.ceil(round(threshold * size, 9))


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def places(words: Column, phrase: str) -> Column:
    """Starts of a phrase in an array of words, from 0."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        same = F.lit(True)
        for k, part in enumerate(parts):
            same = same & (F.get(words, i + k) == part)
        return same

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0))), lambda i: F.coalesce(here(i), F.lit(False)))


def phrase_places(docs: DataFrame, phrases=PHRASES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`row` of every document with its keys, n_words, and a struct of starts for each phrase.

    Null texts and texts without a word have 0 words. Word arrays are made only for
    texts that contain a phrase.
    """
    rows = docs.select(carried(docs, keep), *text_keys(docs), spaced_words("text").alias("_said"))
    hit = F.lit(False)
    for phrase, _ in phrases:
        hit = hit | F.contains(F.col("_said"), F.lit(f" {phrase} "))
    words = F.when(hit, F.split(F.trim("_said"), " "))
    rows = rows.withColumn("_words", words)
    found = [F.when(F.contains(F.col("_said"), F.lit(f" {p} ")), places(F.col("_words"), p)).otherwise(F.array().cast("array<int>")).alias(f"_{k}") for k, (p, _) in enumerate(phrases)]
    n_words = F.greatest(F.length("_said") - F.length(F.replace("_said", F.lit(" "), F.lit(""))) - 1, F.lit(0))
    return rows.select("*", n_words.cast("bigint").alias("n_words"), F.struct(*found).alias("starts")).drop("_said", "_words")


def words_held(docs: DataFrame, words: list[str]) -> DataFrame:
    """Key and `held`, which of the given words it holds, of every row that holds any; stored, as all that follows asks for it."""
    held = F.array_intersect(_array(words), F.split(F.trim(spaced_words("text")), " "))
    return store(docs.select(*text_keys(docs), held.alias("held")).filter(F.size("held") > 0))


def word_order(marks: DataFrame, words: list[str]) -> list[str]:
    """The given words by the number of documents that hold them, rarest first."""
    counted = marks.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    n = {r.word: r.n for r in counted.collect()}  # a row for each word of the templates at most
    return sorted(words, key=lambda w: (n.get(w, 0), w))


def blocks(docs: DataFrame, longest: int, in_words: int) -> DataFrame:
    """Key, line, window and words of every block; a last line stands for the whole text.

    The longest template has so many distinct words, and so many words in all.
    """
    said = lower_ascii(F.col("text"))
    lines = F.split(said, "\n")
    # A text of one line is no block again, unless a template outgrows the windows of a line.
    whole = F.when((F.size(lines) > 1) | F.lit(in_words > longest + 1), F.array(said)).otherwise(F.array().cast("array<string>"))
    rows = docs.select(*text_keys(docs), F.size(lines).alias("n"), F.posexplode(F.concat(lines, whole)).alias("line", "said"))
    words = F.split(F.trim(F.regexp_replace("said", SEPARATORS, " ")), " ")
    rows = rows.select("key1", "key2", "line", words.alias("words"), F.when(F.col("line") == F.col("n"), in_words).otherwise(longest).alias("step"))
    last = F.ceil(F.greatest(F.size("words") - 2 * F.col("step"), F.lit(0)) / F.col("step")).cast("int")
    windows = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("words", k * F.col("step") + 1, 2 * F.col("step")))
    return rows.select("key1", "key2", "line", F.posexplode(windows).alias("window", "words"))


def template_matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Key, line, window, template, label and containment of every block that reaches the threshold."""
    sets = [sorted(set(template_words(text))) for _, text in templates]
    every = sorted(set().union(*sets))
    marks = words_held(docs, every)
    order = word_order(marks, every)
    place = {w: i for i, w in enumerate(order)}
    prefix = []
    for k, words in enumerate(sets):
        ranked, need = sorted(words, key=place.__getitem__), needed(len(words), threshold)
        prefix += [(w, i, k, templates[k][0], ranked, len(ranked), need) for i, w in enumerate(ranked[: len(ranked) - need + 1])]
    schema = "word string, at_template int, template int, label string, ranked array<string>, size int, need int"
    index = docs.sparkSession.createDataFrame(prefix, schema)
    # Texts that hold enough words of some template, wherever they stand.
    able = F.exists(F.array(*[F.size(F.array_intersect("held", _array(s))) >= needed(len(s), threshold) for s in sets]), lambda x: x)
    texts = small(marks.filter(able).select(F.col("key1").alias("able1"), F.col("key2").alias("able2")).distinct())
    keyed = docs.select("text", "doc_id", *text_keys(docs))
    cut = keyed.join(texts, (F.col("key1") == F.col("able1")) & (F.col("key2") == F.col("able2")), "left_semi").select("doc_id", "text")
    rows = blocks(cut, max(map(len, sets)), max(len(template_words(text)) for _, text in templates))
    # The words of a block that any template holds, in the global order.
    rows = rows.filter(F.arrays_overlap("words", _array(sorted({p[0] for p in prefix})))).withColumn("held", F.array_intersect(_array(order), "words"))
    met = rows.select("key1", "key2", "line", "window", "held", F.posexplode("held").alias("at_block", "word")).join(F.broadcast(index), "word")
    room = F.least(F.col("size") - F.col("at_template"), F.size("held") - F.col("at_block"))
    first = ~F.arrays_overlap(F.slice("ranked", F.lit(1), F.col("at_template")), F.col("held"))
    near = met.filter((F.size("held") >= F.col("need")) & (room >= F.col("need")) & first)
    shared = F.size(F.array_intersect("ranked", "held"))
    return near.withColumn("shared", shared).filter("shared >= need").select(
        "key1", "key2", "line", "window", "template", "label", (F.col("shared") / F.col("size")).alias("containment")
    )


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`row` of every document with n_words, n_base, first_word, last_word, base_labels, labels and score.

    score is the greatest containment of a template, 0 without any. Labels are
    sorted, distinct and joined by commas. A null text is an empty one; rows that
    repeat a document and its text have the same results, each its own row.
    """
    found = template_matches(docs, templates, threshold)
    by_text = found.groupBy("key1", "key2").agg(F.collect_set("label").alias("more"), F.max("containment").alias("score"))
    rows = phrase_places(docs, phrases, keep)
    starts = F.flatten(F.array(*[F.col(f"starts._{k}") for k in range(len(phrases))]))
    base = F.filter(F.array(*[F.when(F.size(f"starts._{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]), lambda x: x.isNotNull())
    rows = rows.withColumns({"_all": starts, "_base": F.array_distinct(base)}).join(small(by_text), ["key1", "key2"], "left")
    every = F.array_union("_base", F.coalesce("more", F.array().cast("array<string>")))
    return rows.withColumns(
        {
            "n_base": F.size("_all").cast("bigint"),
            "first_word": F.array_min("_all").cast("bigint"),
            "last_word": F.array_max("_all").cast("bigint"),
            "base_labels": F.array_join(F.array_sort("_base"), ","),
            "labels": F.array_join(F.array_sort(every), ","),
            "score": F.coalesce("score", F.lit(0.0)),
        }
    ).drop("_all", "_base", "more", "starts", "key1", "key2")
