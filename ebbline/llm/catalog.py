"""The operators of this folder as queries on the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import bpe, caps, contamination, counts, language, licenses, lm, phrases, pieces, toxicity, tries, turns, warc
from ebbline.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def held_out(key: str, folds: int) -> Column:
    return (fold(F.col(key), folds) == 0).alias("held_out")


@query
def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    rows = language.identify(table(spark, folder, "documents"))
    return rows.select("row.doc_id", held_out("row.doc_id", 5), "lang_pred", "score", "languages", "shares", "positions")


@query
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages through WARC archives and back."""
    captures = warc.page_ids(warc.round_trip(table(spark, folder, "pages"), bodies=False))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op2_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, max(page_id) AS first_page FROM p WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.first_page IS DISTINCT FROM p.page_id AND g.first_page IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first_page IS DISTINCT FROM p.page_id THEN g.first_page END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= 1000
"""


@query
def op3_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the word-level vocabulary."""
    words = counts.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    rows = counts.count(table(spark, folder, "documents"), words)
    return rows.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes they decode to."""
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = bpe.digests(table(spark, folder, "documents"), codec)
    return rows.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    docs = table(spark, folder, "documents")
    rows = toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))
    return rows.select("row.doc_id", held_out("row.doc_id", 5), "score", "predicted", "evidence")


@query
def op6_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """log10 probability of every document under the interpolated model."""
    rows = lm.score(table(spark, folder, "documents"))
    return rows.select("row.doc_id", held_out("row.doc_id", lm.FOLDS), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    rows = licenses.scan(table(spark, folder, "documents"))
    return rows.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


# In SQL: words, phrases by place, and every template against every block.
WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SETS = [(label, sorted(set(licenses.template_words(text)))) for label, text in licenses.TEMPLATES]
_LONGEST = max(len(words) for _, words in _SETS)
_IN_WORDS = max(len(licenses.template_words(text)) for _, text in licenses.TEMPLATES)
_TEMPLATE_ROWS = ", ".join(f"('{label}', {words}, {licenses.needed(len(words), licenses.THRESHOLD)})" for label, words in _SETS)

ORACLE["op7_licenses"] = f"""
WITH d AS (
  SELECT doc_id, {LOWER} AS said, {WORDS.format(LOWER)} AS w FROM documents
), p AS (
  SELECT doc_id, len(w) AS n_words,
    list_filter(range(len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license') AS mit,
    list_filter(range(len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license') AS apache,
    list_filter(range(len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl
  FROM d
), l AS (
  SELECT doc_id, {WORDS.format('line')} AS w, {_LONGEST} AS step FROM (SELECT doc_id, unnest(string_split(said, chr(10))) AS line FROM d)
  UNION ALL SELECT doc_id, w, {_IN_WORDS} FROM d WHERE contains(said, chr(10)) OR {_IN_WORDS} > {_LONGEST} + 1
), b AS (
  SELECT doc_id, list_distinct(w[k * step + 1 : k * step + 2 * step]) AS w
  FROM (SELECT *, unnest(range(1 + cast(ceil(greatest(len(w) - 2 * step, 0) / step) AS BIGINT))) AS k FROM l)
), t(label, words, need) AS (VALUES {_TEMPLATE_ROWS}
), m AS (
  SELECT doc_id, list(DISTINCT label) AS more, max(len(list_intersect(w, words)) / len(words)) AS score
  FROM b, t WHERE len(list_intersect(w, words)) >= need GROUP BY 1
), f AS (
  SELECT p.*, mit || apache || gpl AS places, coalesce(score, 0.0) AS score,
    list_filter([CASE WHEN len(mit) > 0 THEN 'mit' END, CASE WHEN len(apache) > 0 THEN 'apache' END,
                 CASE WHEN len(gpl) > 0 THEN 'gpl' END], lambda x: x IS NOT NULL) AS base, coalesce(more, []) AS more
  FROM p LEFT JOIN m USING (doc_id)
)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || more)), ',') AS labels, score
FROM f
"""


@query
def op8_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stand in a benchmark passage."""
    rows = contamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return rows.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE["op8_contamination"] = f"""
WITH d AS (
  SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents
), b AS (
  SELECT item_id, {WORDS.format(LOWER)} AS w FROM benchmark
), n AS (
  SELECT DISTINCT item_id, array_to_string(w[k + 1 : k + 10], ' ') AS run, least(len(w), 10) AS many
  FROM (SELECT *, unnest(range(greatest(len(w) - 10, 0) + 1)) AS k FROM b WHERE len(w) > 0)
), s AS (
  SELECT doc_id, k, many, array_to_string(w[k + 1 : k + many], ' ') AS run
  FROM (SELECT *, unnest(range(len(w))) AS k FROM d), (SELECT DISTINCT many FROM n) WHERE k + many <= len(w)
), m AS (
  SELECT doc_id, k, n.many, item_id FROM s JOIN n USING (run)
), h AS (
  SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM (SELECT *, unnest(range(many)) AS j FROM m) GROUP BY 1
), i AS (
  SELECT doc_id, list_sort(list(DISTINCT cast(item_id AS VARCHAR))) AS items FROM m GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query
def op9_caps(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate embeddings of one label."""
    return caps.near_duplicates(table(spark, folder, "embeddings"))


ORACLE["op9_caps"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: cast(x AS DOUBLE)) AS e FROM embeddings
), ok AS (
  SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) >= 0.93
), r(id, reach) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM r JOIN l ON r.reach = l.a
), c AS (
  SELECT id AS vec_id, min(reach) AS component_id FROM r GROUP BY 1
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""


@query
def op10_tries(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return tries.near_duplicates(table(spark, folder, "documents"))


ORACLE["op10_tries"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k + 1 : k + 5], ' ') AS g
  FROM (SELECT *, unnest(range(greatest(len(w) - 4, 1))) AS k FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), l AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)
), r(id, reach) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.id, l.b FROM r JOIN l ON r.reach = l.a
), c AS (
  SELECT id AS doc_id, min(reach) AS component_id FROM r GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
"""


@query
def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The best bound phrases of every language."""
    return phrases.collocations(table(spark, folder, "documents"))


ORACLE["op11_phrases"] = f"""
WITH p AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(said, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS said FROM documents)
), g AS (
  SELECT lang, n, array_to_string(w[k : k + n - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM p, (SELECT unnest([1, 2, 3, 4]) AS n)) GROUP BY ALL
), t AS (
  SELECT lang, cast(sum(f) AS BIGINT) AS n FROM g WHERE n = 1 GROUP BY 1
), c AS (
  SELECT lang, n AS words, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE n > 1 AND f >= 30
), k AS (
  SELECT c.*, k, array_to_string(w[1 : k], ' ') AS front, array_to_string(w[k + 1 : words], ' ') AS back
  FROM (SELECT *, unnest(range(1, words)) AS k FROM c) c
), s AS (
  SELECT k.lang, k.phrase, k.a, min({{'score': cast((2000000::HUGEINT * k.a) // (x.f + y.f) AS BIGINT), 'k': k.k, 'l': x.f, 'r': y.f}}) AS cut
  FROM k JOIN g x ON x.lang = k.lang AND x.phrase = k.front JOIN g y ON y.lang = k.lang AND y.phrase = k.back GROUP BY ALL
), h AS (
  SELECT lang, array_to_string(w[b : b + z - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, words - z + 2)) AS b FROM (SELECT *, unnest(range(2, words)) AS z FROM c)) GROUP BY ALL
), o AS (
  SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank
  FROM s LEFT JOIN h USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT lang, rank, phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score FROM o JOIN t USING (lang) WHERE rank <= 2000
"""


@query
def op12_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """SentencePiece ids of every document and the text they decode to."""
    rows = pieces.digests(table(spark, folder, "documents"), pieces.Model(public_tokenizers.path("piece_bpe_32k.model")))
    return rows.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_covered")


@query
def op13_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, least edits and the repaired text of every damaged conversation."""
    return turns.repair(turns.damaged(table(spark, folder, "conversations")))
