"""Benchmark passages in documents, by a positional inverted index of the documents.

The windows of the benchmark are runs of `WINDOW` words (a shorter item is one
window). The index, a stored table, has the postings (document, place) of all their
words; it says how often each of them occurs. The lists of the `LISTS` rarest words of
a window, moved back by the word's offset in it, are intersected, rarest first. What is
left are candidate places, and there the lists of all the window's words are
intersected, taken from the candidate documents alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import carried, small, spaced_words, text_keys
from ebbline.session import store

WINDOW = 10
LISTS = 2
# No text has more words: a phrase of any length is one window.
LONGEST_ARRAY = (1 << 31) - 1


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, window (its words joined by a space) and terms, distinct; items without a word have none."""
    words = F.filter(F.split(spaced_words("text"), " "), lambda w: w != "")
    rows = items.select("item_id", words.alias("words")).filter("size(words) > 0")
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0))), lambda k: F.slice("words", k + 1, F.least(F.size("words"), F.lit(size)))
    )
    return rows.select("item_id", F.explode(runs).alias("terms")).withColumn("window", F.array_join("terms", " ")).dropDuplicates(["item_id", "window"])


def postings(docs: DataFrame) -> DataFrame:
    """Keys of a document and its text, place and word: the index before it is restricted to a vocabulary."""
    rows = docs.select(*text_keys(docs), F.split(F.trim(spaced_words("text")), " ").alias("words"))
    return rows.select("key1", "key2", F.posexplode("words").alias("pos", "term")).filter("term <> ''")


def occurrences(docs: DataFrame, items: DataFrame, size: int = WINDOW, lists: int = LISTS) -> tuple[DataFrame, DataFrame]:
    """(key1, key2, start, window, len) of every place where a window occurs, and the items' windows.

    Rows that repeat a document and its text count once.
    """
    owned = store(windows(items, size))
    distinct = owned.select("window", "terms").dropDuplicates(["window"])
    terms = distinct.select("window", F.size("terms").alias("len"), F.posexplode("terms").alias("offset", "term"))
    vocabulary = small(terms.select("term").distinct())
    # The texts are read once; all that follows reads the index.
    postings_of = store(postings(docs).join(vocabulary, "term"))
    counts = postings_of.groupBy("term").agg(F.count("*").alias("n"))
    # A window with a word that no document has drops out: fewer counted words than words.
    rank = Window.partitionBy("window").orderBy("n", "term", "offset")
    ranked = terms.join(counts, "term").withColumn("rank", F.row_number().over(rank)).withColumn("counted", F.count("*").over(Window.partitionBy("window")))
    leads = ranked.filter(f"counted = len AND rank <= {lists}").select("term", "window", "offset", F.least("len", F.lit(lists)).alias("lists"))
    moved = postings_of.join(small(leads), "term").select("key1", "key2", (F.col("pos") - F.col("offset")).alias("start"), "window", "lists").filter("start >= 0")
    place = ["key1", "key2", "window", "start"]
    candidates = store(moved.groupBy(*place).agg(F.count("*").alias("met"), F.first("lists").alias("lists")).filter("met >= lists").select(*place))
    # All words at the candidates: lists of the candidate documents only. A repeated
    # document gives its postings twice, so places are counted, not rows.
    there = small(candidates.select("key1", "key2").distinct())
    lists_there = postings_of.join(there, ["key1", "key2"], "left_semi").dropDuplicates(["key1", "key2", "pos"])
    wanted = candidates.join(small(terms.select("window", "len", "offset", "term")), "window").withColumn("pos", F.col("start") + F.col("offset"))
    met = lists_there.join(wanted, ["key1", "key2", "pos", "term"]).groupBy(*place, "len").agg(F.count("*").alias("met"))
    return store(met.filter("met = len").drop("met")), owned


def phrase_matches(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Exact matches of whole phrases (item_id, text): key1, key2, start, len, item_id."""
    found, owned = occurrences(docs, phrases, size=LONGEST_ARRAY)
    return found.join(owned.select("item_id", "window"), "window").select("key1", "key2", "start", "len", "item_id")


def proximity_matches(docs: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """key1, key2, item_id, start, end of the stretches of at most `within` words that hold every
    distinct word of a phrase; of the stretches that end at one word only the shortest.

    For each place of a phrase's word the latest place of each of its other words is carried
    along the document's list, so work and rows grow with the postings of the phrase's words.
    """
    words = F.array_distinct(F.filter(F.split(spaced_words("text"), " "), lambda w: w != ""))
    wanted = phrases.select("item_id", words.alias("terms")).filter("size(terms) > 0")
    single = wanted.select("item_id", F.size("terms").alias("many"), F.posexplode("terms").alias("nth", "term"))
    met = postings(docs).dropDuplicates(["key1", "key2", "pos"]).join(small(single), "term")
    along = Window.partitionBy("key1", "key2", "item_id").orderBy("pos").rangeBetween(-(within - 1), 0)
    seen = met.withColumn("near", F.collect_list(F.struct("nth", "pos")).over(along))
    latest = F.aggregate(
        "near",
        F.create_map().cast("map<int,int>"),
        lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, v: k != x["nth"]), F.create_map(x["nth"], x["pos"])),
    )
    held = seen.withColumn("latest", latest).filter(F.size("latest") == F.col("many"))
    return held.select("key1", "key2", "item_id", F.array_min(F.map_values("latest")).alias("start"), (F.col("pos") + 1).alias("end"))


def contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`row` of every document with n_words, n_hit, n_items, items_sha256 and contaminated.

    A null text has no words. An item that is null or has no word hits nothing.
    Items of one id are one item with the windows of all its rows.
    """
    found, owned = occurrences(docs, items, size)
    key = ["key1", "key2"]
    before = Window.partitionBy(*key).orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max(F.col("start") + F.col("len")).over(before), F.lit(0))
    fresh = F.greatest(F.col("start") + F.col("len") - F.greatest("start", covered), F.lit(0))
    hit = found.withColumn("fresh", fresh).groupBy(*key).agg(F.sum("fresh").alias("n_hit"))
    named = found.select(*key, "window").distinct().join(small(owned.select("window", "item_id")), "window").select(*key, "item_id").distinct()
    by_text = named.groupBy(*key).agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    result = small(hit.join(by_text, key).select(*key, "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")))
    said = spaced_words("text")
    n_words = F.greatest(F.length(said) - F.length(F.replace(said, F.lit(" "), F.lit(""))) - 1, F.lit(0)).cast("bigint")
    rows = docs.select(carried(docs, keep), *text_keys(docs), n_words.alias("n_words")).join(result, key, "left")
    return rows.withColumns(
        {
            "n_hit": F.coalesce("n_hit", F.lit(0)).cast("bigint"),
            "n_items": F.coalesce("n_items", F.lit(0)).cast("bigint"),
            "items_sha256": F.coalesce("items_sha256", F.sha2(F.lit(""), 256)),
            "contaminated": F.coalesce(F.col("n_hit") > 0, F.lit(False)),
        }
    ).drop(*key)
