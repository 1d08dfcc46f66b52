"""Reference profiles of the training data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.operators.prep import long_values
from ebbline.session import store


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, range and missing rate; NaN counts as missing."""
    return (
        long_values(df, columns, "double")
        .groupBy("feature")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.avg(F.col("value").isNull().cast("int")).alias("missing_rate"),
        )
    )


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of each value among the non-NULL ones; missing rate over all rows."""
    counts = long_values(df, columns, "string").groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    filled = F.when(F.col("value").isNotNull(), F.col("n"))
    # One row per listed column, whatever the data.
    totals = counts.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum(filled).alias("filled"))
    return (
        counts.where(F.col("value").isNotNull())
        .join(F.broadcast(totals), "feature")
        .select(
            "feature",
            F.col("value").alias("category"),
            (F.col("n") / F.col("filled")).alias("frequency"),
            ((F.col("rows") - F.col("filled")) / F.col("rows")).alias("missing_rate"),
        )
    )


def bin_of(value: Column, edges: Column) -> Column:
    """Number of the bin ``[edge, next edge)`` a value falls in.

    The outer edges do not bound anything: the first bin reaches to minus
    infinity, the last one to plus infinity.
    """
    inner = F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.size(F.filter(inner, lambda edge: value >= edge))


# Cells that a column, or a cell of one, is cut into while its quantiles are looked for,
# and the distinct values that are put in order in one task.
CELLS = 256
HELD = 200_000


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n): each number of each column once, NULL and NaN left out."""
    return (
        long_values(df, columns, "double")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def hit_cells(values: DataFrame, shares: Sequence[float], held: int = HELD, cells: int = CELLS) -> DataFrame:
    """(feature, path, value, n, before, ranks): the values among which the wanted ranks lie, by cell.

    A column is one cell to begin with. Cells that hold more than ``held`` distinct
    values are cut at quantiles of a summary of fixed size and counted, and only the
    parts that a wanted rank falls into are kept, until none holds more. ``before``
    counts the rows below a cell, ``ranks`` are those that fall into it.
    """
    asked = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(x).alias("share")) for i, x in enumerate(shares)))
    ranks = F.transform(
        asked, lambda s: F.struct(s["i"].alias("i"), F.greatest(F.lit(1), F.ceil(s["share"] * F.col("total"))).alias("rank"))
    )
    # One row per listed column.
    totals = values.groupBy("feature").agg(F.sum("n").alias("total")).select("feature", ranks.alias("ranks"))
    none = F.lit(0).cast("bigint")
    open_ = values.join(F.broadcast(totals), "feature").select("feature", none.alias("path"), "value", "n", none.alias("before"), "ranks")
    most = values.groupBy("feature").count().agg(F.max("count")).first()[0] or 0
    steps = [i / cells for i in range(1, cells)]
    while most > held:
        # One row of at most `cells` numbers for each open cell, of which there is at most one a column and share.
        guide = open_.groupBy("feature", "path").agg(F.array_distinct(F.percentile_approx("value", steps)).alias("guide"))
        part = F.size(F.filter("guide", lambda g: F.col("value") > g))
        placed = open_.join(F.broadcast(guide), ["feature", "path"]).withColumn("part", part).drop("guide")
        below = Window.partitionBy("feature", "path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        counted = (
            placed.groupBy("feature", "path", "part")
            .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("many"), F.first("before").alias("start"), F.first("ranks").alias("all"))
            .withColumn("start", F.col("start") + F.coalesce(F.sum("rows").over(below), F.lit(0)))
        )
        mine = F.filter("all", lambda r: (r["rank"] > F.col("start")) & (r["rank"] <= F.col("start") + F.col("rows")))
        hit = store(counted.withColumn("hit", mine).where(F.size("hit") > 0).drop("all", "rows"))
        open_ = store(
            placed.join(F.broadcast(hit), ["feature", "path", "part"]).select(
                "feature", (F.col("path") * cells + F.col("part")).alias("path"), "value", "n",
                F.col("start").alias("before"), F.col("hit").alias("ranks"),
            )
        )
        most = hit.agg(F.max("many")).first()[0] or 0
    return open_


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], held: int = HELD) -> DataFrame:
    """(feature, quantiles): for each share the least value that as large a part of the column reaches.

    Exact at any size: each value is counted once, and at most ``held`` of them are
    put in order in one task.
    """
    inside = hit_cells(store(value_counts(df, columns)), shares, held)
    upto = Window.partitionBy("feature", "path").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    last = inside.withColumn("last", F.col("before") + F.sum("n").over(upto))
    here = F.filter("ranks", lambda r: (r["rank"] <= F.col("last")) & (r["rank"] > F.col("last") - F.col("n")))
    hit = last.select("feature", "value", F.explode(here).alias("of"))
    ordered = F.array_sort(F.collect_list(F.struct("of.i", "value")))
    return hit.groupBy("feature").agg(ordered.alias("found")).select("feature", F.col("found.value").alias("quantiles"))


def quantile_edges(df: DataFrame, columns: Sequence[str], n_bins: int = 10) -> DataFrame:
    """(feature, edges): the distinct quantiles that cut each column into bins."""
    found = quantiles(df, columns, [i / n_bins for i in range(n_bins + 1)])
    edges = found.select("feature", F.array_distinct("quantiles").alias("edges"))
    constant = F.array(F.element_at("edges", 1), F.element_at("edges", 1))
    return edges.select(
        "feature", F.when(F.size("edges") == 1, constant).otherwise(F.col("edges")).alias("edges")
    )


def numeric_bins(df: DataFrame, columns: Sequence[str], n_bins: int = 10) -> DataFrame:
    """(feature, bin_no, lo, hi, expected_pct) over quantile bins, empty ones included.

    The edges travel with the counts, so the bins that are listed are the bins
    that were counted even if a lost task is run again.
    """
    # At most one row of n_bins + 1 numbers per listed column.
    edges = F.broadcast(quantile_edges(df, columns, n_bins))
    counts = (
        value_counts(df, columns)
        .join(edges, "feature")
        .groupBy("feature", "edges", bin_of(F.col("value"), F.col("edges")).alias("bin_no"))
        .agg(F.sum("n").alias("n"))
    )
    per_feature = counts.groupBy("feature", "edges").agg(
        F.map_from_entries(F.collect_list(F.struct("bin_no", "n"))).alias("filled"),
        F.sum("n").alias("total"),
    )
    listed = per_feature.select(
        "feature",
        "edges",
        "filled",
        "total",
        F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin_no"),
    )
    share = F.coalesce(F.try_element_at("filled", F.col("bin_no")), F.lit(0)) / F.col("total")
    return listed.select(
        "feature",
        "bin_no",
        F.get("edges", F.col("bin_no")).alias("lo"),
        F.get("edges", F.col("bin_no") + 1).alias("hi"),
        share.alias("expected_pct"),
    )


def binned_profile(
    df: DataFrame,
    numerical: Sequence[str],
    categorical: Sequence[str],
    n_bins: int = 10,
) -> DataFrame:
    """The profile drift is measured against.

    Columns: feature, kind, bin_no, lo, hi, category, expected_pct.
    """
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    numbers = numeric_bins(df, numerical, n_bins).select(
        "feature",
        F.lit("numerical").alias("kind"),
        "bin_no",
        "lo",
        "hi",
        no_text.alias("category"),
        "expected_pct",
    )
    if not categorical:
        return numbers
    shares = categorical_profile(df, categorical).select(
        "feature",
        F.lit("categorical").alias("kind"),
        F.lit(None).cast("int").alias("bin_no"),
        no_number.alias("lo"),
        no_number.alias("hi"),
        "category",
        F.col("frequency").alias("expected_pct"),
    )
    return numbers.unionByName(shares)
