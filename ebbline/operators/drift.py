"""Drift of live scores and features against the frozen reference profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.values import number, round_half_up
from ebbline.names import KEY, PREDICTION, TARGET
from ebbline.operators.profiles import bin_of

PSI_EPSILON = 1e-4
ROWS = "__rows"
NOT_MONITORED = (KEY, TARGET, PREDICTION)


# --- which features --------------------------------------------------------------------


def top_features(importance: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most important features; unknown importance counts as zero.

    Rows without a name take up a place and are dropped only afterwards. Ties
    are broken by name.
    """
    weight = F.coalesce("importance", F.lit(0.0))
    return (
        importance.select("feature", weight.alias("importance"))
        .orderBy(F.desc("importance"), "feature")
        .limit(k)
        .where(F.col("feature").isNotNull() & (F.col("feature") != ""))
    )


def fallback_importance(features: Sequence[str], spark) -> DataFrame:
    """1, 1/2, 1/3, ... in profile order where no importance was ever recorded."""
    kept = [f for f in features if f not in NOT_MONITORED]
    rows = [(f, 1.0 / (i + 1)) for i, f in enumerate(kept)]
    return spark.createDataFrame(rows, "feature string, importance double")


def monitored_features(importance: DataFrame, k: int = 5) -> list[str]:
    """Names of the top features; at most ``k`` of them reach the driver."""
    names = [row.feature for row in top_features(importance, k).collect()]
    if not names:
        raise ValueError("the importance table is empty")
    return names


# --- counting --------------------------------------------------------------------------


def _kind() -> Column:
    given = F.coalesce(F.lower("kind"), F.lit("numerical"))
    return F.when(given == "categorical", given).otherwise("numerical")


def profile_cells(
    profile: DataFrame, features: Sequence[str], kind: str | None = None
) -> DataFrame:
    """The profile's bins and categories under one key, ``cell``."""
    cells = profile.where(F.col("feature").isin(list(features))).withColumn("kind", _kind())
    if kind:
        cells = cells.where(F.col("kind") == kind)
    numbered = F.col("kind") == "numerical"
    key = F.when(numbered, F.col("bin_no").cast("string")).otherwise(F.col("category"))
    return cells.withColumn("cell", key).where(F.col("cell").isNotNull())


def _references(cells: DataFrame) -> dict[str, tuple[str, list[float]]]:
    """feature -> (kind, edges), read from the stored profile.

    One row per requested feature with its bin edges; categories stay where they are.
    """
    bins = F.array_sort(
        F.collect_list(F.when(F.col("kind") == "numerical", F.struct("bin_no", "lo", "hi")))
    )
    rows = cells.groupBy("feature", "kind").agg(bins.alias("bins")).collect()
    return {
        r.feature: (r.kind, [b.lo for b in r.bins] + [b.hi for b in r.bins[-1:]]) for r in rows
    }


def _bin_number(value: Column, edges: list[float]) -> Column:
    """:func:`bin_of` for edges known beforehand."""
    return bin_of(value, F.array(*(F.lit(e) for e in edges)))


def cell_counts(
    telemetry: DataFrame, cells: DataFrame, features: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., feature, cell, n): where the values of each feature fall.

    One pass covers all features. The profile is a stored table, and the edges of
    the requested features are part of the plan, so each row finds its cells by
    itself and is counted where it lies; what is shuffled is one row per cell and
    task, however common a value is. The feature ``ROWS`` counts all rows.
    """
    present = [f for f in features if f in telemetry.columns]
    references = _references(cells)
    found = [F.lit("all").alias(ROWS)]
    for name in present:
        kind, edges = references.get(name, (None, []))
        if kind == "categorical":
            cell = telemetry[name].cast("string")
        elif kind == "numerical":
            value = number(telemetry, name)
            cell = F.when(value.isNotNull(), _bin_number(value, edges).cast("string"))
        else:
            cell = F.lit(None).cast("string")
        found.append(cell.alias(name))
    return (
        telemetry.select(*(telemetry[k] for k in by), *found)
        .unpivot(list(by), [ROWS, *present], "feature", "cell")
        .where(F.col("cell").isNotNull())
        .groupBy(*by, "feature", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _all_cells(counts: DataFrame, cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every cell of the features that were seen, with zero where nothing fell."""
    seen = counts.select(*by, "feature").distinct()
    return (
        seen.join(cells, "feature")
        .join(counts, [*by, "feature", "cell"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )


def bin_counts(
    telemetry: DataFrame, profile: DataFrame, features: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., feature, bin_no, lo, hi, expected_pct, n) of the numerical features."""
    cells = profile_cells(profile, features, "numerical")
    counts = cell_counts(telemetry, cells, features, by)
    return _all_cells(counts, cells, by).select(
        *by, "feature", "bin_no", "lo", "hi", "expected_pct", "n"
    )


def category_counts(
    telemetry: DataFrame, profile: DataFrame, features: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., feature, category, expected_pct, n); unknown categories do not count."""
    cells = profile_cells(profile, features, "categorical")
    counts = cell_counts(telemetry, cells, features, by)
    return _all_cells(counts, cells, by).select(*by, "feature", "category", "expected_pct", "n")


# --- population stability index --------------------------------------------------------


def index_of_counts(
    counts: DataFrame, cells: DataFrame, by: Sequence[str] = (), epsilon: float = PSI_EPSILON
) -> DataFrame:
    """(by..., feature, psi): how far the live shares are from the expected ones.

    Shares below ``epsilon`` are raised to it and both sides scaled to sum to one.
    With raised shares a, e and their sums A, E the index is
    sum(a ln(a/e)) / A - sum(e ln(a/e)) / E, as the scale cancels out of the logs.
    A cell nothing fell into has a = epsilon, so its terms depend on the profile
    alone: they are summed once per feature, and only cells that were hit are joined.
    """
    eps = F.lit(epsilon)
    e = F.greatest(F.col("expected_pct"), eps)
    empty_gap = F.ln(eps / e)
    # One row per requested feature: the sums if every cell were empty.
    constants = cells.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum(e).alias("e_sum"),
        F.sum(eps * empty_gap).alias("a_terms"),
        F.sum(e * empty_gap).alias("e_terms"),
    )
    keys = [*by, "feature"]
    hit = counts.join(
        cells.select("feature", "cell", e.alias("e")), ["feature", "cell"]
    )
    totals = hit.groupBy(*keys).agg(F.sum("n").alias("total"))
    shares = hit.join(totals, keys).withColumn("a", F.greatest(F.col("n") / F.col("total"), eps))
    a_gain = F.col("a") * F.ln(F.col("a") / F.col("e")) - eps * F.ln(eps / F.col("e"))
    found = shares.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("k_hit"),
        F.sum("a").alias("a_hit"),
        F.sum(a_gain).alias("a_gain"),
        F.sum(F.col("e") * F.ln(F.col("a") / eps)).alias("e_gain"),
    )
    a_sum = F.col("a_hit") + (F.col("k") - F.col("k_hit")) * eps
    index = (F.col("a_gain") + F.col("a_terms")) / a_sum - (
        F.col("e_gain") + F.col("e_terms")
    ) / F.col("e_sum")
    return found.join(F.broadcast(constants), "feature").select(*keys, index.alias("psi"))


def stability_index(
    telemetry: DataFrame,
    profile: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    epsilon: float = PSI_EPSILON,
    kind: str | None = None,
) -> DataFrame:
    """(by..., feature, psi) of the requested features that have values and a profile."""
    cells = profile_cells(profile, features, kind)
    return index_of_counts(cell_counts(telemetry, cells, features, by), cells, by, epsilon)


def psi_numeric(
    telemetry: DataFrame,
    profile: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    epsilon: float = PSI_EPSILON,
) -> DataFrame:
    return stability_index(telemetry, profile, features, by, epsilon, "numerical")


def psi_categorical(
    telemetry: DataFrame,
    profile: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    epsilon: float = PSI_EPSILON,
) -> DataFrame:
    return stability_index(telemetry, profile, features, by, epsilon, "categorical")


# --- report ----------------------------------------------------------------------------


def drift_report(
    telemetry: DataFrame,
    profile: DataFrame,
    features: Sequence[str],
    prediction: str = PREDICTION,
    by: Sequence[str] = (),
    runs: DataFrame | None = None,
    epsilon: float = PSI_EPSILON,
) -> DataFrame:
    """(by..., scope, feature, psi_score, status) for the prediction and each feature.

    ``runs`` lists the keys that must be reported; a key without telemetry gets
    EMPTY_TELEMETRY rows. Without it the keys found in the telemetry are used.
    """
    keys = list(by)
    wanted = list(dict.fromkeys([prediction, *features]))
    cells = profile_cells(profile, wanted)
    counts = cell_counts(telemetry, cells, wanted, by)
    sizes = counts.where(F.col("feature") == ROWS).select(*keys, F.col("n").alias("rows"))
    if not keys:
        sizes = sizes.agg(F.sum("rows").alias("rows"))  # one row even where there is none
    elif runs is not None:
        sizes = runs.select(*keys).distinct().join(sizes, keys, "left")
    requested = F.array(
        *(
            F.struct(
                F.lit("prediction" if i == 0 else "feature").alias("scope"),
                F.lit(name).alias("feature"),
                F.lit(name in telemetry.columns).alias("in_telemetry"),
            )
            for i, name in enumerate(wanted)
        )
    )
    asked = sizes.select(*keys, F.coalesce("rows", F.lit(0)).alias("rows"), F.inline(requested))
    # At most one row per requested feature.
    known = (
        profile.where(F.col("feature").isin(wanted))
        .select("feature", F.lit(True).alias("in_baseline"))
        .distinct()
    )
    index = index_of_counts(counts, cells, by, epsilon)
    joined = asked.join(F.broadcast(known), "feature", "left").join(
        index, [*keys, "feature"], "left"
    )
    in_baseline = F.coalesce("in_baseline", F.lit(False))
    absent = ~F.col("in_telemetry") | ~in_baseline
    broken = F.isnan("psi") | (F.abs("psi") == float("inf"))
    # The status words.
    status = (
        F.when(F.col("rows") == 0, "EMPTY_TELEMETRY")
        .when((F.col("scope") == "prediction") & absent, "MISSING_DATA")
        .when(~F.col("in_telemetry"), "MISSING_IN_TELEMETRY")
        .when(~in_baseline, "MISSING_IN_BASELINE")
        .when(broken, "ERROR")
        .otherwise("CALCULATED")
    )
    score = round_half_up(F.coalesce("psi", F.lit(0.0)), 4)
    return joined.withColumn("status", status).select(
        *keys,
        "scope",
        "feature",
        F.when(F.col("status") == "CALCULATED", score).otherwise(0.0).alias("psi_score"),
        "status",
    )
