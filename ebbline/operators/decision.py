"""Three rules turn drift and performance into retrain or keep.

Frames are keyed, by default by model and day, so many of them are decided in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("model_run_id", "execution_date")

# The words a decision is made of, the reasons in their order.
REASONS = ("CRITICAL_PREDICTION_DRIFT", "CRITICAL_FEATURE_DRIFT", "SEVERE_PERFORMANCE_DEGRADATION")
NO_REASON = "NONE"
IMMATURE = "INSUFFICIENT_LOOKBACK_MATURITY"


def judged(
    drift: DataFrame,
    performance: DataFrame,
    baseline: DataFrame,
    keys: Sequence[str] = KEYS,
    baseline_keys: Sequence[str] = ("model_run_id",),
    psi_limit: float = 0.20,
    feature_psi_limit: float = 0.20,
    min_features: int = 2,
    brier_factor: float = 1.05,
) -> DataFrame:
    """One row per key with every quantity the rules look at and their outcome.

    Prediction and feature drift are at or above their limit; the Brier score has
    to be strictly above its boundary. An evaluated key without a Brier score or
    a baseline stops the job.
    """
    is_feature = F.col("scope") == "feature"
    drifted = is_feature & (F.col("psi_score") >= feature_psi_limit)
    by_key = drift.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col("scope") == "prediction", F.col("psi_score"))), F.lit(0.0))
        .alias("prediction_psi"),
        F.count_if(drifted).alias("n_drifted"),
        F.array_sort(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted_features"),
    )
    observed = performance.select(*keys, "is_evaluated", "reason", "brier_score")
    reference = baseline.select(*baseline_keys, F.col("brier_score").alias("baseline_brier"))
    rows = by_key.join(observed, list(keys), "left").join(reference, list(baseline_keys), "left")
    evaluated = F.coalesce("is_evaluated", F.lit(False))
    unknown = F.col("brier_score").isNull() | F.col("baseline_brier").isNull()
    boundary = F.col("baseline_brier") * F.lit(brier_factor)
    worse = F.when(
        evaluated & unknown,
        F.raise_error(F.lit("Brier score missing from the performance report or the baseline")).cast("boolean"),
    ).when(evaluated, F.col("brier_score") > boundary).otherwise(False)
    return rows.withColumns(
        {
            "is_evaluated": evaluated,
            "reason": F.when(~evaluated, F.coalesce("reason", F.lit(IMMATURE))),
            "degradation_boundary": F.when(evaluated, boundary),
            "rule1": F.col("prediction_psi") >= psi_limit,
            "rule2": F.col("n_drifted") >= min_features,
            "rule3": worse,
            "psi_limit": F.lit(psi_limit),
            "min_features": F.lit(min_features),
        }
    )


def _severity(hit: Column) -> Column:
    return F.when(hit, "CRITICAL").otherwise("INFO")


def rule_evaluations(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per key and rule: what was measured, against what, and the outcome."""

    def rule(number: int, metric: str, actual: Column, limit: Column, note: Column) -> Column:
        hit = F.col(f"rule{number}")
        return F.struct(
            F.lit(number).alias("rule"),
            F.lit(metric).alias("metric"),
            hit.alias("is_triggered"),
            _severity(hit).alias("severity_level"),
            actual.cast("double").alias("actual_value"),
            limit.cast("double").alias("threshold"),
            note.alias("note"),
        )

    none = F.lit(None).cast("string")
    listed = F.array(
        rule(1, "predicted_probability_psi", F.col("prediction_psi"), F.col("psi_limit"), none),
        rule(2, "drifted_top_features_count", F.col("n_drifted"), F.col("min_features"),
             F.array_join("drifted_features", ",")),
        rule(3, "brier_score_degradation", F.when(F.col("is_evaluated"), F.col("brier_score")),
             F.col("degradation_boundary"), F.col("reason")),
    )
    return rows.select(*keys, F.inline(listed))


def decision(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys..., need_update, trigger_reasons)."""
    reasons = F.concat_ws(
        " | ",
        *(F.when(F.col(f"rule{i + 1}"), reason) for i, reason in enumerate(REASONS)),
    )
    return rows.select(
        *keys,
        (F.col("rule1") | F.col("rule2") | F.col("rule3")).alias("need_update"),
        F.when(reasons == "", NO_REASON).otherwise(reasons).alias("trigger_reasons"),
    )
