"""Performance on labels that have matured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.names import KEY, PREDICTION, TARGET
from ebbline.operators.metrics import (
    LOG_LOSS_EPSILON,
    hit_counts,
    log_error,
    roi_of,
    squared_error,
)


def evaluation_join(
    predictions: DataFrame, labels: DataFrame, keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """Predictions that have a label. Keys are expected to be unique on each side."""
    return predictions.join(labels, list(keys))


def performance_report(
    evaluation: DataFrame,
    y: str = TARGET,
    p: str = PREDICTION,
    by: Sequence[str] = (),
    campaign_cost: float = 10.0,
    customer_ltv: float = 150.0,
    save_rate: float = 0.20,
    epsilon: float = LOG_LOSS_EPSILON,
) -> DataFrame:
    """Brier, log loss and realised return in one pass, or the reason for having none."""
    lacking = [c for c in (y, p) if c not in evaluation.columns]
    if lacking:
        raise ValueError(f"missing evaluation columns: {lacking}")
    label, score = F.col(y).cast("double"), F.col(p).cast("double")
    clean = evaluation.select(
        *by,
        F.when(~F.isnan(label), label).alias("y"),
        F.when(~F.isnan(score), score).alias("p"),
    )
    both = F.col("y").isNotNull() & F.col("p").isNotNull()
    usable = clean.select(
        *by, F.when(both, F.col("y")).alias("y"), F.when(both, F.col("p")).alias("p")
    )
    tp, fp = hit_counts("y", "p")
    found = usable.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("y").alias("n_clean"),
        F.avg(squared_error(F.col("y"), F.col("p"))).alias("brier"),
        F.avg(log_error(F.col("y"), F.col("p"), epsilon)).alias("loss"),
        roi_of(tp, fp, campaign_cost, customer_ltv, save_rate).alias("roi"),
    )
    evaluated = F.col("n_clean") > 0
    # The reasons for having no figures.
    reason = F.when(F.col("n_rows") == 0, "INSUFFICIENT_LOOKBACK_MATURITY").when(
        F.col("n_clean") == 0, "ALL_NAN_EVALUATION_COLUMNS"
    )
    return found.select(
        *by,
        evaluated.alias("is_evaluated"),
        reason.alias("reason"),
        "n_rows",
        "n_clean",
        *(
            F.when(evaluated, F.col(c)).otherwise(0.0).alias(name)
            for c, name in (("brier", "brier_score"), ("loss", "log_loss"), ("roi", "realized_roi"))
        ),
    )
