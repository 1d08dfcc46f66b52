"""Quality and return of probability scores, per model.

Every function takes rows of (``by`` columns, label, probability) and returns
one row per ``by`` group. Rows are reduced before anything is sorted or moved.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.names import PREDICTION, TARGET

LOG_LOSS_EPSILON = 1e-15
THRESHOLDS = [float(t) for t in np.linspace(0.01, 0.99, 99)]


def known_score(p: str) -> Column:
    """The probability as double, NULL where it is missing; NaN is missing."""
    return F.nanvl(F.col(p).cast("double"), F.lit(None).cast("double"))


def complete_rows(df: DataFrame, y: str = TARGET, p: str = PREDICTION) -> DataFrame:
    """Rows whose label and probability are both known; NaN is unknown."""
    label, score = F.col(y).cast("double"), F.col(p).cast("double")
    return df.where(label.isNotNull() & ~F.isnan(label) & score.isNotNull() & ~F.isnan(score))


def label_counts(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, neg) with one row per row of the input."""
    label = F.col(y).cast("int")
    return df.select(
        *by,
        known_score(p).alias("score"),
        (label == 1).cast("int").alias("pos"),
        (label == 0).cast("int").alias("neg"),
    )


def score_counts(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, neg) with one row per distinct score.

    Equal scores merge where they lie, which takes the weight out of a hot score.
    """
    return (
        label_counts(df, y, p, by)
        .groupBy(*by, "score")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )


def squared_error(y: Column, p: Column) -> Column:
    return (p - y) * (p - y)


def log_error(y: Column, p: Column, epsilon: float = LOG_LOSS_EPSILON) -> Column:
    """Cross-entropy of one row with the probability kept off 0 and 1."""
    safe = F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(epsilon)), F.lit(1 - epsilon)))
    return -(y * F.ln(safe) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - safe))


def brier_logloss(
    df: DataFrame, y: str = TARGET, p: str = PREDICTION, by: Sequence[str] = (),
    epsilon: float = LOG_LOSS_EPSILON,
) -> DataFrame:
    label, score = F.col(y).cast("double"), known_score(p)
    return df.groupBy(*by).agg(
        F.avg(squared_error(label, score)).alias("brier_score"),
        F.avg(log_error(label, score, epsilon)).alias("log_loss"),
    )


# Pairs of counts outgrow doubles, which are exact up to 2^53 only.
COUNT, PAIRS = "decimal(18,0)", "decimal(38,0)"


def _twice(pos: Column, neg: Column) -> Column:
    return pos.cast(COUNT) * neg.cast(COUNT) * F.lit(2).cast("decimal(1,0)")


def _ranked_step(rows: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Collapse ``order`` into its group: add the pairs won across its values.

    ``rows`` holds pos, neg and twice the pairs already won inside each value.
    """
    below = Window.partitionBy(*group).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    lower = F.coalesce(F.sum("neg").over(below), F.lit(0))
    return (
        rows.withColumn("won", (F.col("won") + _twice(F.col("pos"), lower)).cast(PAIRS))
        .groupBy(*group)
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )


def _auc(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Area under the ROC curve from one row per score.

    What is needed is a running count of negatives below each score. One ordered
    pass over all scores would put a model into one task, so a score is read as its
    binary exponent and two digits of its mantissa to the base 65,536: scores are
    ordered within the same exponent and digits, then the second digits, the first
    ones and the exponents. As a double has 52 bits of mantissa, the first pass sees
    at most 2^20 distinct scores in a group, the others 65,537 digits or 1,100
    exponents, however large and however small the scores are. Pairs are counted
    twice over, in decimals, so that ties stay whole numbers.
    """
    score = F.col("score")
    exponent = F.when(score > 0, F.floor(F.log2(score))).otherwise(-2000)
    half = F.floor(-exponent / 2)
    whole = score * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), -exponent - half)
    scaled = F.when(score > 0, whole).otherwise(score) * F.lit(float(1 << 16))
    first = F.floor(scaled)
    second = F.floor((scaled - first) * F.lit(float(1 << 16)))
    tied = F.col("pos").cast(COUNT) * F.col("neg").cast(COUNT)
    rows = counts.where(score.isNotNull()).withColumns(
        {"exponent": exponent, "digit1": first, "digit2": second, "won": tied.cast(PAIRS)}
    )
    keys = list(by)
    if not keys:
        rows, keys = rows.withColumn("all", F.lit(1)), ["all"]
    by_two = _ranked_step(rows, [*keys, "exponent", "digit1", "digit2"], "score")
    by_one = _ranked_step(by_two, [*keys, "exponent", "digit1"], "digit2")
    by_exponent = _ranked_step(by_one, [*keys, "exponent"], "digit1")
    total = _ranked_step(by_exponent, keys, "exponent")
    pairs = _twice(F.col("pos"), F.col("neg")).cast("double")
    return total.select(*by, (F.col("won").cast("double") / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def roc_auc(
    df: DataFrame, y: str = TARGET, p: str = PREDICTION, by: Sequence[str] = ()
) -> DataFrame:
    """Share of (positive, negative) pairs ranked right; ties count one half.

    Rows without a probability take no part. Exact in the number of pairs.
    """
    return _auc(score_counts(df, y, p, by), by)


def realised_roi(
    df: DataFrame,
    y: str = TARGET,
    p: str = PREDICTION,
    by: Sequence[str] = (),
    campaign_cost: float = 10.0,
    customer_ltv: float = 150.0,
    save_rate: float = 0.20,
    threshold: float = 0.5,
) -> DataFrame:
    """Money made by treating everyone at or above the threshold."""
    tp, fp = hit_counts(y, p, threshold)
    return df.groupBy(*by).agg(
        roi_of(tp, fp, campaign_cost, customer_ltv, save_rate).alias("realized_roi")
    )


def hit_counts(y: str, p: str, threshold: float = 0.5) -> tuple[Column, Column]:
    treated, label = F.coalesce(known_score(p) >= threshold, F.lit(False)), F.col(y).cast("double")
    return F.count_if(treated & (label == 1)), F.count_if(treated & (label == 0))


def roi_of(tp: Column, fp: Column, cost: float, ltv: float, save_rate: float) -> Column:
    return tp * F.lit(save_rate) * F.lit(ltv) - (tp + fp) * F.lit(cost)


def thresholds_met(p: Column, thresholds: Sequence[float] = THRESHOLDS) -> Column:
    """How many of the ascending thresholds a probability reaches.

    The grid is close to even, so the count is guessed from the probability and
    put right against the two thresholds next to it. A missing one reaches none.
    """
    n = len(thresholds)
    step = (thresholds[-1] - thresholds[0]) / (n - 1)
    grid = F.array(*(F.lit(t) for t in thresholds))
    guess = F.floor((p - thresholds[0]) / step).cast("int") + 1
    bounded = F.greatest(F.lit(0), F.least(F.lit(n), guess))
    too_high = F.coalesce((p < F.get(grid, bounded - 1)).cast("int"), F.lit(0))
    too_low = F.coalesce((p >= F.get(grid, bounded)).cast("int"), F.lit(0))
    return F.when(p.isNotNull(), bounded - too_high + too_low).otherwise(0)


def threshold_returns(
    df: DataFrame,
    y: str = TARGET,
    p: str = PREDICTION,
    by: Sequence[str] = (),
    campaign_cost: float = 10.0,
    customer_ltv: float = 500.0,
    save_rate: float = 0.10,
) -> DataFrame:
    """Expected return per person at each of the 99 thresholds."""
    return _returns(label_counts(df, y, p, by), by, campaign_cost, customer_ltv, save_rate)


def _returns(
    counts: DataFrame, by: Sequence[str], campaign_cost: float = 10.0,
    customer_ltv: float = 500.0, save_rate: float = 0.10,
) -> DataFrame:
    """One pass counts labels by the number of thresholds met, which leaves at most
    100 rows per model; only those are spread over the thresholds."""
    met = counts.groupBy(*by, thresholds_met(F.col("score")).alias("met")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    grid = F.array(*(F.struct(F.lit(i + 1).alias("rank"), F.lit(t).alias("threshold"))
                     for i, t in enumerate(THRESHOLDS)))
    reached = F.col("met") >= F.col("rank")
    spread = met.select(*by, "met", "pos", "neg", F.inline(grid))
    counted = spread.groupBy(*by, "rank", "threshold").agg(
        F.sum(F.when(reached, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(reached, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
    )
    gain = F.col("tp") * F.lit(customer_ltv * save_rate)
    spent = (F.col("tp") + F.col("fp")) * F.lit(campaign_cost)
    return counted.select(*by, "threshold", "tp", "fp", ((gain - spent) / F.col("n")).alias("eroi"))


def _best(returns: DataFrame, by: Sequence[str]) -> DataFrame:
    best = F.max(F.struct("eroi", (-F.col("threshold")).alias("low")))
    return (
        returns.groupBy(*by)
        .agg(best.alias("best"))
        .select(*by, F.col("best.eroi").alias("eroi"), (-F.col("best.low")).alias("optimal_threshold"))
    )


def best_threshold(df: DataFrame, y: str = TARGET, p: str = PREDICTION, by: Sequence[str] = (),
                   **money: float) -> DataFrame:
    """Highest expected return and the lowest threshold that gives it."""
    return _best(threshold_returns(df, y, p, by, **money), by)


def _proper(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Brier score and log loss from one row per score; unscored rows take no part."""
    counts = counts.withColumns({c: F.when(F.col("score").isNotNull(), F.col(c)) for c in ("pos", "neg")})
    score, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    n = F.sum(pos + neg)

    def mean(error) -> Column:
        return F.sum(pos * error(F.lit(1.0), score) + neg * error(F.lit(0.0), score)) / n

    return counts.groupBy(*by).agg(
        mean(squared_error).alias("brier_score"), mean(log_error).alias("log_loss")
    )


def model_metrics(df: DataFrame, y: str = TARGET, p: str = PREDICTION,
                  by: Sequence[str] = ("model",), **money: float) -> DataFrame:
    """Log loss, AUC, Brier, return and threshold of each model on its test rows.

    All of them follow from the label counts per score, so the rows are scored and
    shuffled once and the three branches read the same merged counts.
    """
    keys = list(by)
    counts = score_counts(df, y, p, keys)
    return (
        _proper(counts, keys)
        .join(_auc(counts, keys), keys)
        .join(_best(_returns(counts, keys, **money), keys), keys)
    )


METRICS = ("log_loss", "roc_auc", "brier_score", "eroi", "optimal_threshold")


def duel(
    challengers: DataFrame,
    champions: DataFrame,
    keys: Sequence[str] = ("segment",),
    min_eroi: float = 0.05,
    margin: float = 0.02,
) -> DataFrame:
    """Approve a challenger that clears its champion by a margin.

    Without a champion it has to clear the minimum. Both sides have one row of
    metrics per key; many pairs are settled in one job.
    """
    held = champions.select(
        *keys, F.lit(True).alias("has_champion"), *(F.col(m).alias(f"champion_{m}") for m in METRICS)
    )
    has = F.coalesce("has_champion", F.lit(False))
    enough = F.when(has, F.col("eroi") >= F.col("champion_eroi") + margin).otherwise(
        F.col("eroi") >= min_eroi
    )
    return (
        challengers.select(*keys, *METRICS)
        .join(held, list(keys), "left")
        .withColumns({"has_champion": has, "is_approved": enough})
    )


def baseline_record(settled: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Metrics of the model that serves after the duel; none if nobody does."""
    serving = settled.where(F.col("is_approved") | F.col("has_champion"))
    return serving.select(
        *keys,
        *(
            F.when(F.col("is_approved"), F.col(m)).otherwise(F.col(f"champion_{m}")).alias(m)
            for m in METRICS
        ),
    ).withColumnsRenamed({"optimal_threshold": "optimal_decision_threshold", "eroi": "expected_roi_per_user"})
