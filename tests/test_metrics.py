"""Scores against golden values and brute force."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.operators import metrics as mt
from ebbline.operators import reports as rp
from ebbline.operators.performance import evaluation_join, performance_report

PAIR = "target_is_churn int, predicted_probability double"


def scored(spark, labels, scores, **extra):
    df = spark.createDataFrame(list(zip(labels, [float(s) for s in scores])), PAIR)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def brute_auc(y, p):
    pos = [s for s, label in zip(p, y) if label]
    neg = [s for s, label in zip(p, y) if not label]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else None


def brute_sweep(y, p, cost, ltv, rate):
    y, p = np.asarray(y), np.asarray(p)
    best, where = -math.inf, None
    for t in np.linspace(0.01, 0.99, 99):
        hit = p >= t
        roi = ((hit & (y == 1)).sum() * (ltv * rate) - hit.sum() * cost) / len(y)
        if roi > best:
            best, where = roi, t
    return best, where


def test_golden_scores(spark):
    row = mt.brier_logloss(scored(spark, [1, 0], [0.9, 0.1])).first()
    assert row.brier_score == pytest.approx(0.01) and row.log_loss == pytest.approx(0.10536, abs=1e-4)
    clipped = mt.brier_logloss(scored(spark, [1, 0], [0.0, 1.0])).first().log_loss
    assert 0 < clipped < math.inf
    assert mt.realised_roi(scored(spark, [1, 1, 0, 0], [0.9, 0.1, 0.9, 0.1])).first()[0] == 10.0
    assert mt.roc_auc(scored(spark, [0, 1], [0.1, 0.8])).first()[0] == 1.0
    best = mt.best_threshold(scored(spark, [1, 1, 0, 0], [0.9, 0.4, 0.8, 0.1])).first()
    assert best.eroi == 17.5 and best.optimal_threshold == pytest.approx(0.11)


def test_auc_needs_both_classes(spark):
    assert mt.roc_auc(scored(spark, [1, 1], [0.1, 0.8])).first()[0] is None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.one_of(
    st.floats(0, 1), st.sampled_from([0.0, 0.5, 1.0, 0.5 + 2**-20, 0.5 + 2**-40, 1e-12, 2e-12]))), min_size=2, max_size=40))
def test_auc_and_sweep_equal_brute_force(spark, rows):
    y, p = [r[0] for r in rows], [r[1] for r in rows]
    df = scored(spark, y, p)
    found, expected = mt.roc_auc(df).first()[0], brute_auc(y, p)
    assert found is None if expected is None else found == pytest.approx(expected, abs=1e-12)
    best = mt.best_threshold(df).first()
    value, where = brute_sweep(y, p, 10.0, 500.0, 0.10)
    assert best.eroi == pytest.approx(value) and best.optimal_threshold == pytest.approx(where)


def test_every_threshold_counts_itself(spark):
    df = spark.createDataFrame([(t,) for t in mt.THRESHOLDS] + [(0.0,), (1.0,), (0.0099,), (0.991,)], "p double")
    rows = df.select("p", mt.thresholds_met(F.col("p")).alias("met")).collect()
    for r in rows:
        assert r.met == sum(r.p >= t for t in mt.THRESHOLDS)


def test_a_hot_score_and_a_crowded_interval(spark):
    """A third of the rows share one score, another third differ only below 2^-20."""
    n = 6_000
    df = spark.range(n).select(
        F.when(F.col("id") % 7 < 3, 1).otherwise(0).alias("target_is_churn"),
        F.when(F.col("id") % 3 == 0, 0.5)
        .when(F.col("id") % 3 == 1, 0.25 + F.col("id") * 2.0**-34)
        .otherwise((F.col("id") * 7919 % n) / n).alias("predicted_probability"),
    )
    rows = df.toPandas()
    y, p = rows.target_is_churn.to_numpy(), rows.predicted_probability
    ranks, npos = p.rank().to_numpy(), y.sum()
    expected = (ranks[y == 1].sum() - npos * (npos + 1) / 2) / (npos * (n - npos))
    assert mt.roc_auc(df).first()[0] == pytest.approx(expected, abs=1e-12)


def test_metrics_of_many_models(spark):
    df = scored(spark, [1, 1, 0, 0], [0.9, 0.4, 0.8, 0.1], model="a").union(
        scored(spark, [1, 0, 0, 0], [0.2, 0.9, 0.9, 0.9], model="b"))
    rows = {r.model: r for r in mt.model_metrics(df).collect()}
    assert rows["a"].eroi == 17.5 and rows["a"].roc_auc == 0.75
    assert rows["b"].roc_auc == 0.0


@pytest.mark.parametrize("champion, challenger, approved",
                         [(None, 0.06, True), (None, 0.04, False), (0.10, 0.13, True), (0.10, 0.11, False), (0.50, 0.52, True)])
def test_duel(spark, champion, challenger, approved):
    names = "segment string, log_loss double, roc_auc double, brier_score double, eroi double, optimal_threshold double"
    new = spark.createDataFrame([("s", 0.6, 0.7, 0.2, challenger, 0.4)], names)
    old = spark.createDataFrame([("s", 0.5, 0.8, 0.1, champion, 0.3)] if champion is not None else [], names)
    settled = mt.duel(new, old)
    assert settled.first().is_approved is approved
    kept = mt.baseline_record(settled).collect()
    if approved:
        assert kept[0].brier_score == 0.2 and kept[0].expected_roi_per_user == challenger
    elif champion is None:
        assert kept == []
    else:
        assert kept[0].brier_score == 0.1 and kept[0].optimal_decision_threshold == 0.3


def test_evaluation_join(spark):
    predictions = spark.createDataFrame([("C1", 0.1), ("C2", 0.9), ("C3", 0.5)], "customer_unique_id string, predicted_probability double")
    labels = spark.createDataFrame([("C2", 1), ("C3", 0), ("C4", 1)], "customer_unique_id string, target_is_churn int")
    assert {r.customer_unique_id for r in evaluation_join(predictions, labels).collect()} == {"C2", "C3"}


def test_performance_statuses(spark):
    nan = float("nan")
    empty = performance_report(scored(spark, [1], [0.5]).where("false")).first()
    assert (empty.is_evaluated, empty.reason, empty.brier_score) == (False, "INSUFFICIENT_LOOKBACK_MATURITY", 0.0)
    useless = performance_report(spark.createDataFrame([(None, 0.5), (1, nan), (0, None)], PAIR)).first()
    assert (useless.is_evaluated, useless.reason, useless.log_loss) == (False, "ALL_NAN_EVALUATION_COLUMNS", 0.0)
    part = performance_report(spark.createDataFrame([(1, 0.9), (0, 0.1), (1, nan), (None, 0.9)], PAIR)).first()
    assert part.is_evaluated and part.reason is None and (part.n_rows, part.n_clean) == (4, 2)
    assert part.brier_score == pytest.approx(0.01) and part.realized_roi == 20.0
    assert mt.complete_rows(spark.createDataFrame([(1, 0.9), (1, nan), (None, 0.9)], PAIR)).count() == 1
    with pytest.raises(ValueError):
        performance_report(spark.range(1))


def test_missing_scores_are_never_treated(spark):
    rows = [(1, 0.9), (1, 0.1), (0, 0.9), (0, 0.1), (0, None), (1, None), (0, float("nan")), (1, float("nan"))]
    df = spark.createDataFrame(rows, "target_is_churn int, predicted_probability double")
    roi = mt.realised_roi(df, campaign_cost=10.0, customer_ltv=150.0, save_rate=0.2)
    assert roi.first().realized_roi == 10.0
    for r in mt.threshold_returns(df).collect():
        want = sum(p is not None and p >= r.threshold and y == 0 for y, p in rows)
        assert (r.fp, r.tp) == (want, want)
    assert mt.roc_auc(df).first().roc_auc == 0.5
    assert rp.scored_customers(df.withColumn("customer_unique_id", F.lit("x"))).agg(F.sum("is_churn_risk")).first()[0] == 2


def test_auc_of_many_tiny_scores(spark):
    """Distinct scores below 1e-10: the answer is exact and no group holds many of them."""
    n = 200_000
    df = spark.range(n).select(
        (F.col("id") % 2).cast("int").alias("target_is_churn"),
        ((F.xxhash64("id") % 1_000_003) * F.lit(1e-17) + F.col("id") * F.lit(1e-24) + F.lit(2e-11)).alias("predicted_probability"),
    )
    rows = df.toPandas().sort_values("predicted_probability")
    assert rows.predicted_probability.is_unique and rows.predicted_probability.max() < 1e-10
    y = rows.target_is_churn.to_numpy()
    below = (y == 0).cumsum()
    want = below[y == 1].sum() / ((y == 1).sum() * (y == 0).sum())
    assert mt.roc_auc(df).first().roc_auc == pytest.approx(want, abs=1e-12)
    score = F.col("predicted_probability")
    power = F.floor(F.log2(score))
    scaled = score * F.pow(F.lit(2.0), -power) * 65536
    digits = df.groupBy(power, F.floor(scaled), F.floor((scaled - F.floor(scaled)) * 65536)).count()
    assert digits.agg(F.max("count")).first()[0] < 200
