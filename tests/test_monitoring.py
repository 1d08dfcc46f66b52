"""Reports, drift and the decision."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbline.operators import decision as dec
from ebbline.operators import drift as dr
from ebbline.operators import profiles as pr
from ebbline.operators import reports as rp

PROFILE = "feature string, kind string, bin_no int, lo double, hi double, category string, expected_pct double"


def numeric(spark, name, edges, shares, kind="numerical"):
    rows = [(name, kind, i, float(a), float(b), None, s) for i, (a, b, s) in enumerate(zip(edges, edges[1:], shares))]
    return spark.createDataFrame(rows, PROFILE)


def categorical(spark, name, shares):
    return spark.createDataFrame([(name, "categorical", None, None, None, c, s) for c, s in shares.items()], PROFILE)


def values(spark, items, kind="double"):
    return spark.createDataFrame([(i,) for i in items], f"f {kind}")


def psi_of(df):
    rows = df.collect()
    return rows[0].psi if rows else 0.0


# --- reports ---


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(
        [("CUST-001", "d", 10, 5, 150.0, 0.85), ("CUST-002", "d", 45, 1, 20.0, 0.20), ("CUST-003", "d", 2, 12, 1200.0, 0.95)],
        "customer_unique_id string, snapshot_date string, recency_days int, frequency int, monetary_total double, "
        "predicted_probability double")


def test_business_report(scored):
    report = rp.business_report(scored).collect()
    assert [r.customer_unique_id for r in report] == ["CUST-003", "CUST-001", "CUST-002"]
    assert [r.revenue_at_risk for r in report] == [1140.0, 127.5, 4.0]
    assert [r.is_churn_risk for r in report] == [1, 1, 0]
    assert report[0].asDict().keys() == {"customer_unique_id", "churn_probability", "is_churn_risk", "revenue_at_risk"}
    total = rp.impact_summary(scored).first()
    assert tuple(total) == (3, 2, 1271.5)


def test_report_without_money(scored):
    plain = scored.drop("monetary_total")
    assert [r.customer_unique_id for r in rp.business_report(plain).collect()] == ["CUST-003", "CUST-001", "CUST-002"]
    assert rp.impact_summary(plain).first().total_revenue_at_risk_flagged is None
    assert rp.money_column(["a", "Order_VALUE", "monetary"]) == "Order_VALUE"


def test_threshold_is_inclusive_and_checked(scored):
    assert rp.impact_summary(scored, 0.85).first().total_churners_flagged == 2
    with pytest.raises(ValueError):
        rp.risk_flag(1.5)


def test_telemetry_keeps_the_matrix(scored):
    log = rp.telemetry_log(scored, "r1")
    assert log.columns == [*scored.columns, "inference_run_id", "is_churn_risk"]


# --- drift ---


def test_psi_numeric_golden(spark):
    ref = numeric(spark, "f", [0, 10, 20], [0.5, 0.5])
    assert psi_of(dr.psi_numeric(values(spark, [5.0, 15.0]), ref, ["f"])) == pytest.approx(0, abs=1e-4)
    assert psi_of(dr.psi_numeric(values(spark, [5.0, 5.0]), ref, ["f"])) == pytest.approx(4.6042, abs=1e-4)
    assert psi_of(dr.psi_numeric(values(spark, [None, float("nan")]), ref, ["f"])) == 0.0
    assert psi_of(dr.psi_numeric(values(spark, [1.0]), ref.where("false"), ["f"])) == 0.0


def test_psi_categorical_golden(spark):
    ref = categorical(spark, "f", {"A": 0.5, "B": 0.5})
    assert psi_of(dr.psi_categorical(values(spark, "AB", "string"), ref, ["f"])) == pytest.approx(0, abs=1e-4)
    assert psi_of(dr.psi_categorical(values(spark, "AAC", "string"), ref, ["f"])) == pytest.approx(4.6042, abs=1e-4)
    assert psi_of(dr.psi_categorical(values(spark, [None], "string"), ref, ["f"])) == 0.0
    assert psi_of(dr.psi_categorical(values(spark, "XY", "string"), ref, ["f"])) == 0.0
    assert psi_of(dr.psi_categorical(values(spark, "A", "string"), ref.where("false"), ["f"])) == 0.0


def test_outer_bins_are_open_and_empty_bins_are_listed(spark):
    ref = numeric(spark, "f", [0, 10, 20, 30], [0.25, 0.5, 0.25])
    rows = dr.bin_counts(values(spark, [-99.0, 0.0, 9.9, 20.0, 30.0, 1e9, float("inf"), None]), ref, ["f"])
    assert {r.bin_no: r.n for r in rows.collect()} == {0: 3, 1: 0, 2: 4}


def test_numbers_can_be_categories(spark):
    ref = categorical(spark, "f", {"0": 0.5, "1": 0.5})
    counts = dr.category_counts(values(spark, [0, 1, 1, 2], "int"), ref, ["f"])
    assert {r.category: r.n for r in counts.collect()} == {"0": 1, "1": 2}


def direct_psi(counts, expected, eps=1e-4):
    total = sum(counts)
    a = [max(c / total, eps) for c in counts]
    e = [max(x, eps) for x in expected]
    a, e = [x / sum(a) for x in a], [x / sum(e) for x in e]
    return sum((x - y) * math.log(x / y) for x, y in zip(a, e))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), min_size=2, max_size=6).filter(
    lambda t: sum(a for a, _ in t) and sum(b for _, b in t)))
def test_psi_equals_its_formula_and_is_symmetric(spark, pairs):
    live, past = [a for a, _ in pairs], [b for _, b in pairs]
    found = []
    for now, then in ((live, past), (past, live)):
        shares = [x / sum(then) for x in then]
        ref = numeric(spark, "f", range(len(then) + 1), shares)
        rows = [i + 0.5 for i, n in enumerate(now) for _ in range(n)]
        found.append(psi_of(dr.psi_numeric(values(spark, rows), ref, ["f"])))
        assert found[-1] == pytest.approx(direct_psi(now, shares), abs=1e-9)
    assert found[0] == pytest.approx(found[1], abs=1e-9)


def test_more_bins_than_are_unrolled(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("f"))
    ref = numeric(spark, "f", range(0, 10_001, 100), [0.01] * 100)
    counts = dr.bin_counts(df, ref, ["f"])
    assert counts.count() == 100 and counts.where("n <> 100").count() == 0


def test_a_profile_does_not_drift_from_itself(spark):
    df = spark.range(3_000).select((F.col("id") % 977).cast("double").alias("f"), (F.col("id") % 5).cast("string").alias("g"))
    profile = pr.binned_profile(df, ["f"], ["g"])
    for r in dr.stability_index(df, profile, ["f", "g"]).collect():
        assert r.psi == pytest.approx(0, abs=1e-12)


@pytest.fixture(scope="module")
def profile(spark):
    return (
        numeric(spark, "predicted_probability", [0, 0.33, 0.66, 1], [0.5, 0.3, 0.2])
        .union(numeric(spark, "feature_a", [0, 10, 20, 30], [0.25, 0.5, 0.25]))
        .union(categorical(spark, "feature_b", {"Category_1": 0.6, "Category_2": 0.4}))
    )


@pytest.fixture(scope="module")
def live(spark):
    return spark.createDataFrame(
        [("C001", 0.1, 10.5, "Category_1", 1.0), ("C002", 0.9, 20.1, "Category_2", 2.0), ("C003", 0.4, 15.0, "Category_1", 3.0)],
        "customer_unique_id string, predicted_probability double, feature_a double, feature_b string, feature_d double")


def test_drift_report_statuses(live, profile):
    rows = {r.feature: r for r in dr.drift_report(live, profile, ["feature_a", "feature_b", "feature_c", "feature_d"]).collect()}
    assert {k: (r.scope, r.status) for k, r in rows.items()} == {
        "predicted_probability": ("prediction", "CALCULATED"),
        "feature_a": ("feature", "CALCULATED"),
        "feature_b": ("feature", "CALCULATED"),
        "feature_c": ("feature", "MISSING_IN_TELEMETRY"),
        "feature_d": ("feature", "MISSING_IN_BASELINE"),
    }
    assert rows["feature_b"].psi_score == round(direct_psi([2, 1], [0.6, 0.4]), 4)
    assert rows["feature_a"].psi_score == round(direct_psi([0, 2, 1], [0.25, 0.5, 0.25]), 4)
    assert rows["feature_c"].psi_score == rows["feature_d"].psi_score == 0.0


def test_drift_of_an_empty_day(live, profile, spark):
    empty = spark.createDataFrame([], "customer_unique_id string, predicted_probability double")
    rows = dr.drift_report(empty, profile, ["feature_a"]).collect()
    assert {(r.feature, r.status, r.psi_score) for r in rows} == {
        ("predicted_probability", "EMPTY_TELEMETRY", 0.0), ("feature_a", "EMPTY_TELEMETRY", 0.0)}
    no_score = dr.drift_report(live.drop("predicted_probability"), profile, []).collect()
    assert [(r.scope, r.status) for r in no_score] == [("prediction", "MISSING_DATA")]


def test_many_days_in_one_report(live, profile, spark):
    days = live.withColumn("day", F.lit("d1")).union(live.where("customer_unique_id = 'C002'").withColumn("day", F.lit("d2")))
    runs = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "day string")
    rows = {(r.day, r.feature): r for r in dr.drift_report(days, profile, ["feature_a"], by=["day"], runs=runs).collect()}
    assert len(rows) == 6
    assert rows["d3", "feature_a"].status == "EMPTY_TELEMETRY"
    assert rows["d2", "feature_a"].psi_score == round(direct_psi([0, 0, 1], [0.25, 0.5, 0.25]), 4)
    alone = dr.drift_report(live, profile, ["feature_a"]).where("feature = 'feature_a'").first()
    assert rows["d1", "feature_a"].psi_score == alone.psi_score


def test_broken_profile_is_an_error_and_not_a_zero(live, spark):
    bad = numeric(spark, "feature_a", [0, 10, 20, 30], [float("nan"), 0.5, 0.25])
    rows = dr.drift_report(live, bad, ["feature_a"]).where("scope = 'feature'").first()
    assert (rows.status, rows.psi_score) == ("ERROR", 0.0)


def test_top_features(spark):
    rows = [("a", 0.45), ("b", 0.35), ("c", 0.10), (None, 0.40), ("e", None), ("f", 0.01)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    assert dr.monitored_features(table, 3) == ["a", "b"]
    assert dr.monitored_features(table, 5) == ["a", "b", "c", "f"]
    assert dr.monitored_features(table, 6)[-1] == "e"
    with pytest.raises(ValueError):
        dr.monitored_features(table.where("false"))
    weights = dr.fallback_importance(["customer_unique_id", "x", "predicted_probability", "y"], spark).collect()
    assert [tuple(r) for r in weights] == [("x", 1.0), ("y", 0.5)]


# --- decision ---


def judged(spark, prediction=0.0, features=(), brier=0.10, evaluated=True, baseline=0.10, reason=None, **limits):
    keys = ("m", "d")
    rows = [(*keys, "prediction", "p", prediction, "CALCULATED")]
    rows += [(*keys, "feature", f"f{i}", float(v), "CALCULATED") for i, v in enumerate(features)]
    head = "model_run_id string, execution_date string, "
    drift = spark.createDataFrame(rows, head + "scope string, feature string, psi_score double, status string")
    perf = spark.createDataFrame([(*keys, evaluated, reason, brier)],
                                 head + "is_evaluated boolean, reason string, brier_score double")
    base = spark.createDataFrame([("m", baseline)], "model_run_id string, brier_score double")
    return dec.judged(drift, perf, base, **limits)


@pytest.mark.parametrize("psi, hit", [(0.15, False), (0.20, True), (0.25, True)])
def test_rule_1(spark, psi, hit):
    row = dec.decision(judged(spark, prediction=psi)).first()
    assert (row.need_update, row.trigger_reasons) == (hit, "CRITICAL_PREDICTION_DRIFT" if hit else "NONE")


@pytest.mark.parametrize("psis, hit", [((0.10, 0.15), False), ((0.25, 0.15), False), ((0.25, 0.25), True)])
def test_rule_2(spark, psis, hit):
    rows = {r.rule: r for r in dec.rule_evaluations(judged(spark, features=psis)).collect()}
    assert rows[2].is_triggered is hit and rows[2].severity_level == ("CRITICAL" if hit else "INFO")
    assert rows[2].note == ("f0,f1" if hit else ("f0" if psis[0] >= 0.2 else ""))


@pytest.mark.parametrize("brier, hit", [(0.11, True), (0.10, False), (0.10 * 1.05, False)])
def test_rule_3(spark, brier, hit):
    rows = {r.rule: r for r in dec.rule_evaluations(judged(spark, brier=brier)).collect()}
    assert rows[3].is_triggered is hit and rows[3].threshold == pytest.approx(0.105)


def test_rule_3_is_skipped_or_stops(spark):
    rows = {r.rule: r for r in dec.rule_evaluations(judged(spark, brier=0.9, evaluated=False, reason="ALL_NAN_EVALUATION_COLUMNS")).collect()}
    assert not rows[3].is_triggered and rows[3].note == "ALL_NAN_EVALUATION_COLUMNS" and rows[3].actual_value is None
    with pytest.raises(Exception, match="Brier score missing"):
        dec.decision(judged(spark, baseline=None)).collect()


def test_reasons_keep_their_order(spark):
    row = dec.decision(judged(spark, 0.3, (0.3, 0.4), 0.2)).first()
    assert row.trigger_reasons == "CRITICAL_PREDICTION_DRIFT | CRITICAL_FEATURE_DRIFT | SEVERE_PERFORMANCE_DEGRADATION"
    assert row.need_update is True


def test_many_models_and_days_are_decided_in_one_job(spark):
    head = "model_run_id string, execution_date string, "
    keys = [("m1", "d1"), ("m1", "d2"), ("m2", "d1")]
    scores = {("m1", "d1"): 0.25, ("m1", "d2"): 0.05, ("m2", "d1"): 0.05}
    drift = spark.createDataFrame([(*k, "prediction", "p", v, "CALCULATED") for k, v in scores.items()],
                                  head + "scope string, feature string, psi_score double, status string")
    perf = spark.createDataFrame([("m1", "d1", True, None, 0.1), ("m2", "d1", True, None, 0.3)],
                                 head + "is_evaluated boolean, reason string, brier_score double")
    base = spark.createDataFrame([("m1", 0.1), ("m2", 0.2)], "model_run_id string, brier_score double")
    rows = {(r.model_run_id, r.execution_date): r.trigger_reasons for r in dec.decision(dec.judged(drift, perf, base)).collect()}
    assert rows == dict(zip(keys, ["CRITICAL_PREDICTION_DRIFT", "NONE", "SEVERE_PERFORMANCE_DEGRADATION"]))
