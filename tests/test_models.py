"""Model jobs and the whole way from the lake to a decision."""

import inspect
import math

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ebbline.operators import models as md
from ebbline.operators import prep
from ebbline.operators.features import feature_matrix
from ebbline.operators.gates import GateError
from ebbline.operators.labels import labelled_features
from ebbline.plans.monitoring import watch_day
from ebbline.plans.scoring import score_day
from ebbline.plans.training import build_training_table, duel_run, load_run, save_run, settle, train_run
from ebbline.sources import lake
from ebbline.sources.star import commerce

SPACE = dict(md.SEARCH_SPACE, n_estimators=(5, 10, 5), max_depth=(2, 3))


def test_draws_are_seeded_and_inside_the_space():
    draws = md.sample_params(50, seed=3)
    assert draws == md.sample_params(50, seed=3) and draws != md.sample_params(50, seed=4)
    assert {d.maxIter % 100 for d in draws} == {0} and all(100 <= d.maxIter <= 800 for d in draws)
    assert all(0.01 <= d.stepSize <= 0.2 and 3 <= d.maxDepth <= 9 and 1 <= d.minInstancesPerNode <= 10 for d in draws)
    assert all(0.6 <= d.subsamplingRate <= 1 and 0.6 <= float(d.featureSubsetStrategy) <= 1 for d in draws)


def test_hash_sample_is_bounded_and_repeatable(spark):
    people = spark.range(500).withColumnRenamed("id", "customer_unique_id")
    once = {r[0] for r in md.hash_sample(people, 40).collect()}
    assert len(once) == 40 and once == {r[0] for r in md.hash_sample(people.repartition(9), 40).collect()}
    assert md.hash_sample(people, 1_000).count() == 500
    draw = md.unit_hash("sample-42", F.col("customer_unique_id"))
    assert once == {r[0] for r in people.orderBy(draw).limit(40).collect()}


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Orders from 1999 on as a lake."""
    folder = str(tmp_path_factory.mktemp("lake"))
    tables = commerce(spark, SMALL)
    orders = tables.orders.where("year >= 1999")
    lake.write_lake(orders, tables.customers, tables.payments, folder)
    return folder


@pytest.fixture(scope="module")
def trained(spark, base, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("store"))
    built = build_training_table(spark, base, "1999-01-01", "2000-07-01", store, "run-1")
    row = built.fingerprint.first()
    table = spark.read.parquet(built.path)
    assert row.row_count == table.count() > 0 and built.warnings == []
    run = train_run(table, "challenger", n_trials=2, folds=2, space=SPACE)
    save_run(run, f"{store}/model-1")
    return run, f"{store}/model-1"


def test_training_run(spark, trained):
    run, path = trained
    assert [t.log_loss for t in run.trials] == sorted(t.log_loss for t in run.trials)
    assert all(t.params.maxIter <= t.asked and t.log_loss == t.curve[t.params.maxIter - 1] for t in run.trials)
    row = run.metrics.first()
    assert all(math.isfinite(row[m]) for m in ("log_loss", "brier_score", "eroi", "optimal_threshold"))
    assert run.kinds.categorical == ["customer_state"] and len(run.kinds.numerical) == 8
    features = {r.feature for r in spark.read.parquet(f"{path}/profile").collect()}
    assert features == {*run.kinds.names, "predicted_probability"}
    assert spark.read.parquet(f"{path}/importance").count() == 9
    assert sum(r.n_rows for r in spark.read.parquet(f"{path}/sizes").collect()) > 0


def test_a_saved_model_scores_alike(spark, trained, base):
    run, path = trained
    tables = [lake.read_table(spark, base, n) for n in ("orders", "customers", "order_payments")]
    matrix = feature_matrix(*tables, "1999-01-01", "2000-09-01")
    loaded = md.load_calibrated(f"{path}/model")
    key, p = "customer_unique_id", "predicted_probability"
    ours = {r[key]: r[p] for r in md.score(run.model, matrix).collect()}
    theirs = {r[key]: r[p] for r in md.score(loaded, matrix).collect()}
    assert ours == theirs and all(0 <= v <= 1 for v in ours.values())


def test_from_lake_to_decision(spark, trained, base, tmp_path):
    run, path = trained
    out = str(tmp_path)
    day, then = "2001-03-01", "2000-09-02"
    saved = load_run(spark, path)
    assert set(saved.kinds.names) == set(run.kinds.names) and len(saved.model.folds) == 2
    for cutoff in (then, day):
        done = score_day(spark, base, saved.model, saved.kinds, cutoff, out, f"score-{cutoff}", start="1999-01-01",
                         contract=saved.contract)
        assert done.published and done.impact["total_customers_scored"] > 0
    again = score_day(spark, base, run.model, run.kinds, day, out, "again", start="1999-01-01")
    assert not again.published
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in ("profile", "importance", "metrics")}
    baseline = tables["metrics"].select(F.lit("m1").alias("model_run_id"), "brier_score")
    seen = watch_day(spark, base, f"{out}/telemetry", day, "m1", tables["profile"], tables["importance"],
                     baseline, evaluations_out=f"{out}/evaluations")
    assert (seen.current_status, seen.lookback_status) == ("CURRENT_TELEMETRY_RESOLVED", "MATURED_EVALUATION_READY")
    report = seen.drift.collect()
    assert len(report) == 6 and {r.status for r in report} == {"CALCULATED"}
    assert seen.performance.first().is_evaluated
    row = seen.decision.first()
    assert row.need_update == (row.trigger_reasons != "NONE")
    assert spark.read.parquet(f"{out}/evaluations").columns[:3] == [
        "customer_unique_id", "predicted_probability", "target_is_churn"]
    quiet = watch_day(spark, base, f"{out}/telemetry", "2001-03-05", "m1", tables["profile"], None,
                      baseline)
    assert (quiet.current_status, quiet.lookback_status) == ("SKIPPED_ZERO_TRAFFIC_DAY", "SKIPPED_SYSTEM_IMMATURE")
    assert {r.status for r in quiet.drift.collect()} == {"EMPTY_TELEMETRY"}
    row = quiet.decision.first()
    assert (row.need_update, row.trigger_reasons) == (False, "NONE")


def test_broken_contract_halts_scoring(spark, trained, base, tmp_path):
    run, _ = trained
    kinds = prep.FeatureKinds([*run.kinds.numerical, "no_such_feature"], run.kinds.categorical)
    with pytest.raises(GateError, match="no_such_feature"):
        score_day(spark, base, run.model, kinds, "2000-09-02", str(tmp_path), "r", start="1999-01-01")


def test_an_absent_table_halts_the_build(spark, base, tmp_path):
    with pytest.raises(FileNotFoundError):
        build_training_table(spark, f"{base}/nowhere", "1999-01-01", "2000-07-01", str(tmp_path), "r")
    assert not (tmp_path / "r").exists()


def test_champion_on_the_same_rows(spark, trained, base, tmp_path):
    """A challenger equal to the champion is not promoted, and the champion's metrics stay the baseline."""
    run, path = trained
    tables = [lake.read_table(spark, base, n) for n in ("orders", "customers", "order_payments")]
    table = labelled_features(*tables, "1999-01-01", "2000-07-01")
    first = duel_run(table, run.model, None, str(tmp_path / "first"), "m1")
    assert first.settled.first().has_champion is False
    assert first.approved == (first.settled.first().eroi >= 0.05)
    champion = load_run(spark, path).model
    again = duel_run(table, run.model, champion, str(tmp_path / "again"), "m2")
    row = again.settled.first()
    assert not again.approved and row.has_champion and row.eroi == row.champion_eroi
    assert again.baseline.first().model_run_id == "m2"
    mine = run.metrics.first()
    assert again.baseline.first().brier_score == pytest.approx(mine.brier_score)


def test_places_are_a_permutation(spark):
    people = spark.range(3000).withColumnRenamed("id", "customer_unique_id")
    places = {r.place: r.customer_unique_id for r in md.shuffled_places(people, "x").collect()}
    assert sorted(places) == list(range(1, 3001))
    again = {r.place: r.customer_unique_id for r in md.shuffled_places(people.repartition(7), "x").collect()}
    assert places == again != {r.place: r.customer_unique_id for r in md.shuffled_places(people, "y").collect()}


def test_duel_of_runs(trained):
    run, _ = trained
    mine = run.metrics.withColumnRenamed("model", "segment")
    assert settle(mine, None).first().has_champion is False
    assert settle(mine, mine).first().is_approved is False


def test_catalog_runs_the_default_budgets(spark, monkeypatch):
    """The registered model queries pass no budget of their own to the jobs."""
    from ebbline.catalog import queries as q

    class Asked(Exception):
        pass

    asked = {}

    def job(name, *names):
        real = inspect.signature(getattr(md, name))

        def run(*args, **kwargs):
            bound = real.bind(*args, **kwargs)
            bound.apply_defaults()
            asked[name] = tuple(bound.arguments[n] for n in names)
            raise Asked

        return run

    monkeypatch.setattr(q, "_split", lambda c: spark.range(1).withColumn("split", F.lit("train")))
    monkeypatch.setattr(q, "store", lambda df: df)
    monkeypatch.setattr(md, "fit_encoder", lambda *_: None)
    monkeypatch.setattr(md, "encoded_split", lambda encoder, rows: rows)
    jobs = {"tune": ("n_trials", "space"), "train_model": ("params",), "calibrate": ("params", "folds")}
    made = {name: job(name, *names) for name, names in jobs.items()}
    for name, run in made.items():
        monkeypatch.setattr(md, name, run)
    for name, of in {"tuned_model": "tune", "trained_scores": "train_model", "calibrated_scores": "calibrate", "permutation_importance": "train_model", "mean_contributions": "train_model"}.items():
        asked.clear()
        with pytest.raises(Asked):
            getattr(q, name)(spark, None)
        want = {"tune": (30, md.SEARCH_SPACE), "train_model": (md.TreeParams(),), "calibrate": (md.TreeParams(), 5)}
        assert asked == {of: want[of]}


def test_vectors_of_a_split_are_dealt_evenly(spark, monkeypatch):
    """Rows that lie in one partition keep as many tasks busy as there are cores."""
    monkeypatch.setattr(md, "FIT_ROWS", 50)
    rows = spark.range(0, 1000, 1, 1).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS customer_unique_id", "id % 3 = 0 AS is_churned", "CAST(id AS DOUBLE) AS x",
        "CASE WHEN id % 10 < 8 THEN 'train' ELSE 'val' END AS split",
    ).withColumnRenamed("is_churned", md.TARGET)
    rows = md.store(rows)
    encoder = md.fit_encoder(rows.where("split = 'train'"), prep.FeatureKinds(["x"], []))
    stored = md.stored_split(encoder, rows)
    sizes = [n for n in stored.where("split = 'train'").rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect() if n]
    assert len(sizes) == 8 and max(sizes) < 120
    plain = md.encoded_split(encoder, rows)
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
