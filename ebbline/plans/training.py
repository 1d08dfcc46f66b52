"""From the lake to a training table, and from the table to an approved model."""

from __future__ import annotations

import logging
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.stamps import within_days
from ebbline.names import PREDICTION
from ebbline.operators import gates, metrics, models, prep, profiles
from ebbline.operators.labels import training_table
from ebbline.session import store
from ebbline.sources.lake import read_table, require_datasets, write_run_table

log = logging.getLogger(__name__)
DATASETS = ("orders", "customers", "order_payments")


class TableRun(NamedTuple):
    path: str
    fingerprint: DataFrame
    warnings: list


def lake_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, base, name) for name in DATASETS}


def build_training_table(
    spark: SparkSession,
    lake: str,
    start: str,
    end: str,
    feature_store: str,
    run_id: str,
    policy: gates.GatePolicy = gates.GatePolicy(),
    window_days: int = 180,
    **options,
) -> TableRun:
    """Check the lake, join features and labels, write them under the run.

    A missing table or a broken gate stops the run before anything is written.
    """
    require_datasets(spark, lake, DATASETS, start, end)
    tables = lake_tables(spark, lake)
    warnings = gates.enforce_gates(tables, start, end, policy)
    warnings += gates.censoring_warning(tables["orders"], end, window_days).collect()
    known = within_days(tables["customers"], start, end)
    warnings += gates.repeated_keys_warning(known).collect()
    for row in warnings:
        log.warning("%s", row.message)
    table = training_table(
        tables["orders"], tables["customers"], tables["order_payments"], start, end,
        window_days=window_days, sides_by_order_day=True, **options,
    )
    path = write_run_table(table, feature_store, run_id)
    return TableRun(path, gates.fingerprint(spark.read.parquet(path), start, end), warnings)


class TrainedRun(NamedTuple):
    kinds: prep.FeatureKinds
    model: models.CalibratedModel
    trials: list
    metrics: DataFrame
    profile: DataFrame
    importance: DataFrame
    contract: DataFrame
    sizes: DataFrame


def train_run(
    table: DataFrame,
    model_name: str,
    n_trials: int = models.N_TRIALS,
    folds: int = models.CALIBRATION_FOLDS,
    seed: int = 42,
    space: dict = models.SEARCH_SPACE,
    n_bins: int = 10,
) -> TrainedRun:
    """Split, tune on validation, calibrate on train, measure on test, profile train.

    The split table and its vectors are stored once; every fit reads them again.
    """
    kinds = prep.feature_kinds(prep.drop_system_columns(table))
    rows = store(prep.hash_split(table, seed=seed))
    parts = {s: rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
    encoder = models.fit_encoder(parts["train"], kinds)
    vectors = models.stored_split(encoder, rows)
    train = vectors.where(F.col("split") == "train").drop("split")
    val = vectors.where(F.col("split") == "val").drop("split")
    trials = models.tune(train, val, n_trials, seed, space=space)
    best = trials[0].params
    base = models.train_model(train, best, seed=seed)
    model = models.calibrate(encoder, train, best, folds, seed=seed)
    scored = models.score(model, parts["test"]).withColumn("model", F.lit(model_name))
    scored_train = store(models.score(model, parts["train"]))
    return TrainedRun(
        kinds,
        model,
        trials,
        metrics.model_metrics(scored),
        profiles.binned_profile(
            scored_train, [*kinds.numerical, PREDICTION], kinds.categorical, n_bins
        ),
        store(models.mean_contributions(base, train, kinds)),
        prep.schema_contract(parts["train"], kinds),
        prep.split_sizes(rows),
    )


def save_run(run: TrainedRun, path: str) -> None:
    """Write the model and its frozen tables; later jobs only read them."""
    run.model.save(f"{path}/model")
    for name in ("metrics", "profile", "importance", "contract", "sizes"):
        getattr(run, name).write.mode("overwrite").parquet(f"{path}/{name}")


class SavedRun(NamedTuple):
    """A finished run as its files have it."""

    kinds: prep.FeatureKinds
    model: models.CalibratedModel
    metrics: DataFrame
    profile: DataFrame
    importance: DataFrame
    contract: DataFrame


def load_run(spark: SparkSession, path: str) -> SavedRun:
    """The model with all its folds, its tables, and the kinds of its features.

    The kinds are the frozen contract's; a categorical feature without a single
    value in training is known from the importances alone.
    """
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in ("metrics", "profile", "importance", "contract")}
    kind_of = tables["contract"].select("feature", "kind").distinct()
    named = tables["importance"].select("feature").join(kind_of, "feature", "left").orderBy("feature").collect()
    kinds = prep.FeatureKinds(
        [r.feature for r in named if r.kind == "numerical"], [r.feature for r in named if r.kind != "numerical"]
    )
    return SavedRun(kinds, models.load_calibrated(f"{path}/model"), *tables.values())


def settle(challenger: DataFrame, champion: DataFrame | None, model_key: str = "segment") -> DataFrame:
    """Duel of two one-row metric tables that share ``model_key``."""
    held = champion if champion is not None else challenger.where(F.lit(False))
    return metrics.duel(challenger, held, keys=[model_key])


class Duel(NamedTuple):
    approved: bool
    settled: DataFrame
    baseline: DataFrame


def duel_run(
    table: DataFrame,
    challenger: models.CalibratedModel,
    champion: models.CalibratedModel | None,
    out: str,
    model_run_id: str,
    seed: int = 42,
) -> Duel:
    """Score both models on the same test rows, settle the duel, write the baseline.

    The baseline holds the test metrics of whichever model serves from now on,
    under ``model_run_id``; without an approved challenger or a champion it is empty.
    """
    test = store(prep.hash_split(table, seed=seed).where(F.col("split") == "test").drop("split"))
    rivals = {"challenger": challenger, "champion": champion}
    scored = [
        models.score(model, test).withColumn("model", F.lit(name)) for name, model in rivals.items() if model is not None
    ]
    measured = store(metrics.model_metrics(reduce(DataFrame.unionByName, scored)))
    by_name = {n: measured.where(F.col("model") == n).withColumn("segment", F.lit("all")) for n in rivals}
    settled = store(settle(by_name["challenger"], by_name["champion"]))
    record = metrics.baseline_record(settled).withColumn("model_run_id", F.lit(model_run_id))
    record.write.mode("overwrite").parquet(f"{out}/baseline")
    approved = bool(settled.first().is_approved)
    return Duel(approved, settled, table.sparkSession.read.parquet(f"{out}/baseline"))
