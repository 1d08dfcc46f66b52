"""Watch one day: drift of today's scores, performance of matured ones, the decision."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.names import KEY, PREDICTION
from ebbline.operators import decision as rules
from ebbline.operators import drift, performance
from ebbline.operators.labels import future_targets
from ebbline.plans.training import lake_tables
from ebbline.session import pin
from ebbline.sources.commits import publish_day
from ebbline.sources.telemetry import MATURED, current_telemetry, lookback_day, lookback_telemetry


class Watch(NamedTuple):
    current_status: str
    lookback_status: str
    drift: DataFrame
    performance: DataFrame
    evaluations: DataFrame
    decision: DataFrame


def watch_day(
    spark: SparkSession,
    lake: str,
    telemetry: str,
    day: str,
    model_run_id: str,
    profile: DataFrame,
    importance: DataFrame | None,
    baseline: DataFrame,
    lookback_days: int = 180,
    window_days: int = 180,
    top_k: int = 5,
    evaluations_out: str | None = None,
    **limits,
) -> Watch:
    """Tables in, tables out; a day without traffic or without a look-back still ends
    in a decision. ``baseline`` holds the Brier score of the model's test set."""
    tables = lake_tables(spark, lake)
    then = lookback_day(day, lookback_days)
    targets = future_targets(
        tables["orders"], tables["customers"], tables["order_payments"], then, window_days,
        sides_by_order_day=True,
    )
    today = current_telemetry(spark, telemetry, day)
    past = lookback_telemetry(spark, telemetry, day, targets, lookback_days, window_days)
    if importance is None:
        names = sorted(r.feature for r in profile.select("feature").distinct().collect())
        importance = drift.fallback_importance(names, spark)
    keyed = {"model_run_id": F.lit(model_run_id), "execution_date": F.lit(day)}
    runs = spark.createDataFrame([(model_run_id, day)], "model_run_id string, execution_date string")
    # Both reports are finished tables: they are read by the rules and by people.
    report = pin(
        drift.drift_report(
            today.scores.withColumns(keyed),
            profile,
            drift.monitored_features(importance, top_k),
            by=rules.KEYS,
            runs=runs,
        )
    )
    evaluation = performance.evaluation_join(
        past.scores.select(KEY, PREDICTION), past.labels
    )
    if evaluations_out and past.status == MATURED:
        base, _, name = evaluations_out.rpartition("/")
        publish_day({name: evaluation}, base, day, rerun=True)
    measured = pin(performance.performance_report(evaluation).withColumns(keyed))
    judged = rules.judged(report, measured, baseline, **limits)
    return Watch(
        today.status, past.status, report, measured, rules.rule_evaluations(judged), rules.decision(judged)
    )
