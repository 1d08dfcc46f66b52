"""Score one day: features as of the cutoff, contract check, report and telemetry."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ebbline.names import KEY
from ebbline.operators import gates, models, prep, reports
from ebbline.operators.features import feature_matrix
from ebbline.plans.training import lake_tables
from ebbline.session import store
from ebbline.sources.commits import day_is_complete, publish_day

# Fixed value: scoring looks at everything since the first day of business.
SCORING_START = "2015-01-01"
SYSTEM_COLUMNS = (KEY, "snapshot_date")


class ScoredDay(NamedTuple):
    published: bool
    impact: dict | None


def score_day(
    spark: SparkSession,
    lake: str,
    model: models.CalibratedModel,
    kinds: prep.FeatureKinds,
    cutoff: str,
    out: str,
    run_id: str,
    start: str = SCORING_START,
    threshold: float = 0.5,
    rerun: bool = False,
    contract: DataFrame | None = None,
) -> ScoredDay:
    """Publish the report and the telemetry of the day of ``cutoff``.

    The scored table feeds two outputs and a summary, so it is stored once. A
    matrix that breaks the contract or is empty halts the run. With the frozen
    ``contract`` of the training run the matrix is first brought to the trained
    schema, so what was never seen in training is unknown to the model. A day
    published before is left alone unless ``rerun`` is set.
    """
    if not rerun and day_is_complete(spark, f"{out}/telemetry", cutoff):
        return ScoredDay(False, None)
    tables = lake_tables(spark, lake)
    matrix = feature_matrix(
        tables["orders"], tables["customers"], tables["order_payments"], start, cutoff
    )
    gates.require_contract(matrix, kinds.names, SYSTEM_COLUMNS)
    if contract is not None:
        categories = contract.where("kind = 'categorical'").select("feature", "category")
        others = [c for c in matrix.columns if c not in kinds.names]
        matrix = prep.enforce_schema(matrix, kinds, categories, others)
    scored = store(models.score(model, matrix))
    gates.require_rows(scored)
    outputs: dict[str, DataFrame] = {
        "telemetry": reports.telemetry_log(scored, run_id, threshold),
        "business_report": reports.business_report(scored, threshold),
    }
    publish_day(outputs, out, cutoff, kinds={"business_report": "csv"}, rerun=True)
    return ScoredDay(True, reports.impact_summary(scored, threshold).first().asDict())
