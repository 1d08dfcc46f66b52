"""What scoring hands on: the business report, its summary and the telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions.values import exact_cents, round_half_up
from ebbline.names import KEY, PREDICTION
from ebbline.operators.metrics import known_score


def check_threshold(threshold: float) -> None:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError(f"probability threshold {threshold} is not between 0 and 1")


def risk_flag(threshold: float = 0.5, p: str = PREDICTION) -> Column:
    """1 at or above the threshold; 0 below it and for a missing probability."""
    check_threshold(threshold)
    return F.coalesce(known_score(p) >= threshold, F.lit(False)).cast("int")


def money_column(columns: list[str]) -> str | None:
    """The first column whose name speaks of money."""
    return next((c for c in columns if "monetary" in c.lower() or "value" in c.lower()), None)


def scored_customers(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Id, probability, flag and, where a money column exists, revenue at risk."""
    columns = [
        F.col(KEY),
        known_score(PREDICTION).alias("churn_probability"),
        risk_flag(threshold).alias("is_churn_risk"),
    ]
    money = money_column(scored.columns)
    if money:
        at_risk = round_half_up(known_score(PREDICTION) * F.col(money), 2)
        columns.append(at_risk.alias("revenue_at_risk"))
    return scored.select(*columns)


def business_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Scored customers, most revenue (else probability) at risk first.

    Ties are broken by id, which also lets the range partitioning of the sort
    cut through many customers of equal value.
    """
    report = scored_customers(scored, threshold)
    rank = "revenue_at_risk" if "revenue_at_risk" in report.columns else "churn_probability"
    return report.orderBy(F.desc_nulls_last(rank), KEY)


def impact_summary(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Customers scored and flagged, and the revenue at risk over all of them."""
    report = scored_customers(scored, threshold)
    total = (
        F.sum(exact_cents(F.col("revenue_at_risk"))).cast("double")
        if "revenue_at_risk" in report.columns
        else F.lit(None).cast("double")
    )
    return report.agg(
        F.count(F.lit(1)).alias("total_customers_scored"),
        F.coalesce(F.sum("is_churn_risk"), F.lit(0)).alias("total_churners_flagged"),
        total.alias("total_revenue_at_risk_flagged"),
    )


def telemetry_log(scored: DataFrame, run_id: str, threshold: float = 0.5) -> DataFrame:
    """The whole feature matrix with the run, the probability and the flag."""
    return scored.withColumns(
        {"inference_run_id": F.lit(run_id), "is_churn_risk": risk_flag(threshold)}
    )
