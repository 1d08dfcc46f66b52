"""Counts of days add up to the counts, and the index, of a window."""

import pytest
from pyspark.sql import functions as F

from ebbline.operators import drift, drift_state
from ebbline.operators.profiles import binned_profile
from ebbline.sources.commits import read_days

DAYS = [f"2023-06-{d:02d}" for d in range(1, 6)]


@pytest.fixture(scope="module")
def live(spark):
    return spark.range(600).select(
        (F.col("id") % 5).cast("int").alias("nth"),
        F.when(F.col("id") % 11 > 0, F.sqrt(F.col("id").cast("double"))).alias("x"),
        F.concat(F.lit("s"), F.col("id") % 7).alias("shop"),
    )


@pytest.fixture(scope="module")
def counted(spark, live, tmp_path_factory):
    """Four of five days, one of them published twice, first with other rows."""
    table = str(tmp_path_factory.mktemp("state") / "cells")
    profile = binned_profile(live.where("x < 15"), ["x"], ["shop"], 4).cache()
    for k in (0, 1, 2, 4):
        day = live.where(F.col("nth") == k)
        if k == 1:
            assert drift_state.publish_counts(day.limit(9), profile, ["x", "shop"], table, DAYS[k])
            assert not drift_state.publish_counts(day, profile, ["x", "shop"], table, DAYS[k])
        assert drift_state.publish_counts(day, profile, ["x", "shop"], table, DAYS[k], rerun=True)
    return table, profile


@pytest.mark.parametrize("width", [1, 3, 30])
def test_windows_equal_counting_their_rows(spark, live, counted, width):
    table, profile = counted
    found = {(str(r.window_end), r.feature): r.psi for r in drift_state.window_stability(spark, table, profile, ["x", "shop"], DAYS, width).collect()}
    want = {}
    for k, end in enumerate(DAYS):
        rows = live.where(F.col("nth").isin([j for j in range(max(0, k - width + 1), k + 1) if j != 3]))
        for r in drift.stability_index(rows, profile, ["x", "shop"]).collect():
            want[end, r.feature] = pytest.approx(r.psi)
    assert found == want and len(found) == (8 if width == 1 else 10)


def test_what_a_day_leaves_is_bounded(spark, counted):
    table, profile = counted
    assert read_days(spark, table).groupBy("day").count().agg(F.max("count")).first()[0] <= profile.count() + 1


def test_no_telemetry(spark, live, counted):
    _, profile = counted
    none = drift_state.day_counts(live.limit(0), profile, ["x", "shop"])
    assert none.count() == 0
    dated = none.withColumns({"year": F.lit(2023), "month": F.lit(6), "day": F.lit(1)})
    assert drift_state.window_counts(dated, DAYS, 3).count() == 0
