"""Split, contract and profiles."""

import math
import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ebbline.operators import prep
from ebbline.operators import profiles as pr
from ebbline.operators.features import feature_matrix
from ebbline.operators.prep import FeatureKinds
from ebbline.sources.star import commerce


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(y, f"c{i + 1}", "2023-01-01", "now", 10.0 * (i + 1), 1.1 * (i + 1), s)
            for i, (y, s) in enumerate(zip([1, 0, 1, 0, 1], "ABACB"))]
    return spark.createDataFrame(
        rows, "target_is_churn int, customer_unique_id string, snapshot_date string, ingested_at_utc string, "
        "target_180d_ltv double, numerical_feat double, categorical_feat string")


def test_feature_set(frame):
    features = prep.drop_system_columns(frame)
    assert features.columns == ["numerical_feat", "categorical_feat"]
    assert prep.feature_kinds(features) == (["numerical_feat"], ["categorical_feat"])
    with pytest.raises(KeyError):
        prep.drop_system_columns(frame.drop("target_is_churn"))


def test_split_is_exhaustive_stable_and_near_its_shares(spark):
    people = spark.range(20_000).withColumnRenamed("id", "customer_unique_id")
    split = prep.hash_split(people)
    n = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(n.values()) == 20_000 and set(n) == {"train", "val", "test"}
    assert abs(n["train"] / 20_000 - 0.70) < 0.02 and abs(n["test"] / 20_000 - 0.15) < 0.02
    again = prep.hash_split(people.repartition(13)).withColumnRenamed("split", "other")
    assert split.join(again, "customer_unique_id").where("split <> other").count() == 0
    assert split.join(prep.hash_split(people, seed=7).withColumnRenamed("split", "other"),
                      "customer_unique_id").where("split <> other").count() > 0


def test_contract_is_long_and_without_null(spark, frame):
    more = frame.union(frame.limit(1).withColumn("categorical_feat", F.lit(None).cast("string")))
    lists = prep.category_contract(more, ["categorical_feat", "absent"])
    assert sorted(tuple(r) for r in lists.collect()) == [("categorical_feat", c) for c in "ABC"]
    assert prep.category_contract(more, ["absent"]).count() == 0
    contract = prep.schema_contract(more, FeatureKinds(["numerical_feat"], ["categorical_feat"]))
    assert contract.where("kind = 'numerical'").count() == 1 and contract.count() == 4


def test_enforced_schema(spark):
    kinds = FeatureKinds(["num", "gone"], ["state", "lost"])
    lists = spark.createDataFrame(
        [("state", "SP"), ("state", "RJ"), ("lost", "x")], "feature string, category string")
    rows = spark.createDataFrame(
        [("a", "1.5", "SP"), ("b", "oops", "ZZ"), ("c", None, None), ("d", "NaN", "RJ")],
        "id string, num string, state string").withColumn("extra", F.lit(1))
    out = prep.enforce_schema(rows, kinds, lists, keep=["id"])
    assert out.dtypes == [("id", "string"), ("num", "double"), ("gone", "double"), ("state", "string"), ("lost", "string")]
    assert sorted(tuple(r) for r in out.collect()) == [
        ("a", 1.5, None, "SP", None), ("b", None, None, None, None),
        ("c", None, None, None, None), ("d", None, None, "RJ", None)]
    once = {tuple(r) for r in out.collect()}
    assert {tuple(r) for r in prep.enforce_schema(out, kinds, lists, ["id"]).collect()} == once


def test_profiles_golden(spark):
    df = spark.createDataFrame(list(zip([1.0, 2.0, 3.0, 4.0, 5.0], "ABAAC")), "num_feat double, cat_feat string")
    row = pr.numeric_profile(df, ["num_feat"]).first()
    assert (row.mean, row.missing_rate, row.min, row.max) == (3.0, 0.0, 1.0, 5.0)
    assert abs(row.std - 1.5811) < 1e-4
    shares = {r.category: (r.frequency, r.missing_rate) for r in pr.categorical_profile(df, ["cat_feat"]).collect()}
    assert shares == {"A": (0.6, 0.0), "B": (0.2, 0.0), "C": (0.2, 0.0)}


def test_profiles_with_missing_values(spark):
    df = spark.createDataFrame([(1.0, "A"), (float("nan"), None), (None, "A"), (3.0, "B")], "n double, c string")
    row = pr.numeric_profile(df, ["n"]).first()
    assert (row.mean, row.max, row.missing_rate) == (2.0, 3.0, 0.5)
    shares = {r.category: (round(r.frequency, 4), r.missing_rate) for r in pr.categorical_profile(df, ["c"]).collect()}
    assert shares == {"A": (0.6667, 0.25), "B": (0.3333, 0.25)}


def test_bins_cover_everything_once(spark):
    tables = commerce(spark, SMALL)
    df = feature_matrix(*tables, "1996-01-01", "2000-01-01").withColumn("flat", F.lit(7))
    names = ["recency_days", "monetary_total", "max_delivery_delay_days", "has_undelivered_order", "flat"]
    bins = pr.numeric_bins(df, names).toPandas()
    rows = df.toPandas()
    for name in names:
        part = bins[bins.feature == name].sort_values("bin_no")
        assert list(part.bin_no) == list(range(len(part)))
        assert abs(part.expected_pct.sum() - 1) < 1e-12
        edges = [float("-inf"), *part.lo[1:], float("inf")]
        values = rows[name].dropna().to_numpy(dtype=float)
        shares = [((values >= a) & (values < b)).mean() for a, b in zip(edges, edges[1:])]
        assert list(part.expected_pct) == pytest.approx(shares)
    assert len(bins[bins.feature == "flat"]) == 1


def test_a_value_held_by_a_third_of_all_rows(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    bins = pr.numeric_bins(df, ["v"]).toPandas()
    assert abs(bins.expected_pct.sum() - 1) < 1e-12 and bins.lo.is_unique


def test_quantiles_are_exact_at_any_size(spark):
    """Far more rows than the summary that guides the search tells apart."""
    n = 120_000
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(1_000_000_007)).cast("double").alias("spread"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("heavy"),
        F.when(F.col("id") < 5, F.lit(float("nan"))).when(F.col("id") < 9, 1.5).alias("few"),
    )
    found = {r.feature: r.quantiles for r in pr.quantiles(df, df.columns, [i / 10 for i in range(11)]).collect()}
    frame = df.toPandas()
    for name in df.columns:
        values = sorted(v for v in frame[name] if v == v)
        want = [values[max(1, -(-i * len(values) // 10)) - 1] for i in range(11)]
        assert found[name] == want


@pytest.mark.parametrize(("held", "cells"), [(40, 4), (7, 16), (10**6, 256)])
def test_quantiles_put_few_values_in_order(spark, held, cells):
    """Cells are cut until each holds few values; what comes out does not depend on it."""
    draw = random.Random(11)
    xs = [draw.choice([draw.gauss(0, 1), 5.0, draw.random() * 1e-9]) for _ in range(3000)]
    df = spark.createDataFrame([(x, float(i), 1.0, None) for i, x in enumerate(xs)], "a double, b double, c double, d double").repartition(6)
    shares = [i / 10 for i in range(11)]
    values = pr.value_counts(df, df.columns)
    cut = pr.hit_cells(values, shares, held, cells)
    sizes = cut.groupBy("feature", "path").count().collect()
    assert max(r["count"] for r in sizes) <= held
    if held < 100:
        assert cut.count() <= held * 3 * len(shares) < values.count()
    found = {r.feature: r.quantiles for r in pr.quantiles(df, df.columns, shares, held).collect()}
    ranked = sorted(xs)
    assert found["a"] == [ranked[max(1, math.ceil(s * 3000)) - 1] for s in shares]
    assert found["b"] == [float(max(1, math.ceil(s * 3000)) - 1) for s in shares]
    assert found["c"] == [1.0] * 11 and "d" not in found
