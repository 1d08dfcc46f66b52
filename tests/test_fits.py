"""Encodings, isotonic curves, contributions of trees and the end of boosting."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbline.names import KEY, PREDICTION, TARGET
from ebbline.operators import boosting
from ebbline.operators import contributions as ctb
from ebbline.operators import encoding as enc
from ebbline.operators import isotonic as iso
from ebbline.operators import models as md
from ebbline.operators.prep import FeatureKinds

# --- the end of boosting ---------------------------------------------------------------


def test_small_gains_are_kept():
    """Trees 2 to 40 gain less than one percent each."""
    curve = [0.7 * 0.995**k for k in range(40)]
    assert md.kept_trees(curve, 30) == (40, False)


def test_patience_ends_at_the_best_tree():
    curve = [0.6, 0.5, 0.55, 0.49, *[0.495] * 29]
    assert md.kept_trees(curve, 30) == (4, False)
    assert md.kept_trees([*curve, 0.495], 30) == (4, True)
    assert md.kept_trees([*curve, 0.48], 30) == (34, False)
    assert md.kept_trees([math.nan], 30) == (1, False)


@pytest.fixture(scope="module")
def learnable(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 61 / 61.0).alias("a"), (F.col("id") % 17 / 17.0).alias("b"),
        F.col("id").cast("string").alias(KEY), ((F.col("id") % 61 > 30) != (F.col("id") % 7 == 0)).cast("double").alias("label"),
    )
    return VectorAssembler(inputCols=["a", "b"], outputCol=md.VECTOR).transform(rows).cache()


def test_boosting_goes_on_while_the_loss_falls(learnable):
    """At a small rate every tree gains less than one percent, and all that were asked for are kept."""
    train, val = learnable.where(f"{KEY} % 3 > 0"), learnable.where(f"{KEY} % 3 = 0")
    slow = md.TreeParams(maxIter=40, stepSize=0.01, maxDepth=2)
    trial = md.boost(train, val, slow, first=15)
    assert (trial.asked, trial.params.maxIter, len(trial.curve)) == (40, 40, 40)
    assert all(0.99 * a < b < a for a, b in zip(trial.curve[1:], trial.curve[2:]))
    model = md.train_model(train, trial.params)
    own = md.with_probability(model, val).agg(F.avg(F.when(F.col("label") == 1, -F.log(PREDICTION)).otherwise(-F.log(1 - F.col(PREDICTION))))).first()[0]
    assert trial.log_loss == pytest.approx(own, rel=1e-9)


def test_boosting_ends_early_on_noise(spark):
    noise = spark.range(600).select(F.rand(3).alias("a"), (F.rand(4) > 0.5).cast("double").alias("label"))
    rows = VectorAssembler(inputCols=["a"], outputCol=md.VECTOR).transform(noise).cache()
    trial = md.boost(rows.where("a < 0.7"), rows.where("a >= 0.7"), md.TreeParams(maxIter=400, stepSize=0.2, maxDepth=3), patience=5, first=10)
    assert trial.asked == 400 and trial.params.maxIter + 5 <= len(trial.curve) < 400
    assert trial.log_loss == min(trial.curve[: trial.params.maxIter + 5])


def test_jobs_side_by_side_keep_their_order(spark):
    assert md.side_by_side([lambda k=k: spark.range(k).count() for k in range(7)], 3) == list(range(7))


# --- trees of a search -----------------------------------------------------------------


@pytest.fixture(scope="module")
def wide(spark):
    """12,000 rows in five partitions (one without training rows), five features, two of them all but constant."""
    rows = spark.range(0, 12_000, 1, 5).select(
        "id", *[F.round(F.rand(k) * m, 3).alias(f"x{k}") for k, m in enumerate((1.0, 40.0, 5.0))], F.lit(2.0).alias("x3"), (F.rand(8) < 0.01).cast("double").alias("x4"),
        (F.rand(9) < 0.5).alias("coin"),
    )
    label = (F.col("x0") * F.col("x1") + F.col("x2") + F.when(F.col("coin"), 8) > 14).cast("double")
    rows = rows.withColumn("label", F.coalesce(label, F.lit(0.0)))
    return md.store(VectorAssembler(inputCols=[f"x{k}" for k in range(5)], outputCol=md.VECTOR).transform(rows).select("id", "label", md.VECTOR)).cache()


DRAWS = [
    md.TreeParams(maxIter=9, stepSize=0.1, maxDepth=4, minInstancesPerNode=20, subsamplingRate=0.7, featureSubsetStrategy="0.610", minInfoGain=0.002),
    md.TreeParams(maxIter=4, stepSize=0.2, maxDepth=3, minInstancesPerNode=50),
    md.TreeParams(maxIter=5, stepSize=0.05, maxDepth=1, subsamplingRate=0.9, featureSubsetStrategy="0.200", minInfoGain=0.5),
]


def test_trees_of_a_search_are_mllibs(wide, monkeypatch):
    """In one task, and dealt over the tasks of a barrier stage: the losses of MLlib's fits, tree by tree."""
    train, val = wide.where("id % 6 > 0 AND id >= 2400"), wide.where("id % 6 = 0")
    theirs = md.side_by_side([lambda p=p: md.boost_by_fits(train, val, p, first=6) for p in DRAWS])
    for task_rows, tasks, at_once in ((boosting.TASK_ROWS, 1, 8), (3_000, 4, 2)):
        monkeypatch.setattr(boosting, "TASK_ROWS", task_rows)
        assert boosting.deal(train, val, md.VECTOR, md.BINS, 42)[1:3] == (tasks, at_once)
        for want, trial in zip(theirs, md.boost_all(train, val, DRAWS, first=6)):
            assert trial.curve == pytest.approx(want.curve, rel=1e-9)
            assert (trial.params, trial.asked, len(trial.curve)) == (want.params, want.asked, len(want.curve))


def test_a_cluster_that_cannot_start_all_tasks_at_once(wide, monkeypatch):
    """MLlib's own fits are taken where Spark refuses barrier stages."""
    monkeypatch.setattr(boosting, "TASK_ROWS", 3_000)
    monkeypatch.setattr(boosting, "gangs", lambda context: False)
    rows = wide.where("id < 6000")
    assert boosting.deal(rows, rows, md.VECTOR, md.BINS, 42) is None
    trial = md.boost(rows, rows, md.TreeParams(maxIter=2, maxDepth=1), first=1)
    assert len(trial.curve) == 2 and trial.curve[1] < trial.curve[0]


def test_thresholds_of_more_rows_are_mllibs(spark):
    """Beyond 10,000 rows MLlib finds thresholds on a sample, here with zeros and few distinct values among the features."""
    rows = spark.range(0, 60_000, 1, 3).select(
        (F.rand(1) < 0.4).cast("double").alias("label"), F.when(F.rand(2) < 0.7, 0.0).otherwise(F.rand(3)).alias("a"), F.floor(F.rand(4) * 9).cast("double").alias("b"), F.randn(5).alias("c"),
    ).withColumn("label", F.when(F.abs("c") + F.col("a") > 1.2, 1.0).otherwise(F.col("label")))
    rows = md.store(VectorAssembler(inputCols=["a", "b", "c"], outputCol=md.VECTOR).transform(rows)).cache()
    params = md.TreeParams(maxIter=6, maxDepth=3, subsamplingRate=0.8)
    ours, theirs = (f(rows.where("b > 0"), rows.where("b = 0"), params, first=6) for f in (md.boost, md.boost_by_fits))
    assert ours.curve == pytest.approx(theirs.curve, rel=1e-9)


def test_a_search_is_a_job_a_draw(spark, wide):
    """A fit is one job, not two stages for every level of every tree, and no tree is built twice."""
    spark.sparkContext.setJobGroup("a search", "counted")
    try:
        trials = md.tune(wide.where("id % 6 > 0"), wide.where("id % 6 = 0"), n_trials=6, space=dict(md.SEARCH_SPACE, n_estimators=(20, 20, 10), max_depth=(3, 4)))
    finally:
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("a search")
        spark.sparkContext._jsc.clearJobGroup()
    assert len(trials) == 6 and [t.log_loss for t in trials] == sorted(t.log_loss for t in trials)
    assert len(jobs) <= 20


def test_random_numbers_are_javas(spark):
    java = spark._jvm.org.apache.spark.util.random.XORShiftRandom(5)
    for seed in (43, -3, 1 << 40):
        java.setSeed(seed)
        want = [java.nextDouble() for _ in range(700)]
        one = boosting.XorShift(seed)
        assert [one.uniform() for _ in range(700)] == want == boosting.Uniforms()(seed, 700).tolist()
        other, ours = spark._jvm.java.util.Random(seed), boosting.JavaRandom(seed)
        assert [ours.long() for _ in range(20)] == [other.nextLong() for _ in range(20)]


def test_constant_features_have_no_thresholds():
    few = boosting.thresholds(np.array([[0.0, 1.0, 3.0], [0.0, 1.0, 0.0], [0.0, 1.0, -1.0]]), 3, 32)
    assert [t.tolist() for t in few] == [[], [], [-0.5, 1.5]]
    many = boosting.thresholds(np.arange(1.0, 101.0)[:, None], 100, 4)
    assert [t.tolist() for t in many] == [[25.5, 50.5, 75.5]]


def test_rows_a_search_cannot_take(spark, wide):
    whole = wide.where("id < 100")
    with pytest.raises(ValueError, match="no rows"):
        md.boost(whole.where("id < 0"), whole, DRAWS[1])
    with pytest.raises(Exception, match="neither 0 nor 1"):
        md.boost(whole.withColumn("label", F.lit(2.0)), whole, DRAWS[1])
    with pytest.raises(Exception, match="neither 0 nor 1"):
        md.boost(whole.withColumn("label", F.when(F.col("id") > 3, F.col("label"))), whole, DRAWS[1])
    lost = VectorAssembler(inputCols=["x"], outputCol=md.VECTOR, handleInvalid="keep").transform(whole.select("label", F.when(F.col("id") > 3, 1.0).alias("x")))
    with pytest.raises(Exception, match="not a finite number"):
        md.boost(lost, whole, DRAWS[1])


# --- categories ------------------------------------------------------------------------

TRAINED = f"{KEY} string, shop string, city string, x double, {TARGET} int"


def shops(n=400):
    draw = random.Random(5)
    return [(f"k{i}", draw.choice(["a", "b", None, "rare" if i == 7 else "c"]), draw.choice(["p", "q"]), draw.choice([1.0, None, float("nan"), 3.0]), draw.randrange(2)) for i in range(n)]


def test_codes_are_shares_of_the_other_folds(spark):
    rows = shops()
    df = spark.createDataFrame(rows, TRAINED)
    folds = dict(df.select(KEY, enc.code_fold()).collect())
    encoder = enc.fit_encoder(df, FeatureKinds(["x"], ["shop", "city"]))
    for out_of_fold in (True, False):
        found = encoder.coded(df.repartition(5), out_of_fold).collect()
        assert len(found) == len(rows)
        for r in found:
            others = [t for t in rows if not out_of_fold or folds[t[0]] != folds[r[KEY]]]
            prior = sum(t[4] for t in others) / len(others)
            for place, name in ((1, "shop"), (2, "city")):
                same = [t[4] for t in others if t[place] == r[name]]
                assert r[f"__code_{name}"] == pytest.approx((sum(same) + 20 * prior) / (len(same) + 20))


def test_unknown_categories_and_missing_numbers(spark, tmp_path):
    encoder = enc.fit_encoder(spark.createDataFrame(shops(), TRAINED), FeatureKinds(["x"], ["shop"]))
    encoder.save(str(tmp_path / "e"))
    again = enc.load_encoder(str(tmp_path / "e"))
    new = spark.createDataFrame([("n", "never seen", "p", None, 0)], TRAINED)
    for e in (encoder, again):
        code, number = e.transform(new).select(vector_to_array(enc.VECTOR)).first()[0]
        assert code == e.shares[-1] and number == 1.0
    assert again.kinds == encoder.kinds and again.transform(new).columns == [*new.columns, enc.VECTOR]


def test_no_rows_and_no_categories(spark):
    none = spark.createDataFrame([], TRAINED)
    encoder = enc.fit_encoder(none, FeatureKinds(["x"], ["shop"]))
    assert encoder.shares == [0.5] * 6 and encoder.codes.count() == 0
    assert enc.category_codes(none, [], encoder.shares).count() == 0
    assert encoder.transform(none).count() == 0


def test_a_million_categories_train(spark):
    """No list of values passes through the driver, and the trees' bins do not grow."""
    rows = spark.range(1_200_000).select(
        F.col("id").cast("string").alias(KEY), (F.col("id") % 1_000_000).cast("string").alias("shop"),
        (F.col("id") % 10 / 10.0).alias("x"), (F.xxhash64("id") % 3 == 0).cast("int").alias(TARGET),
    )
    encoder = md.fit_encoder(rows, FeatureKinds(["x"], ["shop"]))
    assert encoder.codes.where("fold IS NULL").count() == 1_000_000
    model = md.train_model(md.encoded(encoder, rows, out_of_fold=True), md.TreeParams(maxIter=1, maxDepth=2))
    assert model.getNumTrees == 1


# --- isotonic curves -------------------------------------------------------------------


def brute(points):
    """value at each score: greatest over beginnings of the least mean over ends."""
    by = {}
    for x, y in points:
        n, s = by.get(x, (0, 0))
        by[x] = n + 1, s + int(y)
    xs = sorted(by)
    mean = lambda a, b: Fraction(sum(by[x][1] for x in xs[a : b + 1]), sum(by[x][0] for x in xs[a : b + 1]))
    return {x: max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i, x in enumerate(xs)}


def drawn(kind, n=160):
    draw = random.Random(n)
    if kind == "falling":
        return [(i / n, float(i < n / 2)) for i in range(n)]
    if kind == "rising":
        return [(i / n, float(i >= n / 2)) for i in range(n)]
    if kind == "ties":
        return [(draw.randrange(9) / 9, float(draw.randrange(2))) for _ in range(n)]
    return [((x := draw.randrange(40) / 40), float(draw.random() < x)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["noisy", "falling", "rising", "ties"])
@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_isotonic_equals_min_max(spark, kind, ranges):
    points = drawn(kind)
    df = spark.createDataFrame([*points, (None, 1.0), (float("nan"), 0.0), (0.5, None)], f"{PREDICTION} double, label double")
    want = brute(points)
    blocks = iso.isotonic_blocks(df, ranges=ranges).orderBy("low").collect()
    assert all(a.value < b.value and a.high < b.low for a, b in zip(blocks, blocks[1:]))
    assert sum(b.weight for b in blocks) == len(points)
    for x, value in want.items():
        (block,) = [b for b in blocks if b.low <= x <= b.high]
        assert block.value == float(value)


def test_scores_are_looked_up_on_the_curve(spark):
    points = drawn("noisy")
    df = spark.createDataFrame(points, f"{PREDICTION} double, label double")
    table = iso.fit_isotonic(df)
    blocks = sorted(tuple(r) for r in table.select("low", "high", "value").collect())

    def value(x):
        if x is None or math.isnan(x):
            return None
        ends = [(x, v) for low, high, v in blocks for x in (low, high)]
        if x <= ends[0][0]:
            return ends[0][1]
        for (a, u), (b, v) in zip(ends, ends[1:]):
            if a <= x <= b:
                return u if a == b else u + (x - a) * (v - u) / (b - a)
        return ends[-1][1]

    xs = [-3.0, 0.0, 1.0, 7.5, None, float("nan"), *[k / 997 for k in range(997)]]
    rows = spark.createDataFrame([(x, "kept") for x in xs], "s double, low string")
    found = iso.apply_curve(rows, table, "s", "v").collect()
    assert len(found) == len(xs) and {r.low for r in found} == {"kept"}
    for r in found:
        assert r.v == (None if value(r.s) is None else pytest.approx(value(r.s)))


def test_no_points(spark):
    none = spark.createDataFrame([], f"{PREDICTION} double, label double")
    table = iso.fit_isotonic(none)
    assert table.count() == 0
    assert iso.apply_curve(spark.createDataFrame([(0.5,)], "s double"), table, "s", "v").first().v is None


# --- contributions ---------------------------------------------------------------------


def test_contributions_and_base_are_the_margin(spark, learnable):
    model = GBTClassifier(labelCol="label", featuresCol=md.VECTOR, maxIter=12, maxDepth=4, seed=3).fit(learnable)
    nodes = ctb.tree_nodes(model, spark)
    rows = ctb.contributions(learnable, nodes, md.VECTOR, [KEY])
    margin = model.transform(learnable).select(F.col(KEY).alias("k"), vector_to_array("rawPrediction")[1].alias("margin"))
    both = rows.join(margin, F.col(KEY) == F.col("k")).collect()
    assert len(both) == 3000
    for r in both:
        assert r.base + sum(r.contributions) == pytest.approx(r.margin, abs=1e-9)
    means = {r.feature: r.importance for r in ctb.contribution_importance(learnable, nodes, md.VECTOR, ["a", "b"]).collect()}
    for k, name in enumerate("ab"):
        assert means[name] == pytest.approx(sum(abs(r.contributions[k]) for r in both) / 3000)
    assert means["a"] > means["b"]


def test_contributions_of_no_rows(spark, learnable):
    model = md.train_model(learnable, md.TreeParams(maxIter=2, maxDepth=1))
    nodes = ctb.tree_nodes(model, spark)
    assert ctb.contributions(learnable.limit(0), nodes, md.VECTOR, [KEY]).collect() == []
    assert {r.importance for r in ctb.contribution_importance(learnable.limit(0), nodes, md.VECTOR, ["a", "b"]).collect()} == {None}
