"""Churn models on MLlib: tuning, training, calibration, scoring, importance."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple, TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.functions.values import unit_hash
from ebbline.names import KEY, PREDICTION, TARGET
from ebbline.operators import boosting
from ebbline.operators.boosting import PATIENCE, kept_trees
from ebbline.operators.contributions import contribution_importance, tree_nodes
from ebbline.operators.encoding import VECTOR, Encoder, fit_encoder, load_encoder
from ebbline.operators.isotonic import apply_curve, fit_isotonic
from ebbline.operators.metrics import log_error
from ebbline.operators.prep import FeatureKinds
from ebbline.session import store

# The search space and the budgets.
SEARCH_SPACE = {
    "n_estimators": (100, 800, 100),
    "learning_rate": (0.01, 0.2),
    "max_depth": (3, 9),
    "min_child_weight": (1, 10),
    "subsample": (0.6, 1.0),
    "colsample_bytree": (0.6, 1.0),
    "gamma": (0.0, 5.0),
}
N_TRIALS = 30
CALIBRATION_FOLDS = 5
# Trees after which that end is first looked for; then again whenever their number has doubled.
FIRST_TREES = 50
# Fits that run side by side. Each is a chain of small jobs that waits more than it works.
FITS_AT_ONCE = 4
BINS = 32
# Rows that make it worth to give a fit one more task.
FIT_ROWS = 20_000

T = TypeVar("T")


class TreeParams(NamedTuple):
    """Boosting parameters under MLlib's names."""

    maxIter: int = 100
    stepSize: float = 0.1
    maxDepth: int = 5
    minInstancesPerNode: int = 1
    subsamplingRate: float = 1.0
    featureSubsetStrategy: str = "all"
    minInfoGain: float = 0.0


def sample_params(n_trials: int, seed: int = 42, space: dict = SEARCH_SPACE) -> list[TreeParams]:
    """Seeded random draws from the search space; the learning rate is drawn on a log scale."""
    draw = random.Random(seed)
    lo, hi, step = space["n_estimators"]
    rate_lo, rate_hi = space["learning_rate"]
    return [
        TreeParams(
            maxIter=draw.randrange(lo, hi + 1, step),
            stepSize=math.exp(draw.uniform(math.log(rate_lo), math.log(rate_hi))),
            maxDepth=draw.randint(*space["max_depth"]),
            minInstancesPerNode=draw.randint(*space["min_child_weight"]),
            subsamplingRate=draw.uniform(*space["subsample"]),
            featureSubsetStrategy=f"{draw.uniform(*space['colsample_bytree']):.3f}",
            minInfoGain=draw.uniform(*space["gamma"]) / 1000.0,
        )
        for _ in range(n_trials)
    ]


# --- inputs ----------------------------------------------------------------------------


def encoded(encoder: Encoder, df: DataFrame, extra: Sequence[str] = (), out_of_fold: bool = False) -> DataFrame:
    """Key, extra columns, label and vector; ``out_of_fold`` for the rows that the encoder was fitted on."""
    label = [F.col(TARGET).cast("double").alias("label")] if TARGET in df.columns else []
    vectors = encoder.transform(df, out_of_fold)
    return vectors.select(*(c for c in (KEY, *extra) if c in df.columns), *label, VECTOR)


def encoded_split(encoder: Encoder, rows: DataFrame) -> DataFrame:
    """The vectors of a split table: out of fold for its training part, by all training rows for the others."""
    train = encoded(encoder, rows.where(F.col("split") == "train"), ["split"], out_of_fold=True)
    return train.unionByName(encoded(encoder, rows.where(F.col("split") != "train"), ["split"]))


def stored_split(encoder: Encoder, rows: DataFrame) -> DataFrame:
    """:func:`encoded_split` of a stored table, written once for all fits and dealt evenly over the cores.

    Vectors are narrow, so by bytes alone a handful of files holds them all, and each of the
    hundreds of passes of a fit would keep as many cores busy.
    """
    vectors = encoded_split(encoder, rows)
    tasks = min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // FIT_ROWS)
    return store(vectors.repartition(tasks).sortWithinPartitions(KEY) if tasks > 1 else vectors)


# --- training --------------------------------------------------------------------------


def classifier(params: TreeParams, bins: int = BINS, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(
        labelCol="label",
        featuresCol=VECTOR,
        seed=seed,
        maxBins=bins,
        checkpointInterval=10,
        **params._asdict(),
    )


def with_probability(model, df: DataFrame, name: str = PREDICTION) -> DataFrame:
    """Probability of churn under a fitted classifier."""
    scored = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return scored.select(*df.columns, name)


def side_by_side(jobs: Sequence[Callable[[], T]], at_once: int = FITS_AT_ONCE) -> list[T]:
    """Run independent fits in a bounded pool of threads; results in the order of the jobs."""
    session = SparkSession.active()
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(session)(job)) for job in jobs]]


class Trial(NamedTuple):
    """One draw: its parameters with the trees kept, their log loss, the trees asked for and the loss after each tree built."""

    params: TreeParams
    log_loss: float
    asked: int
    curve: list[float]


def boost_by_fits(
    train: DataFrame, val: DataFrame, params: TreeParams, bins: int = BINS, seed: int = 42, patience: int = PATIENCE, first: int = FIRST_TREES
) -> Trial:
    """:func:`boost` by MLlib alone, for clusters that cannot start all tasks of a fit at once.

    MLlib stops at the first tree that gains too little, so the number of trees is
    found from outside: the first trees of a longer fit with the same seed are those
    of a shorter one, and the loss after every tree is one pass over ``val``. Fits
    double, so no more than three times the trees needed are built.
    """
    many = 0
    while True:
        many = min(params.maxIter, max(first, 2 * many))
        model = classifier(params._replace(maxIter=many), bins, seed).fit(train)
        # MLlib's loss is twice the log loss.
        curve = [loss / 2.0 for loss in model.evaluateEachIteration(val)]
        kept, ended = kept_trees(curve, patience)
        if ended or many == params.maxIter:
            return Trial(params._replace(maxIter=kept), curve[kept - 1], params.maxIter, curve)


def boost(
    train: DataFrame, val: DataFrame, params: TreeParams, bins: int = BINS, seed: int = 42, patience: int = PATIENCE, first: int = FIRST_TREES
) -> Trial:
    """Boost until the validation loss has not fallen for ``patience`` trees, or all trees asked for are built.

    The trees are MLlib's, grown by :mod:`ebbline.operators.boosting`; whether the end has
    come is looked at after ``first`` trees and whenever their number has doubled.
    """
    return boost_all(train, val, [params], bins, seed, patience, first)[0]


def boost_all(
    train: DataFrame, val: DataFrame, draws: Sequence[TreeParams], bins: int = BINS, seed: int = 42, patience: int = PATIENCE, first: int = FIRST_TREES
) -> list[Trial]:
    """:func:`boost` for each draw, side by side over rows that are binned once."""
    dealt = boosting.deal(train, val, VECTOR, bins, seed)
    if dealt is None:
        return side_by_side([lambda p=p: boost_by_fits(train, val, p, bins, seed, patience, first) for p in draws])

    def trial(params: TreeParams) -> Trial:
        curve = boosting.fit(dealt, params._asdict(), seed, patience, first)
        kept, _ = kept_trees(curve, patience)
        return Trial(params._replace(maxIter=kept), curve[kept - 1], params.maxIter, curve)

    # Those that go on at the least gain tend to take longest, so they begin first.
    order = sorted(range(len(draws)), key=lambda i: draws[i].minInfoGain)
    trials = side_by_side([lambda p=draws[i]: trial(p) for i in order], dealt.at_once)
    return [t for _, t in sorted(zip(order, trials), key=lambda pair: pair[0])]


def tune(
    train: DataFrame,
    val: DataFrame,
    n_trials: int = N_TRIALS,
    seed: int = 42,
    bins: int = BINS,
    space: dict = SEARCH_SPACE,
    patience: int = PATIENCE,
) -> list[Trial]:
    """One boosted model per draw, as many at a time as the cores allow, ordered by validation log loss.

    Each fit is a job of its own over the binned rows; only losses come back.
    """
    trials = boost_all(train, val, sample_params(n_trials, seed, space), bins, seed, patience)
    return sorted(trials, key=lambda t: t.log_loss)


def train_model(train: DataFrame, params: TreeParams, bins: int = BINS, seed: int = 42):
    return classifier(params, bins, seed).fit(train)


class CalibratedModel(NamedTuple):
    """Fold models with their calibration curves; the score is their mean."""

    encoder: Encoder
    folds: list[tuple[GBTClassificationModel, DataFrame]]

    def save(self, path: str) -> None:
        """Write all parts, and last of all a row that says how many folds there are."""
        self.encoder.save(f"{path}/encoder")
        for i, (trees, curve) in enumerate(self.folds):
            trees.write().overwrite().save(f"{path}/fold_{i}/trees")
            curve.write.mode("overwrite").parquet(f"{path}/fold_{i}/curve")
        facts = SparkSession.active().createDataFrame([(len(self.folds),)], "folds int")
        facts.write.mode("overwrite").parquet(f"{path}/facts")


def load_calibrated(path: str) -> CalibratedModel:
    """The saved model with all of its folds."""
    spark = SparkSession.active()
    parts = [f"{path}/fold_{i}" for i in range(spark.read.parquet(f"{path}/facts").first().folds)]
    folds = [(GBTClassificationModel.load(f"{p}/trees"), spark.read.parquet(f"{p}/curve")) for p in parts]
    return CalibratedModel(load_encoder(f"{path}/encoder"), folds)


def calibrate(
    encoder: Encoder,
    train: DataFrame,
    params: TreeParams,
    folds: int = CALIBRATION_FOLDS,
    bins: int = BINS,
    seed: int = 42,
) -> CalibratedModel:
    """Cross-fitted calibration: trees on the other folds, the isotonic curve on the held-out one.

    ``train`` is the encoded training table; a row's fold depends on its key only.
    """
    fold = F.floor(unit_hash(f"fold-{seed}", F.col(KEY)) * folds).cast("int")
    rows = train.withColumn("fold", fold)

    def fit(i: int) -> tuple[GBTClassificationModel, DataFrame]:
        trees = train_model(rows.where(F.col("fold") != i), params, bins, seed)
        return trees, fit_isotonic(with_probability(trees, rows.where(F.col("fold") == i)))

    return CalibratedModel(encoder, side_by_side([lambda i=i: fit(i) for i in range(folds)]))


# --- scoring ---------------------------------------------------------------------------


def score(model: CalibratedModel, df: DataFrame) -> DataFrame:
    """Add the calibrated probability; every column of the table is kept."""
    vectors = model.encoder.transform(df)
    parts = []
    for i, (trees, curve) in enumerate(model.folds):
        raw, part = f"raw_{i}", f"part_{i}"
        vectors = apply_curve(with_probability(trees, vectors, raw), curve, raw, part)
        parts.append(part)
    mean = reduce(lambda a, b: a + b, (F.col(p) for p in parts)) / float(len(parts))
    return vectors.select(*df.columns, mean.alias(PREDICTION))


# --- importance ------------------------------------------------------------------------


def hash_sample(df: DataFrame, n: int, seed: int = 42, key: str = KEY) -> DataFrame:
    """At most ``n`` rows, the same ones on every run: a top-n by hash of the key."""
    drawn = df.withColumn("draw", unit_hash(f"sample-{seed}", F.col(key)))
    return drawn.orderBy("draw", key).limit(n).drop("draw")


PLACE_DIGITS = 1 << 16


def shuffled_places(rows: DataFrame, salt: str, name: str = "place", key: str = KEY) -> DataFrame:
    """Number the rows from 1 in an order that depends on the salt and the key alone.

    The order is that of a hash of the key. Rows are counted by the leading digits
    of the hash, of which there are 65,536, so the only window without a key has at
    most that many rows; the rows themselves are put in order digit by digit.
    """
    drawn = rows.withColumn("draw", unit_hash(salt, F.col(key)))
    drawn = drawn.withColumn("digit", F.floor(F.col("draw") * PLACE_DIGITS))
    before = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    digits = drawn.groupBy("digit").agg(F.count(F.lit(1)).alias("n"))
    digits = digits.select("digit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("digit").orderBy("draw", key))
    return drawn.join(digits, "digit").withColumn(name, F.col("before") + inside).drop("draw", "digit", "before")


def shuffle_importance(
    df: DataFrame,
    names: Sequence[str],
    scored: Callable[[DataFrame], DataFrame],
    n: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """(feature, importance): how much log loss grows when a feature is shuffled.

    ``scored`` adds the probability to rows that have the key, the target and the
    features. The row at place i of one random order gets the feature value of the
    row at place i of another; all shuffled copies are scored in one job. All rows take
    part unless ``n`` asks for a sample.
    """
    rows = df.select(KEY, TARGET, *names)
    rows = store(rows if n is None else hash_sample(rows, n, seed))
    base = shuffled_places(rows, f"rows-{seed}")
    copies = [rows.withColumn("feature", F.lit(""))]
    for name in names:
        donor = shuffled_places(rows.select(KEY, name), f"shuffle-{seed}-{name}").select(
            "place", F.col(name).alias("borrowed")
        )
        copies.append(
            base.join(donor, "place")
            .withColumn(name, F.col("borrowed"))
            .withColumn("feature", F.lit(name))
            .select(KEY, TARGET, *names, "feature")
        )
    label = F.col(TARGET).cast("double")
    losses = (
        scored(reduce(DataFrame.unionByName, copies))
        .groupBy("feature")
        .agg(F.avg(log_error(label, F.col(PREDICTION))).alias("loss"))
    )
    plain = losses.where(F.col("feature") == "").select(F.col("loss").alias("plain_loss"))
    return (
        losses.where(F.col("feature") != "")
        .select("feature", (F.col("loss") - plain.scalar()).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def permutation_importance(
    encoder: Encoder,
    model,
    df: DataFrame,
    kinds: FeatureKinds,
    n: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """:func:`shuffle_importance` of the features of a fitted classifier."""

    def scored(rows: DataFrame) -> DataFrame:
        vectors = encoded(encoder, rows, extra=["feature"])
        return with_probability(model, vectors).withColumnRenamed("label", TARGET)

    return shuffle_importance(df, kinds.names, scored, n, seed)


def mean_contributions(model: GBTClassificationModel, vectors: DataFrame, kinds: FeatureKinds) -> DataFrame:
    """(feature, importance): how much a feature moves the margin of a row on average, over all rows."""
    return contribution_importance(vectors, tree_nodes(model, vectors.sparkSession), VECTOR, kinds.categorical + kinds.numerical)
