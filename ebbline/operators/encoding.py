"""Categories as numbers: label shares of the other folds, for columns of any number of values."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.functions.values import unit_hash
from ebbline.names import KEY, TARGET
from ebbline.operators.prep import FeatureKinds
from ebbline.operators.profiles import quantiles
from ebbline.session import store

VECTOR = "features_vector"
FOLDS = 5
# A value's label share is drawn towards the general one as by so many rows.
SMOOTHING = 20.0
CODES = "feature string, value string, fold int, n bigint, code double"


def code_fold(folds: int = FOLDS, seed: int = 42) -> Column:
    return F.floor(unit_hash(f"code-{seed}", F.col(KEY)) * folds).cast("int")


def label_shares(train: DataFrame, folds: int = FOLDS, seed: int = 42) -> list[float]:
    """The share of positive rows outside of each fold and, last, among all rows; 0.5 without rows."""
    rows = train.groupBy(code_fold(folds, seed).alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(TARGET).cast("double")).alias("hits")
    )
    cells = {r.fold: (r.n, r.hits) for r in rows.collect()}
    n, hits = (sum(c[k] for c in cells.values()) for k in (0, 1))
    without = [(n - cells.get(f, (0, 0))[0], hits - cells.get(f, (0, 0))[1]) for f in range(folds)]
    return [h / m if m else 0.5 for m, h in [*without, (n, hits)]]


def category_codes(
    train: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    folds: int = FOLDS,
    seed: int = 42,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """(feature, value, fold, n, code): what stands for a value in the rows of a fold, and anywhere (fold NULL).

    The code of a fold is the label share of the value's rows in the other folds,
    so no row sees its own label; n counts the rows behind it. A missing value is a
    value of its own. One aggregate for all columns, which keeps one row per value.
    """
    if not columns:
        return train.sparkSession.createDataFrame([], CODES)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    hit = F.col(TARGET).cast("double").alias("hit")
    rows = train.select(code_fold(folds, seed).alias("of_fold"), hit, F.inline(pairs))
    of = [F.col("of_fold") == f for f in range(folds)]
    cells = rows.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.sum("hit").alias("hits_all"),
        *[F.count(F.when(o, 1)).alias(f"n_{f}") for f, o in enumerate(of)],
        *[F.coalesce(F.sum(F.when(o, F.col("hit"))), F.lit(0.0)).alias(f"hits_{f}") for f, o in enumerate(of)],
    )

    def entry(fold: int | None) -> Column:
        n, hits = F.col("n_all"), F.col("hits_all")
        if fold is not None:
            n, hits = n - F.col(f"n_{fold}"), hits - F.col(f"hits_{fold}")
        prior = float(shares[folds if fold is None else fold])
        code = (hits + F.lit(smoothing * prior)) / (n + F.lit(smoothing))
        own = F.lit(True) if fold is None else F.col(f"n_{fold}") > 0
        return F.when(own, F.struct(F.lit(fold).cast("int").alias("fold"), n.alias("n"), code.alias("code")))

    entries = F.filter(F.array(*map(entry, [*range(folds), None])), lambda e: e.isNotNull())
    return cells.select("feature", "value", F.inline(entries))


class Encoder(NamedTuple):
    """Label shares for categories, medians for missing numbers, one vector."""

    kinds: FeatureKinds
    medians: dict[str, float]
    shares: list[float]
    codes: DataFrame
    folds: int = FOLDS
    seed: int = 42

    def coded(self, df: DataFrame, out_of_fold: bool = False) -> DataFrame:
        """Each category column with its code beside it; ``out_of_fold`` for the rows the codes were learnt on."""
        shares = F.array(*[F.lit(float(s)) for s in self.shares])
        fold = code_fold(self.folds, self.seed) if out_of_fold else F.lit(self.folds)
        df = df.withColumn("__fold", fold)
        for name in self.kinds.categorical:
            known = self.codes.where(F.col("feature") == name).where("fold IS NOT NULL" if out_of_fold else "fold IS NULL")
            known = known.select(
                F.col("value").alias("__value"), F.coalesce("fold", F.lit(self.folds)).alias("__of"), F.col("code").alias(f"__code_{name}")
            )
            same = F.col(name).cast("string").eqNullSafe(F.col("__value"))
            df = df.join(known, same & (F.col("__fold") == F.col("__of")), "left").drop("__value", "__of")
            df = df.withColumn(f"__code_{name}", F.coalesce(f"__code_{name}", F.get(shares, F.col("__fold"))))
        return df.drop("__fold")

    def transform(self, df: DataFrame, out_of_fold: bool = False) -> DataFrame:
        """The table with the vector of its features."""
        rows = self.coded(df, out_of_fold)
        numbers = {
            f"__number_{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(float(self.medians.get(c, 0.0))))
            for c in self.kinds.numerical
        }
        rows = rows.withColumns(numbers) if numbers else rows
        inputs = [f"__code_{c}" for c in self.kinds.categorical] + list(numbers)
        return VectorAssembler(inputCols=inputs, outputCol=VECTOR).transform(rows).select(*df.columns, VECTOR)

    def save(self, path: str) -> None:
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        facts = (self.kinds.numerical, self.kinds.categorical, self.medians, self.shares, self.folds, self.seed)
        kinds = "numerical array<string>, categorical array<string>, medians map<string,double>, shares array<double>, folds int, seed int"
        SparkSession.active().createDataFrame([facts], kinds).write.mode("overwrite").parquet(f"{path}/facts")


def load_encoder(path: str) -> Encoder:
    spark = SparkSession.active()
    facts = spark.read.parquet(f"{path}/facts").first()
    kinds = FeatureKinds(facts.numerical, facts.categorical)
    return Encoder(kinds, facts.medians, facts.shares, spark.read.parquet(f"{path}/codes"), facts.folds, facts.seed)


def fit_encoder(train: DataFrame, kinds: FeatureKinds, folds: int = FOLDS, seed: int = 42) -> Encoder:
    """Codes of all category values, lower medians of numbers (exact at any size)."""
    medians = {}
    if kinds.numerical:
        medians = {r.feature: r.quantiles[0] for r in quantiles(train, kinds.numerical, [0.5]).collect()}
    shares = label_shares(train, folds, seed)
    codes = store(category_codes(train, kinds.categorical, shares, folds, seed))
    return Encoder(kinds, {c: m for c, m in medians.items() if m is not None}, shares, codes, folds, seed)
