"""From the training table to model inputs: split, feature set, category contract."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.functions.values import number, unit_hash
from ebbline.names import KEY, TARGET

SYSTEM_COLUMNS = (KEY, "snapshot_date", "ingested_at_utc", "target_180d_ltv")


def hash_split(
    df: DataFrame,
    key: str = KEY,
    seed: int = 42,
    val_size: float = 0.15,
    test_size: float = 0.15,
) -> DataFrame:
    """Add ``split``: train, val or test, decided by a hash of the key alone."""
    train_bound = 1.0 - val_size - test_size
    draw = unit_hash(seed, F.col(key))
    return df.withColumn(
        "split",
        F.when(draw <= train_bound, "train")
        .when(draw <= train_bound + val_size, "val")
        .otherwise("test"),
    )


def drop_system_columns(
    df: DataFrame, target: str = TARGET, system: Sequence[str] = SYSTEM_COLUMNS
) -> DataFrame:
    """The feature columns; a table without the target is an error."""
    if target not in df.columns:
        raise KeyError(f"target column {target!r} not found")
    return df.drop(*[c for c in (*system, target) if c in df.columns])


class FeatureKinds(NamedTuple):
    numerical: list[str]
    categorical: list[str]

    @property
    def names(self) -> list[str]:
        return self.numerical + self.categorical


def feature_kinds(features: DataFrame) -> FeatureKinds:
    """Numbers are numerical, text is categorical."""
    return FeatureKinds(
        [f.name for f in features.schema if isinstance(f.dataType, T.NumericType)],
        [f.name for f in features.schema if isinstance(f.dataType, T.StringType)],
    )


def split_sizes(split: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows and number of features of each part."""
    width = len(drop_system_columns(split, target).drop("split").columns)
    return (
        split.groupBy("split")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("n_features", F.lit(width))
    )


def long_values(
    df: DataFrame, columns: Sequence[str], kind: str, keep: Sequence[str] = ()
) -> DataFrame:
    """(keep..., feature, value): one row per listed column of each row.

    ``kind`` is ``double`` or ``string``. The rows stay where they are; nothing
    is shuffled here.
    """
    cast = [
        (number(df, c) if kind == "double" else df[c].cast("string")).alias(c) for c in columns
    ]
    return df.select(*(df[c] for c in keep), *cast).unpivot(
        list(keep), list(columns), "feature", "value"
    )


def category_contract(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category): the values seen in training, without NULL.

    A long table has no limit on the number of categories; a column the table
    lacks contributes none.
    """
    present = [c for c in columns if c in train.columns]
    if not present:
        return train.sparkSession.createDataFrame([], "feature string, category string")
    return (
        long_values(train, present, "string")
        .where(F.col("value").isNotNull())
        .select("feature", F.col("value").alias("category"))
        .distinct()
    )


def schema_contract(train: DataFrame, kinds: FeatureKinds) -> DataFrame:
    """(feature, kind, category): numerical names, and categories as rows."""
    numbers = train.sparkSession.createDataFrame(
        [(c, "numerical", None) for c in kinds.numerical],
        "feature string, kind string, category string",
    )
    lists = category_contract(train, kinds.categorical)
    return numbers.unionByName(
        lists.select("feature", F.lit("categorical").alias("kind"), "category")
    )


def enforce_schema(
    df: DataFrame,
    kinds: FeatureKinds,
    categories: DataFrame,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bring a table to the trained schema: keys kept, numerical, then categorical.

    What is no number, no known category or no column at all becomes NULL. Each
    categorical column is matched by a left join with the contract's rows for it;
    Spark broadcasts a short list and splits what a frequent value makes long.
    """
    result = df
    shaped = []
    for name in kinds.categorical:
        if name not in df.columns:
            shaped.append(F.lit(None).cast("string").alias(name))
            continue
        text, known = F.col(name).cast("string"), f"__category_{name}"
        lookup = categories.where(F.col("feature") == name).select(F.col("category").alias(known)).distinct()
        result = result.join(lookup, text == F.col(known), "left")
        shaped.append(F.col(known).alias(name))
    numbers = []
    for name in kinds.numerical:
        value = number(df, name) if name in df.columns else F.lit(None).cast("double")
        numbers.append(value.alias(name))
    return result.select(*keep, *numbers, *shaped)
