"""What each feature adds to the margin of boosted trees, row by row.

The fitted trees are a table of nodes. A row goes down every tree; each step changes
the value that the tree stands at, and the change counts for the feature asked. Changes
and the values at the roots add up to the margin.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.session import shared_folder

NODES = "tree int, node int, weight double, value double, feature int, threshold double, yes int, no int"


def tree_nodes(model: GBTClassificationModel, spark) -> DataFrame:
    """The trees of a fitted model, read from its files: a row per node, feature -1 at leaves.

    Categories have been encoded as numbers, so every split is `feature <= threshold`.
    """
    path = f"{shared_folder(spark)}/ebbline-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    weights = spark.createDataFrame(list(enumerate(map(float, model.treeWeights))), "of int, weight double")
    return nodes.join(weights, F.col("tree") == F.col("of")).select(
        "tree",
        F.col("id").alias("node"),
        "weight",
        F.col("prediction").alias("value"),
        F.col("split.featureIndex").alias("feature"),
        F.get(F.col("split.leftCategoriesOrThreshold"), 0).alias("threshold"),
        F.col("leftChild").alias("yes"),
        F.col("rightChild").alias("no"),
    )


class Forest:
    """Node columns as arrays, children by place; its size is that of the model."""

    def __init__(self, nodes: DataFrame):
        rows = nodes.orderBy("tree", "node").collect()
        place = {(r.tree, r.node): k for k, r in enumerate(rows)}
        self.feature = np.array([r.feature for r in rows], np.int32)
        self.threshold = np.array([np.inf if r.threshold is None else r.threshold for r in rows])
        self.value = np.array([r.value * r.weight for r in rows])
        self.yes, self.no = (np.array([place.get((r.tree, r[k]), -1) for r in rows], np.int32) for k in ("yes", "no"))
        self.roots = np.array([place[t] for t in sorted({r.tree: (r.tree, r.node) for r in reversed(rows)}.values())], np.int32)

    def contributions(self, x: np.ndarray) -> tuple[np.ndarray, float]:
        """Changes of the margin (rows by features), and the sum of the values at the roots."""
        out, every = np.zeros_like(x), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int32)
            rows = every
            while len(rows := rows[self.feature[at[rows]] >= 0]):
                here = at[rows]
                asked = self.feature[here]
                onward = np.where(x[rows, asked] <= self.threshold[here], self.yes[here], self.no[here])
                out[rows, asked] += self.value[onward] - self.value[here]
                at[rows] = onward
        return out, float(self.value[self.roots].sum())


def contributions(df: DataFrame, nodes: DataFrame, features: str, keep: Sequence[str]) -> DataFrame:
    """The kept columns, `contributions` (one number per feature) and `base`, whose sum is the margin.

    ``features`` is an array or vector column without missing values.
    """
    forest = Forest(nodes)
    is_array = df.schema[features].dataType.typeName() == "array"
    numbers = (F.col(features).cast("array<double>") if is_array else vector_to_array(features)).alias("__x")
    rows = df.select(F.struct(*keep).alias("row"), numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                found, base = forest.contributions(x.astype(float))
                offsets = pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(found.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array([base] * batch.num_rows)], names=["row", "contributions", "base"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, contributions array<double>, base double").select("row.*", "contributions", "base")


def contribution_importance(df: DataFrame, nodes: DataFrame, features: str, names: Sequence[str]) -> DataFrame:
    """(feature, importance): the mean absolute contribution of every feature over all rows."""
    rows = contributions(df.withColumn("__one", F.lit(1)), nodes, features, ["__one"])
    means = rows.agg(*[F.avg(F.abs(F.get("contributions", F.lit(k)))).alias(f"m{k}") for k in range(len(names))])
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"m{k}").alias("importance")) for k, n in enumerate(names)])
    return means.select(F.inline(pairs)).orderBy(F.desc("importance"), "feature")
