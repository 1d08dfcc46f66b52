"""Spark session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session-level settings; all of them can be changed at run time.
# forceOptimizeSkewedJoin lets adaptive execution split a hot join key even when
# the operator above could have reused the join's partitioning.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    app: str = "ebbline", cores: int | str = "*", partitions: int = 8, memory: str = "8g"
) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, or a private one on a local master.

    The folder must be reachable from every executor, so on a cluster it has to
    be named by ``spark.checkpoint.dir``; a machine-local folder is only made up
    when the whole job runs in one JVM.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ebbline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def store(df: DataFrame, **options: str) -> DataFrame:
    """Write rows as a table in the shared folder and read them from there.

    For tables that are read many times, as by model fits, or that later steps
    meet as a finished table. A lost executor then costs a reread of a file and
    not a new run of everything upstream.
    """
    path = f"{shared_folder(df.sparkSession)}/ebbline-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin(df: DataFrame) -> DataFrame:
    """The same for a handful of rows, such as a report, by way of a checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
