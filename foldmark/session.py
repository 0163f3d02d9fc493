"""Session defaults shared by the entry point, the benchmark and the tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pixels are wide: batches are bounded by bytes, not by the 10 000 rows of the default alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app_name: str = "foldmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; a local one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="foldmark-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the checkpoint folder, for what a job writes and reads again."""
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the table to the checkpoint folder and go on from there: for tables several branches read.

    A written table is computed once and read by column; ``checkpoint()`` would
    compute the last stage twice and keep rows.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_and_measure(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """``cut_lineage`` with aggregates of the written rows, read from the files by column.

    An observation of the write would save that small job, but models with a training summary can't be sent to
    workers any more once the session has made one.
    """
    written = cut_lineage(df)
    return written, written.agg(*[m.alias(name) for name, m in measures.items()]).head().asDict()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a table read from files if it has fewer partitions than there are cores.

    For work that is heavy per row, such as images. At scale a table has more
    partitions than that and is left alone. Not for tables behind a shuffle:
    asking those for their partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
