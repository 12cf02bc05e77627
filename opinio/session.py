"""Session helpers: one builder for tests and benches, plus the shared scratch area.

Scratch data (CSV round trips, sinks, stream checkpoints) always lives under the
folder the cluster names in ``spark.checkpoint.dir``. ``build_session`` (tests and
benches only) passes its own ``scratch`` folder when the configuration names none.
"""

from __future__ import annotations

import os
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "opinio",
                  scratch: str | None = None) -> SparkSession:
    """A local session; ``scratch`` becomes ``spark.checkpoint.dir`` only where that key is unset."""
    builder = SparkSession.builder
    if scratch and SparkConf().get(CHECKPOINT_KEY) is None:
        builder = builder.config(CHECKPOINT_KEY, scratch)
    spark = (
        builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables, read from ``spark.checkpoint.dir``.

    There is no fallback: a machine-local folder would lose data on a cluster, so an unset
    key is an error (tests set their own before the session starts).
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError(f"{CHECKPOINT_KEY} is not set: name a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/opinio-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder name under this application's scratch folder (not created)."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the scratch folder and read it back: one plan per stage. Texts take half the room with zstd."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application staged; call it when its results have been read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
