"""Scans of the landed parquet tables. Only the needed columns are selected, so the
parquet reader prunes the rest (``ReadSchema`` in the plan); how a scan is split is left to Spark
(``spark.sql.files.maxPartitionBytes``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinio.session import table_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def documents(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "documents", *(cols or ("doc_id", "text", "lang", "source", "n_chars")))


def events(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "events", *(cols or ("event_id", "ts", "user_id", "event_type", "value", "props")))


def pages(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "pages", *(cols or ("page_id", "url", "html")))


def conversations(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "conversations", *(cols or ("conv_id", "turn", "role", "text")))


def labels(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "labels", *(cols or ("doc_id", "quality", "toxic")))


def benchmark(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "benchmark", *(cols or ("item_id", "text")))
