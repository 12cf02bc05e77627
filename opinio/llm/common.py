"""Helpers shared by the corpus operators: staged tables, row ids and the two text rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinio.session import scratch_path, table_path

# The white space of every rule here: space, tab, line feed, vertical tab, form feed, carriage return
# (``[\x20\x09-\x0D]``). bytes.split() without arguments splits on exactly these six bytes.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one landed table (column pruning reaches the scan)."""
    return spark.read.parquet(table_path(sf_dir, name)).select(*cols)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back.

    It cuts the lineage, freezes run-dependent row ids, and keeps a lost executor from
    forcing a recompute of everything before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """Rows as one struct column ``row`` beside helper columns, so that no column name of theirs can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[column.alias(name) for name, column in more.items()])


def one_of_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of each key (repeated rows are equal in the key's columns, so any of them will do)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1)))
    return rows.withColumn("place", place).where("place = 1")


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 bytes; none for NULL."""
    return [] if text is None else text.encode().split()


def lower_words(text: str | None) -> list[bytes]:
    """``words`` after A-Z (and no other letter) became a-z."""
    return [] if text is None else text.encode().lower().split()


def none_if_missing(value):
    """pandas shows a NULL string as None or NaN; both become None."""
    return value if isinstance(value, str) else None


def pieces(pdf: pd.DataFrame, text: str, max_bytes: int) -> Iterator[pd.DataFrame]:
    """Cut a batch into runs of rows with about ``max_bytes`` characters of text, a row at least."""
    sizes = np.array([len(t) if isinstance(t, str) else 0 for t in pdf[text]], dtype=np.int64)
    group = np.cumsum(sizes) // max_bytes
    for g in np.unique(group):
        yield pdf[group == g]


class RowIds:
    """Row ids unique over all tasks of one job: partition number in the high bits, a counter below.

    They differ between runs, so they are only used inside staged tables.
    """

    def __init__(self) -> None:
        self.next = TaskContext.get().partitionId() << 36

    def take(self, n: int = 1) -> int:
        first = self.next
        self.next += n
        return first


def null_safe(left: DataFrame, right: DataFrame, *cols: str):
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond
