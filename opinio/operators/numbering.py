"""Global numbering without a single-partition window (W1, W2, ranks).

``Window.orderBy(...)`` with no partition key moves every row into one task.
Instead the rows are cut into ordered buckets, numbered inside each bucket, and
shifted by the row count of all earlier buckets. The bucket count table has one
row per bucket (a number we choose), so broadcasting it is size-bounded.

The bucket of a row must be a pure function of its key: the count table and the
numbered rows are two plans over the same input, and a task re-run after a lost
executor must land its rows in the same bucket again.

* One numeric key (the common case, e.g. ``post_id``): bucket bounds are
  approximate quantiles of the key, computed once and frozen into the plan as
  literals; the bucket is a JVM binary search over them (``Bucketizer``).
* Any other ordering: range partitioning, whose bounds come from a sample; the
  partitioned rows are written once with ``checkpoint()`` (to the shared
  ``spark.checkpoint.dir``) so that counts and rows read the same partitions.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from opinio.session import checkpoint_root, stage


# Rows of one bucket, about: what one task sorts and numbers.
ROWS_PER_BUCKET = 1 << 18


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    """Buckets for the rows there are (callers number a staged, narrow input, so the count is a cheap scan)."""
    return num_partitions or max(1, -(-df.count() // ROWS_PER_BUCKET))


def _single_numeric_key(df: DataFrame, order_cols: list) -> str | None:
    if len(order_cols) != 1 or not isinstance(order_cols[0], str):
        return None
    name = order_cols[0]
    return name if isinstance(df.schema[name].dataType, NumericType) else None


def _with_offsets(df: DataFrame, bucket: str, local: str, out: str) -> DataFrame:
    counts = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        bucket,
        (F.sum("_n").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .alias("_off"))
    return (df.join(F.broadcast(offsets), bucket)
            .withColumn(out, F.col("_off") + F.col(local))
            .drop(bucket, local, "_off"))


def _by_quantiles(df: DataFrame, key: str, out: str, n: int) -> DataFrame:
    probs = [i / n for i in range(1, n)]
    bounds = sorted(set(df.approxQuantile(key, probs, 1.0 / (4 * n)))) if n > 1 else []
    splits = [float("-inf")] + [b for b in bounds if b not in (float("-inf"), float("inf"))] + [float("inf")]
    keyed = df.withColumn("_kd", F.coalesce(F.col(key).cast("double"), F.lit(0.0)))
    if len(splits) > 2:
        bucketed = Bucketizer(splits=splits, inputCol="_kd", outputCol="_bd", handleInvalid="keep").transform(keyed)
    else:
        bucketed = keyed.withColumn("_bd", F.lit(0.0))
    # NULL keys sort first (ascending default), so they get the bucket before all others.
    bucketed = (bucketed.withColumn("_b", F.when(F.col(key).isNull(), F.lit(-1))
                                    .otherwise(F.col("_bd").cast("int")))
                .drop("_kd", "_bd"))
    local = F.row_number().over(Window.partitionBy("_b").orderBy(F.col(key).asc_nulls_first())) - 1
    return _with_offsets(bucketed.withColumn("_local", local.cast("long")), "_b", "_local", out)


def _by_ranges(df: DataFrame, order_cols: list, out: str, n: int) -> DataFrame:
    checkpoint_root(df.sparkSession)
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33))
              .checkpoint(eager=True))
    return _with_offsets(ranged, "_pid", "_local", out)


def global_row_number(df: DataFrame, order_cols: list, out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: the 0-based position of each row in the total order of ``order_cols``.

    The order columns must form a unique key for the numbering to be deterministic
    (the same rule a global ``row_number()`` needs).
    """
    n = _partitions(df, num_partitions)
    key = _single_numeric_key(df, order_cols)
    if key is not None:
        return _by_quantiles(df, key, out, n)
    return _by_ranges(df, order_cols, out, n)


def running_counts(df: DataFrame, order_cols: list, **flags: Column) -> DataFrame:
    """Add one column per flag: the rows with that flag that come before each row in the total order of ``order_cols``.

    Rows are dealt by ranges of the order (one per shuffle partition of the session) and written once; flags are
    counted inside each range and shifted by the counts of earlier ranges. Give it narrow rows.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select("*", *[F.coalesce(flag.cast("long"), F.lit(0)).alias(f"_{name}") for name, flag in flags.items()])
    dealt = stage(dealt.repartitionByRange(ranges, *order_cols).withColumn("_range", F.spark_partition_id()), "ranges")
    so_far = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sums = dealt.groupBy("_range").agg(*[F.sum(f"_{name}").alias(f"_{name}") for name in flags])
    before = sums.select("_range", *[F.coalesce(F.sum(f"_{name}").over(so_far), F.lit(0)).alias(f"_before_{name}") for name in flags])
    inside = Window.partitionBy("_range").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    counted = dealt.select(*df.columns, "_range", *[F.coalesce(F.sum(f"_{name}").over(inside), F.lit(0)).alias(f"_in_{name}") for name in flags])
    return counted.join(F.broadcast(before), "_range").select(
        *df.columns, *[(F.col(f"_before_{name}") + F.col(f"_in_{name}")).alias(name) for name in flags])


def chunk_rows(df: DataFrame, order_cols: list, size: int = 10,
               num_partitions: int | None = None) -> DataFrame:
    """W1 + W2: consecutive groups of ``size`` rows; ``chunk_id`` from 0, ``entry_no`` 1..size."""
    numbered = global_row_number(df, order_cols, "_rn", num_partitions)
    return (numbered.withColumn("chunk_id", F.floor(F.col("_rn") / size).cast("long"))
            .withColumn("entry_no", (F.col("_rn") % size + 1).cast("int"))
            .drop("_rn"))
