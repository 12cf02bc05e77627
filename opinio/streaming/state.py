"""State tables of streaming jobs: a snapshot and the deltas after it.

Every micro-batch writes its delta under its own batch id. Every ``every`` batches the snapshot and the deltas since
become the next snapshot, so a read, and the work of a compaction, meets at most ``every`` deltas however long the
stream has run. Everything is safe to repeat: a replayed batch replaces its own delta, a replayed compaction starts from
the same earlier snapshot (the last one is kept until the next stands) and replaces its own result, and a snapshot
counts only once its writer has committed it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Combine = Callable[[DataFrame], DataFrame]

#: Batches between two snapshots.
EVERY = 10


def sum_per_key(keys: list[str], values: list[str]) -> Combine:
    """Counters: the sum of all deltas."""
    return lambda rows: rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values], F.max("version").alias("version"))


def last_per_key(keys: list[str], values: list[str]) -> Combine:
    """An update-mode log: the values of the last batch that named the key."""
    def combine(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "version").alias("_v"), F.max("version").alias("version"))
        return last.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values], "version")

    return combine


def first_per_key(keys: list[str], values: list[str]) -> Combine:
    """First sightings: the smallest values of the key."""
    def combine(rows: DataFrame) -> DataFrame:
        first = rows.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_v"), F.max("version").alias("version"))
        return first.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values], "version")

    return combine


@dataclass
class StateTable:
    """One table; ``schema`` without the column ``version`` (the batch that a row comes from) that it adds."""

    spark: SparkSession
    path: str
    schema: str
    combine: Combine
    every: int = EVERY

    def _full_schema(self) -> T.StructType:
        return T.StructType(T._parse_datatype_string(self.schema).fields + [T.StructField("version", T.LongType())])

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, kind: str) -> list[int]:
        """Batch ids of the committed folders of a kind (``delta`` or ``snapshot``)."""
        fs, path = self._fs(), self.spark._jvm.org.apache.hadoop.fs.Path
        if not fs.exists(path(f"{self.path}/{kind}")):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(f"{self.path}/{kind}"))]
        return sorted(int(n) for n in names if fs.exists(path(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def _rows(self, after: int, upto: int | None = None) -> DataFrame:
        """The snapshot ``after`` (none: -1) and all deltas behind it."""
        deltas = [n for n in self._numbers("delta") if n > after and (upto is None or n <= upto)]
        folders = [f"{self.path}/delta/{n}" for n in deltas] + ([f"{self.path}/snapshot/{after}"] if after >= 0 else [])
        reader = self.spark.read.schema(self._full_schema())
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], self._full_schema())

    def _snapshot(self, before: int | None = None) -> int:
        return max([n for n in self._numbers("snapshot") if before is None or n < before], default=-1)

    def write(self, delta: DataFrame, batch_id: int) -> None:
        """The delta of a batch; with every ``every``-th one a new snapshot."""
        columns = [f.name for f in self._full_schema().fields[:-1]]
        rows = delta.select(*columns).withColumn("version", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.path}/delta/{batch_id}")
        if (batch_id + 1) % self.every == 0:
            self._compact(batch_id)

    def _compact(self, batch_id: int) -> None:
        base = self._snapshot(before=batch_id)
        self.combine(self._rows(base, batch_id)).write.mode("overwrite").parquet(f"{self.path}/snapshot/{batch_id}")
        fs, path = self._fs(), self.spark._jvm.org.apache.hadoop.fs.Path
        for kind, last in (("delta", base), ("snapshot", base - 1)):  # what a replay of this batch does not need
            for n in self._numbers(kind):
                if n <= last:
                    fs.delete(path(f"{self.path}/{kind}/{n}"), True)

    def read(self, before: int | None = None) -> DataFrame:
        """One row per key, as of all batches (or of those before one, for a batch that reads what came earlier)."""
        upto = None if before is None else before - 1
        return self.combine(self._rows(self._snapshot(before), upto)).drop("version")

    def folders_read(self) -> int:
        base = self._snapshot()
        return sum(n > base for n in self._numbers("delta")) + (base >= 0)
