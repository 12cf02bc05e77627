"""Structured Streaming jobs.

Every job reads files landed in a folder, runs with ``availableNow`` and a
checkpoint, and writes through ``foreachBatch`` into a table partitioned by
``batch_id``; a batch rewrites only its own partition, so a batch replayed after
a failure replaces its earlier output (idempotent). A restart resumes from the
checkpoint, including the aggregation state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.operators import labelers, replies
from opinio.streaming import state

BatchFn = Callable[[DataFrame, int], None]


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent per-batch output: ``path/batch_id=<id>`` is overwritten as a whole."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def run_available(stream: DataFrame, fn: BatchFn, checkpoint: str, output_mode: str = "append") -> list:
    """Process everything landed so far, then stop (state kept in ``checkpoint``); the progress of its batches."""
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q.recentProgress


def land(df: DataFrame, folder: str) -> None:
    """Append a part to a landing folder (a new set of files, as an uploader would)."""
    df.write.mode("append").parquet(folder)


def land_lines(lines: DataFrame, folder: str) -> None:
    """Append text lines to a landing folder."""
    lines.write.mode("append").text(folder)


REQUEST_SCHEMA = "request_id long, requested_at timestamp_ntz, reply string, _corrupt_record string"


def read_landed_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests as they arrive, one JSON object a line; ``_corrupt_record`` holds a line that is none."""
    return (spark.readStream.schema(REQUEST_SCHEMA).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(folder))


def read_landed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


# ---------------------------------------------------------------- T1: hourly counts

def hourly_counts(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Events per hour window; event time cast to ``timestamp`` for the watermark."""
    et = events.withColumn("et", F.col("ts").cast("timestamp"))
    return (et.withWatermark("et", watermark)
            .groupBy(F.window("et", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("win_start"), "n"))


# ------------------------------------------------------------------- T4: late rows

def split_late(out_path: str, late_path: str, max_path: str, delay_seconds: int, ts_col: str = "ts") -> BatchFn:
    """T4: rows older than (latest event time of earlier batches - delay) go to a side table.

    This is the watermark rule made visible: Spark drops such rows silently from
    stateful operators; here they are kept, in their own table.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Every batch writes its row, so only the first one has nothing to read; any failed read is an error.
        prev = None if batch_id == 0 else (spark.read.parquet(max_path).where(F.col("batch_id") < batch_id)
                                           .agg(F.max("max_ts").alias("m")).first()["m"])
        b = batch.persist()
        if prev is None:
            on_time, late = b, b.where(F.lit(False))
        else:
            cut = F.lit(prev).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                                         F.lit(delay_seconds))
            on_time, late = b.where(F.col(ts_col) >= cut), b.where(F.col(ts_col) < cut)
        write_batch(on_time, out_path, batch_id)
        write_batch(late, late_path, batch_id)
        write_batch(b.agg(F.max(ts_col).alias("max_ts")), max_path, batch_id)
        b.unpersist()
    return fn


def _in_window(time: Column) -> Column:
    return time.between(F.col("win_start").cast("timestamp"), F.col("win_end").cast("timestamp"))


def rows_in_time(stream: DataFrame, asked: DataFrame, key: str, delay: str, ts_col: str = "ts") -> DataFrame:
    """T4: of a stream of (request_id, ``key``, ``ts_col``, ...) the first row of every (request_id, ``key``) that lies in
    the window its request asked for, both ends closed, and comes before the watermark has passed it.

    ``asked`` is (request_id, win_start, win_end), one row per request. Every row of a request moves the watermark,
    in the window or not. Keys are remembered until the watermark is ``delay`` beyond their row.
    """
    et = (stream.where(F.col("request_id").isNotNull()).withColumn("_et", F.col(ts_col).cast("timestamp"))
          .withWatermark("_et", delay))
    inside = et.join(asked.select("request_id", "win_start", "win_end"), "request_id").where(_in_window(F.col("_et")))
    return inside.dropDuplicatesWithinWatermark(["request_id", key]).drop("_et", "win_start", "win_end")


def fates(landed: DataFrame, asked: DataFrame, in_time: DataFrame, key: str, ts_col: str = "ts") -> DataFrame:
    """T4: what became of all landed rows: (request_id, ``key``, ``ts_col``, n_rows, fate), a row per different one.

    ``outside``: not in the asked window, without a time, or of no request. ``on_time``: its key is in the output of
    ``rows_in_time``, once; the other ``n_rows`` - 1 are repeats, whenever they came. ``late``: in the window, but the
    watermark had passed it. Copies are counted before the joins.
    """
    rows = landed.groupBy("request_id", key, ts_col).agg(F.count(F.lit(1)).alias("n_rows"))
    came = in_time.select("request_id", key).distinct().withColumn("came", F.lit(True))
    rows = rows.join(asked.select("request_id", "win_start", "win_end"), "request_id", "left").join(came, ["request_id", key], "left")
    inside = F.coalesce(_in_window(F.col(ts_col).cast("timestamp")), F.lit(False))
    fate = F.when(~inside, F.lit("outside")).when(F.col("came"), F.lit("on_time")).otherwise(F.lit("late"))
    return rows.select("request_id", key, ts_col, "n_rows", fate.alias("fate"))


# ----------------------------------------------------------- T3: topic registry state

REGISTRY_KEYS, REGISTRY_VALUES = ["run_id", "topic"], ["first_chunk", "first_entry", "first_pos"]
REGISTRY_SCHEMA = "run_id string, topic string, first_chunk long, first_entry int, first_pos int"


def first_sightings(mentions: DataFrame) -> DataFrame:
    """T3, keyed state: the first sighting of every (run, topic) seen so far, in Spark's state store.

    In update mode a micro-batch puts out the topics that it mentions, with their first sighting over all batches;
    its work grows with the batch, not with the registry.
    """
    first = mentions.groupBy("run_id", "topic").agg(F.min(F.struct("chunk_id", "entry_idx", "topic_pos")).alias("f"))
    return first.select("run_id", "topic", F.col("f.chunk_id").alias("first_chunk"), F.col("f.entry_idx").alias("first_entry"),
                        F.col("f.topic_pos").alias("first_pos"))


def registry_table(spark: SparkSession, path: str, every: int = state.EVERY) -> state.StateTable:
    """The registry as a table: one row per (run, topic), however often a stream put it out."""
    return state.StateTable(spark, path, REGISTRY_SCHEMA, state.first_per_key(REGISTRY_KEYS, REGISTRY_VALUES), every)


# ------------------------------------------- M2 + M5 + T3: labelling with the growing list

#: Stands behind every chunk.
LAST_CHUNK = (1 << 63) - 1


def labelling_step(registry: state.StateTable, replies_path: str, fn: labelers.LabelFn, retries: int = labelers.RETRIES) -> BatchFn:
    """One round of topic labelling: a micro-batch of chunk texts (run_id, chunk_id, text) gets its replies.

    The prompts of a round show the topics that earlier rounds found, in first-seen order; the labeler is called
    with them; its replies are written, and the topics in them join the registry for the next round. With one
    chunk per round every chunk sees all chunks before it; more per round trade that for parallel calls. A chunk
    whose call fails is written as failed and adds nothing. A replayed round sees the same list and replaces its
    own replies and topics.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # to a round, every topic of the registry is an earlier one, whichever chunk it came from
        asking = batch.select("run_id", F.lit(LAST_CHUNK).alias("chunk_id")).distinct()
        lists = replies.topics_visible(asking, registry.read(before=batch_id)).drop("chunk_id")
        prompts = replies.chunk_prompts(batch, batch.select("run_id", "chunk_id").join(lists, "run_id"))
        answers = labelers.label_with(prompts.withColumnRenamed("prompt", "text"), fn, "topic", retries)
        write_batch(answers, replies_path, batch_id)
        answers = spark.read.parquet(f"{replies_path}/batch_id={batch_id}")
        registry.write(first_sightings(replies.topic_mentions_all(replies.parse_replies(answers))), batch_id)

    return step
