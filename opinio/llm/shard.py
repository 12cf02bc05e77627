"""Sharding by balanced label propagation (operator 6), DataFrame functions only.

Law ``rows``: the counts of any two shards differ by at most one. Documents start in shards by hash order.
In each round every group of equal texts asks for the shard where most of its members are. A member that is
elsewhere moves there in exchange for, first, a member of another group that wants the opposite move, then a
document without links, then any other member that is not in its own group's shard (so circles close over
the rounds). Every quota holds after every round. Members in their group's shard stay, so each exchange
raises the number of these; rounds go on until one makes no exchange. Groups larger than an eighth of a shard are cut into parts of that size, which take shards in turn;
only their parts are kept together.

Scale. Texts are read once (size, CRC, md5 as the link key); the rounds join a few numbers per document. A
text that a third of all rows share is counted by partial aggregation and handled as many parts. Exchanges
are matched inside cells of a few hundred documents of a shard, fewer cells as fewer wait, and ranks are numbered inside hash buckets
whose counts give the offsets, so no window holds a shard or a large group.

Defined results. A NULL text has no bytes (size 16, CRC 0) and no links. Rows are told apart by position, so
repeated rows and NULL ids are placed one by one. An empty table gives an empty result. Only doc_id and text
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import stage

SHARDS = 40
#: Rows of a numbering bucket and of an exchange cell, on average; buckets summed at once.
BUCKET_ROWS, CELL_ROWS, BUCKETS_AT_ONCE = 4096, 512, 4096


def number_rows(df: DataFrame, rows: int, order: Column, *within: str) -> DataFrame:
    """Add ``rank``: gapless from 0 inside each value of ``within``, in the order of hash buckets.

    Rows are counted per bucket; offsets are sums over runs of buckets, then over the buckets of a run.
    """
    buckets = max(1, -(-rows // BUCKET_ROWS))
    df = df.withColumn("_bucket", F.pmod(order, F.lit(buckets)).cast("int"))
    counts = stage(df.groupBy(*within, "_bucket").agg(F.count("*").alias("_n"))
                   .withColumn("_run", F.expr(f"_bucket div {BUCKETS_AT_ONCE}")), "bucket-counts")
    runs = counts.groupBy(*within, "_run").agg(F.sum("_n").alias("_n"))
    whole = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*within, "_run", F.coalesce(F.sum("_n").over(whole), F.lit(0)).alias("_before_run"))
    part = Window.partitionBy(*within, "_run").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(part), F.lit(0)))
               .join(runs, [*within, "_run"])
               .select(*within, "_bucket", (F.col("_before") + F.col("_before_run")).alias("_offset")))
    place = F.row_number().over(Window.partitionBy(*within, "_bucket").orderBy(order, "rid")) - 1
    return (df.withColumn("_place", place).join(offsets, [*within, "_bucket"])
            .withColumn("rank", F.col("_offset") + F.col("_place")).drop("_bucket", "_place", "_offset"))


def _swaps(ask: DataFrame, give: DataFrame, *more: str) -> DataFrame:
    """(rid, to, other, back): the k-th that asks for a shard against the k-th that can leave it, by cell (and ``more``)."""
    place = F.row_number().over(Window.partitionBy("at", "cell", *more).orderBy("rid"))
    ask = ask.withColumn("at", F.col("target")).withColumn("k", place)
    give = give.withColumn("at", F.col("shard")).withColumn("k", place).select(F.col("rid").alias("other"), "at", "cell", "k", *more)
    return stage(ask.join(give, ["at", "cell", "k", *more])
                 .select("rid", F.col("target").alias("to"), "other", F.col("shard").alias("back")), "swaps")


def _round(state: DataFrame, shards: int, number: int) -> DataFrame | None:
    """One round: (rid, link, part, turn, shard) with the exchanges made; None when there was none to make."""
    linked = state.where("link is not null")
    there = linked.groupBy("link", "part", "turn", "shard").agg(F.count("*").alias("n"))
    mode = F.max_by("shard", F.struct("n", F.xxhash64("link", "part", "shard")))
    wish = stage(there.groupBy("link", "part").agg(F.coalesce(F.max("turn"), mode).alias("target")), "wishes")
    movers = stage(linked.join(wish, ["link", "part"]).where("shard != target").select("rid", "shard", "target"), "movers")
    spare = state.where("link is null").select("rid", "shard")
    waiting = movers.count()
    if not waiting:
        return None

    def cell(rows: int):
        return F.pmod(F.xxhash64("rid", F.lit(number)), F.lit(max(1, rows // (shards * CELL_ROWS)))).cast("int")

    def rest(done: DataFrame) -> DataFrame:
        return movers.join(done.select("rid").unionByName(done.select(F.col("other").alias("rid"))), "rid", "left_anti")

    movers = movers.withColumn("cell", cell(waiting))
    up = movers.where("shard < target").withColumn("low", F.col("shard"))
    opposite = _swaps(up, movers.where("shard > target").withColumn("low", F.col("target")), "low")
    done = opposite
    with_cells = cell(max(waiting, spare.count()))
    done = done.unionByName(_swaps(rest(done).withColumn("cell", with_cells), spare.withColumn("cell", with_cells)))
    left = stage(rest(done).withColumn("asks", F.pmod(F.xxhash64("rid", F.lit(~number)), F.lit(2)) == 0), "left")
    done = done.unionByName(_swaps(left.where("asks").drop("asks"), left.where("not asks").drop("asks")))
    moves = stage(done.select("rid", "to").unionByName(done.select(F.col("other").alias("rid"), F.col("back").alias("to"))), "moves")
    if moves.isEmpty():
        return None
    return stage(state.join(moves, "rid", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"), "shards")


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per input row."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .select("doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                         F.md5(F.col("text").cast("binary")).alias("link"), F.monotonically_increasing_id().alias("rid")),
                 "documents")
    n = rows.count()
    ordered = number_rows(rows.select("rid", "doc_id", "link"), n, F.xxhash64("doc_id"))
    most = max(2, n // (shards * 8))
    groups = (rows.where("link is not null").groupBy("link").agg(F.count("*").alias("n")).where("n > 1")
              .select("link", F.ceil(F.col("n") / most).cast("int").alias("parts")))
    groups = stage(groups, "equal-texts")
    part = F.pmod(F.xxhash64("rid", F.lit(-1)), F.col("parts")).cast("int")
    turn = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("link") + F.col("part"), F.lit(shards)).cast("int"))
    state = stage(ordered.join(groups, "link", "left").withColumn("part", part).withColumn("turn", turn)
                  .select("rid", F.when(F.col("parts").isNotNull(), F.col("link")).alias("link"), "part", "turn",
                          F.pmod("rank", F.lit(shards)).cast("int").alias("shard")), "shards")
    number, moved = 0, state
    while moved is not None:
        state, number = moved, number + 1
        moved = _round(state, shards, number)
    placed = number_rows(state.select("rid", "shard"), max(1, n // shards), F.xxhash64("rid"), "shard")
    return (rows.join(placed, "rid")
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    F.col("rank").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "link"))
