"""Source and sink round trips (S1, S2, S4, S5, K1-K5). Scratch folders live under the
session's ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.operators import feed, merge, replies
from opinio.plans.registry import query
from opinio.session import scratch_path, stage
from opinio.sources import files, fixtures, tables


def _with_via(posts):
    return posts.withColumn("via", F.coalesce("via", F.lit("无")))


def _posts_csv_rows(spark, sf_dir):
    p = _with_via(fixtures.posts(spark, sf_dir))
    return files.to_csv_columns(p, files.POST_COLUMNS)


@query("src_posts_csv")
def q_src_posts_csv(spark, sf_dir):
    """The crawl CSV written and read back (header, quoted multi-line bodies)."""
    path = scratch_path(spark, "posts-csv")
    files.write_csv(_posts_csv_rows(spark, sf_dir), path)
    return files.read_csv(spark, path, files.POSTS_CSV_SCHEMA)


def _aligned(spark, sf_dir):
    """The labels of both kinds with their bodies, which join at the end and are dealt out once."""
    e = fixtures.entry_rows(spark, sf_dir)
    labels = stage(replies.align_labels(e.rows, replies.parse_replies(fixtures.replies(e.rows)), "_row"), "labels")
    return stage(labels.join(e.bodies, "_row").drop("_row"), "aligned")


@query("src_label_csv")
def q_src_label_csv(spark, sf_dir):
    """The two label CSVs written and read back with explicit schemas."""
    a = _aligned(spark, sf_dir)
    sp, tp = scratch_path(spark, "sentiment-csv"), scratch_path(spark, "topic-csv")
    files.write_csv(files.to_csv_columns(replies.sentiment_table(a), files.SENTIMENT_COLUMNS), sp)
    files.write_csv(files.to_csv_columns(replies.topic_table(a), files.TOPIC_COLUMNS), tp)
    s = files.read_csv(spark, sp, files.SENTIMENT_CSV_SCHEMA)
    t = files.read_csv(spark, tp, files.TOPIC_CSV_SCHEMA)
    return (s.select(F.lit("sentiment").alias("kind"), "entry_no", "body", F.col("sentiment").alias("label"))
            .unionByName(t.select(F.lit("topic").alias("kind"), "entry_no", "body", F.col("topics").alias("label"))))


def _benchmark_files(spark, sf_dir, label, extension):
    """A flat folder with one file per benchmark item."""
    b = tables.benchmark(spark, sf_dir, "item_id", "text")
    name = F.concat(F.lit("item_"), F.col("item_id").cast("string"), F.lit(extension))
    path = scratch_path(spark, label)
    files.write_files(b.select(name.alias("name"), F.encode("text", "UTF-8").alias("content")), path)
    return path


def _template_files(spark, sf_dir):
    """The items' templates, and one damaged file (no valid UTF-8) per document language."""
    path = _benchmark_files(spark, sf_dir, "templates", ".txt")
    langs = tables.documents(spark, sf_dir, "lang").where("lang is not null").distinct()
    files.write_files(langs.select(F.concat(F.lit("lang_"), F.col("lang"), F.lit(".txt")).alias("name"),
                                   F.concat(F.unhex(F.lit("FF")), F.encode("lang", "UTF-8")).alias("content")), path)
    return path


def _wanted_names(spark, sf_dir):
    """Every benchmark item, plus one template per document language (never readable)."""
    items = tables.benchmark(spark, sf_dir, "item_id").select(
        F.concat(F.lit("item_"), F.col("item_id").cast("string")).alias("name"))
    langs = tables.documents(spark, sf_dir, "lang").select(F.concat(F.lit("lang_"), F.col("lang")).alias("name"))
    return items.unionByName(langs).distinct()


@query("templates_with_default")
def q_templates_with_default(spark, sf_dir):
    """A flat folder of text files; what cannot be read reads as the default text."""
    path = _template_files(spark, sf_dir)
    return files.templates_with_default(_wanted_names(spark, sf_dir), files.read_templates(spark, path))


@query("image_parts")
def q_image_parts(spark, sf_dir):
    """S5 + F18: message parts with the file as a base64 image, text only when unreadable."""
    path = _benchmark_files(spark, sf_dir, "images", ".jpg")
    reqs = _wanted_names(spark, sf_dir).withColumn("text", F.concat(F.lit("describe "), F.col("name")))
    m = files.message_parts(reqs, files.read_images(spark, path))
    return m.select("name", "text", F.size("parts").cast("long").alias("n_parts"),
                    F.get(F.col("parts"), 1)["url"].alias("image_url"))


def _owned(schema):
    """A CSV schema with the partition columns of an appended table."""
    return T.StructType(schema.fields + [T.StructField("run_id", T.StringType()), T.StructField("part_id", T.StringType())])


def _append_parts(rows, path):
    """Append the rows part by part, as an hourly crawl does, and the second part once more."""
    parts = [r[0] for r in rows.select("part_id").distinct().orderBy("part_id").collect()]  # a few, chosen by the caller
    for part in [*parts, *parts[1:2]]:
        files.append_csv(rows.where(F.col("part_id") == part), path)


@query("sink_append_posts")
def q_sink_append_posts(spark, sf_dir):
    """K1: two runs in one CSV table, each appended in parts (thirds of the day; odd and even pages), one part of
    each written again; read back."""
    path = scratch_path(spark, "posts-append")
    third = F.coalesce(F.expr("hour(posted_at) div 8").cast("string"), F.lit("none"))
    posts = stage(fixtures.posts(spark, sf_dir), "posts")  # both runs read them

    def owned(rows, run, part):
        return rows.select(*[F.col(internal).alias(header) for header, internal in files.POST_COLUMNS],
                           F.lit(run).alias("run_id"), part.alias("part_id"))

    _append_parts(owned(_with_via(posts), "table", third), path)
    feed_rows = owned(feed.extract_posts(fixtures.pages_of(posts)), "feed", (F.col("page_id") % 2).cast("string"))
    _append_parts(stage(feed_rows, "append-feed"), path)  # extracted once
    return files.read_csv(spark, path, _owned(files.POSTS_CSV_SCHEMA))


@query("sink_append_labels")
def q_sink_append_labels(spark, sf_dir):
    """K2 + K3: sentiment and topic rows appended in parts (every third chunk), one part twice; read back."""
    a = _aligned(spark, sf_dir)
    part = (F.col("chunk_id") % 3).cast("string").alias("part_id")
    out = []
    for kind, table, columns, schema, label in (
            ("sentiment", replies.sentiment_table(a), files.SENTIMENT_COLUMNS, files.SENTIMENT_CSV_SCHEMA, "sentiment"),
            ("topic", replies.topic_table(a), files.TOPIC_COLUMNS, files.TOPIC_CSV_SCHEMA, "topics")):
        path = scratch_path(spark, f"{kind}-append")
        _append_parts(table.select(*[F.col(internal).alias(header) for header, internal in columns], "run_id", part), path)
        back = files.read_csv(spark, path, _owned(schema))
        out.append(back.select("run_id", "part_id", F.lit(kind).alias("kind"), "entry_no", "body", F.col(label).alias("label")))
    return out[0].unionByName(out[1])


AGG_SCHEMA = T.StructType([T.StructField("topics", T.StringType()), T.StructField("negative", T.LongType()),
                           T.StructField("neutral", T.LongType()), T.StructField("positive", T.LongType()),
                           T.StructField("total", T.LongType())])


@query("sink_overwrite_merged")
def q_sink_overwrite_merged(spark, sf_dir):
    """K4 + K5: the merged table and the topic x sentiment table overwritten, read back."""
    a = _aligned(spark, sf_dir)
    t = replies.topic_table(a).select("entry_no", "body", "topics")
    s = replies.sentiment_table(a).select("entry_no", "body", "sentiment")
    merged = merge.merge_labels(t, s)
    mp, ap = scratch_path(spark, "merged"), scratch_path(spark, "aggregated")
    files.write_csv(merged, mp)
    reread = files.read_csv(spark, mp, T.StructType([
        T.StructField("entry_no", T.IntegerType()), T.StructField("body", T.StringType()),
        T.StructField("topics", T.StringType()), T.StructField("sentiment", T.StringType()),
        T.StructField("n", T.LongType())]))
    agg = merge.topic_sentiment_counts(merge.topic_mentions(merge.clean_merged(reread)))
    out = agg.select(F.col("topic").alias("topics"), "negative", "neutral", "positive", "total")
    # a first version (the documents' native labels) is replaced by the second
    from opinio.plans.q_labels import q_topic_sentiment
    first = q_topic_sentiment(spark, sf_dir).select(F.col("topic").alias("topics"), "negative", "neutral",
                                                    "positive", "total")
    files.write_csv(first, ap)
    files.write_csv(out, ap)
    return files.read_csv(spark, ap, AGG_SCHEMA)
