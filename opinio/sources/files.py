"""File sources and sinks.

CSV follows the source program's files: a header row, RFC-4180 quoting with
doubled quotes, bodies with embedded newlines (so ``multiLine`` on read), no
whitespace trimming. Columns are read positionally against an explicit schema
(the header carries the original column names).
"""

from __future__ import annotations

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source program's CSV column names, with our internal names.
POST_COLUMNS = [
    ("页码", "page_no"), ("微博昵称", "author"), ("发布时间", "posted_raw"), ("微博来源", "via"),
    ("转发数", "reposts_raw"), ("评论数", "comments_raw"), ("点赞数", "likes_raw"), ("微博正文", "body"),
]
SENTIMENT_COLUMNS = [("编号", "entry_no"), ("微博正文", "body"), ("sentiment", "sentiment")]
TOPIC_COLUMNS = [("编号", "entry_no"), ("微博正文", "body"), ("topics", "topics")]
# The text used when a template file cannot be read.
DEFAULT_TEMPLATE = "默认系统提示信息"
IMAGE_URL_PREFIX = "data:image/jpeg;base64,"

POSTS_CSV_SCHEMA = T.StructType([
    T.StructField("page_no", T.IntegerType()), T.StructField("author", T.StringType()),
    T.StructField("posted_raw", T.StringType()), T.StructField("via", T.StringType()),
    T.StructField("reposts_raw", T.StringType()), T.StructField("comments_raw", T.StringType()),
    T.StructField("likes_raw", T.StringType()), T.StructField("body", T.StringType()),
])
SENTIMENT_CSV_SCHEMA = T.StructType([
    T.StructField("entry_no", T.IntegerType()), T.StructField("body", T.StringType()),
    T.StructField("sentiment", T.StringType())])
TOPIC_CSV_SCHEMA = T.StructType([
    T.StructField("entry_no", T.IntegerType()), T.StructField("body", T.StringType()),
    T.StructField("topics", T.StringType())])

_WRITE_OPTS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "encoding": "UTF-8"}
_READ_OPTS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "encoding": "UTF-8",
              "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "mode": "FAILFAST"}


def to_csv_columns(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Internal names -> the CSV header names, in the CSV's column order."""
    return df.select(*[F.col(internal).alias(header) for header, internal in columns])


# A quoted multi-line file is read by one task, so files are kept small on the write side.
RECORDS_PER_FILE = 100_000


def write_csv(df: DataFrame, path: str) -> None:
    """K4 + K5: replace the whole table."""
    df.write.mode("overwrite").options(**_WRITE_OPTS).option("maxRecordsPerFile", RECORDS_PER_FILE).csv(path)


def append_csv(df: DataFrame, path: str, owners: tuple[str, ...] = ("run_id", "part_id")) -> None:
    """K1-K3: append one or more parts (an hour, a chunk) of a run to a CSV table.

    The table is partitioned by ``owners``: a part written again replaces its own rows and no others, so a repeated
    append (a retried batch) leaves every row once, and later parts leave the earlier ones as they are.
    """
    (df.write.mode("overwrite").options(**_WRITE_OPTS).option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*owners).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Positional read against ``schema`` (the header row is skipped, not trusted)."""
    return spark.read.options(**_READ_OPTS).schema(schema).csv(path)


def write_files(df: DataFrame, path: str, name_col: str = "name", content_col: str = "content") -> None:
    """One file per row in one flat folder, named by ``name_col`` (with its extension); ``content_col`` is binary.

    Every task writes the files of its own rows, so a task that is run again writes the same files again.
    """
    def run(rows) -> None:
        folder, top = pafs.FileSystem.from_uri(path)
        folder.create_dir(top)
        for row in rows:
            with folder.open_output_stream(f"{top}/{row[0]}") as out:
                out.write(bytes(row[1]))

    df.select(name_col, content_col).foreachPartition(run)


# Files that cannot be read (damaged, or gone since they were listed) are left out.
_LENIENT = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}


def _file_name(df: DataFrame) -> Column:
    """The name of each row's file without its extension, or of its ``name=`` folder."""
    if "name" in df.columns:
        return F.col("name").cast("string")
    return F.regexp_replace("_metadata.file_name", r"\.[A-Za-z0-9]{1,4}$", "")


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """(name, body) - each file of a folder whole; NULL for a file that is not text (no valid UTF-8)."""
    df = spark.read.options(**_LENIENT).text(path, wholetext=True)
    return df.select(_file_name(df).alias("name"), F.when(F.is_valid_utf8("value"), F.col("value")).alias("body"))


def templates_with_default(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """Every wanted name gets its file text, or the default text when there is none."""
    j = wanted.select("name").join(found, "name", "left")
    return j.select("name", F.coalesce(F.col("body"), F.lit(DEFAULT_TEMPLATE)).alias("body"),
                    F.col("body").isNull().alias("is_default"))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(name, b64) - the bytes of every readable file of a folder as base64."""
    df = spark.read.options(**_LENIENT).format("binaryFile").load(path)
    return df.select(_file_name(df).alias("name"), F.replace(F.base64("content"), F.lit("\r\n"), F.lit("")).alias("b64"))


def message_parts(requests: DataFrame, images: DataFrame) -> DataFrame:
    """a text part, plus an image part when the image could be read (else text only)."""
    j = requests.join(images, "name", "left")
    text_part = F.struct(F.lit("text").alias("type"), F.col("text").alias("text"),
                         F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("detail"))
    img_part = F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
                        F.concat(F.lit(IMAGE_URL_PREFIX), F.col("b64")).alias("url"), F.lit("high").alias("detail"))
    parts = F.when(F.col("b64").isNotNull(), F.array(text_part, img_part)).otherwise(F.array(text_part))
    return j.select("name", "text", parts.alias("parts"))
