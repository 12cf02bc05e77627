"""Native labelers (M1 sentiment, M2 topics) and the per-partition labeler hook (M5).

The hosted model of the source program is re-aimed as rules that run inside Spark:

* sentiment: tokens scored against a lexicon (term, weight); the sign of the sum is the label, no hit is
  neutral;
* topics: tokens matched against a taxonomy (topic, term), repeated rows counting once; a topic is kept when
  at least ``min_hits`` of its terms occur, topics sorted, distinct.

There are two methods with the same answers; the caller chooses by the size of the dimension:

* ``label_sentiment`` / ``label_topics`` / ``label_posts`` turn the dimension into a map literal, so posts are
  labelled in one narrow projection (also on a stream). A dimension of over ``MAP_TERMS`` terms is an error.
* ``label_sentiment_by_join`` / ``label_topics_by_join`` explode the tokens and join them to a dimension of any
  size. Rows are told apart by a row id of their own, so keys may be NULL, repeated or absent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.text import CALL_FAILED_PREFIX, tokens
from opinio.session import stage

# The most terms a dimension may have as a map literal; beyond it the caller takes the join method.
MAP_TERMS = 20_000

SENTIMENTS = ("negative", "neutral", "positive")


def _map_literal(keys: list, values: list, value_type: str) -> Column:
    if not keys:
        return F.create_map().cast(f"map<string,{value_type}>")
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*values))


def _bounded(df: DataFrame) -> list:
    """The rows of a dimension, at most ``MAP_TERMS``; a larger one is an error, not another answer."""
    rows = df.limit(MAP_TERMS + 1).collect()
    if len(rows) > MAP_TERMS:
        raise ValueError(f"over {MAP_TERMS} terms: use the labeler that joins")
    return sorted(rows, key=lambda r: (r["term"] is None, r["term"]))


def lexicon_map(lexicon: DataFrame) -> Column:
    """term -> summed weight as a map literal (one bounded collect)."""
    rows = _bounded(lexicon.where("term is not null").groupBy("term").agg(F.sum("weight").alias("w")))
    return _map_literal([r["term"] for r in rows], [F.lit(float(r["w"] or 0)) for r in rows], "double")


def taxonomy_map(taxonomy: DataFrame) -> Column:
    """term -> sorted distinct topics as a map literal (one bounded collect)."""
    rows = _bounded(taxonomy.where("term is not null").groupBy("term")
                    .agg(F.array_sort(F.collect_set("topic")).alias("topics")))
    return _map_literal([r["term"] for r in rows], [F.array(*[F.lit(t) for t in r["topics"]]).cast("array<string>")
                                                    for r in rows], "array<string>")


def sentiment_of(score: Column) -> Column:
    """positive / neutral / negative by the sign of ``score`` (NULL counts as 0); one evaluation of ``score``."""
    labels = F.array(*[F.lit(s) for s in SENTIMENTS])
    return F.element_at(labels, (F.signum(F.coalesce(score, F.lit(0.0))) + 2).cast("int"))


def _score(toks: Column, lex: Column) -> Column:
    hits = F.filter(toks, lambda t: F.map_contains_key(lex, t))
    return F.aggregate(F.transform(hits, lambda t: F.element_at(lex, t)), F.lit(0.0), lambda a, x: a + x)


def _topics(toks: Column, tax: Column, min_hits: int) -> Column:
    hit_terms = F.filter(toks, lambda t: F.map_contains_key(tax, t))
    hits = F.flatten(F.transform(hit_terms, lambda t: F.element_at(tax, t)))
    if min_hits <= 1:
        topics = F.array_sort(F.array_distinct(hits))
    else:
        topics = F.array_sort(F.filter(
            F.array_distinct(hits), lambda x: F.size(F.filter(hits, lambda y: y == x)) >= min_hits))
    # a NULL text has no tokens, hence no topics (as on the join path)
    return F.coalesce(topics, F.array().cast("array<string>"))


def label_sentiment(df: DataFrame, lexicon: DataFrame, text_col: str = "body", out: str = "sentiment") -> DataFrame:
    """M1: add ``out`` (positive / neutral / negative) from a (term, weight) lexicon."""
    return df.withColumn(out, sentiment_of(_score(tokens(text_col), lexicon_map(lexicon))))


def label_topics(df: DataFrame, taxonomy: DataFrame, text_col: str = "body", out: str = "topics_arr",
                 min_hits: int = 1) -> DataFrame:
    """M2: add ``out`` = sorted distinct topics with at least ``min_hits`` term hits."""
    return df.withColumn(out, _topics(tokens(text_col), taxonomy_map(taxonomy), min_hits))


def label_posts(df: DataFrame, lexicon: DataFrame, taxonomy: DataFrame, text_col: str = "body",
                min_hits: int = 1) -> DataFrame:
    """Both labels in one pass: the tokens found in either dimension are kept in a helper column that both
    labels read, so the long token array of a document is built only once."""
    lex, tax = lexicon_map(lexicon), taxonomy_map(taxonomy)
    hits = F.filter(tokens(text_col), lambda t: F.map_contains_key(lex, t) | F.map_contains_key(tax, t))
    return (df.withColumn("_hits", hits)
            .withColumn("sentiment", sentiment_of(_score(F.col("_hits"), lex)))
            .withColumn("topics_arr", _topics(F.col("_hits"), tax, min_hits))
            .drop("_hits"))


def _with_row(df: DataFrame) -> DataFrame:
    """Rows with an id that stays the same however often the plan reads them."""
    return stage(df.withColumn("_row", F.monotonically_increasing_id()), "label-rows")


def label_sentiment_by_join(df: DataFrame, lexicon: DataFrame, text_col: str = "body",
                            out: str = "sentiment") -> DataFrame:
    """M1 for a lexicon of any size."""
    rows = _with_row(df)
    weights = lexicon.where("term is not null").groupBy("term").agg(F.sum("weight").cast("double").alias("_weight"))
    scores = (rows.select("_row", F.explode(tokens(text_col)).alias("term")).join(weights, "term")
              .groupBy("_row").agg(F.sum("_weight").alias("_score")))
    return rows.join(scores, "_row", "left").withColumn(out, sentiment_of(F.col("_score"))).drop("_score", "_row")


def label_topics_by_join(df: DataFrame, taxonomy: DataFrame, text_col: str = "body", out: str = "topics_arr",
                         min_hits: int = 1) -> DataFrame:
    """M2 for a taxonomy of any size."""
    rows = _with_row(df)
    terms = taxonomy.where("term is not null and topic is not null").select("term", "topic").distinct()
    topics = (rows.select("_row", F.explode(tokens(text_col)).alias("term")).join(terms, "term")
              .groupBy("_row", "topic").count().where(F.col("count") >= min_hits)
              .groupBy("_row").agg(F.array_sort(F.collect_list("topic")).alias("_topics")))
    return (rows.join(topics, "_row", "left")
            .withColumn(out, F.coalesce(F.col("_topics"), F.array().cast("array<string>"))).drop("_topics", "_row"))


# ---------------------------------------------------------------- M5: labeler hook

LabelFn = Callable[[pd.DataFrame], pd.DataFrame]

#: Calls made again for a chunk whose labeler raised.
RETRIES = 2


def _call_failed(reason) -> str:
    """The reply of a chunk whose call failed."""
    return f"{CALL_FAILED_PREFIX}：{reason}"


def _one_reply(fn: LabelFn, row: pd.DataFrame, retries: int) -> str:
    for left in range(retries, -1, -1):
        try:
            return str(fn(row)["reply"].iloc[0])
        except Exception as err:  # whatever a caller's function raises stays with its chunk
            if not left:
                return _call_failed(f"{type(err).__name__}: {err}")


def _replies(fn: LabelFn, rows: pd.DataFrame, retries: int) -> pd.DataFrame:
    """One reply per row. A batch that raises, or leaves chunks out, is called again chunk by chunk."""
    keys = ["run_id", "chunk_id"]
    try:
        found = rows[keys].merge(fn(rows)[[*keys, "reply"]].drop_duplicates(keys), on=keys, how="left")["reply"].tolist()
    except Exception:
        found = [None] * len(rows)
    return rows[keys].assign(reply=[r if isinstance(r, str) else _one_reply(fn, rows.iloc[k:k + 1], retries)
                                    for k, r in enumerate(found)])


def label_with(chunk_text: DataFrame, fn: LabelFn, kind: str, retries: int = RETRIES) -> DataFrame:
    """M5: run a caller-supplied labeler over chunk texts, one Arrow batch at a time.

    ``chunk_text`` has (run_id, chunk_id, text); ``fn`` maps a pandas frame with those columns to one with (run_id,
    chunk_id, reply). Output: the ``replies`` table shape (run_id, chunk_id, kind, reply). The work is spread over the
    partitions of ``chunk_text``; nothing goes through the driver.

    A chunk whose call raises, or that gets no reply, is called alone, ``retries`` times more; what fails then is a
    failed call's reply (P18) for that chunk only, and all other chunks keep theirs.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _replies(fn, pdf, retries).assign(kind=kind)[["run_id", "chunk_id", "kind", "reply"]]

    return chunk_text.select("run_id", "chunk_id", "text").mapInPandas(
        run, "run_id string, chunk_id long, kind string, reply string")
