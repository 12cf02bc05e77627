"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. All but
the last return the columns of ``documents``; the last returns the encoded corpus. ``run`` applies them.

The stages take whole texts and every row that their predecessor kept; rows with equal id and text are one
document from exact dedup on. There is no SQL for the encoding, so ``ORACLE_SQL`` is None and
``tests/llm/test_pipeline.py`` holds the rows against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinio.llm import bpe, exact, langid, minhash, mix
from opinio.llm.common import stage
from opinio.session import table_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go: NULL texts and texts without a letter (``und``), and every text when
    nothing can be learned because no row has a language. There is no threshold on the score."""
    return langid.keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space, the one with the smallest id stays."""
    return exact.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8 or more)."""
    return minhash.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them: weights 5, 2, 1 by source, at most three times; the last
    document that a source's target reaches counts when at least half of it is taken. Texts without words go."""
    return mix.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digests of ids and decoded text."""
    encoded = bpe.bpe(docs, bpe.load(public_tokenizers.path("word_bpe_49k.json")))
    return bpe.digests(encoded, "ids")


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("minhash_dedup", near_copies),
    ("mix_sources", mixture),
    ("bpe_encode", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
