"""Language ID (operator 7): multinomial naive Bayes over hashed character n-grams.

Learning counts the hashed 1- to 3-grams of every learning document in numpy, one (language, bucket,
count) table per task, and Spark sums those tables. The log-probability matrix has one row per bucket
and one column per language (languages x ``BUCKETS`` numbers, whatever the corpus size) and is
broadcast. Scoring gathers the matrix rows of all n-grams of a batch and sums them by document.

Letters are folded to lower case, every other character to a space. Very long texts are cut into
pieces whose n-grams add up to those of the whole text.

Defined results. A NULL text or one without a letter is ``und`` with score 0; so is every text when
nothing could be learned. Rows with a NULL language or a NULL id are never learned from. Repeated
rows are scored (and counted) as often as they occur; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import packed

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
#: Characters scored at once.
PIECE = 1 << 18
UNKNOWN = "und"
_COUNTS = "lang string, bucket int, n long, docs long"


@lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """Lower-case code point of each letter of the first three planes, 32 for all else."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for cp in range(0x40000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of pieces: folded code points, and start and text number of each piece.

    A piece ends with up to two code points of look-ahead, marked by ``owned`` lengths.
    """
    look, codes, number, owned, held = ORDERS[-1] - 1, [], [], [], 0
    fold = _fold_table()

    def flush():
        lengths = np.array([len(c) for c in codes])
        return np.concatenate(codes), lengths, np.array(owned), np.array(number)

    for k, text in enumerate(texts):
        if not text:
            continue
        for a in range(0, len(text), PIECE):
            part = fold[np.frombuffer(text[a:a + PIECE + look].encode("utf-32-le"), dtype=np.uint32)]
            codes.append(part)
            number.append(k)
            owned.append(min(PIECE, len(text) - a))
            held += len(part)
            if held >= PIECE:
                yield flush()
                codes, number, owned, held = [], [], [], 0
    if codes:
        yield flush()


def _grams(code: np.ndarray, lengths: np.ndarray, owned: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the buckets of all n-grams of the pieces and the piece of each.

    An n-gram must start in the owned part and end inside the piece.
    """
    piece = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    at = np.arange(len(code)) - starts[piece]
    for n in ORDERS:
        h = np.full(len(code), n, dtype=np.uint64)
        for j in range(n):
            c = np.zeros(len(code), dtype=np.uint64)
            c[:len(code) - j] = code[j:]
            h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        ok = (at < owned[piece]) & (at + n <= lengths[piece])
        yield ((h >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int64)[ok], piece[ok]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for pdf in batches:
        for lang, part in pdf.groupby("lang"):
            table = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            docs[lang] = docs.get(lang, 0) + len(part)
            for code, lengths, owned, _ in _pieces(part["text"].tolist()):
                for bucket, _ in _grams(code, lengths, owned):
                    table += np.bincount(bucket, minlength=BUCKETS)
    for lang, table in counts.items():
        used = np.flatnonzero(table)
        if len(used):
            n_docs = np.zeros(len(used), dtype=np.int64)
            n_docs[0] = docs[lang]
            yield pd.DataFrame({"lang": lang, "bucket": used, "n": table[used], "docs": n_docs})


@dataclass
class LanguageModel:
    languages: list[str]
    log_p: np.ndarray      # BUCKETS x languages
    log_prior: np.ndarray  # languages


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of the documents that is never learned from; false for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Count over all learning documents; add-half smoothing over the buckets."""
    rows = (docs.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull()
                       & F.col(text_col).isNotNull())
            .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
    # At most languages x BUCKETS rows reach the driver.
    sums = (rows.mapInPandas(_count, _COUNTS).groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).toPandas())
    languages = sorted(sums["lang"].unique())
    table = np.full((BUCKETS, len(languages)), 0.5)
    column = {name: k for k, name in enumerate(languages)}
    np.add.at(table, (sums["bucket"].to_numpy(dtype=np.int64), sums["lang"].map(column).to_numpy(dtype=np.int64)),
              sums["n"].to_numpy(dtype=np.float64))
    n_docs = sums.groupby("lang")["docs"].sum().reindex(languages).to_numpy(dtype=np.float64)
    if not languages:
        return LanguageModel([], table, n_docs)
    return LanguageModel(languages, np.log(table / table.sum(axis=0)), np.log(n_docs / n_docs.sum()))


def score_texts(texts: list[str | None], model: LanguageModel) -> pd.DataFrame:
    """Predicted language and its posterior probability for each text."""
    n, k = len(texts), len(model.languages)
    total, letters = np.zeros((n, k)), np.zeros(n, dtype=bool)
    for code, lengths, owned, number in _pieces(texts):
        starts = np.cumsum(lengths) - lengths
        np.logical_or.at(letters, number, np.maximum.reduceat(code != 32, starts))
        if k:
            for bucket, piece in _grams(code, lengths, owned):
                if len(piece):
                    first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
                    np.add.at(total, number[piece[first]], np.add.reduceat(model.log_p[bucket], first, axis=0))
    if not k:
        return pd.DataFrame({"lang_pred": [UNKNOWN] * n, "score": np.zeros(n)})
    total += model.log_prior
    total -= total.max(axis=1, keepdims=True)
    best = total.argmax(axis=1)
    score = 1 / np.exp(total).sum(axis=1)
    names = np.array(model.languages, dtype=object)[best]
    names[~letters] = UNKNOWN
    return pd.DataFrame({"lang_pred": names, "score": np.where(letters, score, 0.0)})


def prediction(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> Column:
    """Struct column (lang_pred, score) from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield score_texts([t if isinstance(t, str) else None for t in texts], shared.value)

    return F.pandas_udf("lang_pred string, score double")(_typed(predict))(F.col(text_col))


def _typed(fn):
    """Spark reads the kind of a pandas UDF from evaluated type hints."""
    fn.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return fn


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learned from the rows that are not held out."""
    model = learn(docs)
    return (docs.select("doc_id", held_out().alias("held_out"), prediction(docs, model).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which a language is identified (only ``und`` goes, however sure the others are)."""
    model = learn(docs)
    return packed(docs, found=prediction(docs, model)).where(F.col("found.lang_pred") != UNKNOWN).select("row.*")
