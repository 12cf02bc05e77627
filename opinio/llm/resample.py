"""Target-distribution importance resampling (operator 11): length-bucketed CRC matrices.

The words of a text are its runs of ASCII letters, digits and non-ASCII characters after A-Z became a-z; its
features are all runs of ``RUNS`` consecutive words, joined by one space, repeats counted. The distinct features
of a batch are grouped by their number of bytes into two-dimensional uint8 arrays, one row each; the CRC-32 of
all rows is updated column by column, and the buckets (CRC modulo ``BUCKETS``) are scattered back to where the
features stand. Features longer than ``PIECE`` bytes are cut into a head and pieces of that length, which take
part as rows of their own; the CRCs of the pieces are joined by the linear map that appends ``PIECE`` zero bytes.

A bucket's gain is the log ratio of its smoothed shares in the target and in the corpus, a document's weight the
sum of the gains of its features. A Gumbel number that hangs on seed and doc_id alone is added, and the highest
scores are drawn: sampling without replacement in proportion to the weights, the same on every run.

Scale. Texts are read once: the staged table has two bytes per feature. Bucket counts are summed in each task
before they meet; ``BUCKETS`` gains are all that the driver sees and broadcasts. Ranks are numbered inside ranges
of the order (one per shuffle partition of the session), whose counts give the offsets; a row number closes the
order, so equal scores and repeated ids are split between ranges too. No window holds all rows but the one over
the ranges.

Defined results. NULL, empty and wordless texts have no features, weight 0, and are never drawn; they have a
score. A NULL doc_id hashes like the empty text and stands behind all ids. Repeated rows count each for itself;
among rows of equal id and score the one with more features stands first. Without documents the result is empty;
without target texts all gains come from smoothing alone. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import none_if_missing, pieces, stage

BUCKETS, RUNS, SEED = 10_000, (1, 1), 2024
#: Documents with fewer words are not drawn; percent of the others that are.
LEAST_WORDS, PERCENT = 20, 10
#: Bytes of the longest row of a matrix; characters of a batch; words that a worker remembers before it starts anew.
PIECE, BATCH_CHARS, REMEMBERED = 256, 1 << 20, 400_000

# Fixed value: the reversed polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(b if b in _WORD_BYTES else 0x20 for b in bytes(range(256)).lower())


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(_POLYNOMIAL), t >> 1)
    return t


_TABLE = _byte_table()


def _advance(crc: np.ndarray, column: np.ndarray | int) -> np.ndarray:
    return _TABLE[(crc ^ column) & 0xFF] ^ crc >> 8


def _append_tables() -> np.ndarray:
    """[byte place, byte]: what each byte of a CRC becomes when ``PIECE`` zero bytes follow (XOR of the four)."""
    out = np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    for _ in range(PIECE):
        out = _advance(out, 0)
    return out


_APPEND = _append_tables()


def _matrix_crcs(data: list[bytes]) -> np.ndarray:
    """CRC-32 of byte strings of at most ``PIECE`` bytes, by length."""
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    flat = np.frombuffer(b"".join(data), dtype=np.uint8)
    begin = np.cumsum(sizes) - sizes
    out = np.zeros(len(data), dtype=np.uint32)
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        columns = flat[begin[rows] + np.arange(n)[:, None]]
        crc = np.full(len(rows), _ONES)
        for column in columns:
            crc = _advance(crc, column)
        out[rows] = crc ^ _ONES
    return out


def crc32s(data: list[bytes]) -> np.ndarray:
    """Unsigned CRC-32 of each byte string."""
    long = [k for k, d in enumerate(data) if len(d) > PIECE]
    if not long:
        return _matrix_crcs(data)
    parts, first = list(data), {}
    for k in long:
        d, head = data[k], len(data[k]) % PIECE
        parts[k], first[k] = d[:head], len(parts)
        parts += [d[a:a + PIECE] for a in range(head, len(d), PIECE)]
    crcs = _matrix_crcs(parts)
    for k in long:
        crc, append = int(crcs[k]), _APPEND
        for other in crcs[first[k]:first[k] + len(data[k]) // PIECE].tolist():
            crc = int(append[0, crc & 255] ^ append[1, crc >> 8 & 255] ^ append[2, crc >> 16 & 255]
                      ^ append[3, crc >> 24]) ^ other
        crcs[k] = crc
    return crcs[:len(data)]


def feature_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(_FOLD).split()


class Buckets:
    """Buckets of the features of texts; remembers the words it has seen."""

    def __init__(self, buckets: int, runs: tuple[int, int]) -> None:
        self.buckets, self.runs, self.known = buckets, runs, {}

    def of(self, words: list[bytes]) -> np.ndarray:
        features = []
        for n in range(self.runs[0], self.runs[1] + 1):
            features += words if n == 1 else [b" ".join(words[k:k + n]) for k in range(len(words) - n + 1)]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = [f for f in set(features) if f not in self.known]
        if new:
            self.known.update(zip(new, (crc32s(new) % np.uint32(self.buckets)).tolist()))
        return np.fromiter(map(self.known.__getitem__, features), np.uint16, len(features))


def bucketed(texts: DataFrame, buckets: int = BUCKETS, runs: tuple[int, int] = RUNS) -> DataFrame:
    """id, n_words, n_features, features: the buckets of all features of every text, as little-endian uint16."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("a bucket number has two bytes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Buckets(buckets, runs)
        for whole in batches:
            for pdf in pieces(whole, "text", BATCH_CHARS):
                found = [feature_words(none_if_missing(t)) for t in pdf["text"]]
                features = _split_features(seen, found)
                yield pd.DataFrame({"id": pdf["id"].astype("Int64").to_numpy(), "n_words": [len(w) for w in found],
                                    "n_features": [len(f) for f in features],
                                    "features": [f.astype("<u2").tobytes() for f in features]})

    return texts.mapInPandas(run, "id long, n_words long, n_features long, features binary")


def _split_features(seen: Buckets, found: list[list[bytes]]) -> list[np.ndarray]:
    """The features of all texts of a batch; those of single words in one go."""
    if seen.runs != (1, 1):
        return [seen.of(w) for w in found]
    flat = seen.of([w for words in found for w in words])
    return np.split(flat, np.cumsum([len(w) for w in found])[:-1]) if found else []


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: summed in each task first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for pdf in batches:
            for data in pdf["features"]:
                total += np.bincount(np.frombuffer(data, dtype="<u2"), minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    return features.select("features").mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares) of each bucket, from the (bucket, n) of both sides."""
    both = [dict(map(tuple, side.collect())) for side in (corpus, target)]  # at most ``buckets`` rows each
    s, t = (np.array([side.get(b, 0) for b in range(buckets)], dtype=np.float64) for side in both)
    all_s, all_t = sum(both[0].values()), sum(both[1].values())
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features, weight, score of every text."""
    shared = features.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sums = [int(shared.value[np.frombuffer(f, dtype="<u2")].sum()) for f in pdf["features"]]
            yield pdf.drop(columns="features").assign(id=pdf["id"].astype("Int64"), weight=sums)

    return features.mapInPandas(run, "id long, n_words long, n_features long, weight long")


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + gumbel)


def numbered(rows: DataFrame, *order) -> DataFrame:
    """Add ``rank`` 1, 2, 3 ... in the order of the columns, which must tell all rows apart."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "ranges")
    so_far = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = (dealt.groupBy("range").agg(F.count("*").alias("n"))
              .select("range", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before")))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return (dealt.withColumn("place", place).join(F.broadcast(before), "range")
            .withColumn("rank", F.col("before") + F.col("place")).drop("range", "place", "before"))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        target_col: str = "text", buckets: int = BUCKETS, runs: tuple[int, int] = RUNS,
                        percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (NULL for what is not drawn) of every document."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = target.select(F.lit(None).cast("long").alias("id"), F.col(target_col).cast("string").alias("text"))
    features = stage(bucketed(src, buckets, runs), "features")
    gain = gains(bucket_counts(features, buckets), bucket_counts(bucketed(wanted, buckets, runs), buckets), buckets)
    rows = stage(with_score(weighted(features, gain), seed).withColumn("row", F.monotonically_increasing_id()), "scores")
    able = rows.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.desc("n_features"), F.asc("row")]
    ranks = numbered(able.select("row", "id", "score", "n_features"), *order).where(F.col("rank") <= drawn)
    return (rows.join(ranks.select("row", "rank"), "row", "left")
            .select(F.col("id").alias("doc_id"), "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")))
