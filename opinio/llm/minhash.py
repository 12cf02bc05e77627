"""MinHash near-dedup with sequential Bayesian verification (operator 3).

1. One pass over the texts gives each its set size, a 128-bit digest of the set and a MinHash signature.
   Texts with equal sets are one class; only class representatives go on.
2. Bands of the signature are bucket keys, and the smallest member of a bucket is its pivot. Every member is
   paired with the pivot it shares most buckets with.
3. Pairs are compared in batches of signature values. After each batch the posterior of the similarity
   (uniform prior) decides: a pair goes as soon as P(similarity >= threshold) is below ``MISS``.
4. Survivors are verified on the full shingle sets of their whole texts, and linked.
5. In a bucket that still holds several components, the members outside its largest one are compared with
   all members of other components, in numpy blocks with the same sequential test. Survivors are verified on
   the full sets in the same task, the likeliest first and each in the first bucket that it shares, unless links
   found there join the two already. So no pair that shares a bucket is left untested unless a path of links
   joins it, and only links become rows.

Scale. Class members never meet in a task: equal sets are reduced in the map tasks. A bucket with very
many near copies gives about one pair per member, and its rows are counted by partial aggregation, joined on a
staged table (skew joins may split it) and, in step 5, cut into blocks. A pair at the threshold shares no
band with probability (1 - t^ROWS)^BANDS: 4e-7 at 0.85, 5e-5 at 0.8.

Defined results. Empty or NULL texts have size 0 and link with nothing. NULL ids sort behind all others;
repeated rows are one group of which one stays. An empty table gives an empty result. Only the id and
text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import RowIds, none_if_missing, one_of_each, packed, pieces, stage
from opinio.llm.components import components
from opinio.llm.groups import groups_in_order
from opinio.llm.shingles import mix, same_enough, shingle_sets

BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
#: Signature values compared between two looks at the posterior.
BATCH = 25
#: A pair is dropped when its similarity reaches the threshold with a smaller probability than this.
MISS = 1e-6
#: Members of a bucket compared at once in step 5.
BLOCK = 512
_CHARS = 1 << 21

_SIGNED = "rid long, doc_id long, text_key string, n_shingles long, s1 long, s2 long, signature binary"
_RNG = np.random.default_rng(3)
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (rows: non-empty sets, columns: hash functions)."""
    out = np.zeros((len(sets), HASHES), dtype=np.uint32)
    a = 0
    while a < len(sets):
        b, held = a, 0
        while b < len(sets) and (b == a or held + len(sets[b]) <= 1 << 16):
            held += len(sets[b])
            b += 1
        flat = np.concatenate(sets[a:b])
        starts = np.cumsum([0] + [len(s) for s in sets[a:b - 1]])
        for k in range(HASHES):
            out[a:b, k] = np.minimum.reduceat((flat * _A[k] + _B[k]) >> np.uint64(32), starts)
        a = b
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """Bucket keys (rows x BANDS) of a signature matrix."""
    weight = mix(np.arange(11, 11 + ROWS, dtype=np.uint64)) | np.uint64(1)
    parts = signature.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = (mix(parts + np.uint64(1)) * weight).sum(axis=2, dtype=np.uint64)
    return mix(key + mix(np.arange(1, BANDS + 1, dtype=np.uint64))).view(np.int64)


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, fewest equal ones that keep a pair) for each batch.

    With a uniform prior and m of n values equal the similarity is Beta(m + 1, n - m + 1), and
    P(similarity >= t) is the chance of at most m successes in n + 1 trials with probability t.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        at_most, m = 0.0, 0
        while True:
            at_most += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if at_most >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ids, seen = RowIds(), set()
    for whole in batches:
        for pdf in pieces(whole, "text", _CHARS):
            texts = [none_if_missing(t) for t in pdf["text"]]
            sets = shingle_sets(texts)
            size = np.array([len(s) for s in sets])
            s1 = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            s2 = np.array([mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64) for s in sets],
                          dtype=np.uint64).view(np.int64)
            new = []  # the first of each set in this task carries the signature
            for k, key in enumerate(zip(s1.tolist(), s2.tolist())):
                if size[k] and key not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(key)
                    new.append(k)
            signature = np.full(len(sets), None, dtype=object)
            for k, row in zip(new, signatures([sets[k] for k in new])):
                signature[k] = row.tobytes()
            first = ids.take(len(sets))
            yield pd.DataFrame({
                "rid": np.arange(first, first + len(sets)), "doc_id": pdf["doc_id"].astype("Int64").to_numpy(),
                "text_key": [None if t is None else hashlib.md5(t.encode()).hexdigest() for t in texts],
                "n_shingles": size, "s1": s1, "s2": s2, "signature": signature})


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(-1, HASHES)


def _bucket_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            yield pd.DataFrame({"bucket": band_keys(_matrix(pdf["signature"])).ravel(),
                                "node": np.repeat(pdf["node"].to_numpy(), BANDS)})


def _sequential(percent: int):
    """Keep the pairs that pass every look at the posterior."""
    looks = least_matches(percent / 100)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            left, right = _matrix(pdf["sig_a"]), _matrix(pdf["sig_b"])
            alive, equal, done = np.arange(len(pdf)), np.zeros(len(pdf), dtype=np.int64), 0
            for n, least in looks:
                equal += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                go_on = equal >= least
                alive, equal, done = alive[go_on], equal[go_on], n
            yield pdf[["a", "b"]].iloc[alive]
    return run


def _verify(percent: int):
    """Exact test on the full sets of both texts; the last left set is kept for the next row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, held_set = None, None
        for pdf in batches:
            good = np.zeros(len(pdf), dtype=bool)
            for k, (a, ta, tb) in enumerate(zip(pdf["a"], pdf["text_a"], pdf["text_b"])):
                if a != held:
                    held, held_set = a, shingle_sets([ta])[0]
                good[k] = same_enough(held_set, shingle_sets([tb])[0], percent)
            yield pdf.loc[good, ["a", "b"]]
    return run


def _block_links(percent: int):
    """Step 5: rows sorted by (bucket, i, j); the asking members of block i against members of block j."""
    looks = least_matches(percent / 100)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        ask, own = rows[rows["asks"]], rows[~rows["asks"]]
        if not len(ask) or not len(own):
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        x, y = _matrix(ask["signature"]), _matrix(own["signature"])
        na, nb = ask["node"].to_numpy(), own["node"].to_numpy()
        ca, cb = ask["component"].to_numpy(), own["component"].to_numpy()
        # Two asking members meet twice in a bucket; one order is enough.
        p, q = np.nonzero((ca[:, None] != cb) & (own["main"].to_numpy() | (na[:, None] < nb)))
        equal, done = np.zeros(len(p), dtype=np.int64), 0
        for n, least in looks:
            for c in range(done, n):
                equal += x[p, c] == y[q, c]
            go_on = equal >= least
            p, q, equal, done = p[go_on], q[go_on], equal[go_on], n
        # A pair is verified in the first bucket that it shares.
        shared = band_keys(x)[p] == band_keys(y)[q]
        first = band_keys(x)[p, shared.argmax(axis=1)] == rows["bucket"].iloc[0]
        order = np.flatnonzero(first)[np.argsort(-equal[first], kind="stable")]
        p, q = p[order], q[order]
        used_a, used_b = np.unique(p), np.unique(q)
        sets_a = dict(zip(used_a.tolist(), shingle_sets(ask["text"].iloc[used_a].tolist())))
        sets_b = dict(zip(used_b.tolist(), shingle_sets(own["text"].iloc[used_b].tolist())))
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        links = []
        for i, j in zip(p.tolist(), q.tolist()):  # the likeliest first; joined components need no more links
            ra, rb = find(int(ca[i])), find(int(cb[j]))
            if ra != rb and same_enough(sets_a[i], sets_b[j], percent):
                root[max(ra, rb)] = min(ra, rb)
                links.append((na[i], nb[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in groups_in_order(batches, ["bucket", "i", "j"]):
            yield compare(rows)
    return run


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Exact verification: (a, b) of the pairs whose full sets are similar enough."""
    rows = (pairs.distinct().join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return stage(rows.mapInPandas(_verify(percent), "a long, b long"), "links")


def _tested(star: DataFrame, leads: DataFrame, percent: int) -> DataFrame:
    """The (pivot, node) pairs that pass the sequential test, as (a, b)."""
    sig_a = leads.select(F.col("node").alias("a"), F.col("signature").alias("sig_a"))
    sig_b = leads.select(F.col("node").alias("b"), F.col("signature").alias("sig_b"))
    pairs = star.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    return pairs.join(sig_b, "b").join(sig_a, "a").mapInPandas(_sequential(percent), "a long, b long")


def _open_links(members: DataFrame, found: DataFrame, leads: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Step 5: links (a, b) between members of one bucket that are in different components."""
    placed = stage(members.select("bucket", "node").join(found, "node", "left")
                   .withColumn("component", F.coalesce("component", "node")), "placed")
    # Of a bucket with several components only the members outside its largest one ask; they meet all members.
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    mixed = (parts.groupBy("bucket").agg(F.max_by("component", F.struct("k", "component")).alias("largest"),
                                         (F.sum("k") - F.max("k")).alias("outside"), F.sum("k").alias("n"))
             .where("outside > 0")
             .select("bucket", "largest", F.ceil(F.col("outside") / BLOCK).cast("int").alias("ask_blocks"),
                     F.ceil(F.col("n") / BLOCK).cast("int").alias("own_blocks")))
    rows = stage(placed.join(mixed, "bucket").withColumn("main", F.col("component") == F.col("largest")), "open-buckets")
    part = F.xxhash64("node")

    def blocks(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    ask = (rows.where("not main").withColumn("i", F.pmod(part, F.col("ask_blocks")).cast("int"))
           .withColumn("j", blocks("own_blocks")).withColumn("asks", F.lit(True)))
    own = (rows.withColumn("j", F.pmod(part, F.col("own_blocks")).cast("int"))
           .withColumn("i", blocks("ask_blocks")).withColumn("asks", F.lit(False)))
    rows = ask.unionByName(own).select("bucket", "i", "j", "asks", "main", "node", "component")
    rows = (rows.join(leads, "node").join(texts, "node").repartition("bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j"))
    return stage(rows.mapInPandas(_block_links(percent), "a long, b long"), "open-links")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, text_key.

    Links: 100 * |intersection| >= percent * |union| of the distinct five-word shingles.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage(docs.mapInPandas(_sign, _SIGNED), "signed")
    nodes = stage(signed.where("n_shingles > 0").groupBy("s1", "s2", "n_shingles")
                  .agg(F.min("rid").alias("node"), F.min_by("text_key", "rid").alias("text_key")), "classes")
    leads = stage(nodes.select("node").join(
        signed.where("signature is not null").select(F.col("rid").alias("node"), "signature"), "node"), "leads")
    buckets = stage(leads.mapInPandas(_bucket_rows, "bucket long, node long"), "buckets")
    shared = (buckets.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("n"))
              .where("n > 1").select("bucket", "pivot"))
    members = stage(buckets.join(shared, "bucket"), "members")
    # The whole texts of all members of shared buckets, fetched once.
    keys = nodes.join(members.select("node").distinct(), "node").select("node", "text_key")
    texts = docs.where(F.col("text").isNotNull()).select(F.md5(F.col("text")).alias("text_key"), "text")
    texts = stage(texts.join(keys, "text_key").groupBy("node").agg(F.first("text").alias("text")), "texts")

    pivots = (members.where("node != pivot").groupBy("pivot", "node").agg(F.count("*").alias("n"))
              .groupBy("node").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("pivot")))
    links = _links(_tested(pivots, leads, percent), texts, percent)
    found = stage(components(links), "components")
    more = _open_links(members, found, leads, texts, percent)
    if not more.isEmpty():
        found = stage(components(links.unionByName(more)), "components")

    placed = (signed.select("rid", "doc_id", "text_key", "n_shingles", "s1", "s2")
              .join(nodes.select("s1", "s2", "n_shingles", "node"), ["s1", "s2", "n_shingles"], "left")
              .join(found, "node", "left")
              .withColumn("group", F.coalesce("component", "node", "rid")).drop("component", "node", "s1", "s2"))
    placed = stage(placed, "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    groups = stage(placed.groupBy("group").agg(first), "groups")
    return (placed.join(groups, "group")
            .select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"),
                    (F.col("rid") == F.col("first.rid")).alias("kept"), "text_key"))


def drop_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one of each group of linked documents.

    Rows with equal id and text are one document here, also where they hold no words.
    """
    kept = (near_duplicates(docs, percent).where("kept")
            .select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")))
    rows = packed(docs, id=F.col("doc_id"), key=F.md5(F.col("text").cast("string")))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & F.col("key").eqNullSafe(F.col("kept_key")))
    return one_of_each(rows, "id", "key").select("row.*")
