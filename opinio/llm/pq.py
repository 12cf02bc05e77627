"""Embedding near-dedup by product quantisation (operator 1).

A coarse quantiser puts each unit vector into one inverted list; its residual is coded by one code word per
subspace. Vectors of one label are compared through the lists: each vector probes its ``PROBES`` nearest
lists and sums table look-ups (asymmetric distances: exact query against coded member). A member goes on
when that distance, less the member's own coding error, does not rule the threshold out (the triangle
inequality, so coding loses nothing), and the exact cosine in double precision decides.

Links are symmetric: a pair counts for both vectors when either one finds the other. Recall against brute
force is 1.0 on the given tables (see tests/llm/test_pq.py); what can be missed is a pair of which neither
vector is in a list that the other probes.

Scale. The codebooks come from a bounded sample (``TRAIN_ROWS`` vectors in hash order); every vector is
indexed. Equal vectors of a label are one class before anything else, so copies never meet. A list of a
label is cut into blocks of ``BLOCK`` members and ``BLOCK`` probing vectors, so a label or list with a third
of all rows is spread over many tasks. A task returns link counts per vector and a spanning forest of the
links of its block, never the pairs.

Defined results. Vectors with a NULL label, NULL or zero vectors, and those with a NULL or non-finite
component link with nothing (n_links 0, own component). Vectors of different lengths never link; each
length has its own codebooks. Repeated rows are vectors of their own; NULL ids sort last. An empty table
gives an empty result. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import stage
from opinio.llm.components import components
from opinio.llm.groups import groups_in_order

THRESHOLD = 0.93
PROBES = 6
#: Bounds of what the driver learns from and broadcasts.
TRAIN_ROWS, MOST_LISTS = 20_000, 8192
SUBSPACES, CODES = 8, 64
#: Members, and probing vectors, compared at once.
BLOCK = 1024

_CODED = "node long, label long, copies long, home int, probes array<int>, code binary, error double, unit binary"


@dataclass
class Index:
    lists: np.ndarray        # coarse centres
    edges: list[int]         # bounds of the subspaces
    words: list[np.ndarray]  # code words of each subspace


def _nearest(x: np.ndarray, centres: np.ndarray, n: int = 1) -> np.ndarray:
    d = (centres * centres).sum(axis=1) - 2 * (x @ centres.T)
    if n == 1:
        return d.argmin(axis=1)[:, None]
    n = min(n, len(centres))
    some = np.argpartition(d, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.take_along_axis(d, some, axis=1).argsort(axis=1, kind="stable"), axis=1)


def _means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from a fixed random start; an empty cell keeps its centre."""
    centres = x[np.random.default_rng(1).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        cell = np.concatenate([_nearest(x[a:a + 4096], centres)[:, 0] for a in range(0, len(x), 4096)])
        count = np.bincount(cell, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def train(sample: np.ndarray, n_lists: int) -> Index:
    """Codebooks of a sample of unit vectors (rows)."""
    lists = _means(sample, min(n_lists, len(sample)))
    residual = sample - lists[_nearest(sample, lists)[:, 0]]
    edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int).tolist()
    return Index(lists, edges, [_means(residual[:, a:b], min(CODES, len(sample))) for a, b in zip(edges, edges[1:])])


def _unit(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _code(index_of):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = index_of.value
        for whole in batches:
            for a in range(0, len(whole), 4096):
                pdf = whole.iloc[a:a + 4096]
                unit = _unit(pdf["embedding"])
                probes = _nearest(unit, index.lists, PROBES)
                residual = unit - index.lists[probes[:, 0]]
                code = np.empty((len(pdf), len(index.words)), dtype=np.uint8)
                for s, words in enumerate(index.words):
                    part = residual[:, index.edges[s]:index.edges[s + 1]]
                    code[:, s] = _nearest(part, words)[:, 0]
                    part -= words[code[:, s]]
                yield pd.DataFrame({
                    "node": pdf["node"].to_numpy(), "label": pdf["label"].to_numpy(), "copies": pdf["copies"].to_numpy(),
                    "home": probes[:, 0].astype(np.int32), "probes": list(probes.astype(np.int32)),
                    "code": [c.tobytes() for c in code], "error": np.sqrt((residual * residual).sum(axis=1)),
                    "unit": [u.tobytes() for u in unit]})
    return run


def _local_roots(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest node reachable through the links of a block, for its rows and columns."""
    top = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        new_b = np.minimum(b, np.where(link, a[:, None], top).min(axis=0))
        new_a = np.minimum(a, np.where(link, new_b[None, :], top).min(axis=1))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b


def _compare(index_of, threshold: float):
    """For each (label, list, i, j): probing block i against member block j."""
    reach = np.sqrt(2 - 2 * threshold) + 1e-9

    def block(rows: pd.DataFrame, index: Index) -> pd.DataFrame:
        ask, own = rows[rows["asks"]], rows[~rows["asks"]]
        if not len(ask) or not len(own):
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype=np.int64)
        x, y = (np.frombuffer(b"".join(part["unit"]), dtype=np.float64).reshape(len(part), -1) for part in (ask, own))
        code = np.frombuffer(b"".join(own["code"]), dtype=np.uint8).reshape(len(own), -1)
        # Asymmetric distances: one table of squared distances per query and subspace.
        residual = x - index.lists[rows["list"].iloc[0]]
        far = np.zeros((len(ask), len(own)))
        for s, words in enumerate(index.words):
            part = residual[:, index.edges[s]:index.edges[s + 1]]
            table = (part * part).sum(axis=1)[:, None] - 2 * part @ words.T + (words * words).sum(axis=1)
            far += table[:, code[:, s]]
        node_a, node_b = ask["node"].to_numpy(), own["node"].to_numpy()
        near = np.sqrt(np.maximum(far, 0)) <= reach + own["error"].to_numpy()
        p, q = np.nonzero(near & (node_a[:, None] != node_b))
        exact = np.concatenate([np.zeros(0)] + [np.einsum("ij,ij->i", x[p[k:k + 8192]], y[q[k:k + 8192]])
                                                for k in range(0, len(p), 8192)])
        link = np.zeros((len(ask), len(own)), dtype=bool)
        link[p[exact >= threshold], q[exact >= threshold]] = True
        if not link.any():
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype=np.int64)
        # The member counts the pair here only if it does not probe the asking vector's list itself.
        home_a = ask["home"].to_numpy()
        probes_b = np.stack(own["probes"].to_numpy())
        asks_back = np.zeros((len(ask), len(own)), dtype=bool)
        for k in range(probes_b.shape[1]):
            asks_back |= home_a[:, None] == probes_b[None, :, k]
        links_a = link @ own["copies"].to_numpy()
        links_b = ask["copies"].to_numpy() @ (link & ~asks_back)
        root_a, root_b = _local_roots(link, node_a, node_b)
        out = pd.DataFrame({"node": np.r_[node_a, node_b], "links": np.r_[links_a, links_b], "root": np.r_[root_a, root_b]})
        return out[(out["links"] > 0) | (out["root"] != out["node"])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in groups_in_order(batches, ["label", "list", "i", "j"]):
            yield block(rows, index_of.value)
    return run


def _links_of_length(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) parts for classes whose vectors all have one length."""
    spark = classes.sparkSession
    n = classes.count()
    n_lists = min(MOST_LISTS, max(1, round(n**0.5)))
    sample = (classes.select("embedding", F.xxhash64("embedding").alias("order")).orderBy("order").limit(TRAIN_ROWS)
              .select("embedding").toPandas())
    shared = spark.sparkContext.broadcast(train(_unit(sample["embedding"]), n_lists))
    coded = stage(classes.select("node", "label", "copies", "embedding").mapInPandas(_code(shared), _CODED), "coded")
    asking = coded.select("*", F.explode("probes").alias("list"))
    sizes = (asking.groupBy("label", "list")
             .agg(F.count("*").alias("n_ask"), F.sum((F.col("home") == F.col("list")).cast("int")).alias("n_own")))
    sizes = stage(sizes.where("n_own > 0").select(
        "label", "list", F.ceil(F.col("n_ask") / BLOCK).cast("int").alias("ask_blocks"),
        F.ceil(F.col("n_own") / BLOCK).cast("int").alias("own_blocks")), "list-sizes")
    part = F.xxhash64("node")

    def blocks(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    ask = (asking.join(sizes, ["label", "list"]).withColumn("i", F.pmod(part, F.col("ask_blocks")).cast("int"))
           .withColumn("j", blocks("own_blocks")).withColumn("asks", F.lit(True)))
    own = (coded.withColumn("list", F.col("home")).join(sizes, ["label", "list"])
           .withColumn("j", F.pmod(part, F.col("own_blocks")).cast("int"))
           .withColumn("i", blocks("ask_blocks")).withColumn("asks", F.lit(False)))
    units = (ask.unionByName(own).drop("ask_blocks", "own_blocks").repartition("label", "list", "i", "j")
             .sortWithinPartitions("label", "list", "i", "j"))
    return stage(units.mapInPandas(_compare(shared, threshold), "node long, links long, root long"), "list-links")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row."""
    e = F.col("embedding")
    sound = (F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
             & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
             & F.exists(e, lambda v: v != 0))
    rows = stage(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                                e.cast("array<double>").alias("embedding"))
                 .withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("rid", F.monotonically_increasing_id()),
                 "vectors")
    # Equal vectors of a label are one class; its node is its first row.
    classes = stage(rows.where("sound").groupBy("label", "embedding")
                    .agg(F.min("rid").alias("node"), F.count("*").alias("copies")), "vector-classes")
    parts = None
    for (length,) in classes.select(F.size("embedding")).distinct().collect():
        found = _links_of_length(classes.where(F.size("embedding") == length), threshold)
        parts = found if parts is None else parts.unionByName(found)
    named = rows.join(classes, ["label", "embedding"], "left").select("rid", "vec_id", "node", "copies")
    if parts is None:
        named = named.withColumn("links", F.lit(0)).withColumn("component", F.lit(None).cast("long"))
    else:
        counts = stage(parts.groupBy("node").agg(F.sum("links").alias("links")), "link-counts")
        found = stage(components(parts.where("root != node").select(F.col("node").alias("a"), F.col("root").alias("b"))),
                      "vector-components")
        named = named.join(counts, "node", "left").join(found, "node", "left")
    named = stage(named.withColumn("group", F.coalesce("component", "node", "rid")), "vector-groups")
    first = F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "rid")).alias("first")
    groups = stage(named.groupBy("group").agg(first), "groups")
    n_links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    return named.join(groups, "group").select(
        "vec_id", n_links.cast("long").alias("n_links"), F.col("first.vec_id").alias("component_id"),
        (F.col("rid") == F.col("first.rid")).alias("kept"))
