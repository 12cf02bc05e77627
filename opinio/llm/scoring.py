"""LM scoring by masked pseudo-likelihood (operator 4).

A bidirectional window network predicts every word from the ``SIDE`` words before and after it; a document's
score is the sum of the conditional log-probabilities of all its words.

1. Corpus counts: Spark counts every word (64-bit hash, A-Z as a-z) of every document in a written table. The words that
   occur ``LEAST`` times or more are the network's vocabulary; beyond ``VOCABULARY`` words the least count is raised.
2. Coding: each document is written once as vocabulary places, with the list of its words outside the vocabulary.
3. Classes: the ``OWN`` most frequent words are classes of their own. The other vocabulary words are grouped by the
   neighbour that they have most often among those, all others are one class. P(word | class) is the
   word's share of its class over the whole corpus; for words outside the vocabulary it comes from a join with the counts.
4. Network: position-wise embeddings of the neighbours' classes, one tanh layer, and P(class) as P(row of the class) times
   P(class | its row), a softmax each (``ROW`` rows of ``ROW`` classes). It is trained in numpy, data-parallel: in each round every task starts from the broadcast weights, makes gradient steps over
   every position of all its documents, and Spark averages the tasks' weights by positions seen.
5. Scoring: log P(class | both sides) + log P(word | class), summed over all words of the whole text.

Scale. The counts and the coded corpus grow with the input and stay in Spark. Broadcast are at most ``VOCABULARY`` words
(14 bytes each) and about 18,000 weights; to the driver come the vocabulary, a histogram of at most some 4,000 rows and
the averaged weights. Texts are read twice and never shuffled; a very long text is hashed in parts and its words are
scored a few thousand at a time.

Defined results. NULL and empty texts have no words, log-probability 0 and a NULL mean. The edge of a text is a
class of its own. Repeated rows count as often as they occur. An empty table gives an empty result. Only the
id and text columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm.common import RowIds, none_if_missing, pieces, stage
from opinio.llm.shingles import word_hashes

#: Words that the network knows, at most, and how often they occur at least.
VOCABULARY, LEAST = 1 << 18, 4
OWN, SHARED = 104, 39
RARE, EDGE = OWN + SHARED, OWN + SHARED + 1  # words outside the vocabulary; what lies beyond a text's edge
CLASSES = EDGE + 1
ROW = 12  # the classes that words have, EDGE of them, stand in rows of this size
SIDE, WIDTH = 2, 24
ROUNDS, STEP, RATE, DAMPING = 3, 4096, 0.1, 1e-4
#: Characters hashed at once and words trained or scored at once, a text at least.
_CHARS, _WORDS = 1 << 20, 1 << 18
#: Words a task holds before it counts them.
_HELD = 1 << 20


@dataclass
class Vocabulary:
    words: np.ndarray      # sorted hashes
    n: np.ndarray          # how often each occurs
    least: int             # every word with this count or more is in it
    rare: int              # occurrences of all other words

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word, len(words) for those outside."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, len(self.words)).astype(np.int32)


@dataclass
class Classes:
    of_place: np.ndarray   # class of each vocabulary place; the last one stands for all other words
    log_p: np.ndarray      # log P(word | class); for the last place, of a word that occurs once


@dataclass
class Network:
    embed: np.ndarray   # 2 * SIDE x CLASSES x WIDTH
    bias: np.ndarray    # WIDTH
    row: np.ndarray     # WIDTH x ROW
    row_bias: np.ndarray
    member: np.ndarray  # row x WIDTH x ROW
    member_bias: np.ndarray

    @staticmethod
    def shapes() -> list[tuple[int, ...]]:
        return [(2 * SIDE, CLASSES, WIDTH), (WIDTH,), (WIDTH, ROW), (ROW,), (ROW, WIDTH, ROW), (ROW, ROW)]

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.embed, self.bias, self.row, self.row_bias, self.member, self.member_bias

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        parts, at = [], 0
        for shape in cls.shapes():
            n = int(np.prod(shape))
            parts.append(flat[at:at + n].reshape(shape).astype(np.float32))
            at += n
        return cls(*parts)


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in order, and the number of words of each text."""
    hashes, counts = word_hashes(texts)
    return hashes.view(np.int64), counts


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[str | None]]]:
    for whole in batches:
        for pdf in pieces(whole, "text", _CHARS):
            yield pdf, [none_if_missing(t) for t in pdf["text"]]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for _, texts in _texts(batches):
        held.append(hashed(texts)[0])
        size += len(held[-1])
        if size >= _HELD:
            word, n = np.unique(np.concatenate(held), return_counts=True)
            yield pd.DataFrame({"word": word, "n": n})
            held, size = [], 0
    if size:
        word, n = np.unique(np.concatenate(held), return_counts=True)
        yield pd.DataFrame({"word": word, "n": n})


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of the corpus, written once."""
    found = docs.select("text").mapInPandas(_count, "word long, n long")
    return stage(found.groupBy("word").agg(F.sum("n").alias("n")), "words")


def vocabulary(counts: DataFrame, most: int = VOCABULARY) -> Vocabulary:
    """All words from the smallest count (``LEAST`` or more) on that at most ``most`` words have."""
    # Counts below 64 have a step of their own, larger ones share 64 steps each time they double.
    step = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(F.log2("n") * 64) - 320)
    steps = counts.groupBy(step.cast("long").alias("step")).agg(
        F.count("*").alias("words"), F.min("n").alias("least"), F.sum("n").alias("n")).toPandas().sort_values("step", ascending=False)
    fits = (steps["words"].cumsum() <= most) & (steps["least"] >= LEAST)
    least = int(steps["least"][fits].min()) if fits.any() else 1 << 62
    known = counts.where(F.col("n") >= least).toPandas().sort_values("word")
    return Vocabulary(known["word"].to_numpy(np.int64), known["n"].to_numpy(np.int64), least, int(steps["n"][~fits].sum()))


def code(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """rid, doc_id, n_words, places (32-bit integers), others (words outside the vocabulary), written once."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = RowIds()
        for pdf, texts in _texts(batches):
            words, counts = hashed(texts)
            places = shared.value.places(words)
            outside = places == len(shared.value.words)
            text = np.repeat(np.arange(len(counts)), counts)
            cut = np.cumsum(counts)[:-1]
            first = ids.take(len(pdf))
            yield pd.DataFrame({
                "rid": np.arange(first, first + len(pdf)), "doc_id": pdf["doc_id"].astype("Int64").to_numpy(), "n_words": counts,
                "places": [p.tobytes() for p in np.split(places, cut)],
                "others": np.split(words[outside], np.cumsum(np.bincount(text[outside], minlength=len(counts)))[:-1])})

    schema = "rid long, doc_id long, n_words long, places binary, others array<long>"
    return stage(docs.select("doc_id", "text").mapInPandas(run, schema), "coded")


def _coded(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Runs of coded rows of about ``_WORDS`` words, a row at least: rows, their places, words of each."""
    for whole in batches:
        run = np.cumsum(whole["n_words"].to_numpy()) // _WORDS
        for k in np.unique(run):
            pdf = whole[run == k]
            yield pdf, np.frombuffer(b"".join(pdf["places"]), np.int32), pdf["n_words"].to_numpy()


def own_classes(known: Vocabulary) -> np.ndarray:
    """Class of each place that is a class of its own, -1 for the others and for words outside."""
    order = np.lexsort((known.words, -known.n))[:OWN]
    own = np.full(len(known.words) + 1, -1, np.int16)
    own[order] = np.arange(len(order))
    return own


def grouped(known: Vocabulary, own: np.ndarray, mark: np.ndarray) -> Classes:
    """Classes from each place's commonest neighbour (``mark``): the ``SHARED`` marks with most occurrences are classes, the rest
    join the smallest of them."""
    of_place = np.r_[own[:-1], np.int16(RARE)]
    left = np.flatnonzero(own[:-1] < 0)
    mass = np.bincount(mark[left], weights=known.n[left], minlength=2 * OWN + 1)
    order = np.lexsort((np.arange(len(mass)), -mass))
    group = np.zeros(len(mass), np.int16)
    sizes: list[tuple[float, int]] = []
    for k, m in enumerate(order):
        size, g = (0.0, k) if k < SHARED else heapq.heappop(sizes)
        group[m] = OWN + g
        heapq.heappush(sizes, (size + mass[m], g))
    of_place[left] = group[mark[left]]
    n = known.n.astype(np.float64)
    total = np.bincount(of_place[:-1], weights=n, minlength=CLASSES)
    return Classes(of_place, np.r_[np.log(n / total[of_place[:-1]]), -np.log(max(known.rare, 1))].astype(np.float32))


def _neighbours(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for _, places, counts in _coded(batches):
            text = np.repeat(np.arange(len(counts)), counts)
            same = text[1:] == text[:-1]
            keys = []
            for word, near, side in ((places[1:], places[:-1], 0), (places[:-1], places[1:], OWN)):
                use = same & (own[near] >= 0) & (own[word] < 0) & (word < len(own) - 1)
                keys.append(word[use].astype(np.int64) * (2 * OWN) + side + own[near[use]])
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            yield pd.DataFrame({"place": (key // (2 * OWN)).astype(np.int32), "mark": (key % (2 * OWN)).astype(np.int32), "n": n})
    return run


def word_classes(coded: DataFrame, known: Vocabulary) -> Classes:
    """Classes of the vocabulary; one row per word of it reaches the driver."""
    own = own_classes(known)
    shared = coded.sparkSession.sparkContext.broadcast(own)
    met = coded.select("n_words", "places").mapInPandas(_neighbours(shared), "place int, mark int, n long")
    best = (met.groupBy("place", "mark").agg(F.sum("n").alias("n"))
            .groupBy("place").agg(F.max(F.struct("n", (-F.col("mark")).alias("m"))).alias("best"))
            .select("place", (-F.col("best.m")).alias("mark")).toPandas())
    mark = np.full(len(known.words), 2 * OWN)
    mark[best["place"]] = best["mark"]
    return grouped(known, own, mark)


def contexts(classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Classes of the SIDE words before and after each word, EDGE beyond the text."""
    n = len(classes)
    text = np.repeat(np.arange(len(counts)), counts)
    out = np.full((n, 2 * SIDE), EDGE, dtype=np.int16)
    for k in range(1, SIDE + 1):
        same = text[k:] == text[:-k]
        out[k:, SIDE - k][same] = classes[:-k][same]
        out[:-k if n > k else 0, SIDE + k - 1][same] = classes[k:][same]
    return out


def hidden(net: Network, around: np.ndarray) -> np.ndarray:
    h = net.embed[0][around[:, 0]]
    for k in range(1, around.shape[1]):
        h += net.embed[k][around[:, k]]
    h += net.bias
    return np.tanh(h, out=h)


def _by_row(target: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The chosen positions in order of their targets' rows, and (row, begin, end) of each row among them."""
    row = target[chosen] // ROW
    order = np.argsort(row, kind="stable")
    ends = np.searchsorted(row[order], np.arange(ROW + 1)).tolist()
    return chosen[order], [(r, a, b) for r, a, b in zip(range(ROW), ends, ends[1:]) if a < b]


def _log_softmax(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    z -= z.max(axis=0)
    own = z[target, np.arange(len(target))]
    return own - np.log(np.exp(z, out=z).sum(axis=0))


def log_probs(net: Network, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log P(target class | classes on both sides)."""
    out = np.empty(len(target), dtype=np.float64)
    for at in range(0, len(target), 8192):
        here, rows = _by_row(target, np.arange(at, min(at + 8192, len(target))))
        h, y = hidden(net, around[here]), target[here]
        log_p = _log_softmax(net.row.T @ h.T + net.row_bias[:, None], y // ROW).astype(np.float64)
        for r, a, b in rows:
            log_p[a:b] += _log_softmax(net.member[r].T @ h[a:b].T + net.member_bias[r][:, None], y[a:b] % ROW)
        out[here] = log_p
    return out


def _sums_by_class(rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Sum of the rows of each class."""
    out = np.zeros((CLASSES, rows.shape[1]), np.float32)
    order = np.argsort(cls, kind="stable")
    cls = cls[order]
    first = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
    out[cls[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _errors(z: np.ndarray, target: np.ndarray, size: int) -> np.ndarray:
    """Slope of the mean loss over ``size`` positions by the inputs of a softmax, in place."""
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    z[target, np.arange(len(target))] -= 1
    z *= np.float32(1 / size)
    return z


def train_steps(net: Network, squares: list[np.ndarray], around: np.ndarray, target: np.ndarray, order: np.ndarray) -> None:
    """Gradient steps over batches of STEP positions, scaled by the root of the squares so far, in place."""
    for at in range(0, len(order), STEP):
        here, rows = _by_row(target, order[at:at + STEP])
        x, y = around[here], target[here]
        h = hidden(net, x)
        e = _errors(net.row.T @ h.T + net.row_bias[:, None], y // ROW, len(y))
        dh = e.T @ net.row.T
        member, member_bias = np.zeros_like(net.member), np.zeros_like(net.member_bias)
        for r, a, b in rows:
            m = _errors(net.member[r].T @ h[a:b].T + net.member_bias[r][:, None], y[a:b] % ROW, len(y))
            dh[a:b] += m.T @ net.member[r].T
            member[r], member_bias[r] = (m @ h[a:b]).T, m.sum(axis=1)
        dh *= 1 - h * h
        embed = np.stack([_sums_by_class(dh, x[:, k]) for k in range(x.shape[1])])
        for part, square, slope in zip(net.parts(), squares,
                                       (embed, dh.sum(axis=0), (e @ h).T, e.sum(axis=1), member, member_bias)):
            square += slope * slope
            part -= RATE * slope / np.sqrt(square)


def start() -> Network:
    rng = np.random.default_rng(4)
    shapes = Network.shapes()
    return Network(*(rng.normal(0, 0.1, s).astype(np.float32) if len(s) > 1 else np.zeros(s, np.float32) for s in shapes))


def _train(shared, classes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net, of_place, seen = Network.of(shared.value), classes.value, 0
        squares = [np.full(s, DAMPING, np.float32) for s in Network.shapes()]
        wait_x, wait_y, waiting = [], [], 0

        def learn() -> None:
            x, y = np.concatenate(wait_x), np.concatenate(wait_y)
            mixed = np.random.default_rng(len(x)).permutation(len(x))  # neighbours come from one text
            train_steps(net, squares, x, y, mixed)

        for _, places, counts in _coded(batches):
            if not len(places):
                continue
            cls = of_place[places]
            wait_x.append(contexts(cls, counts))
            wait_y.append(cls)
            waiting += len(cls)
            if waiting >= 8 * STEP:
                learn()
                seen, wait_x, wait_y, waiting = seen + waiting, [], [], 0
        if waiting:
            learn()
            seen += waiting
        if seen:
            yield pd.DataFrame({"seen": [seen], "weights": [net.flat()]})
    return run


def train(coded: DataFrame, classes: Classes, rounds: int = ROUNDS) -> Network:
    """Rounds of local steps on all documents and averaging of the weights by positions seen."""
    spark: SparkSession = coded.sparkSession
    spread = spark.sparkContext.broadcast(classes.of_place)
    flat = start().flat()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(flat)
        local = coded.select("n_words", "places").mapInPandas(_train(shared, spread), "seen long, weights array<float>")
        mean = (local.select("seen", F.posexplode("weights").alias("place", "w")).groupBy("place")
                .agg((F.sum(F.col("w").cast("double") * F.col("seen")) / F.sum("seen")).alias("w")).toPandas())
        if mean.empty:
            break
        flat = mean.sort_values("place")["w"].to_numpy(np.float64)
    return Network.of(flat)


def score_places(places: np.ndarray, counts: np.ndarray, net: Network, classes: Classes) -> np.ndarray:
    """Summed conditional log-probability of each text; words outside the vocabulary as if they occurred once."""
    total = np.zeros(len(counts))
    if len(places):
        cls = classes.of_place[places]
        word = log_probs(net, contexts(cls, counts), cls) + classes.log_p[places]
        filled = np.flatnonzero(counts)
        total[filled] = np.add.reduceat(word, (np.cumsum(counts) - counts)[filled])
    return total


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_p, mean_log_p for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = count_words(docs)
    known = vocabulary(counts)
    coded = code(docs, known)
    classes = word_classes(coded, known)
    shared = docs.sparkSession.sparkContext.broadcast((train(coded, classes), classes))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, places, n in _coded(batches):
            yield pd.DataFrame({"rid": pdf["rid"], "doc_id": pdf["doc_id"].astype("Int64").to_numpy(), "n_words": n,
                                "known_log_p": score_places(places, n, *shared.value)})

    scored = coded.select("rid", "doc_id", "n_words", "places").mapInPandas(
        run, "rid long, doc_id long, n_words long, known_log_p double")
    # A word outside the vocabulary that occurs n times is n times as likely as one that occurs once.
    often = counts.where((F.col("n") > 1) & (F.col("n") < known.least))
    more = (coded.select("rid", F.explode("others").alias("word")).join(often, "word")
            .groupBy("rid").agg(F.sum(F.log("n")).alias("more")))
    log_p = F.col("known_log_p") + F.coalesce("more", F.lit(0.0))
    return scored.join(more, "rid", "left").select(
        "doc_id", "n_words", log_p.alias("log_p"), F.when(F.col("n_words") > 0, log_p / F.col("n_words")).alias("mean_log_p"))
