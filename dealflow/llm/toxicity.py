"""Toxic passages by maximum-scoring segments.

Tokens score by their log-odds between toxic and clean labelled texts under Dirichlet
priors; a linear scan finds every maximal-scoring segment of a text; extreme-value
statistics, fitted on clean texts, say how surprising a segment of that score is in a text
of that length; and the surprises of a text's passages make one calibrated score.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import add_columns, class_share, cut, kept, labelled_sample, training_rows

WORD_BUCKETS, STEM_BUCKETS, STEM = 1 << 18, 1 << 16, 5
EDGE = ".,;:!?\"'()[]{}<>*#$%&|"
DRIFT, LOW, HIGH = 0.8, -1.5, 5.0


def tokens(text: str) -> list[str]:
    return [w.strip(EDGE) for w in text.lower().split()]


def buckets(token: str) -> tuple[int, int]:
    """Where a token and its stem (its first letters) are counted: a table of fixed size, however
    many tokens the corpus has."""
    raw = token.encode("utf-8", "replace")
    return (xxhash.xxh64_intdigest(raw) % WORD_BUCKETS,
            WORD_BUCKETS + xxhash.xxh64_intdigest(token[:STEM].encode("utf-8", "replace"), 7) % STEM_BUCKETS)


#: Pseudo-counts of the priors of a token and of a stem.
WORD_PRIOR, STEM_PRIOR = 16.0, 16.0


class Scorer:
    """Token scores, and the extreme-value law and calibration of a text's passages.

    ``toxic`` and ``clean`` count, by bucket, the labelled texts that hold a token. A token's prior
    is Dirichlet with WORD_PRIOR pseudo-counts, split as the texts that hold its stem are; a stem's
    has STEM_PRIOR, split as the totals are."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray):
        self.toxic, self.clean = toxic[:WORD_BUCKETS].astype(np.float32), clean[:WORD_BUCKETS].astype(np.float32)
        a, b = self.toxic.sum() + 1.0, self.clean.sum() + 1.0
        share, self.odds = a / (a + b), math.log(b / a)
        stem = toxic[WORD_BUCKETS:] + STEM_PRIOR * share
        self.stem = (stem / (stem + clean[WORD_BUCKETS:] + STEM_PRIOR * (1 - share))).astype(np.float32)
        self.name = uuid.uuid4().hex  # token scores are fixed from here on
        self.rate, self.k, self.weights, self.center, self.spread = 1.0, 1.0, None, None, None

    def token(self, w: str) -> float:
        if not w:
            return -DRIFT
        i, j = buckets(w)
        share = float(self.stem[j - WORD_BUCKETS])
        s = math.log((self.toxic[i] + WORD_PRIOR * share) / (self.clean[i] + WORD_PRIOR * (1 - share))) + self.odds
        return min(max(s, LOW), HIGH) - DRIFT

    def scores(self, text: str) -> np.ndarray:
        cache = kept(("toxicity", self.name), dict)
        ws = tokens(text)
        out = list(map(cache.get, ws))
        if None in out:
            for i, v in enumerate(out):
                if v is None:
                    out[i] = cache[ws[i]] = self.token(ws[i])
            if len(cache) > 300_000:
                cache.clear()
        return np.array(out, np.float64)

    def law(self, scores: np.ndarray, counts: np.ndarray, best: np.ndarray, size: np.ndarray) -> None:
        """Fit P(best segment of m tokens < x) = exp(-k m exp(-rate x)) on clean texts: ``rate`` solves
        E[exp(rate s)] = 1 over the histogram of their tokens, k is its maximum-likelihood value
        given the best segments."""
        low, high = 1e-3, 20.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if np.average(np.exp(np.minimum(mid * scores, 700)), weights=counts) < 1 else (low, mid)
        self.rate = low
        self.k = len(best) / max(1e-9, float((np.maximum(size, 1) * np.exp(-self.rate * best)).sum()))

    def passages(self, s: np.ndarray, level: float = 0.05) -> list[tuple[int, int, float, float]]:
        """(first token, end, score, expected number by chance) of each segment that a clean text of
        this length would have with a probability under ``level``."""
        m = max(len(s), 1)
        out = [(a, b, x, self.k * m * math.exp(-self.rate * x)) for a, b, x in segments(s)]
        return [p for p in out if p[3] < -math.log1p(-level)]

    def features(self, s: np.ndarray, found: list | None = None) -> list[float]:
        """Of a text: the surprise of its best segment (0 if none is significant), that of all
        passages together for its length, and how many there are."""
        found = self.passages(s) if found is None else found
        surprise = [-math.log(max(p[3], 1e-300)) for p in found]
        return [max(surprise, default=0.0) ** 0.5, math.log1p(100 * sum(p[2] for p in found) / max(len(s), 1)), math.log1p(len(found))]

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.center, self.spread = x.mean(0), x.std(0) + 1e-6
        self.weights = logistic(self.scaled(x), y, weight)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        z = (np.asarray(x, float).reshape(-1, 3) - self.center) / self.spread
        return np.concatenate([z, np.ones((len(z), 1))], 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scaled(x) @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last column, the constant, isn't shrunk."""
    w, shrink = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + shrink, x.T @ (weight * (y - p)) - shrink @ w)
        w = w + np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return w


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of ``s`` in linear time, from the left. Runs
    of positive tokens are single items: between them only the running sum matters."""
    if not len(s):
        return []
    up = s > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], up, [False]]).astype(np.int8)))
    total = np.concatenate([[0.0], np.cumsum(s)])
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, nearest with a lower sum before
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        left, right = float(total[a]), float(total[b])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((a, b, left, right, j))
                break
            a, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, r - lo) for a, b, lo, r, _ in stack]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", max_train: int = 16_000) -> Scorer:
    """Learn from at most ``max_train`` labelled rows (half of each label, see
    ``labelled_sample``; of rows that repeat an id, one); held-out rows are never among them. Counts go to tables of fixed
    size; law and calibration come from the same rows, weighted as all learnable labels are
    split. Without rows of both labels every text scores 0."""
    chosen = labelled_sample(labels, label, max_train)
    train = cut(training_rows(docs, text, chosen).select("y", "t"), "toxicity-train")

    def count(batches):
        n = np.zeros((2, WORD_BUCKETS + STEM_BUCKETS), np.int64)
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where = [b for w in set(tokens(t or "")) if w for b in buckets(w)]
                np.add.at(n[y], where, 1)
        at = np.flatnonzero(n.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[1][at]), pa.array(n[0][at])], names=["at", "toxic", "clean"])

    got = train.mapInArrow(count, "at int, toxic bigint, clean bigint").groupBy("at").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    toxic, clean = np.zeros(WORD_BUCKETS + STEM_BUCKETS), np.zeros(WORD_BUCKETS + STEM_BUCKETS)
    at = got["at"].to_numpy()
    toxic[at], clean[at] = got["toxic"].to_numpy(), got["clean"].to_numpy()
    scorer = Scorer(toxic, clean)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def background(batches):
        for batch in batches:
            own = [shared.value.scores(t or "") for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if y == 0]
            yield pa.RecordBatch.from_arrays([pa.array([float(max([x[2] for x in segments(s)], default=0.0)) for s in own], pa.float64()), pa.array([len(s) for s in own], pa.int64()),
                                              pa.array([np.histogram(s, GRID)[0] for s in own], pa.list_(pa.int64()))], names=["best", "size", "hist"])

    got = train.mapInArrow(background, "best double, size bigint, hist array<bigint>")
    bins = got.select(F.posexplode("hist").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    pairs = got.select("best", "size").toArrow()  # max_train / 2 rows at most
    if not pairs.num_rows or not toxic.sum():
        return scorer
    weight, mids = np.zeros(len(GRID) - 1), (GRID[1:] + GRID[:-1]) / 2
    weight[bins["i"].to_numpy()] = bins["n"].to_numpy()
    scorer.law(mids, weight, pairs["best"].to_numpy(), pairs["size"].to_numpy().astype(float))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def describe(batches):
        for batch in batches:
            x = [shared.value.features(shared.value.scores(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    got = train.mapInArrow(describe, "y int, x array<double>").toArrow()
    x, y = np.array(got["x"].to_pylist()), got["y"].to_numpy()
    share = class_share(labels, label)
    own = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    scorer.calibrate(x, y, own)
    return scorer


#: Bins for token scores.
GRID = np.linspace(LOW - DRIFT, HIGH - DRIFT, 261)

PASSAGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                        T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())])


def score_toxicity(docs: DataFrame, scorer: Scorer, text: str = "text", prefix: str = "", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``passages``, the significant segments as (start,
    end) in white-space separated tokens, their log-odds score and the number expected by chance.

    A null or empty text has no passages and scores as the calibration says for a text without.
    Texts are taken whole: scan and memory are linear in their length. Repeated rows score
    alike. Columns named like the new ones (``prefix`` goes before them) are replaced; ``keep``
    names the columns to return. No rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # tables of fixed size

    def make():
        g = shared.value

        def compute(texts):
            each = [g.scores(t) for t in texts]
            found = [g.passages(s) for s in each]
            p = np.zeros(len(texts)) if g.weights is None else g.probability([g.features(s, f) for s, f in zip(each, found, strict=True)])
            return [p.tolist(), [[{"start": a, "end": b, "score": x, "expected": e} for a, b, x, e in f] for f in found]]

        return compute

    return add_columns(docs, text, [(prefix + "score", T.DoubleType()), (prefix + "passages", T.ArrayType(PASSAGE))], make, keep)
