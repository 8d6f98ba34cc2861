"""A linear-chain conditional random field over the lines of a text, with two states.

State 1 is a good (content) line, state 0 a bad one. Emissions are linear in features of the
line and its two neighbours, transitions a 2 x 2 table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow.llm.common import class_share, cut, labelled_sample, training_rows

OTHER, UPPER, DIGIT, SIGN, BANG, POINT, SPACE, BAR, INNER, END = range(10)
_CLASS = np.zeros(256, np.uint8)
for _c, _chars in ((UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, "0123456789"), (SIGN, "#*$%&<>"), (BANG, "!"), (POINT, ".,;:?"), (SPACE, " \t\x0b\x0c\r"), (BAR, "|"), (END, "\n")):
    _CLASS[[ord(x) for x in _chars]] = _c
_CLASS[0x80:0xC0] = INNER  # later bytes of a character
#: Features that a line also has of the line before and the line after it.
NEAR = (1, 3, 4, 5, 8, 10)
N_FEATURES = 18 + 2 * len(NEAR)


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, characters, first line of each text and the end) of all lines of ``texts``,
    split at newlines. An empty text is one empty line."""
    raw = "\n".join(texts).encode("utf-8", "replace")
    cls = _CLASS[np.frombuffer(raw, np.uint8)]
    ends = np.append(np.flatnonzero(cls == END), len(cls))
    starts = np.concatenate([[0], ends[:-1] + 1])
    first = np.concatenate([[0], np.cumsum([t.count("\n") + 1 for t in texts])]).astype(np.int64)

    def count(mask):
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (total[ends] - total[starts]).astype(np.float64)

    blank = (cls == SPACE) | (cls == END)
    begins = ~blank
    begins[1:] &= blank[:-1]
    chars, words = count(cls != INNER), count(begins)
    n, w = np.maximum(chars, 1), np.maximum(words, 1)
    by = {c: count(cls == c) for c in (UPPER, DIGIT, SIGN, BANG, POINT, BAR)}
    last = np.where(ends > starts, cls[np.maximum(ends - 1, 0)] if len(cls) else 0, 255)
    repeated = np.zeros(len(ends))
    at = 0
    for t in texts:
        seen = set()
        for line in t.split("\n"):
            if line in seen and line:
                repeated[at] = 1
            seen.add(line)
            at += 1
    cap = lambda x: np.minimum(x, 1.0)
    upper, sign, bang, bar = by[UPPER] / n, cap(by[SIGN] / w), cap(by[BANG] / w), cap(by[BAR] / w)
    own = np.stack([np.ones(len(n)), upper, by[DIGIT] / n, sign, bang, bar, cap(by[POINT] / w), cap(chars / w / 20), repeated, np.log1p(words) / 6,
                    ((last == POINT) | (last == BANG)).astype(float), (words == 0).astype(float), (words < 4).astype(float),
                    (upper > 0.3).astype(float), (sign > 0.2).astype(float), (bang > 0.3).astype(float), (bar > 0.2).astype(float), ((sign > 0.03) & (sign <= 0.2)).astype(float)], 1)
    before, after = np.zeros((len(n), len(NEAR))), np.zeros((len(n), len(NEAR)))
    before[1:], after[:-1] = own[:-1, NEAR], own[1:, NEAR]
    before[first[:-1]], after[first[1:] - 1] = 0, 0
    return np.concatenate([own, before, after], 1), chars, first


def groups(first: np.ndarray, most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts in groups of like length, as (texts, lines of each padded with -1), of about
    ``most`` cells, so that one very long text doesn't widen the others' rows."""
    size = np.diff(first)
    order = np.argsort(size, kind="stable")
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and size[order[j]] <= max(2 * size[order[i]], 8) and (j - i + 1) * size[order[j]] <= most:
            j += 1
        own = order[i:j]
        col = np.arange(size[own].max())
        yield own, np.where(col[None, :] < size[own][:, None], first[own][:, None] + col[None, :], -1)
        i = j


def _chain(e: np.ndarray, mask: np.ndarray, trans: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded log-odds ``e``: P(state 1) of each cell, and the expected number of
    each transition, rows counting by ``weight`` (only where given)."""
    rows, width = e.shape
    a = np.exp(trans)
    one = 1 / (1 + np.exp(-np.clip(e, -30, 30)))
    em = np.stack([1 - one, one], 2)
    alpha, beta = np.empty((rows, width, 2)), np.ones((rows, width, 2))
    alpha[:, 0] = em[:, 0]
    for t in range(1, width):
        step = (alpha[:, t - 1] @ a) * em[:, t]
        alpha[:, t] = np.where(mask[:, t][:, None], step / step.sum(1, keepdims=True), alpha[:, t - 1])
    pairs = np.zeros((2, 2))
    for t in range(width - 2, -1, -1):
        ahead = em[:, t + 1] * beta[:, t + 1]
        on = mask[:, t + 1]
        if weight is not None:
            both = alpha[on, t][:, :, None] * a * ahead[on][:, None, :]
            pairs += (weight[on][:, None, None] * both / both.sum((1, 2), keepdims=True)).sum(0)
        back = ahead @ a.T
        beta[:, t] = np.where(on[:, None], back / back.sum(1, keepdims=True), 1.0)
    both = alpha * beta
    return both[:, :, 1] / both.sum(2), pairs


class Crf:
    def __init__(self, n_features: int = N_FEATURES):
        self.w, self.trans = np.zeros(n_features), np.zeros((2, 2))

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3) -> None:
        """Maximise the conditional likelihood of lines that all bear their text's label, by
        gradient ascent with adaptive steps; each text counts by its weight however long it is."""
        each = weight / np.diff(first) / weight.sum()
        share = np.repeat(each, np.diff(first))
        theta = np.concatenate([self.w, self.trans.ravel()])
        m, v, n = np.zeros_like(theta), np.zeros_like(theta), len(self.w)
        batches = [(own, at, at >= 0) for own, at in groups(first)]
        for k in range(1, rounds + 1):
            self.w, self.trans = theta[:n], theta[n:].reshape(2, 2)
            e = x @ self.w
            grad_e, grad_t = np.zeros(len(x)), np.zeros((2, 2))
            for own, at, mask in batches:
                for label in (0, 1):
                    pick = y[own] == label
                    if not pick.any():
                        continue
                    on, w = mask[pick], each[own][pick]
                    p, pairs = _chain(np.where(on, e[at[pick]], 0), on, self.trans, w)
                    grad_e[at[pick][on]] = label - p[on]
                    grad_t[label, label] += (w * on[:, 1:].sum(1)).sum()
                    grad_t -= pairs
            g = np.concatenate([x.T @ (grad_e * share), grad_t.ravel()]) - ridge * theta
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta = theta + rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
        self.w, self.trans = theta[:n], theta[n:].reshape(2, 2)

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(state 1) of each line."""
        e, out = x @ self.w, np.zeros(len(x))
        for _, at in groups(first):
            mask = at >= 0
            out[at[mask]] = _chain(np.where(mask, e[at], 0), mask, self.trans)[0][mask]
        return out

    def viterbi(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The likeliest state of each line, together with its neighbours'; ties go to 1."""
        e, out = x @ self.w, np.ones(len(x), np.int8)
        for _, at in groups(first):
            mask = at >= 0
            rows, width = at.shape
            score = np.stack([np.zeros(rows), e[at[:, 0]]], 1)
            back = np.zeros((rows, width, 2), np.int8)
            for t in range(1, width):
                both = score[:, :, None] + self.trans[None]
                back[:, t] = both[:, 1] >= both[:, 0]
                step = both.max(1)
                step[:, 1] += np.where(mask[:, t], e[at[:, t]], 0)
                score = np.where(mask[:, t][:, None], step, score)
            state = (score[:, 1] >= score[:, 0]).astype(np.int8)
            for t in range(width - 1, -1, -1):
                on = mask[:, t]
                out[at[on, t]] = state[on]
                state = np.where(on, back[np.arange(rows), t, state], state)
        return out


def fit_on_labels(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", max_train: int = 8_000,
                  max_lines: int = 400_000) -> tuple[Crf, np.ndarray, np.ndarray, np.ndarray]:
    """A CRF from the whole texts of at most ``max_train`` labelled ids (half of each label; held-out rows
    never, see ``labelled_sample``), of rows that repeat an id one. Rows are taken by their id's hash
    while all lines of a label stay within half of ``max_lines``, which bounds the driver's memory
    (120 bytes a line); no text is cut. Texts are weighted as all learnable labels are split. Also
    returns each text's length-weighted P(good), its label and its weight, for calibration."""
    chosen = labelled_sample(labels, label, max_train)
    train = cut(training_rows(docs, text, chosen), "labelled-texts")
    sizes = train.select("doc_id", "y", F.xxhash64("doc_id").alias("h"), (F.length("t") - F.length(F.replace("t", F.lit("\n"))) + 1).alias("n")).collect()
    taken, total = [], {0: 0, 1: 0}
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if total[r["y"]] + r["n"] <= max_lines // 2:
            total[r["y"]] += r["n"]
            taken.append((r["doc_id"],))
    if len(taken) < len(sizes):
        train = train.join(F.broadcast(docs.sparkSession.createDataFrame(taken, "doc_id bigint")), "doc_id", "left_semi")
    train = train.select("y", "t")

    def describe(batches):
        for batch in batches:
            out_x, out_c = [], []
            for t in batch.column(1).to_pylist():
                x, chars, _ = line_features([t])
                out_x.append(x.astype(np.float32).tobytes())
                out_c.append(chars.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out_x, pa.binary()), pa.array(out_c, pa.list_(pa.float64()))], names=["y", "x", "chars"])

    got = train.mapInArrow(describe, "y int, x binary, chars array<double>").toArrow()
    crf = Crf()
    if not got.num_rows:
        return crf, np.zeros(0), np.zeros(0), np.zeros(0)
    y = got["y"].to_numpy()
    parts = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES).astype(np.float64) for b in got["x"].to_pylist()]
    order = sorted(range(len(y)), key=lambda i: (y[i], parts[i].tobytes()))  # whatever order the tasks ended in
    parts, y = [parts[i] for i in order], y[order]
    chars = got["chars"].to_pylist()
    chars = [chars[i] for i in order]
    share = class_share(labels, label)
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    x = np.concatenate(parts)
    crf.fit(x, first, y, weight)
    good = weighted(crf.marginals(x, first), np.concatenate(chars), first)
    return crf, good, y, weight


def weighted(value: np.ndarray, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The mean of ``value`` over each text's lines, weighted by their length and one more."""
    total = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[first])
    return total(value * (chars + 1)) / total(chars + 1)
