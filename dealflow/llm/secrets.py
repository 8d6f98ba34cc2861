"""Secret scan: fixed formats by pattern, other credentials by an inferred grammar.

The values of the fixed formats are the labelled credentials. Their prefix tree is merged
into one probabilistic automaton per kind (state merging under a Hoeffding test), and every
candidate token of every text is scored by its likelihood under the best automaton against
that under the corpus' own character statistics.
"""

from __future__ import annotations

import bisect
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import add_columns, cut, slices

KINDS = ("assign", "access", "hex", "grammar")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")
#: What may be a credential: the characters and the least length of the assigned ones. Every such run is
#: scored, and the likelihoods decide.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Symbol classes: 0 anything else, then digits, a-f, g-z, A-F, G-Z and each joining sign.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", ".", "=", "-")
N = len(CLASSES) + 1
BYTE_CLASS = bytes(next((i + 1 for i, c in enumerate(CLASSES) if chr(b) in c), 0) for b in range(256))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, index of kind, end, secret) of the fixed formats, by start, then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(out)


def likely(text: str, taken: list[tuple[int, int, int, str]], accepts) -> list[tuple[int, int]]:
    """The runs of token characters that ``accepts`` likes and that touch no span in ``taken``. A span is
    never longer than its run, so the neighbours by start decide."""
    found = [m.span() for m in CANDIDATE.finditer(text) if accepts(m.group())]
    if not found or not taken:
        return found
    starts, reach = [s[0] for s in taken], []
    for s in taken:
        reach.append(max(s[2], reach[-1] if reach else 0))
    return [(a, b) for a, b in found if not (i := bisect.bisect_left(starts, b)) or reach[i - 1] <= a]


def symbols(token: str) -> list[int]:
    return list(token.encode("utf-8", "replace").translate(BYTE_CLASS))


class Automaton:
    """A deterministic probabilistic automaton: per state, how often a string passes, ends
    and goes on by each symbol."""

    def __init__(self, samples: list[list[int]], alpha: float = 0.05, least: int = 10):
        self.next: list[dict[int, int]] = [{}]
        self.by: list[list[int]] = [[0] * N]
        self.ends = [0]
        for s in samples:
            at = 0
            for c in s:
                self.by[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.by.append([0] * N)
                    self.ends.append(0)
                at = self.next[at][c]
            self.ends[at] += 1
        self.slack, self.least = math.sqrt(0.5 * math.log(2 / alpha)), least
        self._merge()
        self._score()

    def _seen(self, q: int) -> int:
        return self.ends[q] + sum(self.by[q])

    def _close(self, f: int, n: int, g: int, m: int) -> bool:
        return abs(f / n - g / m) <= self.slack * (n ** -0.5 + m ** -0.5)

    def _compatible(self, a: int, b: int) -> bool:
        """Whether no end or symbol frequency differs by more than chance, from here on. A
        state seen fewer than ``least`` times says nothing."""
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            n, m = self._seen(p), self._seen(q)
            if n < self.least or m < self.least or p == q:
                continue
            if not self._close(self.ends[p], n, self.ends[q], m):
                return False
            for c in range(N):
                if not self._close(self.by[p][c], n, self.by[q][c], m):
                    return False
            todo += [(self.next[p][c], self.next[q][c]) for c in self.next[q] if c in self.next[p]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the state ``a``."""
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            self.ends[p] += self.ends[q]
            for c in range(N):
                self.by[p][c] += self.by[q][c]
            for c, child in self.next[q].items():
                if c in self.next[p]:
                    todo.append((self.next[p][c], child))
                else:
                    self.next[p][c] = child

    def _merge(self) -> None:
        """Red states are final; a blue one, a child of a red, merges into the first red it is
        compatible with or turns red itself. Blue states are taken in order of weight."""
        red, self.kept = [0], {0}
        while True:
            blue = [(self._seen(t), p, c, t) for p in red for c, t in self.next[p].items() if t not in self.kept]
            if not blue:
                break
            _, p, c, t = max(blue, key=lambda x: (x[0], -x[3]))
            for r in red:
                if self._compatible(r, t):
                    self.next[p][c] = r
                    self._fold(r, t)
                    break
            else:
                red.append(t)
                self.kept.add(t)
        self.states = red

    def _score(self) -> None:
        self.log = {q: [math.log((n + 0.1) / (self._seen(q) + 0.1 * (N + 1))) for n in [*self.by[q], self.ends[q]]] for q in self.states}

    def log_likelihood(self, s: list[int]) -> float:
        """Of a string that may go on: the end's probability is left out, as formats differ in
        length. An unseen step has the floor's probability and starts again at the root."""
        at, total = 0, 0.0
        for c in s:
            total += self.log[at][c]
            at = self.next[at].get(c, 0)
        return total


class Grammar:
    """One automaton a kind, the corpus' class statistics, and each kind's least score."""

    def __init__(self, automata: list[Automaton], background: np.ndarray, samples: list[list[list[int]]], quantile: float):
        self.automata, self.seen, self.most = automata, {}, 300_000
        rows = background[:, 1:] + 0.5  # within a token: the next class is never "anything else"
        self.background = np.log(rows / rows.sum(1, keepdims=True)).tolist()
        self.least = []
        for a, own in zip(automata, samples, strict=True):
            got = sorted(self.per_symbol(a, s) for s in own)
            self.least.append(max(0.25, got[int(quantile * len(got))]))

    def per_symbol(self, a: Automaton, s: list[int]) -> float:
        usual = sum(self.background[p][c - 1] for p, c in zip([0, *s], s, strict=False))
        return (a.log_likelihood(s) - usual) / len(s)

    def accepts(self, token: str) -> bool:
        """Whether some kind's automaton finds the token likelier than the corpus' statistics do, by as much as
        its own credentials. Verdicts on short tokens are kept, up to a bound."""
        known = self.seen.get(token)
        if known is None:
            s = symbols(token)
            known = any(self.per_symbol(a, s) >= least for a, least in zip(self.automata, self.least, strict=True))
            if len(token) <= 60:
                if len(self.seen) >= self.most:
                    self.seen.clear()
                self.seen[token] = known
        return known


def fit(docs: DataFrame, text: str = "text", max_train: int = 1500, max_chars: int = 200, quantile: float = 0.02) -> Grammar:
    """Learn the grammar from the corpus itself. Each kind's labelled credentials are the
    distinct values of its pattern over all texts, of longer ones the first ``max_chars``
    characters; a bounded sample of them, the ``max_train`` with the smallest hash, builds its
    automaton. Class statistics cover every byte of every text. A kind without a value gets
    no automaton; without any, nothing is accepted."""

    def scan(batches):
        counts = np.zeros(N * N, np.int64)
        for batch in batches:
            for part in slices(batch, "t"):
                found = set()
                for t in part.column(0).to_pylist():
                    if t:
                        found.update((kind, value[:max_chars]) for _, kind, _, value in base_spans(t))
                        c = np.frombuffer(t.encode("utf-8", "replace").translate(BYTE_CLASS), np.uint8).astype(np.int64)
                        counts += np.bincount(c[:-1] * N + c[1:], minlength=N * N)
                kinds, values = zip(*sorted(found), strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.string()), pa.array([1] * len(kinds), pa.int64())], names=["kind", "value", "n"])
        pairs = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-1] * len(pairs), pa.int32()), pa.array([str(p) for p in pairs], pa.string()), pa.array(counts[pairs], pa.int64())], names=["kind", "value", "n"])

    seen = docs.select(F.col(text).alias("t")).mapInArrow(scan, "kind int, value string, n bigint")
    seen = cut(seen.groupBy("kind", "value").agg(F.sum("n").alias("n")), "credentials")
    background = np.zeros(N * N)
    for r in seen.where("kind = -1").collect():  # N * N rows at most
        background[int(r["value"])] = r["n"]
    samples = []
    for kind in range(3):
        rows = seen.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(max_train).collect()
        samples.append([symbols(r["value"]) for r in rows])
    samples = [s for s in samples if s]
    return Grammar([Automaton(s) for s in samples], background.reshape(N, N), samples, quantile)


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def find_secrets(docs: DataFrame, grammar: Grammar, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``spans``, an array of (kind, start, end) in code points, by start, then
    kind as in KINDS: all fixed-format spans and those that ``grammar`` adds.

    A null or empty text has no spans. Rows that repeat are scanned alike, each by itself. Texts are taken
    whole, whatever their length. A column of ``docs`` named ``spans`` is replaced; ``keep``
    names the columns to return (default all). No rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # bounded by fit()'s max_train * max_chars

    def make():
        g = shared.value

        def compute(texts):
            out = []
            for t in texts:
                spans = base_spans(t)
                if g.automata:
                    spans = spans + [(a, 3, b, "") for a, b in likely(t, spans, g.accepts)]
                out.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b, _ in sorted(spans)])
            return [out]

        return compute

    return add_columns(docs, text, [("spans", T.ArrayType(SPAN))], make, keep)
