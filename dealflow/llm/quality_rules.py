"""Quality rules: fixed measures of a text, and the share of its lines that are content.

Viterbi decoding of a linear-chain conditional random field marks each line as content or
boilerplate; the content lines' share of the characters decides whether a text stays.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dealflow.llm.common import WS, ByteWords, Words, add_columns, byte_words, flat_words, grams, mix
from dealflow.llm.crf import Crf, fit_on_labels, line_features, weighted

SYMBOLS, WINDOW = "#*$%&|<>", 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text, its words in windows of WINDOW words that it has twice or more."""
    n = np.diff(first)
    if len(h) < WINDOW:
        return np.zeros(len(n), np.int64)
    owner = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    g = grams(h, WINDOW)
    inside = owner[: len(g)] == owner[WINDOW - 1:]
    at = np.flatnonzero(inside)
    key = mix(g[at] ^ mix(owner[at] + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:-1] > 0)])
    return covered[first[1:]] - covered[first[:-1]]


def measures(texts: list[str], words: Words) -> list[np.ndarray]:
    """MEASURES of each text."""
    h, first = flat_words(texts, words, byte_words)
    dup = []
    for t in texts:
        seen, n = set(), 0
        for line in t.split("\n"):
            if line in seen:
                n += bool(line.strip(WS))
            else:
                seen.add(line)
        dup.append(n)
    return [np.diff(first), np.array([len(t) - sum(map(t.count, WS)) for t in texts], np.int64),
            np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64), np.array(dup, np.int64),
            repeated_words(h, first)]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", max_train: int = 8_000) -> Crf:
    """The field that tells content from boilerplate, see ``fit_on_labels``."""
    return fit_on_labels(docs, labels, text, label, max_train)[0]


def judge(docs: DataFrame, crf: Crf, text: str = "text", min_words: int = 10, max_repeat_pct: int = 20, min_content: float = 0.5,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` with MEASURES, ``base_failed`` (fewer than ``min_words`` words, or more than
    ``max_repeat_pct`` per cent of them in repeated windows), ``content_share``, the share of
    characters in content lines, ``boilerplate``, the other lines' numbers from 0, and
    ``kept``: false if ``base_failed``, else whether the share reaches ``min_content``.

    A null or empty text has no words and fails. Texts are taken whole; sorting their windows
    is the most costly step. Repeated rows are judged alike. Columns named like the new ones
    are replaced; ``keep`` names the columns to return. No rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)  # some dozens of numbers

    def make():
        words = ByteWords(seed=101)

        def compute(texts):
            m = measures(texts, words)
            failed = (m[0] < min_words) | (100 * m[4] > max_repeat_pct * m[0])
            x, chars, first = line_features(texts)
            state = shared.value.viterbi(x, first)
            share = weighted(state.astype(float), chars, first)
            lines = [np.flatnonzero(s == 0).tolist() for s in np.split(state, first[1:-1])]
            return [*(v.tolist() for v in m), failed.tolist(), share.tolist(), lines, (~failed & (share >= min_content)).tolist()]

        return compute

    fields = [(n, T.LongType()) for n in MEASURES] + [("base_failed", T.BooleanType()), ("content_share", T.DoubleType()), ("boilerplate", T.ArrayType(T.IntegerType())), ("kept", T.BooleanType())]
    return add_columns(docs, text, fields, make, keep)
