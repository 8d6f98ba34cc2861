"""Exact substring deduplication: windows of words that occur more than once go.

A count-min sketch says which windows may repeat, and only those are grouped exactly. What
the sketch counts is a window's minimizer: of the GRAM-word sequences in the window, the one
with the least hash. Equal windows have equal minimizers at equal offsets, so a window that
repeats has a minimizer that does, at two places; and neighbouring windows mostly share the
place, so there are far fewer to count than windows. The sketch overestimates, so no
repeated window is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow.llm.common import MAX_ID, ByteWords, byte_words, cut, discard, flat_words, grams, mix, slices

GRAM, DEPTH, ROOM = 11, 2, 8
#: Bytes of text that a task takes words and hashes of at once (they need some twenty-five times as much), and
#: rows of a batch: with a core's Python process each, this is what an executor holds beside its heap.
SLICE, ROWS = 1_000_000, 2_000
_BASE = np.uint64(0xD6E8FEB86659FD93)


def minimizers(h: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, minimizer hash) of every run of consecutive windows of a text with
    the minimizer at the same place; windows by their first word in ``h``."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = min(GRAM, window)
    if len(h) < window:
        return none
    g = grams(h, gram)
    span = window - gram + 1
    low = least(g, span)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(owner[: len(low)] == owner[window - 1:])
    if not len(at):
        return none
    low, text = low[at], owner[at]
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (text[1:] != text[:-1])])
    begin = np.flatnonzero(new)
    return at[begin], np.diff(np.append(begin, len(at))), g[low[begin]]


def least(g: np.ndarray, span: int) -> np.ndarray:
    """Where the least of every ``span`` consecutive entries is, the first of equal ones: windows of doubled
    size from two that overlap, so that no entry is copied once a window."""
    low, size = np.arange(len(g)), 1
    while size < span:
        step = min(size, span - size)
        a, b = low[:-step], low[step:]
        low, size = np.where(g[b] < g[a], b, a), size + step
    return low


def window_hashes(h: np.ndarray, window: int) -> np.ndarray:
    """The hash of every ``window`` consecutive words, from running sums."""
    n = len(h)
    if n < window:
        return np.zeros(0, np.uint64)
    power = np.cumprod(np.full(n, _BASE, np.uint64))
    back = np.cumprod(np.full(n, np.uint64(pow(int(_BASE), -1, 2**64)), np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power, dtype=np.uint64)])
    return mix((total[window:] - total[: n - window + 1]) * back[: n - window + 1])


def _blocks(window: int):
    def run(batches):
        words = ByteWords(seed=21)
        for batch in batches:
            for part in slices(batch, "t", SLICE):
                h, first = flat_words(part.column(2).to_pylist(), words, byte_words)
                at, n, key = minimizers(h, first, window)
                text = np.searchsorted(first, at, "right") - 1
                own = pa.array(text)
                yield pa.RecordBatch.from_arrays([part.column(0).take(own), part.column(1).take(own), pa.array((at - first[text]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(key.view(np.int64))],
                                                 names=["id", "version", "at", "n", "key"])

    return run


def _windows(window: int):
    def run(batches):
        words = ByteWords(seed=22)
        for batch in batches:
            for part in slices(batch, "t", SLICE):
                h, first = flat_words(part.column(2).to_pylist(), words, byte_words)
                w = window_hashes(h, window)
                runs = part.column(3)
                size = np.diff(runs.offsets.to_numpy())
                v = runs.flatten()
                at, n, key = (v.field(k).to_numpy() for k in range(3))
                text = np.repeat(np.arange(part.num_rows), size)
                begin = first[text] + at
                ends = np.cumsum(n, dtype=np.int64)
                where = np.repeat(begin - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
                hashes = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(w[where].view(np.int64)))
                own = pa.array(text)
                yield pa.RecordBatch.from_arrays([part.column(0).take(own), part.column(1).take(own), pa.array(at), pa.array(key), hashes], names=["id", "version", "at", "key", "hashes"])

    return run


def _remove(window: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "t", SLICE):
                out, total, gone = [], [], []
                for text, starts in zip(part.column(1).to_pylist(), part.column(2), strict=True):
                    words = byte_words(text)
                    total.append(len(words))
                    if not starts.is_valid:
                        gone.append(0)
                        out.append(b" ".join(words).decode("utf-8", "replace"))
                        continue
                    edge = np.zeros(len(words) + 1, np.int64)
                    at = starts.values.to_numpy()
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                    stay = np.cumsum(edge)[:-1] == 0
                    gone.append(int(len(words) - stay.sum()))
                    out.append(b" ".join([words[i] for i in np.flatnonzero(stay)]).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())], names=["own", "n_words", "n_removed", "kept"])

    return run


def dedup_substrings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs``: each word goes that a window of
    ``window`` words covers whose word sequence starts anywhere else, in the same text
    included; all windows are judged on the input. ``kept`` is the rest, joined by spaces.

    1. Each text gives one row per run of windows with one minimizer.
    2. The sketch has DEPTH rows of counters, ROOM times as many as there are runs. A row is kept
       sparse: each task's partial counts are its sketch, and merging them is the shuffle. Runs
       whose counter says 1 are done; the second row counts only those that remain.
    3. Runs left over meet their texts and give the hashes of their windows; these, together with
       the minimizer 128 bits from two independent word hashes, are counted exactly.
    4. What occurs twice or more goes back to the texts as window starts.
    A join that a hot minimizer or window meets reads both sides from shuffles of its own, so that
    adaptive execution can split it; the counts combine before they are shuffled. What is read
    once only isn't written. A table goes when the next that is made of it is written.

    A null or empty text has no words; one shorter than ``window`` loses none. Rows that repeat are
    documents of their own: each loses all its windows. A null id is carried along. Other
    columns aren't looked at, whatever their names. No rows give no rows.
    """
    base = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(MAX_ID)).alias("id"), F.col(doc_id).alias("own"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    base = base.withColumn("version", F.xxhash64("t"))
    runs = cut(base.select("id", "version", "t").mapInArrow(_blocks(window), "id bigint, version bigint, at int, n int, key bigint"), "window-runs", ROWS)
    bits = max(10, math.ceil(math.log2(ROOM * runs.count() + 1)))
    written = runs
    for depth in range(DEPTH):
        if depth:
            runs = cut(runs, "repeated-runs")
            discard(written)
            written = runs
        cell = F.shiftrightunsigned(F.xxhash64(F.lit(depth), "key"), 64 - bits).alias("cell")
        # Counted by cell, joined by its complement: the join then shuffles the row anew, and can be split.
        row = runs.select(cell).groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select(F.bitwise_not("cell").alias("cell"))
        runs = runs.withColumn("cell", F.bitwise_not(cell)).join(row, "cell", "left_semi").drop("cell")
    mine = runs.groupBy("id", "version").agg(F.collect_set(F.struct("at", "n", "key")).alias("runs"))
    rows = base.select("id", "version", "t").join(mine, ["id", "version"])
    held = cut(rows.mapInArrow(_windows(window), "id bigint, version bigint, at int, key bigint, hashes array<bigint>"), "windows", ROWS)
    discard(written)
    each = held.select("id", "version", "key", "at", F.posexplode("hashes").alias("i", "hash")).select("id", "version", "key", "hash", (F.col("at") + F.col("i")).alias("start"))
    again = cut(each.groupBy("key", "hash").agg(F.count("*").alias("n")).where("n > 1").select("key", "hash"), "repeated-windows")
    gone = cut(each.join(again, ["key", "hash"], "left_semi").groupBy("id", "version")
               .agg(F.collect_set("start").alias("starts")), "removed")
    discard(held, again)
    return (base.join(gone, ["id", "version"], "left").select("own", "t", "starts")
            .mapInArrow(_remove(window), f"own {docs.schema[doc_id].dataType.simpleString()}, n_words bigint, n_removed bigint, kept string")
            .withColumnRenamed("own", doc_id))
