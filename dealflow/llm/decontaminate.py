"""Benchmark decontamination by SimHash over item-sized windows.

Every window of a text that is as long as some benchmark item gets a 128-bit SimHash of its
weighted word shingles; a multi-index over blocks of the fingerprints' bits leads to all items
within the Hamming radius, and the exact weighted similarity decides.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import add_columns, flat_words, grams, mix, Words

SHINGLE, BITS, BLOCKS = 5, 128, 8
WORD = re.compile(r"\w+").findall
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_FILTER = 20


def normal_words(text: str) -> list[str]:
    return WORD(text.lower())


def signs(g: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's hash and of a second one."""
    both = np.stack([g, mix(g ^ np.uint64(0x5851F42D4C957F2D))], axis=1).astype("<u8")
    bits = np.unpackbits(both.view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
    return bits.astype(np.float32) * 2 - 1


def radius(threshold: float, deviations: float) -> int:
    """The bits that two SimHashes may differ in: so many standard deviations more than sets that are
    ``threshold`` alike do, which is 19 of 128 bits at 0.8, the deviation being 4."""
    p = math.acos(min(1.0, 2 * threshold / (1 + threshold))) / math.pi
    return int(BITS * p + deviations * math.sqrt(BITS * p * (1 - p)))


class MultiIndex:
    """Fingerprints by the values of their blocks: every value that a block may have within its share of the
    radius leads to the fingerprint, in a table from (block, value) to fingerprints, so a look-up reads
    only what is near. Fingerprints within the radius (three deviations; at 0.8 31 bits, so three a block)
    share such a block, so none is missed; of random ones one pair in twelve does. Alike ones
    further apart share a block too, but for a few in a million: those within five deviations count."""

    def __init__(self, prints: np.ndarray, threshold: float = 0.8):
        self.prints, self.radius, self.reach = prints, radius(threshold, 3), radius(threshold, 5)
        changes = np.array([sum(1 << b for b in bits) for n in range(self.radius // BLOCKS + 1) for bits in itertools.combinations(range(BITS // BLOCKS), n)], np.uint16)
        ids, counts = [], []
        for v in prints.view("<u2").T:
            values = (v[:, None] ^ changes[None]).ravel()
            ids.append((np.argsort(values, kind="stable") // len(changes)).astype(np.int32))
            counts.append(np.bincount(values, minlength=1 << 16))
        self.ids, self.first = np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    def candidates(self, prints: np.ndarray, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, id) of the pairs of ``prints`` and indexed fingerprints (those where the mask ``of`` holds) that
        share a block nearly, each once."""
        keys = (prints.view("<u2").astype(np.int64) + (np.arange(BLOCKS) << 16)).ravel()
        n = self.first[keys + 1] - self.first[keys]
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(self.first[keys] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        rows = np.repeat(np.arange(len(keys)) // BLOCKS, n)
        if of is not None:
            rows, ids = rows[of[ids]], ids[of[ids]]
        pairs = np.unique(rows * max(len(self.prints), 1) + ids)
        return pairs // max(len(self.prints), 1), pairs % max(len(self.prints), 1)

    def within(self, prints: np.ndarray, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, id) of those pairs within reach."""
        rows, ids = self.candidates(prints, of)
        near = _POP[prints[rows] ^ self.prints[ids]].sum(1) <= self.reach
        return rows[near], ids[near]


def pack(total: np.ndarray) -> np.ndarray:
    """The fingerprint, BITS / 8 bytes, of each row of bit sums; they are rounded, so that a sum of
    zero gives the same bit however it was added up."""
    return np.packbits(np.round(total, 6) > 0, axis=1, bitorder="little")


class Benchmark:
    """One block of items: shingles with their weights, fingerprints, and the multi-index.
    ``statistics`` are those of the whole benchmark, see ``frequencies``; without them the block is it."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = 0.8, statistics: tuple[int, np.ndarray, np.ndarray] | None = None):
        words = Words(seed=5)
        self.threshold, self.ids, self.sets = threshold, [], []
        #: Items shorter than a shingle have one of all their words: by length, its hash and the items' ids.
        self.short: dict[int, dict[int, list[int]]] = {}
        sizes = []
        for i, text in items:
            h, _ = flat_words([text], words, normal_words)
            if 0 < len(h) < SHINGLE:
                self.short.setdefault(len(h), {}).setdefault(int(grams(h, len(h))[0]), []).append(i)
            if len(h) >= SHINGLE:
                self.ids.append(i)
                self.sets.append(grams(h, SHINGLE))
                sizes.append(len(h) - SHINGLE + 1)
        self.sizes = np.array(sizes, np.int64)
        own, df = np.unique(np.concatenate([np.unique(s) for s in self.sets] or [np.zeros(0, np.uint64)]), return_counts=True)
        n_items, common, df = statistics or (len(self.ids), own[df > 1], df[df > 1])
        self.unseen = float(np.log1p(n_items))
        #: The block's shingles and all that several items have, of whatever block; any other weighs as an unseen one.
        self.shingles = np.union1d(own, common)
        self.own = np.isin(self.shingles, own)
        self.weight = np.full(len(self.shingles), self.unseen)
        self.weight[np.searchsorted(self.shingles, common)] = np.log1p(n_items / df)
        self.has = np.zeros(1 << _FILTER, bool)
        self.has[(self.shingles & np.uint64((1 << _FILTER) - 1)).astype(np.int64)] = True
        self.prints = np.concatenate([pack((signs(x) * self.weights(x)[0][:, None]).sum(0, keepdims=True)) for x in self.sets] or [np.zeros((0, BITS // 8), np.uint8)])
        self.index = MultiIndex(self.prints, threshold)

    def weights(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each shingle's weight, and whether an item of the block has it. One that none has weighs as
        much as one that a single item has, so that weights never depend on the texts searched."""
        known = np.zeros(len(g), bool)
        out = np.full(len(g), self.unseen)
        if len(self.shingles):
            may = np.flatnonzero(self.has[(g & np.uint64((1 << _FILTER) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.shingles, g[may]), len(self.shingles) - 1)
            hit = self.shingles[at] == g[may]
            known[may[hit]] = self.own[at[hit]]
            out[may[hit]] = self.weight[at[hit]]
        return out, known

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of the two multisets of shingles."""
        keys, where = np.unique(np.concatenate([window, self.sets[item]]), return_inverse=True)
        a = np.bincount(where[: len(window)], minlength=len(keys))
        b = np.bincount(where[len(window):], minlength=len(keys))
        w = self.weights(keys)[0]
        return float((w * np.minimum(a, b)).sum() / (w * np.maximum(a, b)).sum())

    def search(self, g: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of the best window for each item that the text with
        these shingles holds. A window whose known shingles weigh less than the threshold's share
        of it is as similar to no item, so it needs no fingerprint."""
        w, known = self.weights(g)
        total = np.concatenate([[0.0], np.cumsum(w)])
        part = np.concatenate([[0.0], np.cumsum(w * known)])
        best: dict[int, tuple[float, int]] = {}
        for n in np.unique(self.sizes):
            if n > len(g):
                break
            at = np.flatnonzero(part[n:] - part[:-n] >= self.threshold * (total[n:] - total[:-n]) - 1e-9)
            for i in range(0, len(at), 4096):
                self._match(g, w, at[i: i + 4096], int(n), best)
        return [(self.ids[k], s, a, int(self.sizes[k]) + SHINGLE - 1) for k, (s, a) in sorted(best.items(), key=lambda x: self.ids[x[0]])]

    def search_short(self, h: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, 1.0, first word, words) of the first window of the text's words ``h`` that is an item
        shorter than a shingle."""
        out = []
        for n, ids in self.short.items():
            g = grams(h, n)
            for a in np.flatnonzero(np.isin(g, np.array(list(ids), np.uint64))).tolist():
                out += [(i, 1.0, a, n) for i in ids[int(g[a])]]
        return [min(x for x in out if x[0] == i) for i in sorted({x[0] for x in out})]

    def _match(self, g, w, at, n, best) -> None:
        lo = at[0]
        span = slice(int(lo), int(at[-1]) + n)
        if span.stop - span.start <= 20 * len(at) + 8 * n:
            sums = np.concatenate([np.zeros((1, BITS)), np.cumsum(signs(g[span]) * w[span, None], axis=0, dtype=np.float64)])
            prints = pack(sums[at - lo + n] - sums[at - lo])
        else:  # windows far apart: one by one
            prints = np.concatenate([pack((signs(g[a: a + n]) * w[a: a + n, None]).sum(0, keepdims=True)) for a in at])
        for r, k in zip(*[x.tolist() for x in self.index.within(prints, self.sizes == n)], strict=True):
            a = int(at[r])
            s = self.similarity(g[a: a + n], k)
            if s >= self.threshold - 1e-9 and s > best.get(k, (0.0, 0))[0] + 1e-12:
                best[k] = (s, a)


def frequencies(items: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Of all items (i, t): how many have a shingle, the shingles that several have, by hash, and how
    many have each."""
    def each(batches):
        words = Words(seed=5)
        for batch in batches:
            sets = [np.unique(grams(flat_words([t], words, normal_words)[0], SHINGLE)) for t in batch.column(0).to_pylist()]
            for s in sets:
                if len(s):  # a null stands for the item itself
                    yield pa.RecordBatch.from_arrays([pa.array([None, *s.view(np.int64).tolist()], pa.int64())], names=["g"])

    got = items.select("t").mapInArrow(each, "g bigint").groupBy("g").agg(F.count("*").alias("n")).where("n > 1 or g is null").toArrow().to_pydict()
    found = sorted((g & (2**64 - 1), n) for g, n in zip(got["g"], got["n"], strict=True) if g is not None)
    n_items = sum(n for g, n in zip(got["g"], got["n"], strict=True) if g is None)
    return n_items, np.array([g for g, _ in found], np.uint64), np.array([n for _, n in found], np.int64)


LEAK = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("n_words", T.LongType())])


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", threshold: float = 0.8,
               block_items: int = 2000, out: str = "leaks", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``out``: for each benchmark item that the text holds, the item's id, the
    weighted-shingle similarity of the best window, its first word and its length in words
    (lower-cased runs of letters, digits and underscores), by item id.

    Windows have the item's own length; SHINGLE words make a shingle, weighted by how few of all
    items have it: the counts are one aggregate over the whole benchmark, so ``block_items``
    changes no similarity. Fingerprints within the radius of the threshold are all found, whatever the bits. Items are taken in blocks of about
    ``block_items``, chosen by the id's hash, and each block passes over the texts once, without
    a shuffle: memory is bounded by a block, the shingles that several items have (17 bytes each)
    and the longest text. An item of fewer than SHINGLE words has one shingle of them all, so a text
    holds it where it has the same words in a row. Items with a null id or text or without a word
    match nothing; null and empty texts hold nothing.
    Items that repeat an id count each for themselves. Repeated rows of ``docs`` get the same
    result. A column named like ``out`` is replaced; ``keep`` names the columns to return. An
    empty benchmark or an empty ``docs`` gives empty results."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    n_blocks = max(1, -(-items.count() // block_items))
    names = [c for c in (docs.columns if keep is None else keep) if c != out]
    statistics = frequencies(items)
    current, parts = docs, []
    for b in range(n_blocks):
        rows = sorted((r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64("i"), F.lit(n_blocks)) == b).collect())
        shared = docs.sparkSession.sparkContext.broadcast(Benchmark(rows, threshold, statistics))
        part = out if n_blocks == 1 else f"__{out}_{b}"
        current = add_columns(current, text, [(part, T.ArrayType(LEAK))], _searcher(shared), names + parts + ([text] if b < n_blocks - 1 and text not in names else []))
        parts.append(part)
    if n_blocks > 1:
        current = current.select(*[F.col(f"`{c}`") for c in names], F.array_sort(F.concat(*parts)).alias(out))
    return current


def _searcher(shared):
    def make():
        bench, words = shared.value, Words(seed=5)

        def compute(texts):
            h, first = flat_words(texts, words, normal_words)
            g = grams(h, SHINGLE)
            out: list[list] = [[] for _ in texts]
            if bench.short:
                for i in range(len(texts)):
                    out[i] = bench.search_short(h[first[i]: first[i + 1]])
            if len(g) and len(bench.shingles):
                search(g, first, out)
            return [[[{"item_id": k, "similarity": s, "start": a, "n_words": n} for k, s, a, n in sorted(x)] for x in out]]

        def search(g, first, out):
            seen = np.concatenate([[0], np.cumsum(bench.weights(g)[1])])
            ends = np.maximum(first[1:] - SHINGLE + 1, first[:-1])
            for i in np.flatnonzero(seen[np.minimum(ends, len(g))] > seen[np.minimum(first[:-1], len(g))]):
                out[i] += bench.search(g[first[i]: ends[i]])

        return compute

    return make
