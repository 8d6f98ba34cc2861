"""Byte-level BPE by speculation: greedy longest matches propose a word's tokens, the
adjacent pairs of all proposals are checked together, and only words with a pair that
exact merging would split otherwise are merged exactly.

A token sequence is the exact one if and only if every adjacent pair is what merging gives
for the pair's own bytes, so words that pass need no merging at all.
"""

from __future__ import annotations

import heapq
import json
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import add_columns, fresh, kept

#: Fixed: the split pattern of byte-level vocabularies, white space by its Unicode property.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: printable Latin-1 characters
    stand for themselves, the other bytes in order for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """``spec``: the JSON text of a byte-level BPE tokenizer file. ``cached``: after this many
    words the caches are emptied, so that memory stays bounded."""

    def __init__(self, spec: str, cached: int = 300_000):
        j, to_byte = json.loads(spec), byte_of_char()
        pre = j["pre_tokenizer"]
        if j["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or j["normalizer"] or j["model"]["ignore_merges"]:
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        raw = lambda s: bytes(to_byte[c] for c in s)
        self.bytes_of = {i: raw(s) for s, i in j["model"]["vocab"].items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.id_of_byte = [self.id_of.get(bytes([b])) for b in range(256)]
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.rank: dict[int, tuple[int, int]] = {}
        for r, m in enumerate(j["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b = raw(a), raw(b)
            self.rank.setdefault(self.id_of[a] << 32 | self.id_of[b], (r, self.id_of[a + b]))
        self.last = len(self.rank)
        self.pair_keys = np.array(sorted(self.rank), np.int64)
        by = sorted(self.rank.items())
        order = np.argsort([v[0] for _, v in by])
        self.pair_ranks = np.empty(len(by), np.int64)
        self.pair_ranks[order] = np.arange(len(by))
        self.made = np.array([by[i][1][1] for i in order], np.int64)
        self.byte_ids = np.array([-1 if i is None else i for i in self.id_of_byte], np.int64)
        self.prefixes = {b[:k] for b in self.id_of for k in range(1, len(b) + 1)}
        self.split = regex.compile(PATTERN).findall
        self.apart = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else lambda t: [t]
        self.special_ids = {s: np.array([i], np.int32).tobytes() for s, i in self.special.items()}
        self.all_bytes = self.bytes_of | {i: s.encode() for s, i in self.special.items()}
        self.cached, self.words, self.pairs, self.exact = cached, {}, {}, 0

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest rank first, the leftmost among equals. Short words are
        searched pair by pair, long ones by a heap over a linked list in O(n log n)."""
        ids = [self.id_of_byte[b] for b in word]
        if len(ids) > 40:
            return self._merge_long(ids)
        rank, none = self.rank.get, (1 << 62, 0)
        found = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best is none:
                break
            i = found.index(best)
            ids[i: i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = rank(ids[i - 1] << 32 | ids[i], none)
            if i < len(found):
                found[i] = rank(ids[i] << 32 | ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, rank = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := rank(a << 32 | b))]
        heap = [(r, i, a, b, new) for r, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n and (got := rank(ids[x] << 32 | ids[after[x]])):
                    heapq.heappush(heap, (got[0], x, ids[x], ids[after[x]], got[1]))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest matches from the left."""
        out, i, n, known, ids = [], 0, len(word), self.prefixes, self.id_of
        while i < n:
            k = last = i + 1
            while k < n and word[i: k + 1] in known:
                k += 1
                if word[i:k] in ids:
                    last = k
            out.append(ids[word[i:last]])
            i = last
        return out

    def learn(self, words: list[str]) -> None:
        """Put the tokens of new words into the cache. The adjacent pairs of all proposals, and
        lone tokens as pairs with nothing, are looked up as one array; pairs met for the
        first time are merged, once and together, as the words that fail are."""
        raw = [w.encode("utf-8", "replace") for w in words]
        got = [self.propose(b) for b in raw]
        sizes = np.array([len(g) for g in got])
        flat = np.array([t for g in got for t in g], np.int64)
        ends = np.cumsum(sizes)
        keys = flat << 32
        inner = np.ones(len(flat), bool)
        inner[ends - 1] = False
        keys[:-1][inner[:-1]] |= flat[1:][inner[:-1]] + 1
        keep = inner | np.repeat(sizes == 1, sizes)
        distinct, where = np.unique(keys[keep], return_inverse=True)
        fine = np.ones(len(flat), bool)
        fine[keep] = self.compatible(distinct.tolist())[where]
        failed = np.flatnonzero(~np.logical_and.reduceat(fine, ends - sizes)).tolist()
        for i, g in zip(failed, self.merge_all([raw[i] for i in failed]), strict=True):
            got[i] = g
        self.exact += len(failed)
        for w, g in zip(words, got, strict=True):
            self.words[w] = array("i", g).tobytes()

    def compatible(self, keys: list[int]) -> np.ndarray:
        """Whether each pair (first token in the high half, second plus one in the low) is what
        merging gives for its bytes."""
        new = [k for k in keys if k not in self.pairs]
        own = [[k >> 32, (k & 0xFFFFFFFF) - 1][: 1 + bool(k & 0xFFFFFFFF)] for k in new]
        for k, o, g in zip(new, own, self.merge_all([b"".join([self.bytes_of[t] for t in o]) for o in own]), strict=True):
            self.pairs[k] = o == g
        return np.array([self.pairs[k] for k in keys], bool)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging of many words at a time: in every round each word merges its lowest-ranked
        pair, the leftmost among equals. Long words go one by one."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= 40]
        for i, w in enumerate(words):
            if len(w) > 40:
                out[i] = self.merge(w)
        if not short:
            return out
        sizes = np.array([len(words[i]) for i in short])
        ids = self.byte_ids[np.frombuffer(b"".join([words[i] for i in short]), np.uint8)]
        owner = np.repeat(np.arange(len(short)), sizes)
        rank = self.ranks(ids, owner)
        done = np.flatnonzero(sizes > 0)
        while True:
            begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(rank, begin)
            live = low < self.last
            if not live.any():
                break
            at = np.flatnonzero((rank == np.repeat(low, np.diff(np.append(begin, len(rank))))) & (rank < self.last))
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            ids[at] = self.made[rank[at]]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            new = np.cumsum(stay) - 1
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            at = new[at]
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[touched] = self.ranks_at(ids, owner, touched)
        parts = np.split(ids, np.flatnonzero(owner[1:] != owner[:-1]) + 1)
        for k, g in zip(done, parts, strict=True):
            out[short[k]] = g.tolist()
        return [[] if g is None else g for g in out]

    def ranks(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return self.ranks_at(ids, owner, np.arange(len(ids)))

    def ranks_at(self, ids: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rank of the pair that begins at each place; ``last`` if it can't merge."""
        after = np.minimum(at + 1, len(ids) - 1)
        key = ids[at] << 32 | ids[after]
        where = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[where] == key) & (owner[after] == owner[at]) & (after > at), self.pair_ranks[where], self.last)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if len(self.words) > self.cached:
            self.words.clear()
        if len(self.pairs) > 2 * self.cached:
            self.pairs.clear()
        parts = [self.apart(t) for t in texts]
        split = [[(p,) if p in self.special else self.split(p) for p in ps if p] for ps in parts]
        new = {w for s in split for ws in s if not isinstance(ws, tuple) for w in ws if w not in self.words}
        if new:
            self.learn(list(new))
        get = self.words.__getitem__
        return [b"".join(self.special_ids[ws[0]] if isinstance(ws, tuple) else b"".join(map(get, ws)) for ws in s) for s in split]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of the tokens' bytes, special tokens as written; ids that the vocabulary
        lacks stand for nothing, bytes that aren't UTF-8 for U+FFFD."""
        get = self.all_bytes.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


def loaded(spec: str) -> Bpe:
    """The tokenizer, with the words that earlier tasks of this Python process have met."""
    return kept(("bpe", spec), lambda: Bpe(spec))


def _shared(df: DataFrame, path: str):
    """The tokenizer file's text, read once by the driver; executors need no such file."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", keep: list[str] | None = None, decoded: str | None = None) -> DataFrame:
    """``docs`` with ``out``, the array of token ids of each text under the tokenizer file at
    ``path`` (special tokens' strings become their ids). With ``decoded``, also a column of that
    name, the text that the ids decode to, by the same task: a round trip in one pass.

    A null or empty text has no tokens. Words repeat across texts, so each process keeps those it
    has met, up to a bound. A text is encoded whole; a word of any length costs O(n log n) at
    most. Repeated rows are encoded alike. A column named like a new one is replaced; ``keep``
    names the columns to return. No rows give no rows."""
    spec = _shared(docs, path)

    def make():
        bpe = loaded(spec.value)

        def compute(texts):
            got = bpe.encode_batch(texts)
            offsets = np.concatenate([[0], np.cumsum([len(g) // 4 for g in got])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(got), np.int32)))
            return [ids] + ([] if decoded is None else [[bpe.decode(np.frombuffer(g, np.int32).tolist()) for g in got]])

        return compute

    fields = [(out, T.ArrayType(T.IntegerType()))] + ([] if decoded is None else [(decoded, T.StringType())])
    return add_columns(docs, text, fields, make, keep)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``out``, the text of the token ids in ``ids`` (null: null)."""
    spec = _shared(df, path)
    names = [n for n in (df.columns if keep is None else keep) if n != out]
    schema = T.StructType([df.schema[n] for n in names] + [T.StructField(out, T.StringType())])

    def run(batches):
        bpe = loaded(spec.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [None if x is None else bpe.decode(x) for x in part.column(len(names)).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(k) for k in range(len(names))] + [pa.array(texts, pa.string())], names=[*names, out])

    return df.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{ids}`").alias(fresh("__ids", names))).mapInArrow(run, schema)
