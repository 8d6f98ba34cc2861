"""Near duplicates: a self-join on the Jaccard similarity of word 5-grams by an LSH forest.

Every text has ``TREES`` MinHash signatures of up to ``MAX_DEPTH`` values. A tree sorts the
texts by its signature; texts that share a prefix are candidates, and the prefix is shortened
from the full signature until pairs at the threshold are found with the target recall. Texts
with the same shingles are one node throughout. The members of a trie node are dealt out in
blocks; pairs of blocks are verified exactly where their shingles meet, and give counts and
connections by member, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow.llm.common import Words, components, cut, flat_words, grams, mix, slices

SHINGLE, TREES, MAX_DEPTH, BLOCK = 5, 12, 5, 512
_rng = np.random.default_rng(20240607)
_A = _rng.integers(0, 2**63, TREES * MAX_DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, TREES * MAX_DEPTH, dtype=np.uint64)


def depth_for(threshold: float, recall: float) -> int:
    """The prefix length to stop at: shortened from MAX_DEPTH until a pair at the threshold meets in
    some tree with probability ``recall``."""
    for depth in range(MAX_DEPTH, 1, -1):
        if 1 - (1 - threshold ** depth) ** TREES >= recall:
            return depth
    return 1


def shingles(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of all texts one after another, and where each text starts (and the
    end). A text of one to four words has one shingle, all its words; one without words none."""
    h, first = flat_words(texts, words, lambda t: t.lower().split())
    n = np.diff(first)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    start = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(start[-1], np.uint64)
    g = grams(h, SHINGLE)
    if len(g):
        owner = np.repeat(np.arange(len(n)), n)
        inside = owner[: len(g)] == owner[SHINGLE - 1:]
        long = np.repeat(n >= SHINGLE, count)
        out[long] = g[inside]
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)):
        out[start[i]] = grams(np.concatenate([h[first[i]: first[i + 1]], np.array([n[i]], np.uint64)]), n[i] + 1)[0]
    return out, start


def content_key(g: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell multisets of shingles apart whatever their order."""
    total = lambda x: np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])[start])
    return total(mix(g)).view(np.int64), total(mix(g ^ np.uint64(0xA5A5F00D12345678))).view(np.int64)


def prefixes(g: np.ndarray, start: np.ndarray, depth: int) -> np.ndarray:
    """For each text with shingles, the hash of its signature's first ``depth`` values by tree."""
    out = np.zeros((len(start) - 1, TREES), np.uint64)
    has = np.flatnonzero(np.diff(start) > 0)
    if not len(has):
        return out.view(np.int64)
    for t in range(TREES):
        for d in range(depth):
            k = t * MAX_DEPTH + d
            low = np.minimum.reduceat(g * _A[k] + _B[k], start[has])
            out[has, t] = mix(out[has, t] * np.uint64(0x9E3779B97F4A7C15) + low + np.uint64(d))
    return out.view(np.int64)


def signatures(docs: DataFrame, text: str, doc_id: str, depth: int) -> DataFrame:
    """(id, m1, m2, p) of every row: the text's key by content and its tree prefixes, null for a row
    without a word or an id."""

    def run(batches):
        words = Words(seed=9)
        for batch in batches:
            for part in slices(batch, "t"):
                g, start = shingles(["" if t is None else t for t in part.column(1).to_pylist()], words)
                m1, m2 = content_key(g, start)
                p = prefixes(g, start, depth)
                none = (np.diff(start) == 0) | np.array(part.column(0).is_null())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(m1, mask=none), pa.array(m2, mask=none),
                                                  pa.array([None if x else r for x, r in zip(none, p, strict=True)], pa.list_(pa.int64()))], names=["id", "m1", "m2", "p"])

    source = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("t"))
    return source.mapInArrow(run, "id bigint, m1 bigint, m2 bigint, p array<bigint>")


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows with equal ``keys`` of a sorted partition, one after another."""
    rest: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        k = np.stack([t[c].to_numpy() for c in keys], 1)
        edge = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, [len(k)]])
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            key = tuple(k[a].tolist())
            if rest and key != last:
                yield pa.concat_tables(rest)
                rest = []
            rest.append(t.slice(a, b - a))
            last = key
    if rest:
        yield pa.concat_tables(rest)


KEYS = ["tree", "prefix", "lo", "hi"]


def new_pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(members of the first block, of the second, matrix): which pairs of them meet in this tree
    and in no earlier one, so that each pair is looked at once."""
    p = np.array(t["p"].combine_chunks().values.to_numpy()).reshape(-1, TREES)
    block, tree = t["block"].to_numpy(), int(t["tree"][0].as_py())
    lo, hi = int(t["lo"][0].as_py()), int(t["hi"][0].as_py())
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    new = np.ones((len(left), len(right)), bool) if lo != hi else np.triu(np.ones((len(left), len(right)), bool), 1)
    for e in range(tree):
        new &= p[left, e][:, None] != p[right, e][None, :]
    return left, right, new


def first_meetings(batches):
    """The members of each pair of blocks that meet another member for the first time."""
    for t in grouped(batches, KEYS):
        left, right, new = new_pairs(t)
        keep = np.zeros(t.num_rows, bool)
        keep[left] |= new.any(1)
        keep[right] |= new.any(0)
        if keep.any():
            yield from t.filter(pa.array(keep)).combine_chunks().to_batches()


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, most: int = 8192) -> np.ndarray:
    """How many shingles each of ``left`` shares with each of ``right``: products of incidence
    matrices over the shingles that both sides have, ``most`` at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    flat = [(np.concatenate([sets[i] for i in s]), np.repeat(np.arange(len(s)), [len(sets[i]) for i in s])) for s in (left, right)]
    common = np.intersect1d(flat[0][0], flat[1][0])
    if left is right or np.array_equal(left, right):
        values, n = np.unique(flat[0][0], return_counts=True)
        common = values[n > 1]
    for i in range(0, len(common), most):
        cols = common[i: i + most]
        sides = []
        for (values, owner), rows in zip(flat, (len(left), len(right)), strict=True):
            at = np.minimum(np.searchsorted(cols, values), len(cols) - 1)
            hit = cols[at] == values
            m = np.zeros((rows, len(cols)), np.float32)
            m[owner[hit], at[hit]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def verify(threshold: float):
    """Per pair of blocks and member: the copies that it links to there, and the smallest member of
    its connected component there."""

    def run(batches):
        for t in grouped(batches, KEYS):
            left, right, new = new_pairs(t)
            sets = [np.frombuffer(b, np.uint64) for b in t["g"].to_pylist()]
            size = np.array([len(s) for s in sets])
            both = intersections(sets, left, right).astype(np.float64)
            linked = new & (both >= threshold * (size[left][:, None] + size[right][None, :] - both) - 1e-6)
            if not linked.any():
                continue
            ids, copies = t["id"].to_numpy(), t["copies"].to_numpy()
            links = np.zeros(t.num_rows, np.int64)
            np.add.at(links, left, linked.astype(np.int64) @ copies[right])
            np.add.at(links, right, linked.T.astype(np.int64) @ copies[left])
            root, none = ids.copy(), np.iinfo(np.int64).max
            while True:  # the smallest id spreads along the links, within two blocks
                old = root.copy()
                root[left] = np.minimum(root[left], np.where(linked, root[right][None, :], none).min(1, initial=none))
                root[right] = np.minimum(root[right], np.where(linked, root[left][:, None], none).min(0, initial=none))
                if (root == old).all():
                    break
            on = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids[on]), pa.array(t["m1"].to_numpy()[on]), pa.array(t["m2"].to_numpy()[on]), pa.array(links[on]), pa.array(root[on])], names=["id", "m1", "m2", "links", "root"])

    return run


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """(doc_id, class_id, copy_id, n_links) for every row of ``docs``.

    Two documents are linked if the sets of their word 5-grams (lower-cased, split at white
    space) have a Jaccard similarity of ``threshold`` or more; candidates are verified exactly.
    ``class_id`` is the smallest id that links, however many, lead to; ``copy_id`` the smallest
    id with the very same shingles; ``n_links`` the number of documents linked to this one.

    Documents with the same shingles are one node with a count, so a group of copies costs no
    more than one text. Nodes that share a tree prefix are dealt out in blocks of about BLOCK by
    hash, and each pair of blocks is a row group of its own: a large group of near copies is
    spread over many tasks, and gives rows by member and block, never pairs. A pair that meets
    in several trees counts in the first.

    A text of one to four words has one shingle, all its words. A null or empty text links to
    nothing and is a class of its own. A row without an id links to nothing and has a null
    class. Rows that repeat id and text are one document; rows that share an id but not the
    text bring their classes together. Other columns aren't looked at. No rows give no rows.
    """
    depth = depth_for(threshold, recall)
    sig = cut(signatures(docs, text, doc_id, depth), "signatures")
    worded = sig.where("m1 is not null")
    nodes = cut(worded.groupBy("m1", "m2", "id").agg(F.first("p").alias("p"))
                .groupBy("m1", "m2").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("p").alias("p")), "nodes")
    member = nodes.select("id", "m1", "m2", F.posexplode("p").alias("tree", "prefix"))
    busy = cut(member.groupBy("tree", "prefix").agg(F.count("*").alias("n")).where("n > 1"), "trie-nodes")
    held = member.join(busy, ["tree", "prefix"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    held = held.withColumn("block", F.pmod(F.xxhash64("m1", "m2"), F.col("blocks")).cast("int"))
    dealt = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "m1", "m2", "tree", "prefix", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    dealt = dealt.join(nodes.select("m1", "m2", "copies", "p"), ["m1", "m2"])
    order = ["tree", "prefix", "lo", "hi"]
    shape = "m1 bigint, m2 bigint, id bigint, tree int, prefix bigint, block int, lo int, hi int, copies bigint, p array<bigint>"
    dealt = dealt.select("m1", "m2", "id", "tree", "prefix", "block", "lo", "hi", "copies", "p")
    met = cut(dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(first_meetings, shape), "meetings")
    wanted = met.select("id", "m1", "m2").distinct()

    def sets(batches):
        words = Words(seed=9)
        for batch in batches:
            for part in slices(batch, "t"):
                g, start = shingles(["" if t is None else t for t in part.column(1).to_pylist()], words)
                m1, m2 = content_key(g, start)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(m1), pa.array(m2), pa.array([np.unique(g[a:b]).tobytes() for a, b in zip(start[:-1], start[1:], strict=True)], pa.binary())], names=["id", "m1", "m2", "g"])

    texts = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("t")).join(wanted.select("id").distinct().hint("merge"), "id", "left_semi")
    known = texts.mapInArrow(sets, "id bigint, m1 bigint, m2 bigint, g binary").join(wanted.hint("merge"), ["id", "m1", "m2"], "left_semi").dropDuplicates(["id", "m1", "m2"])
    work = met.join(known.select("m1", "m2", "g"), ["m1", "m2"])
    result = cut(work.repartition(*order).sortWithinPartitions(*order).mapInArrow(verify(threshold), "id bigint, m1 bigint, m2 bigint, links bigint, root bigint"), "links")
    shared_ids = worded.groupBy("id").agg(F.min("m1").alias("a"), F.max("m1").alias("b"), F.min("m2").alias("c"), F.max("m2").alias("d")).where("a <> b or c <> d").select("id")
    several = worded.join(shared_ids, "id", "left_semi").select("id", "m1", "m2").join(nodes.select("m1", "m2", F.col("id").alias("root")), ["m1", "m2"]).select("id", "root")
    group = components(result.select("id", "root").unionByName(several), "id", "root")
    counts = result.groupBy("m1", "m2").agg(F.sum("links").alias("links"))
    judged = cut(nodes.select("m1", "m2", "id", "copies").join(counts, ["m1", "m2"], "left").join(group, F.col("id") == F.col("node"), "left")
                 .select("m1", "m2", F.col("id").alias("copy_id"), F.coalesce("component", "id").alias("class_id"),
                         (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    return sig.select("id", "m1", "m2").join(judged, ["m1", "m2"], "left").select(
        F.col("id").alias(doc_id), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("copy_id", "id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
