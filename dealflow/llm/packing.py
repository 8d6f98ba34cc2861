"""Best-fit packing with certificates: tokens of documents, cut into pieces, share sequences of
bounded length, and lower bounds say how far from the fewest sequences the result is.

Every partition of pieces is packed by best-fit decreasing. Dual feasible functions bound from
below the number of sequences that a partition needs; where the packing uses more, the partition
has a gap. Partitions with gaps give the pieces of their unfilled sequences to an exchange, which
deals them out anew and packs them again, as long as that saves sequences.
"""

from __future__ import annotations

import itertools
import json
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow.llm.bpe import byte_of_char
from dealflow.llm.common import arrow_schema, cut, kept, map_arrow, slices

SIZE, END = 4096, 1


class Recent:
    """Values by key, of which those not asked for lately go: when ``size`` keys are young, they become
    the old ones and the old ones before them are forgotten."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def recall(self, keys: list, make) -> dict:
        """The values of keys that are not young, from the old ones or else by ``make``; young from now on."""
        here = {k: self.old[k] for k in keys if k in self.old}
        got = here | make([k for k in keys if k not in here])
        if len(self.young) + len(got) > self.size:
            self.old, self.young = self.young, {}
        self.young.update(got)
        return got


#: The pre-tokens of lower-cased Latin-1 text, as the vocabulary file's pattern has them: contractions,
#: letters, one digit, or other characters together, but no white space. Text without a contraction
#: is split by two simpler patterns, which take a fifth of the time.
CONTRACTION, LETTERS, DIGITS = "'s|'t|'re|'ve|'m|'ll|'d", "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
LATIN = rf"({CONTRACTION}|[{LETTERS}]+|[{DIGITS}]|[^{LETTERS}{DIGITS} \t-\r]+)"
#: Text that is lower-cased and split here: Latin-1 without its own white space; it is always in NFC.
PLAIN = r"^[\x00-\x7f\x{a1}-\x{ff}]*$"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Token ids of texts by a tokenizers file. Plain texts are split into pre-tokens by Arrow, and every
    distinct one of a batch is merged by the library's model, unless it was met lately; longer ones
    than ``longest`` are not kept. Any other text is split at ASCII white space, which no pre-token
    crosses, and each distinct part is left to the library."""

    def __init__(self, spec: str, size: int = 250_000, longest: int = 100):
        from tokenizers import Tokenizer

        j = json.loads(spec)
        if j["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": SPLIT} or [n["type"] for n in j["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("a BPE file over lower-cased words, digits and signs is needed")
        self.lib, self.longest, self.known = Tokenizer.from_str(spec), longest, Recent(size)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.special = [t["content"] for t in j["added_tokens"]]
        self.shown = {b: c for c, b in byte_of_char().items()}

    def resolved(self, keys) -> dict:
        """The ids of pre-tokens (texts) and of other parts (bytes), as little-endian unsigned 32-bit bytes."""
        words, parts = [k for k in keys if type(k) is str], [k for k in keys if type(k) is bytes]
        merge, shown = self.lib.model.tokenize, self.shown.__getitem__
        out = {w: array("I", [t.id for t in merge(w if w.isalpha() and w.isascii() else "".join(map(shown, w.encode())))]).tobytes() for w in words}
        got = self.lib.encode_batch([p.decode("utf-8") for p in parts], add_special_tokens=False)
        return out | {p: array("I", e.ids).tobytes() for p, e in zip(parts, got, strict=True)}

    def flat(self, keys: list, order: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """The ids of rows, of which row i has the keys ``order[starts[i]: starts[i + 1]]``."""
        each = list(map(self.known.young.get, keys))
        if None in each:
            lacking = [k for k, v in zip(keys, each, strict=True) if v is None]
            long = self.resolved([k for k in lacking if len(k) > self.longest])
            have = self.known.recall([k for k in lacking if len(k) <= self.longest], self.resolved)
            each = [v if v is not None else have[k] if k in have else long[k] for k, v in zip(keys, each, strict=True)]
        size = np.array([len(b) // 4 for b in each], np.int64)
        ids, first = np.frombuffer(b"".join(each), "<u4"), np.concatenate([[0], np.cumsum(size)])
        n = size[order]
        ends = np.concatenate([[0], np.cumsum(n)])
        out = ids[np.repeat(first[order] - ends[:-1], n) + np.arange(ends[-1])]
        at = ends[starts]
        return [out[a:b] for a, b in itertools.pairwise(at.tolist())]

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (none is null)."""
        plain = pc.match_substring_regex(texts, PLAIN)
        for s in self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring(texts, s)))
        lower = pc.utf8_lower(texts.filter(plain))
        short = pc.match_substring_regex(lower, CONTRACTION)
        simple = pc.replace_substring_regex(lower.filter(pc.invert(short)), rf"([^{LETTERS} \t-\r]+)", r" \1 ")
        simple = pc.replace_substring_regex(simple, f"([{DIGITS}])", r" \1 ")
        split = pc.ascii_split_whitespace(pa.concat_arrays([simple, pc.replace_substring_regex(lower.filter(short), LATIN, r"\1 ")]))
        starts = split.offsets.to_numpy().astype(np.int64)
        words = split.values.slice(int(starts[0]), int(starts[-1] - starts[0])).dictionary_encode()
        # What splitting leaves at the ends of texts is empty, and has no ids.
        got = self.flat(words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(), starts - starts[0])
        first, last = iter(got[: len(simple)]), iter(got[len(simple):])
        rows = iter([next(last) if s else next(first) for s in short.to_pylist()])
        others = [t.encode("utf-8").split() for t in texts.filter(pc.invert(plain)).to_pylist()]
        place = {k: i for i, k in enumerate(dict.fromkeys(k for s in others for k in s))}
        rest = iter(self.flat(list(place), np.array([place[k] for s in others for k in s], np.int64), np.cumsum([0, *map(len, others)])))
        return [next(rows) if p else next(rest) for p in plain.to_pylist()]


def cut_pieces(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the tokens of each row and the id ``end``, in pieces of
    ``size``; the last may be shorter. ``vocabulary``: a file that the driver reads. Null texts are
    empty, so each row has one piece at least; repeated rows and null ids are kept, row by row. Memory
    in a task grows with the longest text."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    key = ("word ids", zlib.crc32(spec.encode()))

    def run(batches):
        words = kept(key, lambda: WordIds(spec))
        for batch in batches:
            for part in slices(batch, 1, 8_000_000):
                n, crcs = [], []
                for ids in words.ids(part.column(1)):
                    b = ids.tobytes() + end.to_bytes(4, "little")
                    n.append(len(b) // 4)
                    crcs.append([zlib.crc32(b[i: i + 4 * size]) for i in range(0, len(b), 4 * size)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], names=["doc_id", "n", "crcs"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    got = map_arrow(rows, run, "doc_id bigint, n bigint, crcs array<bigint>")
    start = F.col("piece").cast("bigint") * size
    return (got.select("doc_id", "n", F.posexplode("crcs").alias("piece", "ids_crc32"))
            .select("doc_id", "piece", start.alias("start"), F.least(F.lit(size).cast("bigint"), F.col("n") - start).alias("length"), "ids_crc32"))


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin of every length and its place there, and the load of every bin: the longest first, each
    into the fullest bin that has room. ``free`` has a bit for each amount of room that a bin has."""
    bins, places, loads = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    with_room: list[list[int]] = [[] for _ in range(size + 1)]
    free = 0
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = free >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                free ^= 1 << room
        else:
            room, b = size, len(loads)
            loads.append(0)
        bins[i], places[i] = b, loads[b]
        loads[b] += n
        room -= n
        if room:
            if not with_room[room]:
                free |= 1 << room
            with_room[room].append(b)
    return bins, places, np.array(loads, np.int64)


def fewest(counts: np.ndarray, size: int, most_k: int = 64) -> float:
    """A lower bound, as a fraction, of the bins of ``size`` that ``counts[n]`` pieces of each length n
    need: the largest total of the dual feasible functions U(e), which takes lengths over size - e as
    whole and leaves out those under e, and u(k), which rounds (k + 1) n / size down to a k-th."""
    c = np.zeros(size + 1, np.int64)
    c[: len(counts)] = counts
    n = np.arange(size + 1, dtype=np.int64)
    number, total = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(c * n)])
    e = np.arange(size // 2 + 1)
    whole = (number[size + 1] - number[size - e + 1]) * size
    best = (whole + total[size - e + 1] - total[e]).max() / size
    for k in range(1, most_k + 1):
        parts = (k + 1) * n
        best = max(best, (c * np.where(parts % size == 0, n * k, parts // size * size)).sum() / (k * size))
    return float(best)


COLUMNS = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pack_partitions(pieces: DataFrame, parts: int, size: int, first_id: int) -> DataFrame:
    """``pieces`` dealt to ``parts`` partitions, each packed on its own, with sequence_id, offset, the
    load of the sequence and the gap of the partition: its sequences less the lower bound. A
    partition holds a bounded number of pieces, so a task's memory is bounded."""

    def run(batches):
        rows = pa.Table.from_batches(list(batches), schema=arrow)
        if not rows.num_rows:
            return
        length = rows.column("length").to_numpy().astype(np.int64)
        bins, places, loads = best_fit_decreasing(length, size)
        gap = len(loads) - fewest(np.bincount(length, minlength=size + 1), size)
        base = (first_id << 56) + (TaskContext.get().partitionId() << 32)
        for name, v in (("sequence_id", base + bins), ("offset", places), ("load", loads[bins]), ("gap", np.full(len(length), gap))):
            rows = rows.append_column(name, pa.array(v))
        yield from rows.to_batches(max_chunksize=20_000)

    arrow = arrow_schema(COLUMNS)
    return map_arrow(pieces.repartition(parts), run, f"{COLUMNS}, sequence_id bigint, offset bigint, load bigint, gap double")


def pack(pieces: DataFrame, size: int = SIZE, per_partition: int = 100_000, rounds: int = 8) -> DataFrame:
    """``pieces`` of ``cut_pieces`` with sequence_id, offset, and ``bound``: the fewest sequences that the
    lower bound leaves possible for all pieces together.

    Partitions of about ``per_partition`` pieces are packed; then the pieces in unfilled sequences
    of partitions with a gap are exchanged: dealt out anew, and packed again. A round that saves no
    sequence is not used and ends the work, as does a total that meets the bound, or the last of
    ``rounds``. Every round is written to the shared folder. Only the number of pieces of each
    length (``size`` numbers) reaches the driver. Rows that repeat are packed each for itself. No
    rows give no rows."""
    pieces = cut(pieces, "pieces")
    by_length = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    counts = np.zeros(size + 1, np.int64)
    for n, c in by_length.items():
        counts[n] = c
    bound = int(np.ceil(fewest(counts, size) - 1e-9))
    parts = lambda n: max(1, -(-n // per_partition))
    packed = cut(pack_partitions(pieces, parts(int(counts.sum())), size, 0), "packed")
    first = F.col("offset") == 0  # a sequence's first piece
    done, used = [], packed.where(first).count()
    for r in range(1, rounds + 1):
        if used <= bound:
            break
        goes = (F.col("load") < size) & (F.col("gap") > 1e-9)
        moved = packed.where(goes)
        n, before = moved.agg(F.count("*"), F.count_if(first)).collect()[0]
        if not n:
            break
        again = cut(pack_partitions(moved.select(*pieces.columns), parts(n), size, r), "exchanged")
        after = again.where(first).count()
        if after >= before:
            break
        done.append(packed.where(~goes))
        packed, used = again, used - before + after
    for t in done:
        packed = packed.unionByName(t)
    return packed.select(*pieces.columns, "sequence_id", "offset", F.lit(bound).cast("bigint").alias("bound"))
