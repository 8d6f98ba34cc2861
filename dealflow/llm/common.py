"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The white space of the contracts, ``[\x20\x09-\x0D]``.
WS = " \t\n\x0b\x0c\r"
MAX_ID = 2**63 - 1
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session without one
    (tests) gets a scratch folder; a cluster without one is an error."""
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    d = tempfile.mkdtemp(prefix="dealflow-llm-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut(df: DataFrame, label: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: its lineage
    ends there, and a lost executor costs only a re-read. The shuffle files of the write go
    when it ends, as nothing reads them again. With ``batch`` the Arrow batches of the write
    have no more rows than that."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k) for k in (CLEANUP, BATCH)}
    spark.conf.set(CLEANUP, "true")
    if batch is not None and not 0 < int(before[BATCH]) <= batch:
        spark.conf.set(BATCH, str(batch))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once all that was made of them is written itself."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(df.written_at)
        where.getFileSystem(conf).delete(where, True)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(labels: DataFrame, label: str) -> DataFrame:
    """The labelled ids that may be learned from, as (doc_id, y). Ids or labels that are null are
    left out; an id with several labels has its largest."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")))


def class_share(labels: DataFrame, label: str) -> float:
    """The share of label 1 among all learnable labels of 0 or 1; 0 without any."""
    got = learnable(labels, label).where("y in (0, 1)").agg(F.avg("y").alias("share")).collect()
    return got[0]["share"] or 0.0


def labelled_sample(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled ids that may be learned from, as (doc_id, y), the ones
    with the smallest hash, so the choice doesn't depend on how rows are dealt out. Half of
    the rows go to each label."""
    rows = learnable(labels, label)
    by_hash = lambda y: rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2)
    return by_hash(0).unionByName(by_hash(1))


def training_rows(docs: DataFrame, text: str, chosen: DataFrame) -> DataFrame:
    """(doc_id, y, t) of the labelled ids in ``chosen``, one row an id: of rows that repeat it, the one whose
    text has the least hash, by an aggregate with partial combine. So as many rows as ids, at most."""
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(chosen), "doc_id")
    least = rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("least"))
    return least.select("doc_id", "y", F.col("least.t").alias("t"))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string (on the driver: its parser is Spark's)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(ddl))


def add_columns(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]],
                make: Callable[[], Callable[[list], list[list]]], keep: list[str] | None = None) -> DataFrame:
    """``df`` with the columns ``fields`` that ``make()(texts)`` computes from the texts of a
    batch (null: ""), batch by batch, without a shuffle. ``make`` runs once a task.
    ``keep``: the columns of ``df`` to return (all). A column of ``df`` that is named like a
    new one is replaced."""
    new = [n for n, _ in fields]
    names = [n for n in (df.columns if keep is None else keep) if n not in new]
    schema = T.StructType([df.schema[n] for n in names] + [T.StructField(n, t) for n, t in fields])
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(t) for _, t in fields]
    # The text goes last, under a name of its own; columns are then taken by place.
    source = df.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text}`").alias(fresh("text", names)))

    def run(batches):
        compute = make()
        for batch in batches:
            for part in slices(batch, len(names)):
                texts = ["" if t is None else t for t in part.column(len(names)).to_pylist()]
                out = compute(texts)
                old = [part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(old + [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names + new)

    return source.mapInArrow(run, schema)


def fresh(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores before it as it takes to be new, in any case of letters."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, text: str | int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``most`` bytes of text; a longer text is alone."""
    col = batch.column(text)
    if not len(col):
        return
    ends = np.cumsum([0 if n is None else n for n in pc.binary_length(col).to_pylist()])
    start, base = 0, 0
    while start < len(col):
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


_KEPT: dict = {}


def kept(key, make: Callable):
    """What ``make`` returns, kept for later tasks of this Python process that ask by the same key.
    Only one thing is kept: a process that serves one stage after another holds the last's."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


class Words:
    """64-bit hashes of words. Those met are ``kept``; beyond ``size`` words the cache is emptied."""

    def __init__(self, seed: int = 0, size: int = 300_000):
        self.seed, self.size, self.cache = seed, size, kept(("words", seed), dict)

    def hashes(self, words: list[str]) -> np.ndarray:
        found = list(map(self.cache.get, words))
        if None in found:
            for i, v in enumerate(found):
                if v is None:
                    w = words[i]
                    found[i] = self.cache[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), self.seed)
            if len(self.cache) > self.size:
                self.cache.clear()
        return np.array(found, np.uint64) if found else np.zeros(0, np.uint64)


class ByteWords(Words):
    """As ``Words``, for words that are bytes."""

    def hashes(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.cache.get, words))
        if None in found:
            for i, v in enumerate(found):
                if v is None:
                    found[i] = self.cache[words[i]] = xxhash.xxh64_intdigest(words[i], self.seed)
            if len(self.cache) > self.size:
                self.cache.clear()
        return np.array(found, np.uint64) if found else np.zeros(0, np.uint64)


def byte_words(text: str) -> list[bytes]:
    """Words between [\\x20\\x09-\\x0D]: exactly what bytes are split at."""
    return text.encode("utf-8", "surrogatepass").split()


def flat_words(texts: list[str], words: Words, split: Callable[[str], list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts one after another, and where each text starts (and the end)."""
    parts = [split(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return words.hashes([w for p in parts for w in p]), starts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(h: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """The hash of every ``n`` consecutive entries of ``h``."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for j in range(1, n):
        out = out * np.uint64(base) + h[j: len(h) - n + 1 + j]
    return mix(out)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges as (node, component): the smallest node of
    each, by rounds of minimum-label propagation with pointer jumping. Every round is written
    to the shared folder; a node's many links meet as a partial minimum before the shuffle,
    so hubs cost no more than other nodes. Null ends and loops are ignored."""
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    e = cut(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = (e.join(labels, e.b == labels.node).groupBy("a").agg(F.min("component").alias("m")))
        low = labels.join(near, labels.node == near.a, "left").select(
            "node", F.col("component").alias("old"), F.least("component", F.coalesce("m", "component")).alias("new"))
        up = labels.select(F.col("node").alias("at"), F.col("component").alias("above"))
        nxt = cut(low.join(up, low.new == up["at"], "left").select(
            "node", "old", F.least("new", F.coalesce("above", "new")).alias("component")), "labels")
        changed = nxt.where("old <> component").limit(1).count()
        labels = nxt.select("node", "component")
        if not changed:
            return labels
