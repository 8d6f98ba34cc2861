"""Embedding whitening with MLlib's BlockMatrix: centred rows as distributed blocks, a
transpose-multiply for the scatter, a local eigh of it, and a second multiplication by the
whitening matrix that projects the rows.

A number c of a vector becomes the whole number x = floor(1024 c) + 100000, so sums and deviations
are exact. With S the sum of a dimension over n vectors, S = q n + r, an entry is centred as
(x - q) - r / n: no digits cancel, however far the mean is from zero.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import cut, map_arrow

SCALE, OFFSET, LARGEST = 1024, 100_000, 2**62
RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def finite_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the rows whose vector is neither null nor holds null or non-finite entries."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("v").isNotNull() & ~bad)


def whole(v: np.ndarray) -> np.ndarray:
    """x of every entry, held within plus and minus 2^62."""
    f = np.clip(np.floor(v * SCALE), -LARGEST, LARGEST)
    return f.astype(np.int64) + OFFSET


def matrix_of(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers; a vector shorter than ``d`` ends in zeros."""
    v = batch.column(column)
    sizes = v.value_lengths().to_numpy(zero_copy_only=False)
    flat = v.flatten().to_numpy(zero_copy_only=False)
    if (sizes == d).all():
        return whole(flat.reshape(-1, d))
    out = np.zeros((len(sizes), d))
    out[np.arange(d) < sizes[:, None]] = flat
    return whole(out)


def exact(x: np.ndarray, squares: bool, factor: int = 1) -> np.ndarray:
    """``x`` as Python's integers where sums over it, or of its squares or multiples, may not fit a long."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    return x if max(most * factor, most * most if squares else 0) * max(x.shape) < LARGEST else x.astype(object)


def column_sums(points: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors, and the exact sum of x in every dimension of the longest: one row of each
    task and dimension is added up by Spark."""

    def run(batches):
        n, sums, counts = 0, [], []
        for b in batches:
            sizes = b.column(1).value_lengths().to_numpy(zero_copy_only=False)
            d = int(sizes.max(initial=0))
            sums += [0] * (d - len(sums))
            counts += [0] * (d - len(counts))
            n += len(sizes)
            x = exact(matrix_of(b, 1, d), False)
            # Zeros that end shorter vectors are put in by the caller, for all tasks alike.
            here = np.arange(d) < sizes[:, None]
            for j, (s, c) in enumerate(zip(np.where(here, x, 0).sum(axis=0).tolist() if len(sizes) else [], here.sum(axis=0).tolist(), strict=False)):
                sums[j] += s
                counts[j] += c
        rows = [(-1, n, "0"), *((j, c, str(s)) for j, (s, c) in enumerate(zip(sums, counts, strict=True)))]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.string()), strict=True)], names=["dim", "n", "s"])

    got = map_arrow(points, run, "dim int, n bigint, s string").groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["dim"]: (int(r["n"]), int(r["s"])) for r in got}
    n = by.pop(-1, (0, 0))[0]
    return n, [by[j][1] + (n - by[j][0]) * OFFSET for j in range(len(by))]


def indexed_blocks(points: DataFrame, d: int, rows_per_block: int) -> DataFrame:
    """Rows in blocks of ``rows_per_block``, one row of (part, seq, ids, x) a block, written as a table so
    that a block's place (its task's number, its number there) never changes. Whole numbers of
    little spread take a quarter of their vector's bytes there."""

    def run(batches):
        part, seq, ids, rows = TaskContext.get().partitionId(), 0, [], np.zeros((0, d), np.int64)

        def block(k):
            nonlocal seq, ids, rows
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([ids[:k]], pa.list_(pa.int64())),
                                              pa.ListArray.from_arrays(pa.array([0, d * len(rows[:k])], pa.int32()), pa.array(rows[:k].ravel()))], names=["part", "seq", "ids", "x"])
            seq, ids, rows = seq + 1, ids[k:], rows[k:]
            return out

        for b in batches:
            ids += b.column(0).to_pylist()
            rows = np.concatenate([rows, matrix_of(b, 1, d)])
            while len(ids) >= rows_per_block:
                yield block(rows_per_block)
        if ids:
            yield block(rows_per_block)

    return cut(map_arrow(points, run, "part int, seq int, ids array<bigint>, x array<bigint>"), "blocks")


class Strip:
    """One of ``of`` strips of the blocks: those whose number in their task leaves ``k``. Each strip is a
    BlockMatrix of its own, so that the shuffle files of a product are a strip's, not the table's."""

    def __init__(self, blocks: DataFrame, per_part: dict[int, int], k: int, of: int, n: int, sums: list[int], rows_per_block: int):
        self.spark, self.blocks, self.d, self.rows_per_block = blocks.sparkSession, blocks.where(F.col("seq") % of == k), len(sums), rows_per_block
        self.n, self.q, self.r = n, [s // n for s in sums], [s % n for s in sums]
        self.at, self.count = {}, 0
        for part in sorted(per_part):
            self.at[part] = self.count
            self.count += (per_part[part] - k + of - 1) // of
        self.of = of

    def matrix(self) -> BlockMatrix:
        """The centred rows; a block that isn't full ends in rows of zeros, which add nothing."""
        d, size, at, of, n = self.d, self.rows_per_block, self.at, self.of, self.n
        q, r = np.array(self.q, np.int64), np.array(self.r, np.float64) / n
        schema = T.StructType([T.StructField("at", T.StructType([T.StructField("i", T.LongType(), False), T.StructField("j", T.LongType(), False)])), T.StructField("m", MatrixUDT())])
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(schema["at"].dataType), to_arrow_type(MatrixUDT.sqlType())]

        def run(batches):
            for b in batches:
                for part, seq, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    y = x.values.to_numpy().reshape(-1, d) - q
                    full = np.zeros((size, d))
                    full[: len(y)] = y - r
                    m = {"type": 1, "numRows": size, "numCols": d, "colPtrs": None, "rowIndices": None, "values": full.ravel(), "isTransposed": True}
                    yield pa.RecordBatch.from_arrays([pa.array([{"i": at[part] + seq // of, "j": 0}], kinds[0]), pa.array([m], kinds[1])], names=["at", "m"])

        rows = self.blocks.select("part", "seq", "x").mapInArrow(run, schema)
        return BlockMatrix(callMLlibFunc("createBlockMatrix", rows, size, d, size * self.count, d), size, d)

    def scatter(self, blocks_a_task: int = 32) -> np.ndarray:
        """The sum of the rows' outer products, d x d. The middle dimension (the rows) is split over tasks,
        which Spark's own multiply can do, though its Python wrapper has no argument for it."""
        x = self.matrix()
        product = x.transpose()._java_matrix_wrapper.call("multiply", x._java_matrix_wrapper._java_model, max(1, -(-self.count // blocks_a_task)))
        return BlockMatrix(product, self.d, self.d).toLocalMatrix().toArray()

    def projected(self, w: np.ndarray) -> DataFrame:
        """(i, values): the rows of every block times ``w``, column by column."""
        from pyspark.mllib.linalg import Matrices

        k = w.shape[1]
        right = BlockMatrix(self.spark.sparkContext.parallelize([((0, 0), Matrices.dense(self.d, k, w.ravel(order="F").tolist()))], 1), self.d, k)
        product = self.matrix().multiply(right)

        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0).field(0).cast(pa.int64()), b.column(1).field("values")], names=["i", "values"])

        return map_arrow(callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model), run, "i bigint, values array<double>")

    def whitened(self, w: np.ndarray) -> DataFrame:
        """(vec_id, deviation, w) of the strip's rows: the projected blocks meet their ids and exact
        deviations by block number."""
        d, k, size, at, of, n = self.d, w.shape[1], self.rows_per_block, self.at, self.of, self.n
        q, r = np.array(self.q, np.int64), np.array(self.r, object)

        def deviations(batches):
            for b in batches:
                for part, seq, ids, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                    y = x.values.to_numpy().reshape(-1, d) - q
                    y = exact(y, True, n)
                    # the sum of (n x - S)^2, with n x - S = n y - r
                    got = (y * y).sum(axis=1).astype(object) * (n * n) - (y * r.astype(y.dtype)).sum(axis=1).astype(object) * (2 * n) + int((r * r).sum())
                    fit = [int(v) if v < 2**63 else None for v in got.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array([at[part] + seq // of], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([fit], pa.list_(pa.int64()))], names=["i", "ids", "deviations"])

        def rows(batches):
            for b in batches:
                for ids, deviation, values in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    v = values.values.to_numpy().reshape(k, size).T[: len(ids)]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(ids) + 1, k), pa.int32()), pa.array(np.ascontiguousarray(v).ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(deviation, pa.int64()), lists], names=["vec_id", "deviation", "w"])

        named = map_arrow(self.blocks.select("part", "seq", "ids", "x"), deviations, "i bigint, ids array<bigint>, deviations array<bigint>")
        return map_arrow(named.join(self.projected(w), "i").select("ids", "deviations", "values"), rows, "vec_id bigint, deviation bigint, w array<double>")


def forget(spark) -> None:
    """Let the driver drop what nothing refers to any more: a finished product's shuffle files."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 8, rows_per_block: int = 512, strips: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row with a finite
    vector and every component up to ``components`` (or the dimension, if smaller).

    The driver holds the sums of the dimensions, the d x d scatter and one number for each task that
    wrote blocks; all else stays in tables and shuffles of one strip. Vectors shorter than the
    longest end in zeros; entries beyond 2^62 / 1024 are held there. A component without variance
    (none of 10^-12 of the largest) has null ``whitened`` and is left out of ``identity_error``, the
    largest absolute entry of the covariance of the whitened rows less the identity. A deviation
    that does not fit a long is null. Repeated rows and null or repeated ids are rows like others. No
    vectors give no rows."""
    spark = vectors.sparkSession
    points = finite_vectors(vectors, vec_id, embedding)
    n, sums = column_sums(points)
    if not n or not sums:
        return spark.createDataFrame([], RESULT)
    blocks = indexed_blocks(points, len(sums), rows_per_block)
    per_part = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.count("*").alias("n")).collect()}
    parts = [s for s in (Strip(blocks, per_part, k, strips, n, sums, rows_per_block) for k in range(strips)) if s.count]
    scatter = np.zeros((len(sums), len(sums)))
    for s in parts:
        scatter += s.scatter()
        forget(spark)
    covariance = (scatter + scatter.T) / (2 * n)
    values, axes = np.linalg.eigh(covariance)
    k = min(components, len(sums))
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    spread = values > max(values[0], 0) * 1e-12
    w = np.where(spread, axes / np.sqrt(np.where(spread, values, 1)), 0)
    rows = None
    for s in parts:
        one = cut(s.whitened(w), "whitened")
        rows = one if rows is None else rows.unionByName(one)
        forget(spark)
    at = [i for i in range(k) if spread[i]]
    pairs = [(i, j) for i in at for j in at if i <= j]
    off = lambda i, j: F.abs(F.covar_pop(F.col("w")[i], F.col("w")[j]) - (1.0 if i == j else 0.0))
    error = max(rows.agg(*[off(i, j).alias(f"c{i}_{j}") for i, j in pairs]).collect()[0]) if pairs else None
    trace = float(np.trace(covariance))
    shares = F.array(*[F.lit(float(v) / trace if trace > 0 else None).cast("double") for v in values])
    flat = F.array(*[F.lit(not bool(s)) for s in spread])
    return (rows.select("vec_id", "deviation", F.posexplode("w").alias("p", "v"))
            .select("vec_id", (F.col("p") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
                    F.when(~flat[F.col("p")], F.col("v")).alias("whitened"), shares[F.col("p")].alias("explained"), F.lit(error).cast("double").alias("identity_error")))
