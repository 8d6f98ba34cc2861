import math
import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealflow.llm.whitening import RESULT, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows):
    """Deviations in whole numbers, and the covariance by the definition."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in [*v, *[0.0] * (d - len(v))]] for _, v in kept]
    n, s = len(x), [sum(r[j] for r in x) for j in range(d)]
    deviations = [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    centred = np.array([[float(n * a - b) / n for a, b in zip(r, s, strict=True)] for r in x]).reshape(n, d)
    return [i for i, _ in kept], deviations, centred


def judge(got, rows, components=8):
    ids, deviations, centred = brute(rows)
    n, d = centred.shape
    v = centred.T @ centred / n
    e = np.linalg.eigvalsh(v)[::-1]
    k = min(components, d)
    assert len(got) == n * k and all(r.n == n for r in got)
    assert sorted((repr(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted((repr(i), x if x < 2**63 else None) for i, x in zip(ids, deviations, strict=True))
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
    assert sorted(by) == list(range(1, k + 1))
    for c, own in by.items():
        assert all(abs(r.explained - e[c - 1] / e.sum()) <= 1e-6 * max(r.explained, 1e-6) for r in own)
        if e[c - 1] > e[0] * 1e-11:
            w = np.array([r.whitened for r in own])
            assert abs(w.mean()) < 1e-6 and abs((w * w).mean() - 1) < 1e-6 and own[0].identity_error < 1e-4
        else:
            assert all(r.whitened is None for r in own)
    return by


def test_against_the_definition(spark):
    r = np.random.default_rng(5)
    mix = r.normal(size=(12, 12))
    rows = [(i, (r.normal(size=12) @ mix * 0.2 + 3).astype(np.float32).tolist()) for i in range(700)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    by = judge(whiten(df, rows_per_block=64).collect(), rows)
    # every row's projection, up to a component's sign
    ids, _, centred = brute(rows)
    e, u = np.linalg.eigh(centred.T @ centred / len(rows))
    for c in range(1, 9):
        want = dict(zip(ids, centred @ u[:, -c] / math.sqrt(e[-c]), strict=True))
        mine = {x.vec_id: x.whitened for x in by[c]}
        sign = 1 if sum(want[i] * mine[i] for i in ids) > 0 else -1
        assert max(abs(want[i] - sign * mine[i]) for i in ids) < 1e-6


def test_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    a, b = [0.25, -1.5, 3.0], [1.0, 0.5, 0.125]
    rows = [(1, None), (2, [0.5, None, 1.0]), (3, [nan, 1.0, 2.0]), (4, [inf, 1.0, 2.0]), (None, a), (None, a), (5, a), (5, b), (6, b), (7, []), (8, [2.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    clash = df.select("*", *[F.lit("extra").alias(c) for c in ("x", "ids", "seq", "part", "W", "n", "v", "whitened")])
    judge(whiten(clash, rows_per_block=2, strips=2).collect(), rows)
    same = spark.createDataFrame([(i, a, 0) for i in range(5)], SCHEMA)
    assert {(r.deviation, r.whitened, r.explained) for r in whiten(same).collect()} == {(0, None, None)}
    far = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 4.0])]
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in far], SCHEMA)).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got if r.vec_id < 3)
    empty = whiten(df.limit(0))
    assert empty.collect() == [] and empty.schema == spark.createDataFrame([], RESULT).schema
    assert whiten(df.where("vec_id < 5 and embedding is null")).collect() == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    from dealflow.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    judge(QUERIES["op11_embedding_whitening"](spark, sf).collect(), rows)
