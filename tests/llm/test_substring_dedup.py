import random
import re
from collections import Counter

import numpy as np

from dealflow.llm import substring_dedup as S


def brute(rows, window=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i: i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {k for a in range(len(w) - window + 1) if seen[tuple(w[a: a + window])] > 1 for k in range(a, a + window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def got(df, window=35):
    return sorted((tuple(r) for r in S.dedup_substrings(df, window=window).collect()), key=repr)


def test_against_brute_force(docs, prose):
    r = random.Random(4)
    passage, rows = prose(99, 70), []
    for i in range(40):
        w = prose(i, r.randrange(1, 160)).split()
        if i % 3 == 0:
            at = r.randrange(len(w) + 1)
            w[at:at] = passage.split()[r.randrange(20): 30 + r.randrange(40)]
        rows.append((i, " ".join(w)))
    rows += [(100, rows[7][1]), (101, rows[7][1]), (102, "a b " * 60), (103, "tick " * 36), (104, "tock " * 35), (105, " ".join(f"u{k}" for k in range(200)) * 2)]
    assert got(docs(rows)) == brute(rows)


def test_small_windows_and_small_alphabet(docs):
    r = random.Random(6)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randrange(0, 25)))) for i in range(30)]
    assert got(docs(rows), window=6) == brute(rows, window=6)


def test_edge_cases(docs, clashing, edge_rows):
    assert got(clashing) == brute(edge_rows)
    assert got(docs([])) == []


def test_equal_windows_have_equal_minimizers_at_different_places():
    h = np.random.default_rng(0).integers(0, 7, 400).astype(np.uint64)
    at, n, key = S.minimizers(h, np.array([0, 400]), 12)
    of = {a + k: (key[i], i) for i, a in enumerate(at.tolist()) for k in range(int(n[i]))}
    assert len(of) == 389
    seen = {}
    for a in of:
        w = tuple(h[a: a + 12].tolist())
        if w in seen:
            assert of[seen[w]][0] == of[a][0] and of[seen[w]][1] != of[a][1]
        seen[w] = a


def test_texts_of_one_id_whose_short_hashes_are_equal(spark, docs):
    from pyspark.sql import functions as F

    rows = [(None, "p0 p1 p2 p3 p4 p5 p6 p7 p8 p9 own14627"), (None, "q0 q1 q2 q3 q4 q5 own131520"), (1, "p0 p1 p2 p3 p4 p5 p6 p7 p8 p9")]
    assert docs(rows[:2]).select(F.hash("text")).distinct().count() == 1
    assert got(docs(rows), window=6) == brute(rows, window=6)


def test_a_task_holds_little_beside_its_batch():
    """Hashes of a slice of the texts at a time: a task's memory doesn't grow with the batch."""
    import tracemalloc

    import pyarrow as pa

    r = random.Random(5)
    texts = [" ".join(r.choice("abcdefgh") + str(r.randrange(400)) for _ in range(2000)) for _ in range(600)]
    ids = pa.array(range(600), pa.int64())
    run = pa.array([[{"at": 0, "n": 1966, "key": 1}]] * 600, pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("key", pa.int64())])))
    for make, cols in ((S._blocks, [ids, ids, pa.array(texts)]), (S._windows, [ids, ids, pa.array(texts), run])):
        batch = pa.RecordBatch.from_arrays(cols, names=["id", "version", "t", "runs"][: len(cols)])
        tracemalloc.start()
        rows = sum(out.num_rows for out in make(35)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= 600 and peak < 40e6, (make.__name__, rows, peak)


def test_least_of_every_span():
    r = np.random.default_rng(3)
    for span in (1, 2, 3, 7, 16, 25):
        for top in (2, 2**40):
            g = r.integers(0, top, span + 200).astype(np.uint64)
            want = np.lib.stride_tricks.sliding_window_view(g, span).argmin(1) + np.arange(len(g) - span + 1)
            assert (S.least(g, span) == want).all()
    assert len(S.least(np.arange(5, dtype=np.uint64), 5)) == 1


def test_what_is_read_once_is_not_written_and_windows_move_as_start_places(docs, prose, monkeypatch):
    """Executors hold and write what is needed only: the sketch and the runs that its last row leaves go on
    without tables of their own, and a window is shuffled with its start, not with its run's place and its
    number in the run."""
    written, width = [], []
    cut = S.cut

    def seen(df, label, *more):
        written.append(label)
        if label == "removed":
            plan = df._jdf.queryExecution().optimizedPlan()
            while plan.nodeName() != "Join":
                plan = plan.children().apply(0)
            width.append(plan.children().apply(0).output().size())
        return cut(df, label, *more)

    monkeypatch.setattr(S, "cut", seen)
    rows = [(i, prose(i % 3, 90)) for i in range(6)]
    assert got(docs(rows)) == brute(rows)
    assert written == ["window-runs", *["repeated-runs"] * (S.DEPTH - 1), "windows", "repeated-windows", "removed"]
    assert width == [5]
