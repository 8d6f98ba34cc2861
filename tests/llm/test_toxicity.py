import numpy as np
import pytest
from pyspark.sql import functions as F

from dealflow.llm import toxicity as X


def all_maximal(s):
    """By the definition: the best segment, then the same to its left and right."""
    out = []

    def go(a, b):
        best = None
        for i in range(a, b):
            for j in range(i + 1, b + 1):
                v = sum(s[i:j])
                if v > 1e-12 and (best is None or v > best[0] + 1e-12):
                    best = (v, i, j)
        if best:
            go(a, best[1])
            out.append((best[1], best[2], round(best[0], 6)))
            go(best[2], b)

    go(0, len(s))
    return sorted(out)


def test_segments_equal_brute_force():
    r = np.random.default_rng(1)
    for _ in range(300):
        s = r.normal(size=r.integers(0, 14))
        assert [(a, b, round(v, 6)) for a, b, v in X.segments(s)] == all_maximal(list(s))


def labelled(spark, docs, prose, n=400):
    bad = ["vile", "awful", "nasty", "rotten"]
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 120).split()
        if toxic := i % 3 == 0:
            for k in range(20, 40, 3):
                words[k] = bad[(i + k) % 4]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy_and_passages(spark, docs, prose):
    from dealflow.llm.common import held_out

    df, labels = labelled(spark, docs, prose)
    out = X.score_toxicity(df, X.fit(df, labels)).join(labels, "doc_id").withColumn("out", held_out(F.col("doc_id"))).collect()
    held = [r for r in out if r["out"]]
    assert 90 < len(held) < 180
    assert np.mean([(r.score >= 0.7) == bool(r.toxic) for r in held]) > 0.97
    toxic = next(r for r in held if r.toxic)
    best = max(toxic.passages, key=lambda p: p.score)
    assert 15 <= best.start and best.end <= 45 and best.expected < 0.05


def test_a_passage_in_a_long_clean_text_is_found_and_held_out_rows_teach_nothing(spark, docs, prose):
    df, labels = labelled(spark, docs, prose)
    g = X.fit(df, labels)
    text = prose(9, 2000) + " vile nasty w1x1 rotten awful vile nasty rotten awful " + prose(10, 2000)
    assert X.score_toxicity(docs([(1, text)]), g).collect()[0].score > 0.7
    from dealflow.llm.common import held_out

    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = X.fit(df, flipped)
    assert np.array_equal(g.toxic, other.toxic) and np.array_equal(g.clean, other.clean)


@pytest.mark.parametrize("some", [True, False])
def test_edge_cases(spark, docs, clashing, some):
    labels = spark.createDataFrame([(3, 0, 1), (4, 1, 0), (4, 1, 1), (None, 1, 1), (8, None, None)] if some else [], "doc_id bigint, quality int, toxic int")
    out = X.score_toxicity(clashing, X.fit(clashing, labels))
    assert out.count() == 15 and all(0 <= r.score <= 1 for r in out.collect())
    empty = docs([])
    assert X.score_toxicity(empty, X.fit(empty, labels)).count() == 0


def test_held_out_labels_change_no_weights(spark, docs, prose):
    from dealflow.llm import quality
    from dealflow.llm.common import held_out

    df, labels = labelled(spark, docs, prose, n=120)
    labels = labels.withColumn("quality", 1 - F.col("toxic"))
    out = held_out(F.col("doc_id"))
    other = labels.select("doc_id", *[F.when(out, 1).otherwise(F.col(c)).alias(c) for c in ("quality", "toxic")])
    a, b = X.fit(df, labels), X.fit(df, other)
    assert np.allclose(a.weights, b.weights, rtol=1e-9) and np.isclose(a.rate, b.rate, rtol=1e-9) and np.isclose(a.k, b.k, rtol=1e-9)
    a, b = quality.fit(df, labels), quality.fit(df, other)
    assert np.array_equal(a.crf.w, b.crf.w) and np.array_equal(a.crf.trans, b.crf.trans) and np.array_equal(a.weights, b.weights)


def test_one_training_row_for_a_repeated_id(spark, docs, prose):
    """3,000 rows of one labelled id are one row to learn from, the same whatever the partitions."""
    from dealflow.llm.common import training_rows

    rows = docs([(1, prose(1, 20)), (2, None)] + [(7, prose(i % 50, 30)) for i in range(3000)])
    chosen = spark.createDataFrame([(1, 0), (2, 0), (7, 1)], "doc_id bigint, y int")
    got = [sorted(map(tuple, training_rows(rows.repartition(n), "text", chosen).collect())) for n in (1, 5)]
    assert got[0] == got[1] and [r[:2] for r in got[0]] == [(1, 0), (2, 0), (7, 1)] and got[0][1][2] == ""
