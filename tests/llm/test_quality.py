import itertools
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from dealflow.llm import crf, quality, quality_rules
from dealflow.llm.common import ByteWords, held_out


def texts(prose):
    return ["", "\n", "a b", "One line.\nTWO LINES!! HERE\n\n# $ % |", prose(1, 30) + "\n" + prose(2, 3), "é É ü\nx | y | z", "w. \n" * 7]


def test_features_of_lines(prose):
    t = texts(prose)
    x, chars, first = crf.line_features(t)
    lines = [line for s in t for line in s.split("\n")]
    assert x.shape == (len(lines), crf.N_FEATURES) and first[-1] == len(lines) and chars.tolist() == [len(line) for line in lines]
    assert np.allclose(x[:, 9], [np.log1p(len(line.split())) / 6 for line in lines])


def test_forward_backward_and_viterbi_against_all_paths(prose):
    t = texts(prose)
    x, _, first = crf.line_features(t)
    m = crf.Crf()
    r = np.random.default_rng(3)
    m.w, m.trans = r.normal(size=crf.N_FEATURES), r.normal(size=(2, 2))
    p, best = m.marginals(x, first), m.viterbi(x, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        e = x[a:b] @ m.w
        score = lambda s: sum(v for v, k in zip(e, s, strict=True) if k) + sum(m.trans[i, j] for i, j in zip(s, s[1:], strict=False))  # noqa: E731,B023
        paths = list(itertools.product((0, 1), repeat=b - a))
        w = np.exp([score(s) for s in paths])
        assert np.allclose(p[a:b], (w[:, None] * np.array(paths)).sum(0) / w.sum())
        assert np.isclose(score(best[a:b].tolist()), max(map(score, paths)))


def corpus(spark, docs, prose, n=300):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        lines = [prose(i * 10 + k, 25).capitalize() + "." for k in range(4)]
        if not good:
            lines = [lines[0]] + [" | ".join(line.split()) if i % 2 else line.upper().replace(" ", "!! ") for line in lines[1:]]
        rows.append((i, "\n".join(lines)))
        labels.append((i, int(good), 0))
    return docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark, docs, prose):
    df, labels = corpus(spark, docs, prose)
    out = quality.score_quality(df, quality.fit(df, labels)).join(labels, "doc_id").withColumn("out", held_out(F.col("doc_id"))).collect()
    held = [r for r in out if r["out"]]
    assert np.mean([(r.score >= 0.5) == bool(r.quality) for r in held]) > 0.97
    kept = quality_rules.judge(df, quality_rules.fit(df, labels)).join(labels, "doc_id").collect()
    assert np.mean([r.kept == bool(r.quality) for r in kept]) > 0.95
    bad = next(r for r in kept if not r.quality)
    assert bad.boilerplate and 0 <= bad.content_share < 0.5


def brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))
    cover = {k for i in range(len(w) - 4) if c[tuple(w[i: i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return [len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), dup, len(cover)]


def test_measures_against_brute_force():
    r = random.Random(8)
    t = ["".join(r.choice("ab #|<\n\t\x1c\x85\u3000é\U0001F600") for _ in range(r.randrange(120))) for _ in range(300)] + ["a b c d e a b c d e", "x " * 30]
    got = np.stack(quality_rules.measures(t, ByteWords(seed=101)), 1)
    assert got.tolist() == [brute(x) for x in t]


def test_edge_cases(spark, docs, clashing):
    for labels in ([(3, 1, 0), (4, 0, 0), (None, 1, 1), (5, None, 0)], []):
        lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
        out = quality.score_quality(clashing, quality.fit(clashing, lab)).collect()
        assert len(out) == 15 and all(0 <= r.score <= 1 and len(r.lines) == (r.text or "").count("\n") + 1 for r in out)
        judged = quality_rules.judge(clashing, quality_rules.fit(clashing, lab)).collect()
        assert len(judged) == 15 and all(r.base_failed and not r.kept for r in judged if not r.text)
        assert quality_rules.judge(docs([]), quality_rules.fit(docs([]), lab)).count() == 0
        assert quality.score_quality(docs([]), quality.fit(docs([]), lab)).count() == 0
