import importlib.util
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in P.STAGES:
        docs = P.cut(stage(spark, docs, SF), name.replace(" ", "-"))
        seen.append(docs)
    return P, seen


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_columns_and_only_filter(stages):
    P, seen = stages
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    for a, b in zip(seen[:4], seen[1:5], strict=True):
        assert a.columns == b.columns and ids(b) <= ids(a)
    assert ids(seen[5]) == ids(seen[4]) and seen[5].count() == seen[4].count()


def test_each_decision_against_its_operator(spark, stages):
    _, (docs, clean, lines, single, safe, tokens) = stages
    from dealflow.llm.common import table
    from dealflow.llm.decontaminate import find_leaks
    from dealflow.llm.near_dup import near_duplicates
    from dealflow.llm.toxicity import fit, score_toxicity

    scored = score_toxicity(docs, fit(docs, table(spark, SF, "labels")), keep=["doc_id"])
    assert ids(clean) == ids(scored.where("score < 0.7"))
    assert ids(lines) == ids(clean) and lines.where(F.col("text").isNotNull() & (F.length("text") != F.col("n_chars"))).count() == 0
    kinds = near_duplicates(lines)
    assert ids(single) == ids(kinds.where("class_id = doc_id")) and single.count() == len(ids(single))
    assert near_duplicates(single).where("n_links > 0").count() == 0
    held = find_leaks(single, table(spark, SF, "benchmark"), keep=["doc_id"])
    assert ids(safe) == ids(held.where("size(leaks) = 0"))


def test_edge_rows_and_extra_columns(spark, clashing, stages):
    P, _ = stages
    docs = clashing
    for _, stage in P.STAGES[:4]:
        docs = P.cut(stage(spark, docs, SF), "edge")
        assert docs.columns == clashing.columns
    rows = docs.collect()
    assert {1, 2, 3, 8} <= {r.doc_id for r in rows} and sum(r.doc_id is None for r in rows) == 2
    # the only line of 4 is that of 3: two rows of an empty document, of which one stays
    assert [r.text for r in rows if r.doc_id == 4] == [""] and all(r.score == "extra" for r in rows)
    assert P.STAGES[4][1](spark, docs, SF).count() == len(rows)
    empty = clashing.limit(0)
    for _, stage in P.STAGES[:4]:
        empty = P.cut(stage(spark, empty, SF), "empty")
    assert P.STAGES[4][1](spark, empty, SF).count() == 0


def test_queries_are_registered_once_each():
    import __spark_entry__ as E

    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14 and {int(n[2:].split("_")[0]) for n in names if n != "pipeline"} == set(range(1, 14))
    assert importlib.util.find_spec("corpus_pipeline")
