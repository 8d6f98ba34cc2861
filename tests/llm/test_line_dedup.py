from collections import defaultdict

from dealflow.llm.line_dedup import dedup_lines

WS = " \t\n\x0b\x0c\r"


def brute(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))
    last = 2**63
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held[key(line)].add(last if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(held[key(x)]) < 2 or min(held[key(x)]) == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in dedup_lines(df).collect()), key=repr)


def test_against_brute_force(docs):
    shared, other = "A line that many share", "Ünïcode KEEPS its Case É"
    rows = [(i, f"{shared}\nown line number {i}\n  {other.swapcase() if i % 2 else other}\t\nshort\n{shared}") for i in range(30)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "a line that many share\x0b"), (54, shared), (54, shared), (55, "x" * 100_000 + "\n" + shared)]
    assert got(docs(rows)) == brute(rows)


def test_edge_cases(docs, clashing, edge_rows):
    assert got(clashing.select("*")) == brute(edge_rows)
    assert got(docs([])) == []


def test_plan_is_native(docs):
    plan = dedup_lines(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_many_repeated_rows_take_linear_work(spark, docs):
    """50,000 rows of one id and text share each row's 40 lines with an earlier document."""
    from pyspark.sql import functions as F

    text = "\n".join(f"a line that is shared, number {i}" for i in range(40))
    rows = docs([(1, text)]).unionByName(spark.range(50_000).select(
        F.lit(None).cast("bigint").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("bigint").alias("n_chars")))
    out = dedup_lines(rows).groupBy("doc_id", "n_dropped", "kept").count().collect()
    assert sorted((r.doc_id or 0, r.n_dropped, len(r.kept), r["count"]) for r in out) == [(0, 40, 0, 50_000), (1, 0, len(text), 1)]
