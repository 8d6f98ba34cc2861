"""Write PLANS.md: the physical-plan shape of every model and every registered query of the
sales operators, all lazy, over the landed tables.

usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(df) -> dict:
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan().toString()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = qe.explainString(mode)
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", text):
        if not re.match(r"\(\d+\) Scan parquet", block):
            continue
        loc = re.search(r"Location: \w+ \[[^\]]*/([\w\-]+?)(?:\.parquet)?\]", block)
        pf = re.search(r"PushedFilters: \[([^\]]*)\]", block)
        rs = re.search(r"ReadSchema: struct<(.*)>", block)
        ncols = len(re.findall(r"(?:^|,)\w+:", rs.group(1))) if rs else 0
        scans.append(f"{loc.group(1) if loc else '?'}({ncols} cols{'; ' + pf.group(1) if pf and pf.group(1) else ''})")
    return {
        "exchanges": len(re.findall(r"Exchange (?:hash|range|Single|round)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "bnlj": plan.count("BroadcastNestedLoopJoin"),
        "window": len(re.findall(r"\bWindow\b", plan)),
        "generate": plan.count("Generate "),
        "scans": scans,
    }


def row(name, s) -> str:
    scans = "; ".join(s["scans"]) or "-"
    return (f"| {name} | {s['exchanges']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | {s['bnlj']} | {s['window']} | "
            f"{s['generate']} | {scans} |")


def main():
    import tempfile

    from dealflow.plans.context import LEVELS, Models
    from dealflow.plans.registry import QUERIES, load_all
    from dealflow.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    load_all()
    head = ("| query | shuffles | broadcasts | SMJ | BHJ | BNLJ | Window | Generate | scans (cols; pushed filters) |\n"
            "| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    out = ["# Physical plans", "",
           f"Generated by `tools/plan_report.py` on `{sf}` (Spark {spark.version}, AQE on; counts are of the",
           "initial executed plan). *shuffles* = hash / range / single-partition exchanges. Every model and query",
           "is a lazy view over the landed tables; nothing reads a finished model.", "", "## Models", "", head]
    m = Models.of(spark, sf)
    m.materialize(tempfile.mkdtemp(prefix="plans-"), levels=1)
    for level in LEVELS[1:]:
        for name in level:
            out.append(row(name, shape(getattr(m, name))))
    out.append(row("report (M13)", shape(m.report())))
    out += ["", "## Registered queries", "", head]
    for name, fn in QUERIES.items():
        if name.startswith(("s8_", "s9_", "s10_")):
            out.append(f"| {name} | file round trip | | | | | | | |")
            continue
        out.append(row(name, shape(fn(spark, sf))))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
