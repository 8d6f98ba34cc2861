"""Expressions that every filter over the landed tables repeats: constant-array lookups and days read once a row."""

import datetime as dt

from dealflow import config as C
from dealflow.functions import flags as FL
from dealflow.operators import reconcile as RC
from dealflow.plans import standins as S
from pyspark.sql import functions as F


def test_stage_is_a_lookup(spark, tmp_path):
    """The stage of a deal by pipeline and slot, unknown slots, priorities and negative keys included."""
    prios = (*S.PIPELINES, "5-LOW", None)
    rows = [(k, c, "O", dt.datetime(2000, 1, 1), p) for k in (*range(-4, 20), None) for c in (-9, 0, 5) for p in prios]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([], "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, "
                              "l_shipdate timestamp_ntz").write.parquet(str(tmp_path / "lineitem.parquet"))
    raw = S.raw_deal(spark, str(tmp_path))
    slots = S.stage_slots()
    slot = lambda k, c: (abs(k * 7 + c) % 16) * (1 if k * 7 + c >= 0 else -1)
    want = sorted(repr((k, None if k is None else slots.get((S.PIPELINES.get(p), slot(k, c)), f"x-{slot(k, c)}"))) for k, c, _, _, p in rows)
    assert sorted(repr(tuple(r)) for r in raw.select("deal_id", "deal_pipeline_stage_id").collect()) == want
    assert raw.select("deal_pipeline_stage_id")._jdf.queryExecution().optimizedPlan().toString().count("WHEN") <= len(S.PIPELINES)


def test_activity_and_outcome_are_lookups(spark, tmp_path):
    kinds = (*S.ACTIVITIES, "other", None)
    rows = [(e, dt.datetime(2024, 1, 1), 1, t) for e in (*range(-13, 30), None) for t in kinds]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    by_hand = F.expr("""CASE WHEN t = 'signup' THEN CASE WHEN e % 2 = 0 THEN 'Renewal 3 Month' ELSE 'Renewal Accelerator 3 month' END
        WHEN t = 'click' THEN CASE e % 3 WHEN 0 THEN 'Renewal Strategy' WHEN 1 THEN 'Renewal Accelerator' ELSE 'Renewal Follow-up' END
        WHEN t = 'view' THEN CASE WHEN e % 2 = 0 THEN 'Renewal Post Webinar Call' ELSE 'Renewal Strategy Alignment' END
        WHEN t = 'purchase' THEN 'Renewal Winback Call' WHEN t = 'error' AND e % 2 = 0 THEN 'Renewal Accelerator Evergreen' END""")
    outcome = F.expr("""CASE WHEN e % 5 IN (0, 3) THEN 'COMPLETED' WHEN e % 5 = 1 THEN CASE WHEN e % 2 = 0 THEN 'CANCELED' ELSE 'CANCELLED' END
        WHEN e % 5 = 4 THEN CASE WHEN e % 2 = 0 THEN 'NO_SHOW' ELSE 'COMPLETED - NURTURE' END END""")
    want = spark.read.parquet(str(tmp_path / "events.parquet")).select(F.col("event_id").alias("e"), F.col("event_type").alias("t")).select("e", by_hand, outcome)
    got = S.raw_meeting(spark, str(tmp_path)).select("engagement_id", "property_hs_activity_type", "property_hs_meeting_outcome")
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(tuple(r)) for r in want.collect())


def test_category_holds_the_activity_once(spark):
    all_types = {a: c for c, types in (("PC", C.PC_ACTIVITY_TYPES), ("RC", C.RC_ACTIVITY_TYPES), ("PWC", C.PWC_ACTIVITY_TYPES), ("WB", C.WB_ACTIVITY_TYPES)) for a in types}
    df = spark.createDataFrame([(a,) for a in (*all_types, *C.RETIRED_ACTIVITY_TYPES, "", None)], "a string")
    assert {r.a: r.c for r in df.select("a", FL.categorize("a").alias("c")).collect()} == {**all_types, **dict.fromkeys((*C.RETIRED_ACTIVITY_TYPES, "", None))}
    plan = spark.range(5).select(FL.categorize(F.concat(F.lit("needle"), F.col("id").cast("string"))).alias("c")).filter("c IN ('PC', 'RC')")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("\n")[1].count("needle") <= 2


def test_text_days_are_read_once_a_row(spark):
    texts = [None, "", "2001-02-03", "2001-02-03T04:05:06Z", "2001-02-30", "2000-02-29", "1900-02-29", "2001-2-3", "2001-02-3 ", " 2001-02-3", "2001-02-3T", "0000-01-01",
             "+2001-01-1", "-001-01-01", "2001", "2001-02", "2001/02/03", "２001-02-03", "2001-02-0\n", "1582-10-10"]
    df = spark.createDataFrame([(t,) for t in texts], "upsell___close_date string")
    for r in df.selectExpr("upsell___close_date AS t", f"string({RC.day_sql('upsell___close_date', 'string', 'day')}) AS got", "string(try_to_date(substring(upsell___close_date, 1, 10), 'yyyy-MM-dd')) AS want").collect():
        assert r.got == r.want, r
    assert RC.with_days(df).columns == ["upsell___close_date", "upsell___close_date__day"]
    rules = (RC.Rule("upsell___close_date", "BETWEEN", (RC.Bound.START, RC.Bound.END)), RC.Rule("upsell___close_date", "HAS_PROPERTY"))
    one = RC.filter_sql(RC.with_days(df), rules, "2001-01-01", "2001-12-31")
    assert "RLIKE" not in one and RC.filter_by_spec(RC.with_days(df), rules, "2001-01-01", "2001-12-31").count() == RC.filter_by_spec(df, rules, "2001-01-01", "2001-12-31").count() == 2
