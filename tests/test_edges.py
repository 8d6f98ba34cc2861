"""Edge cases the reference does not test."""

import datetime as dt
import random

import pytest
from builders import A, closers, deals, flags, meeting_deals, meetings, stages
from pyspark.sql import functions as F

from dealflow.config import CashComponent
from dealflow.functions import dates as D
from dealflow.functions import flags as FL
from dealflow.functions import ratios as RT
from dealflow.operators import models as M
from dealflow.operators import quality as Q
from dealflow.operators import reconcile as RC
from dealflow.operators import report as R
from dealflow.operators import staging as ST
from dealflow.sources import dims, scans


def one(df):
    return df.collect()[0]


def test_null_outcome_three_valued_logic(spark):
    df = spark.createDataFrame([("Renewal Strategy", None), ("Renewal 3 Month", None)], "a string, o string")
    r = df.select(FL.is_booked("o").alias("b"), FL.is_completed("o").alias("c"),
                  FL.is_closing_call(FL.categorize("a"), FL.is_completed("o"), "a").alias("cl")).collect()
    assert (r[0].b, r[0].c, r[0].cl) == (False, None, None)   # RC: closing flag NULL
    assert (r[1].b, r[1].c, r[1].cl) == (False, None, False)  # PC: closing flag FALSE


def test_one_deal_per_meeting_prefers_tracked_then_high_id_null_first(spark):
    assoc = spark.createDataFrame([(1, 10), (1, 20), (2, 30), (2, None), (3, 40), (3, 50)],
                                  "engagement_id long, deal_id long")
    d = deals(spark, [{"deal_id": 10, "pipeline_id": "95211801"}, {"deal_id": 20, "pipeline_id": "1"},
                      {"deal_id": 30, "pipeline_id": "1"}, {"deal_id": 40, "pipeline_id": "917643668"},
                      {"deal_id": 50, "pipeline_id": "898243912"}])
    out = dict(ST.one_deal_per_meeting(assoc, d).collect())
    assert out == {1: 10, 2: None, 3: 50}


def test_first_call_ties_broken_by_meeting_id_and_null_start_last(spark):
    m = meetings(spark, [
        {"meeting_id": 7, "owner_id": A, "activity_type": "Renewal Strategy", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-01 10:00:00"},
        {"meeting_id": 6, "owner_id": A, "activity_type": "Renewal Strategy", "meeting_outcome": "COMPLETED", "meeting_start_at": "2026-08-01 10:00:00"},
        {"meeting_id": 5, "owner_id": A, "activity_type": "Renewal Strategy", "meeting_outcome": "COMPLETED", "meeting_start_at": None},
    ])
    md = meeting_deals(spark, [{"meeting_id": i, "deal_id": 1} for i in (5, 6, 7)])
    out = dict(M.meetings(m, md, closers(spark)).select("meeting_id", "is_first_call").collect())
    assert out == {5: False, 6: True, 7: False}
    assert Q.check_first_call(M.meetings(m, md, closers(spark))).count() == 0


def test_duplicate_normalised_tier_keys_are_reported(spark):
    tm = spark.createDataFrame([("Gold", "TERM_2", ""), (" gold ", "MM_TIER", ""), ("Bronze", "TERM_2", "")],
                               "active_product_snapshot_at_won string, tier_of_origin_column string, notes string")
    bad = Q.normalised_key_conflicts(tm, "active_product_snapshot_at_won").collect()
    assert [(r.normalised_key, r.n_records) for r in bad] == [("GOLD", 2)]


def test_tier_lookup_is_case_and_space_insensitive(spark):
    tm = dims.load_dim(spark, "dim_member_tier_map")
    df = spark.createDataFrame([("  defi accelerator gems ",), ("PLATINUM",), ("nope",), (None,)], "active_product_snapshot_at_won string")
    out = {r[0]: r[1] for r in M.tier_of_origin(df, tm).collect()}
    assert out == {"  defi accelerator gems ": "ACC_TIER", "PLATINUM": "TERM_2", "nope": "UNMAPPED", None: "UNMAPPED"}


@pytest.mark.parametrize("ts,expected", [
    ("2026-03-08 04:30:00", dt.date(2026, 3, 7)),   # 23:30 EST
    ("2026-03-08 05:30:00", dt.date(2026, 3, 8)),   # 00:30 EST
    ("2026-03-09 03:00:00", dt.date(2026, 3, 8)),   # 23:00 EDT
    ("2026-03-09 04:30:00", dt.date(2026, 3, 9)),   # 00:30 EDT
    ("2026-11-01 03:00:00", dt.date(2026, 10, 31)),  # 23:00 EDT
    ("2026-11-01 04:30:00", dt.date(2026, 11, 1)),  # 00:30 EDT
    ("2026-11-02 04:30:00", dt.date(2026, 11, 1)),  # 23:30 EST
    ("2026-11-02 05:30:00", dt.date(2026, 11, 2)),  # 00:30 EST
])
def test_et_date_around_dst(spark, ts, expected):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(ts),)], "t timestamp_ntz")
    assert one(df.select(D.et_date("t")))[0] == expected
    assert one(df.select(D.date_only("t")))[0] == dt.date.fromisoformat(ts[:10])


def test_month_bounds_clamp_prior_month_end(spark):
    df = spark.range(1)
    b = D.month_bounds(dt.date(2026, 3, 31))
    r = one(df.select(*[v.alias(k) for k, v in b.items()]))
    assert (r.mtd_start, r.prior_month_start, r.prior_mtd_end, r.yesterday_et) == (
        dt.date(2026, 3, 1), dt.date(2026, 2, 1), dt.date(2026, 2, 28), dt.date(2026, 3, 30))
    r = one(df.select(*[v.alias(k) for k, v in D.month_bounds(dt.date(2026, 3, 1)).items()]))
    assert (r.prior_month_start, r.prior_mtd_end, r.yesterday_et) == (dt.date(2026, 2, 1), dt.date(2026, 2, 1),
                                                                       dt.date(2026, 2, 28))


def test_midpoint_floor_and_prior_window(spark):
    df = spark.createDataFrame([(dt.date(2026, 2, 14), dt.date(2027, 2, 15)), (dt.date(2026, 1, 10), dt.date(2026, 1, 1))],
                               "s date, e date")
    mids = [r[0] for r in df.select(D.midpoint("s", "e")).collect()]
    assert mids == [dt.date(2026, 8, 16), dt.date(2026, 1, 5)]
    ps, pe = D.prior_window(dt.date(2026, 8, 1), dt.date(2026, 8, 30))
    r = one(spark.range(1).select(ps.alias("a"), pe.alias("b")))
    assert (r.a, r.b) == (dt.date(2026, 7, 2), dt.date(2026, 7, 31))


def test_window_presets_end_yesterday(spark):
    s, e = D.window_bounds("mtd", dt.date(2026, 3, 1))
    r = one(spark.range(1).select(s.alias("s"), e.alias("e")))
    assert (r.s, r.e) == (dt.date(2026, 2, 1), dt.date(2026, 2, 28))
    s, e = D.window_bounds("last7d", dt.date(2026, 8, 17))
    r = one(spark.range(1).select(s.alias("s"), e.alias("e")))
    assert (r.s, r.e) == (dt.date(2026, 8, 10), dt.date(2026, 8, 16))
    with pytest.raises(ValueError):
        D.window_bounds("last90d", dt.date(2026, 8, 17))


def test_zero_denominators(spark):
    df = spark.createDataFrame([(3, 0), (1, 4), (2, None)], "n long, d long")
    r = df.select(RT.safe_pct("n", "d").alias("s"), RT.report_pct("n", "d").alias("p"),
                  RT.ratio_or_zero("n", "d").alias("z")).collect()
    assert [(x.s, x.p, x.z) for x in r] == [(None, None, 0.0), (25.0, 25.0, 0.25), (None, None, 0.0)]


def test_labels(spark):
    df = spark.createDataFrame([(1234.0,), (123456.0,), (999.0,), (-1500.0,), (4184.4,)], "x double")
    r = df.select(RT.money_k("x"), RT.money_k_signed("x"), RT.money("x"), RT.pct_label(F.col("x") / 1000)).collect()
    assert [tuple(x) for x in r] == [
        ("$1.2K", "+$1.2K", "$1,234", "1%"), ("$123K", "+$123K", "$123,456", "123%"),
        ("$999", "+$999", "$999", "100%"), ("$-1500", "-$1.5K", "$-1,500", "-150%"),
        ("$4.2K", "+$4.2K", "$4,184", "4%")]


def test_missing_optional_columns_are_typed_null(spark):
    raw = spark.createDataFrame([(1, 5, "95211801", "175346331", None)],
                                "deal_id long, owner_id long, deal_pipeline_id string, deal_pipeline_stage_id string, "
                                "_fivetran_deleted boolean")
    cols = {c: F.lit(None).cast("string") for c in (
        "property_upsell_close_date", "property_closedate", "property_cash_collected", "property_renewal_year_count",
        "property_renewal_product_category_originally_purchased", "property_upsell_plan",
        "property_renewal_product_pitched", "property_active_product_snapshot_at_won",
        "property_renewal_traffic_source", "property_hs_v_2_date_entered_current_stage",
        "property_membership_expiration_date")}
    for _, a, b in ST._PAYMENT_SOURCES:
        cols[a], cols[b] = F.lit(None).cast("double"), F.lit(None).cast("timestamp_ntz")
    from dealflow.config import STAGE_ENTRY_SOURCES
    for _, n, o in STAGE_ENTRY_SOURCES:
        cols[n], cols[o] = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz")
    raw = raw.withColumns(cols)
    d = ST.stage_deals(raw)
    f = d.schema
    assert f["ap11_amount"].dataType.typeName() == "double"
    assert f["ap12_stamped_at"].dataType.typeName() == "timestamp_ntz"
    assert one(d.select("ap11_amount", "renewal_product")) == (None, None)


def test_soft_delete_filter_is_pushed_down(spark, tmp_path):
    p = str(tmp_path / "raw")
    spark.createDataFrame([(1, True), (2, False), (3, None)], "id long, _fivetran_deleted boolean").write.parquet(p)
    df = scans.live_rows(spark.read.parquet(p))
    assert sorted(r.id for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "_fivetran_deleted" in plan.split("PushedFilters")[1].split("]")[0]


def test_empty_component_list_and_negative_or_undated_components(spark):
    won = spark.createDataFrame([(1, A, dt.date(2026, 8, 1), 0.0, -5.0, None, 7.0, dt.datetime(2026, 8, 2))],
                                "deal_id long, closer_owner_id string, close_date_et date, cash_collected double, "
                                "ap1_amount double, ap1_stamped_at timestamp_ntz, ap2_amount double, ap2_stamped_at timestamp_ntz")
    assert M.unpivot_components(won, components=()).count() == 0
    comps = (CashComponent("base", "cash_collected", None, "close"), CashComponent("ap1", "ap1_amount", "ap1_stamped_at"),
             CashComponent("ap2", "ap2_amount", "ap2_stamped_at"))
    rows = M.unpivot_components(won, components=comps).collect()
    assert [(r.cash_component, r.cash_date_et, r.cash_amount) for r in rows] == [("ap2", dt.date(2026, 8, 2), 7.0)]


def test_report_keeps_idle_closers_and_ignores_unknown_targets(spark):
    cash = spark.createDataFrame([(A, dt.date(2026, 3, 31), 100.0), (A, dt.date(2026, 2, 28), 40.0),
                                  (A, dt.date(2026, 3, 30), 10.0)], "closer_owner_id string, cash_date_et date, cash_amount double")
    won = spark.createDataFrame([(A, dt.date(2026, 3, 5))], "closer_owner_id string, close_date_et date")
    mt = spark.createDataFrame([(A, "RC", True, True, dt.date(2026, 3, 2))],
                               "closer_owner_id string, meeting_category string, is_completed boolean, is_first_call boolean, "
                               "meeting_date_et date")
    tg = spark.createDataFrame([("Closer A", 70000.0, 6.0, 30.0, 3500.0), ("Nobody", 1.0, 1.0, 1.0, 1.0)],
                               "closer_name string, goal_total_cash double, goal_deals_won double, "
                               "goal_live_close_pct double, goal_avg_dpl double")
    rep = {r.closer_owner_id: r for r in R.closer_report(cash, won, mt, tg, closers(spark), dt.date(2026, 3, 31)).collect()}
    a, b = rep[A], rep["82734543"]
    assert (a.cash_mtd, a.cash_prior_mtd, a.cash_today, a.cash_today_vs_yesterday) == (110.0, 40.0, 100.0, 90.0)
    assert (a.deals_won_mtd, a.live_meetings_mtd, a.live_close_pct, a.avg_dpl, a.goal_total_cash) == (1, 1, 100.0, 110.0, 70000.0)
    assert (b.cash_mtd, b.deals_won_mtd, b.live_close_pct, b.goal_total_cash) == (0.0, 0, None, None)
    assert a.prior_mtd_end == dt.date(2026, 2, 28)


def test_bounded_broadcast_falls_back_above_bound(spark):
    plan = lambda df: df._jdf.queryExecution().logical().toString().lower()
    assert "hint" in plan(dims.bounded_broadcast(spark.range(5), 1_000_000))
    assert "hint" not in plan(dims.bounded_broadcast(spark.range(5), 1))


def test_filter_spec_placeholders_and_owner_drop(spark):
    df = spark.createDataFrame([("1", "a", "2", dt.datetime(2026, 8, 3)), ("2", "b", "3", dt.datetime(2026, 9, 3))],
                               "id string, dealstage string, hubspot_owner_id string, d timestamp_ntz")
    spec = [RC.f("dealstage", "IN", ["a", "b"]), RC.f("hubspot_owner_id", "EQ", RC.Bound.OWNER),
            RC.f("d", "BETWEEN", (RC.Bound.START, RC.Bound.END)), RC.f("id", "HAS_PROPERTY")]
    assert [r.id for r in RC.filter_by_spec(df, spec, "2026-08-01", "2026-08-31", None).collect()] == ["1"]
    assert RC.filter_by_spec(df, spec, "2026-08-01", "2026-09-30", "3").count() == 1


def test_verdicts(spark):
    df = spark.createDataFrame([(10.0, 10.5), (10.0, 12.0), (None, 1.0), (0.0, 0.0), (0.0, 3.0), (101.0, 100.0)],
                               "a double, b double")
    ve, de = RC.verdict_exact(F.col("a"), F.col("b"), 1.0)
    vr, dr = RC.verdict_ratio(F.col("a"), F.col("b"))
    r = [tuple(x) for x in df.select(ve, de, vr, dr).collect()]
    assert r[0][:2] == ("confirmed", "")
    assert r[1][:2] == ("discrepancy", "diff=-2.00 (tolerance=1.0)")
    assert r[2] == ("not_checkable", "one side returned no data", "not_checkable", "one side returned no data")
    assert r[3][2:] == ("confirmed", "")
    assert r[4][2:] == ("discrepancy", "one side is zero, ratio undefined")
    assert r[5][2:] == ("confirmed", "ratio=1.010")


def test_audit_diff_sides(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    b = spark.createDataFrame([("2",), ("3",), ("9",)], "id string")
    out = sorted(tuple(r) for r in RC.sorted_diff(RC.audit_diff(a, b)).collect())
    assert out == [("extra_in_other", "9"), ("missing_in_other", "1")]


def _union_anti_snapshot(spark, d, fl, st, cl, as_of):
    """The three-branch form (rc_due, pc_due, stage) glued with anti joins."""
    from dealflow.config import PRE_PC_SNAPSHOT_COLS, PRE_RC_SNAPSHOT_COLS
    base = d.join(fl, "deal_id", "left").filter(~F.coalesce(F.col("is_test_contact"), F.lit(False)))
    roster = cl.withColumnRenamed("owner_id", "closer_owner_id")
    exp = D.date_only("membership_expiration_date")
    start = D.start_date("close_date", "close_date_fallback", "contact_true_renewal_close_date")
    new = "898243912"
    pre_rc = st.filter((F.col("pipeline_id") == new) & F.col("snapshot_col").isin(*PRE_RC_SNAPSHOT_COLS)).select(
        F.col("stage_id").alias("dealstage_id"))
    pre_pc = st.filter((F.col("pipeline_id") == new) & F.col("snapshot_col").isin(*PRE_PC_SNAPSHOT_COLS)).select(
        F.col("stage_id").alias("dealstage_id"))
    rc = (base.join(pre_rc, "dealstage_id").join(roster, "closer_owner_id")
          .filter((F.col("pipeline_id") == new) & exp.isNotNull() & FL.rc_due_pred(as_of, exp))
          .select("closer_owner_id", "closer_name", "pipeline_id", F.lit("renewal_call").alias("stage_group"),
                  F.lit("rc_due").alias("snapshot_col"), "deal_id", F.date_sub(exp, 45).alias("entry_date_et")))
    mid = D.midpoint(start, exp)
    pc = (base.join(pre_pc, "dealstage_id").join(roster, "closer_owner_id")
          .filter((F.col("pipeline_id") == new) & mid.isNotNull() & FL.pc_due_pred(as_of, mid))
          .join(rc.select("deal_id"), "deal_id", "left_anti")
          .select("closer_owner_id", "closer_name", "pipeline_id", F.lit("progress_call").alias("stage_group"),
                  F.lit("pc_due").alias("snapshot_col"), "deal_id", F.date_sub(mid, 15).alias("entry_date_et")))
    sb = (base.join(st.withColumnRenamed("pipeline_id", "s_pipe"), base["dealstage_id"] == st["stage_id"])
          .join(roster, "closer_owner_id")
          .join(rc.select("deal_id"), "deal_id", "left_anti").join(pc.select("deal_id"), "deal_id", "left_anti")
          .select("closer_owner_id", "closer_name", F.col("s_pipe").alias("pipeline_id"), "stage_group", "snapshot_col",
                  "deal_id", D.et_date("date_entered_current_stage").alias("entry_date_et")))
    return sb.unionByName(rc).unionByName(pc)


def test_one_pass_snapshot_equals_union_and_anti_joins(spark):
    rnd = random.Random(7)
    st_rows = dims.seed_rows("dim_renewal_stages")
    stage_ids = [r["stage_id"] for r in st_rows] + ["unknown-1"]
    pipes = ["95211801", "898243912", "917643668", "1"]
    base_day = dt.datetime(2026, 1, 1)
    rows, frows = [], []
    for i in range(400):
        e = base_day + dt.timedelta(days=rnd.randint(0, 400))
        rows.append({"deal_id": i, "closer_owner_id": rnd.choice([A, "82734543", "999"]), "pipeline_id": rnd.choice(pipes),
                     "dealstage_id": rnd.choice(stage_ids),
                     "close_date": None if rnd.random() < 0.3 else (e - dt.timedelta(days=rnd.randint(100, 400))).isoformat(),
                     "close_date_fallback": None if rnd.random() < 0.5 else (e - dt.timedelta(days=200, hours=rnd.randint(0, 23))).isoformat(),
                     "membership_expiration_date": None if rnd.random() < 0.1 else e.isoformat(),
                     "date_entered_current_stage": (e - dt.timedelta(hours=rnd.randint(0, 900))).isoformat()})
        if rnd.random() < 0.4:
            frows.append({"deal_id": i, "is_test_contact": rnd.random() < 0.3,
                          "contact_true_renewal_close_date": (e - dt.timedelta(days=180, hours=3)).isoformat()})
    d, fl = deals(spark, rows), flags(spark, frows)
    st = stages(spark, st_rows)
    cl = closers(spark)
    as_of = dt.date(2026, 8, 17)
    one_pass = M.fct_pipeline_snapshot(d, fl, st, cl, as_of)
    ref = _union_anti_snapshot(spark, d, fl, st, cl, as_of)
    a = sorted(tuple(r) for r in one_pass.collect())
    b = sorted(tuple(r) for r in ref.select(*one_pass.columns).collect())
    assert a == b and len(a) > 50
    assert one_pass.groupBy("deal_id").count().filter("count > 1").count() == 0


def test_check_summary_shape(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    s = {r.check: r.failing_rows for r in Q.run_checks([("u", "error", Q.check_unique(df, "k")),
                                                          ("n", "error", Q.check_not_null(df, "k"))]).collect()}
    assert s == {"u": 1, "n": 1}


def test_empty_inputs_give_empty_facts_and_a_zero_report(spark):
    d = deals(spark, [])
    cl = closers(spark)
    won = M.won_deals(d, cl)
    cash = M.fct_cash(won, dims.load_dim(spark, "dim_product_map"), dims.load_dim(spark, "dim_member_tier_map"), cl)
    mt = M.fct_meetings(M.meetings(meetings(spark, []), meeting_deals(spark, []), cl), cl)
    assert cash.count() == 0 and mt.count() == 0
    snap = M.fct_pipeline_snapshot(d, flags(spark, []), stages(spark, []), cl, dt.date(2026, 8, 17))
    assert snap.count() == 0
    tg = spark.createDataFrame([], "closer_name string, goal_total_cash double, goal_deals_won double, "
                                   "goal_live_close_pct double, goal_avg_dpl double")
    rep = R.closer_report(cash, won, mt, tg, cl, dt.date(2026, 8, 17)).collect()
    assert len(rep) == 2 and all(r.cash_mtd == 0.0 and r.deals_won_mtd == 0 and r.live_close_pct is None for r in rep)


def test_winback_overrides_a_mapped_plan_and_unmapped_plans_default(spark):
    pm = dims.load_dim(spark, "dim_product_map")
    df = spark.createDataFrame([("917643668", "Winback - Acc Plus"), ("95211801", "Winback - Acc Plus"),
                                ("95211801", "No Such Plan"), ("898243912", None)],
                               "pipeline_id string, upsell_plan string")
    out = [r.product_column for r in M.product_column(df, pm).orderBy("pipeline_id", "upsell_plan").collect()]
    assert sorted(out) == sorted(["WINBACK", "ACC_TIER", "UNMAPPED", "UNMAPPED"])
    got = {(r.pipeline_id, r.upsell_plan): r.product_column for r in M.product_column(df, pm).collect()}
    assert got[("917643668", "Winback - Acc Plus")] == "WINBACK"
    assert got[("95211801", "Winback - Acc Plus")] == "ACC_TIER"


def test_first_call_plan_has_no_window_over_deal_groups(spark):
    m = meetings(spark, [{"meeting_id": i, "owner_id": A, "activity_type": "Renewal Strategy",
                          "meeting_outcome": "COMPLETED", "meeting_start_at": f"2026-08-{1 + i % 28:02d} 10:00:00"}
                         for i in range(60)])
    md = meeting_deals(spark, [{"meeting_id": i, "deal_id": 1 if i < 20 else i} for i in range(60)])  # one hot deal
    out = M.meetings(m, md, closers(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    flags_ = dict(out.select("meeting_id", "is_first_call").collect())
    assert sum(flags_[i] for i in range(20)) == 1 and all(flags_[i] for i in range(20, 60))


def test_filter_rules_against_python(spark):
    rows = [(str(i), ["a", "b", "c", None][i % 4], str(i % 3), dt.datetime(2026, 8, 1 + i % 20, i % 24), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, dealstage string, hubspot_owner_id string, d timestamp_ntz, amt double")
    day = lambda r: r[3].date().isoformat()
    cases = [
        ([RC.f("dealstage", "IN", ["a", "b"]), RC.f("d", "BETWEEN", ["2026-08-03", "2026-08-10"])],
         lambda r: r[1] in ("a", "b") and "2026-08-03" <= day(r) <= "2026-08-10"),
        ([RC.f("dealstage", "EQ", "c"), RC.f("amt", "GTE", 10.0), RC.f("amt", "LT", 40.0)], lambda r: r[1] == "c" and 10 <= r[4] < 40),
        ([RC.f("hubspot_owner_id", "EQ", "1"), RC.f("dealstage", "HAS_PROPERTY")], lambda r: r[2] == "1" and r[1] is not None),
        ([RC.f("d", "GT", "2026-08-15"), RC.f("id", "LTE", "5")], lambda r: day(r) > "2026-08-15" and r[0] <= "5"),
    ]
    for rules, holds in cases:
        want = sorted(r[0] for r in rows if holds(r))
        assert want and sorted(r.id for r in RC.filter_by_spec(df, rules).collect()) == want, rules
    with pytest.raises(ValueError):
        RC.filter_sql(df, [RC.f("id", "LIKE", "x")])
    total = df.agg(F.expr(f"sum({RC.dated_components_sql(df, [('amt', 'd')], '2026-08-02', '2026-08-09')})")).collect()[0][0]
    assert total == sum(r[4] for r in rows if "2026-08-02" <= day(r) <= "2026-08-09")


def test_text_dates_and_instants_of_the_second_system(spark):
    """Text days keep the window's last day; an instant counts on its New York day; malformed text never matches or fails."""
    df = spark.createDataFrame([("a", "2001-03-30T15:00:00Z", "2001-03-31T01:00:00Z"), ("b", "2001-03-31T00:00:00Z", "2001-03-31T05:00:00Z"),
                                ("c", "2026-13-45T00:00", "nonsense"), ("d", "2001-03-30", "2001-03-30 23:30:00")],
                               "id string, upsell___close_date string, hs_meeting_start_time string")
    window = (RC.Bound.START, RC.Bound.END)
    got = lambda prop, frame: sorted(r.id for r in RC.filter_by_spec(frame, [RC.f(prop, "BETWEEN", window)], "2001-03-30", "2001-03-30").collect())
    assert got("upsell___close_date", df) == ["a", "d"]
    assert got("hs_meeting_start_time", df) == ["a", "d"]
    stamped = df.filter("id <> 'c'").select("id", F.expr("CAST(replace(replace(hs_meeting_start_time, 'T', ' '), 'Z', '') AS TIMESTAMP_NTZ)").alias("hs_meeting_start_time"))
    assert got("hs_meeting_start_time", stamped) == ["a", "d"]
    paid = spark.createDataFrame([(5.0, "2026-13-45T00:00"), (7.0, "2001-03-30T00:00:00Z"), (None, "2001-03-30")], "amt double, upsell___close_date string")
    assert paid.agg(F.expr(f"sum({RC.dated_components_sql(paid, [('amt', 'upsell___close_date')], '2001-03-30', '2001-03-30')})")).collect()[0][0] == 7.0


def test_soft_delete_flag_in_any_case_and_missing(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, _FIVETRAN_DELETED boolean")
    assert sorted(r.id for r in scans.live_rows(df).collect()) == [2, 3]
    with pytest.raises(ValueError):
        scans.live_rows(df.select("id"))
    assert scans.live_rows(df.select("id"), required=False).count() == 3


def test_reconcile_mode_per_metric_and_unknown_ids(spark):
    from dataclasses import replace

    long = lambda v: spark.createDataFrame([("deals_won", None, v)], "metric_id string, owner_id string, value double")
    m = replace(RC.BASE_METRICS[0], mode="ratio", tolerance=0.02)
    assert RC.reconcile(long(101.0), long(100.0), [m], derived=()).collect()[0].verdict == "confirmed"
    assert RC.reconcile(long(101.0), long(100.0), [replace(m, mode="exact")], derived=()).collect()[0].verdict == "discrepancy"
    with pytest.raises(ValueError):
        RC.reconcile(long(1.0), long(1.0), [replace(m, mode="fuzzy")], derived=())
    with pytest.raises(ValueError):
        RC.reconcile(long(1.0), long(1.0), [m], derived=(), requested=["no_such_metric"])


def test_load_dim_from_csv_path_with_declared_types(spark):
    path = str(dims.SEED_DIR / "dim_renewal_stages.csv")
    a = dims.load_dim(spark, "dim_renewal_stages", path=path)
    b = dims.load_dim(spark, "dim_renewal_stages")
    def names_types(df):
        return [(f.name, f.dataType) for f in df.schema.fields]  # the CSV reader marks every column nullable

    assert names_types(a) == names_types(b) and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() == 36 and [f.dataType.typeName() for f in a.schema.fields] == ["string"] * 5


def test_publish_view_and_table_in_a_layer_database(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "deal_id long, x string")
    v = scans.publish(df, "fct_example_view", "view")
    assert v.count() == 2 and spark.table("fct_example_view").count() == 2
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts_layer LOCATION '{tmp_path}/marts_layer'")
    t = scans.publish(df, "fct_example", "table", database="marts_layer")
    assert sorted(r.deal_id for r in t.collect()) == [1, 2]
    assert spark.catalog.tableExists("marts_layer.fct_example")
    with pytest.raises(ValueError):
        scans.publish(df, "x", "materialized_view")
    with pytest.raises(ValueError):
        scans.publish(df, "x", "view", database="marts_layer")


def test_freshness_statuses(spark):
    one = lambda hour: spark.createDataFrame([(dt.datetime(2026, 8, 17, hour),), (None,)], "_FIVETRAN_SYNCED timestamp_ntz")
    sources = {"A": one(1), "B": one(0), "C": spark.createDataFrame([], "x int"), "D": one(1).filter("false")}
    got = {r.source: (r.age_hours, r.status) for r in scans.freshness(sources, dt.datetime(2026, 8, 17, 5, 0)).collect()}
    assert got == {"A": (4.0, "pass"), "B": (5.0, "warn"), "C": (None, "error"), "D": (None, "error")}


def test_aligned_sides_equal_the_join_of_both_sides(spark):
    """Owners off the roster and NULL owners count for the team only; a roster owner without rows has the
    defaults; empty tables leave the team row."""
    day = dt.date(2024, 1, 5)
    cash = spark.createDataFrame([("1", day, 10.0, "ACC_TIER"), ("9", day, 5.0, "MM_TIER"), (None, day, 2.0, "X"), ("1", day + dt.timedelta(days=60), 99.0, "X")],
                                 "closer_owner_id string, cash_date_et date, cash_amount double, product_column string")
    won = spark.createDataFrame([("1", day, True), ("9", day, False)], "closer_owner_id string, close_date_et date, is_post_webinar_close boolean")
    calls = spark.createDataFrame([("2", day, True, "RC"), (None, day, True, "PC")], "closer_owner_id string, meeting_date_et date, is_completed boolean, meeting_category string")
    snap = spark.createDataFrame([("1", "pc_invited"), ("2", "wb_eligible")], "closer_owner_id string, snapshot_col string")
    props = {p for m in RC.BASE_METRICS if m.obj == "deals" for p in [r.prop for r in m.filters] + [c for pair in m.components for c in pair]}
    deals = spark.createDataFrame([("1", "1359841792"), ("9", "1359841792"), (None, "240516941")], "hubspot_owner_id string, dealstage string")
    deals = deals.select("*", *[F.lit("2024-01-05" if p.endswith("date") else None).cast("double" if "amount" in p and "date" not in p else "string").alias(p) for p in sorted(props - {"hubspot_owner_id", "dealstage"})])
    meetings = spark.createDataFrame([("2", "Renewal Strategy", "COMPLETED", "2024-01-05T12:00:00Z")], "hubspot_owner_id string, hs_activity_type string, hs_meeting_outcome string, hs_meeting_start_time string")
    closers = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "owner_id string, closer_name string")
    for some in (lambda df: df, lambda df: df.limit(0)):
        sides = [some(x) for x in (cash, won, calls, snap)], [some(x) for x in (deals, meetings)]
        a = RC.warehouse_side(*sides[0], closers, "2024-01-01", "2024-01-31")
        b = RC.other_side(*sides[1], closers, RC.BASE_METRICS, "2024-01-01", "2024-01-31")
        want = {tuple(r) for r in RC.align(a, b).collect()}
        got = RC.aligned_sides(*sides[0], *sides[1], closers, RC.BASE_METRICS, "2024-01-01", "2024-01-31")
        assert {tuple(r) for r in got.collect()} == want and len(want) == got.count() == 4 * len(RC.BASE_METRICS)
    values = {(r.metric_id, r.owner_id): (r.a_value, r.b_value) for r in RC.aligned_sides(cash, won, calls, snap, deals, meetings, closers, RC.BASE_METRICS, "2024-01-01", "2024-01-31").collect()}
    assert values["total_cash", None] == (17.0, 0.0) and values["total_cash", "1"] == (10.0, 0.0) and values["total_cash", "3"] == (None, 0.0)
    assert values["pc_invited", None] == (1.0, 3.0) and values["rc_completed", "2"] == (1.0, 1.0) and values["rc_completed", "1"] == (0.0, 0.0)
