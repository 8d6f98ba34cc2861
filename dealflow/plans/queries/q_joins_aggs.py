"""J1-J15 (joins), A1-A23 (aggregations), W1-W5 / T1-T2 (windows, ordering), K1-K15
(KPIs) and B1-B2 (rule buckets)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.operators import buckets as B
from dealflow.operators import metrics as A
from dealflow.operators import models as M
from dealflow.operators import quality as Q
from dealflow.operators import reconcile as RC
from dealflow.operators import report as R
from dealflow.operators import staging as ST
from dealflow.plans import standins as S
from dealflow.plans.context import Models
from dealflow.plans.oracle import DAYS, W_END, W_START, bounds_sql, et, lst, safe_pct, sql
from dealflow.plans.registry import register

WIN = f"BETWEEN DATE '{W_START}' AND DATE '{W_END}'"
TODAY_CALLS_AS_OF = _dt.date(2001, 3, 10)


def base(m: Models, first_only: bool = False):
    return A.base_metrics(m.cash, m.won_fct, m.meetings_fct, m.entries, m.snapshot, m.closers, *S.WINDOW,
                          first_only=first_only)


def kpis(spark, sf_dir, first_only: bool = False):
    return A.funnel_kpis(base(Models.of(spark, sf_dir), first_only))


# ---------------------------------------------------------------- J


@register("j1_only_roster", sql("SELECT d.deal_id, d.closer_owner_id FROM stg_deals d "
                                "WHERE d.closer_owner_id IN (SELECT owner_id FROM closers)"))
def j1_only_roster(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.only_roster(m.deals, m.closers).select("deal_id", "closer_owner_id")


@register("j2_with_closer_name", sql("SELECT w.deal_id, c.closer_name FROM int_won w "
                                     "LEFT JOIN closers c ON w.closer_owner_id = c.owner_id"))
def j2_with_closer_name(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.with_closer_name(m.won, m.closers).select("deal_id", "closer_name")


@register("j3_product_column", sql(
    f"SELECT w.deal_id, w.upsell_plan, CASE WHEN w.pipeline_id = '{C.WINBACK_PIPELINE_ID}' THEN 'WINBACK' "
    "ELSE COALESCE(pm.product_column, 'UNMAPPED') END AS product_column "
    "FROM int_won w LEFT JOIN product_map pm ON w.upsell_plan = pm.upsell_plan"))
def j3_product_column(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.product_column(m.won, m.product_map).select("deal_id", "upsell_plan", "product_column")


@register("j4_tier_of_origin", sql(
    "SELECT w.deal_id, w.active_product_snapshot_at_won, COALESCE(tm.tier_of_origin_column, 'UNMAPPED') AS tier_of_origin_column "
    "FROM int_won w LEFT JOIN tier_map tm "
    "ON upper(trim(w.active_product_snapshot_at_won)) = upper(trim(tm.active_product_snapshot_at_won))"))
def j4_tier_of_origin(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.tier_of_origin(m.won, m.tier_map).select("deal_id", "active_product_snapshot_at_won",
                                                      "tier_of_origin_column")


@register("j5_cash_with_attrs", sql(
    "SELECT c.deal_id, c.cash_component, c.cash_amount, w.pipeline_id, w.upsell_plan, w.renewal_year_count "
    "FROM int_cash c LEFT JOIN int_won w ON c.deal_id = w.deal_id"))
def j5_cash_with_attrs(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.cash_with_attrs(m.deal_cash, m.won).select("deal_id", "cash_component", "cash_amount", "pipeline_id",
                                                        "upsell_plan", "renewal_year_count")


@register("j6_contact_flags", sql("SELECT deal_id, is_test_contact FROM stg_deal_contacts"))
def j6_contact_flags(spark, sf_dir):
    return Models.of(spark, sf_dir).contact_flags.select("deal_id", "is_test_contact")


@register("j7_with_deal", sql("SELECT m.meeting_id, md.deal_id FROM stg_meetings m "
                              "LEFT JOIN stg_meeting_deals md ON m.meeting_id = md.meeting_id"))
def j7_with_deal(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return m.stg_meetings.join(m.meeting_deals, "meeting_id", "left").select("meeting_id", "deal_id")


@register("j8_assoc_priority", sql("SELECT meeting_id, deal_id, priority FROM assoc_priority"))
def j8_assoc_priority(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return ST.assoc_priority(m.raw_engagement_deal, m.deals, m.cfg)


@register("j9_with_stage", sql("SELECT d.deal_id, s.snapshot_col, s.stage_group FROM stg_deals d "
                               "JOIN stages s ON d.dealstage_id = s.stage_id"))
def j9_with_stage(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.with_stage(m.deals, m.stages).select("deal_id", "snapshot_col", "stage_group")


@register("j10_not_in", sql("SELECT deal_id FROM stg_deals WHERE deal_id NOT IN (SELECT deal_id FROM int_won)"))
def j10_not_in(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.not_in(m.deals, m.won).select("deal_id")


@register("j11_with_first_call", sql("SELECT meeting_id, is_first_call FROM int_meetings"))
def j11_with_first_call(spark, sf_dir):
    return Models.of(spark, sf_dir).meetings.select("meeting_id", "is_first_call")


@register("j12_with_bounds", sql(f"SELECT deal_id, cash_component, {bounds_sql(*DAYS)} FROM fct_cash"))
def j12_with_bounds(spark, sf_dir):
    c = Models.of(spark, sf_dir).cash.select("deal_id", "cash_component")
    return R.with_bounds(c, S.AS_OF)


@register("j13_wide_report", sql("SELECT closer_owner_id, closer_name, cash_mtd, deals_won_mtd, goal_total_cash FROM rpt"))
def j13_wide_report(spark, sf_dir):
    return Models.of(spark, sf_dir).report().select("closer_owner_id", "closer_name", "cash_mtd", "deals_won_mtd",
                                                 "goal_total_cash")


@register("j14_with_midpoint", sql("SELECT deal_id, began AS membership_start_date_et, expires AS membership_expiration_date_et, "
                                   "middle AS pc_due_midpoint_et FROM snap"))
def j14_with_midpoint(spark, sf_dir):
    """Start, expiry and midpoint of every deal that the snapshot looks at."""
    m = Models.of(spark, sf_dir)
    d = M.snapshot_candidates(m.deals, m.contact_flags, m.stages, m.closers, m.cfg)
    return d.select("deal_id", "membership_start_date_et", "membership_expiration_date_et", "pc_due_midpoint_et")


def metric_definitions() -> tuple:
    from dealflow.sources.dims import seed_rows

    return RC.BASE_METRICS + RC.snapshot_metrics_defs(seed_rows("dim_renewal_stages"))


def aligned(spark, sf_dir):
    """Both sides over the stand-in window: one row per metric and owner."""
    m, metrics = Models.of(spark, sf_dir), metric_definitions()
    buckets = [d.id.split(".", 1)[1] for d in metrics[len(RC.BASE_METRICS):]]
    return RC.aligned_sides(m.cash, m.won_fct, m.meetings_fct, m.snapshot, m.other_deals, m.other_meetings, m.closers, metrics,
                            S.WINDOW[0].isoformat(), S.WINDOW[1].isoformat(), snapshot_cols=buckets)


@register("j15_align", sql("SELECT metric_id, owner_id, a_value, b_value FROM aligned"))
def j15_align(spark, sf_dir):
    return aligned(spark, sf_dir)


# ---------------------------------------------------------------- A


@register("a1_contact_agg", sql("SELECT deal_id, contact_true_renewal_close_date FROM stg_deal_contacts"))
def a1_contact_agg(spark, sf_dir):
    return Models.of(spark, sf_dir).contact_flags.select("deal_id", "contact_true_renewal_close_date")


@register("a2_cash_agg", sql("FROM owner_cash"))
def a2_cash_agg(spark, sf_dir):
    return R.cash_agg(Models.of(spark, sf_dir).cash, S.AS_OF)


@register("a3_deals_agg", sql("FROM owner_deals"))
def a3_deals_agg(spark, sf_dir):
    return R.deals_agg(Models.of(spark, sf_dir).won, S.AS_OF)


@register("a4_meetings_agg", sql("FROM owner_calls"))
def a4_meetings_agg(spark, sf_dir):
    return R.meetings_agg(Models.of(spark, sf_dir).meetings_fct, S.AS_OF)


@register("a5_total_cash", sql(f"SELECT closer_owner_id, SUM(cash_amount) AS total_cash FROM fct_cash "
                               f"WHERE cash_date_et {WIN} GROUP BY 1"))
def a5_total_cash(spark, sf_dir):
    return A.total_cash(Models.of(spark, sf_dir).cash, *S.WINDOW)


@register("a6_deals_won", sql(f"SELECT closer_owner_id, count(*) AS deals_won, count_if(is_post_webinar_close) AS pwc_deals_won "
                              f"FROM fct_won WHERE close_date_et {WIN} GROUP BY 1"))
def a6_deals_won(spark, sf_dir):
    return A.deals_won(Models.of(spark, sf_dir).won_fct, *S.WINDOW)


@register("a7_call_outcomes", sql(
    "SELECT closer_owner_id, count_if(meeting_category = 'PC') AS pc_invited, "
    "count_if(meeting_category = 'PC' AND is_booked) AS pc_booked, count_if(meeting_category = 'PC' AND is_completed) AS pc_completed, "
    "count_if(meeting_category = 'RC') AS rc_invited, count_if(meeting_category = 'RC' AND is_booked) AS rc_booked, "
    "count_if(meeting_category = 'RC' AND is_completed) AS rc_completed, "
    f"count_if(meeting_category = 'PWC' AND is_completed) AS pwc_completed FROM fct_meetings WHERE meeting_date_et {WIN} GROUP BY 1"))
def a7_call_outcomes(spark, sf_dir):
    return A.call_outcomes(Models.of(spark, sf_dir).meetings_fct, *S.WINDOW)


@register("a8_completed", sql(
    "SELECT closer_owner_id, " + ", ".join(
        f"count_if(meeting_category = '{c}' AND is_completed) AS {c.lower()}_completed" for c in ("PC", "RC", "PWC", "WB"))
    + f" FROM fct_meetings WHERE meeting_date_et {WIN} GROUP BY 1"))
def a8_completed(spark, sf_dir):
    return A.completed_counts(Models.of(spark, sf_dir).meetings_fct, *S.WINDOW)


@register("a9_cash_by_product", sql(
    "SELECT closer_owner_id, " + ", ".join(
        f"SUM(CASE WHEN product_column = '{p}' THEN cash_amount ELSE 0.0 END) AS {p.lower()}" for p in C.PRODUCT_COLUMNS)
    + f", SUM(cash_amount) AS total_cash FROM fct_cash WHERE cash_date_et {WIN} GROUP BY 1"))
def a9_cash_by_product(spark, sf_dir):
    return A.cash_by_product(Models.of(spark, sf_dir).cash, *S.WINDOW)


@register("a10_cash_by_origin", sql(f"SELECT closer_owner_id, tier_of_origin_column, SUM(cash_amount) AS cash FROM fct_cash "
                                    f"WHERE cash_date_et {WIN} GROUP BY 1, 2"))
def a10_cash_by_origin(spark, sf_dir):
    return A.cash_by_origin(Models.of(spark, sf_dir).cash, *S.WINDOW)


@register("a11_snapshot_counts", sql(
    "SELECT closer_owner_id, " + ", ".join(f"count_if(snapshot_col = '{c}') AS {c}" for c in C.SNAPSHOT_COLS)
    + ", count(*) AS total FROM fct_snapshot GROUP BY 1"))
def a11_snapshot_counts(spark, sf_dir):
    return A.snapshot_counts(Models.of(spark, sf_dir).snapshot)


@register("a12_snapshot_metrics", sql(
    "SELECT 'pipeline_snapshot.' || s.snapshot_col AS metric_id, s.snapshot_col, CAST(COALESCE(x.deals, 0) AS BIGINT) AS value "
    "FROM (SELECT DISTINCT snapshot_col FROM stages) s "
    "LEFT JOIN (SELECT snapshot_col, count(*) AS deals FROM fct_snapshot GROUP BY 1) x ON s.snapshot_col = x.snapshot_col"))
def a12_snapshot_metrics(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return A.snapshot_metrics(m.snapshot, m.stages)


@register("a13_stage_entry_counts", sql(
    "SELECT closer_owner_id, count_if(stage_entry_type = 'pc_invited') AS pc_invited, "
    "count_if(stage_entry_type = 'pc_scheduled') AS pc_booked, count_if(stage_entry_type = 'rc_invited') AS rc_invited, "
    f"count_if(stage_entry_type = 'rc_scheduled') AS rc_booked FROM fct_stage_entries WHERE entry_date_et {WIN} GROUP BY 1"))
def a13_stage_entry_counts(spark, sf_dir):
    return A.stage_entry_counts(Models.of(spark, sf_dir).entries, *S.WINDOW)


@register("a14_pwc_deals_won", sql(f"SELECT closer_owner_id, count_if(is_post_webinar_close) AS pwc_deals_won FROM fct_won "
                                   f"WHERE close_date_et {WIN} GROUP BY 1"))
def a14_pwc_deals_won(spark, sf_dir):
    return A.pwc_deals_won(Models.of(spark, sf_dir).won_fct, *S.WINDOW)


@register("a15_stage_bucket_count", sql("SELECT closer_owner_id, count(*) AS wb_booked FROM fct_snapshot "
                                        "WHERE snapshot_col = 'wb_booked' GROUP BY 1"))
def a15_stage_bucket_count(spark, sf_dir):
    return A.stage_bucket_count(Models.of(spark, sf_dir).snapshot, "wb_booked")


def _components_sql() -> str:
    return " + ".join(
        f"(CASE WHEN {a} IS NOT NULL AND CAST({d} AS DATE) BETWEEN DATE '{W_START}' AND DATE '{W_END}' THEN {a} ELSE 0.0 END)"
        for a, d in RC.CASH_COMPONENTS_OTHER)


_WON_BASE_SQL = f"pipeline IN ({lst(RC.TRACKED_PIPELINES)}) AND dealstage IN ({lst(RC.WON_STAGES_ALL)})"


@register("a16_sum_dated_components", sql(
    f"SELECT COALESCE(SUM({_components_sql()}), 0.0) AS value, count(*) AS matched FROM other_deals WHERE {_WON_BASE_SQL}"))
def a16_sum_dated_components(spark, sf_dir):
    spec = next(m for m in RC.BASE_METRICS if m.id == "total_cash")
    return RC.sum_dated_components(Models.of(spark, sf_dir).other_deals, spec.filters, spec.components,
                                   S.WINDOW[0].isoformat(), S.WINDOW[1].isoformat())


@register("a17_count_matching", sql(
    f"SELECT CAST(count(*) AS DOUBLE) AS value FROM other_deals WHERE {_WON_BASE_SQL} "
    f"AND CAST(upsell___close_date AS DATE) {WIN}"))
def a17_count_matching(spark, sf_dir):
    spec = next(m for m in RC.BASE_METRICS if m.id == "deals_won")
    return RC.count_matching(Models.of(spark, sf_dir).other_deals, spec.filters, S.WINDOW[0].isoformat(),
                             S.WINDOW[1].isoformat())


@register("a18_team_total", sql(
    "SELECT SUM(cash_mtd) AS cash_mtd, SUM(cash_today) AS cash_today, SUM(cash_today_vs_yesterday) AS cash_today_vs_yesterday, "
    "CAST(SUM(deals_won_mtd) AS BIGINT) AS deals_won_mtd, CAST(SUM(deals_today) AS BIGINT) AS deals_today, "
    "CAST(SUM(live_meetings_mtd) AS BIGINT) AS live_meetings_mtd FROM rpt"))
def a18_team_total(spark, sf_dir):
    r = Models.of(spark, sf_dir).report()
    return A.team_total(r, ["cash_mtd", "cash_today", "cash_today_vs_yesterday", "deals_won_mtd", "deals_today",
                            "live_meetings_mtd"])


@register("a19_pooled_ratio", sql(
    "SELECT CAST(SUM(pc_booked) AS BIGINT) AS pc_booked, CAST(SUM(pc_invited) AS BIGINT) AS pc_invited, "
    f"{safe_pct('SUM(pc_booked)', 'SUM(pc_invited)')} AS pc_book_pct FROM ("
    "SELECT closer_owner_id, count_if(meeting_category = 'PC') AS pc_invited, "
    "count_if(meeting_category = 'PC' AND is_booked) AS pc_booked "
    f"FROM fct_meetings WHERE meeting_date_et {WIN} GROUP BY 1)"))
def a19_pooled_ratio(spark, sf_dir):
    co = A.call_outcomes(Models.of(spark, sf_dir).meetings_fct, *S.WINDOW)
    return A.pooled_ratio(co, "pc_booked", "pc_invited", "pc_book_pct")


@register("a20_having_count_if", sql("""SELECT closer_owner_id, meeting_category, n AS meetings, booked
  FROM (SELECT closer_owner_id, meeting_category, count(*) AS n, count(*) FILTER (is_booked) AS booked FROM fct_meetings GROUP BY ALL)
  WHERE booked <> n"""))
def a20_having_count_if(spark, sf_dir):
    """Groups whose conditional count differs from what it should be: not every meeting booked."""
    return Q.groups_where(Models.of(spark, sf_dir).meetings_fct, ["closer_owner_id", "meeting_category"], F.col("is_booked"),
                          lambda n, hits: hits != n, n="meetings", hits="booked")


@register("a21_on_fire", sql(
    "SELECT closer_owner_id, closer_name, deals_today, cash_today FROM rpt WHERE cash_today > 0 "
    "ORDER BY cash_today DESC, closer_owner_id LIMIT 1"))
def a21_on_fire(spark, sf_dir):
    return A.on_fire(Models.of(spark, sf_dir).report())


_TD, _YD = f"DATE '{TODAY_CALLS_AS_OF.isoformat()}'", f"DATE '{(TODAY_CALLS_AS_OF - _dt.timedelta(days=1)).isoformat()}'"


@register("a22_today_calls", sql(
    f"SELECT closer_owner_id, ct AS closing_calls_today, cy AS closing_calls_yesterday, mt AS midway_calls_today, "
    f"my AS midway_calls_yesterday, ct - cy AS closing_calls_vs_yesterday, mt - my AS midway_calls_vs_yesterday FROM ("
    f"SELECT closer_owner_id, count_if(is_closing_call AND meeting_date_et = {_TD}) AS ct, "
    f"count_if(is_closing_call AND meeting_date_et = {_YD}) AS cy, "
    f"count_if(meeting_category = 'PC' AND is_completed AND meeting_date_et = {_TD}) AS mt, "
    f"count_if(meeting_category = 'PC' AND is_completed AND meeting_date_et = {_YD}) AS my "
    f"FROM fct_meetings WHERE meeting_date_et BETWEEN {_YD} AND {_TD} GROUP BY 1)"))
def a22_today_calls(spark, sf_dir):
    return A.today_calls(Models.of(spark, sf_dir).meetings_fct, TODAY_CALLS_AS_OF)


@register("a23_assigned_deals", sql(
    f"SELECT d.closer_owner_id, count(*) AS assigned_deals FROM stg_deals d JOIN closers c ON d.closer_owner_id = c.owner_id "
    f"WHERE d.pipeline_id IN ({lst(C.PipelineConfig().renewal_pipeline_ids)}) GROUP BY 1"))
def a23_assigned_deals(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return A.assigned_deals(m.deals, m.closers)


# ---------------------------------------------------------------- W, T


@register("w1_one_deal_per_meeting", sql("SELECT meeting_id, deal_id FROM stg_meeting_deals"))
def w1_one_deal_per_meeting(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return ST.one_deal_per_meeting(m.raw_engagement_deal, m.deals, m.cfg)


@register("w2_first_call", sql(
    "SELECT meeting_id, deal_id, meeting_category, is_first_call FROM int_meetings "
    "WHERE is_completed AND meeting_category IN ('RC', 'PWC', 'WB') AND deal_id IS NOT NULL"))
def w2_first_call(spark, sf_dir):
    mt = Models.of(spark, sf_dir).meetings
    return mt.filter(F.col("is_completed") & F.col("meeting_category").isin("RC", "PWC", "WB")
                     & F.col("deal_id").isNotNull()).select("meeting_id", "deal_id", "meeting_category", "is_first_call")


def _board(spark, sf_dir):
    return base(Models.of(spark, sf_dir)).select("closer_owner_id", "total_cash")


@register("w3_rank_closers", sql(
    "SELECT closer_owner_id, total_cash, RANK() OVER (ORDER BY total_cash DESC NULLS LAST) AS rank, "
    "ROW_NUMBER() OVER (ORDER BY total_cash DESC NULLS LAST, closer_owner_id) AS position FROM bm"))
def w3_rank_closers(spark, sf_dir):
    r = R.rank_closers(_board(spark, sf_dir), "total_cash")
    return r.withColumn("rank", F.col("rank").cast("long")).withColumn("position", F.col("position").cast("long"))


@register("w4_gap_to_next", sql(
    "SELECT closer_owner_id, deals_won_mtd, gap AS gap_to_next, CASE WHEN gap = 0 THEN 'tied' WHEN gap IS NULL THEN 'leader' "
    "ELSE 'behind' END AS gap_label FROM (SELECT closer_owner_id, deals_won_mtd, "
    "lag(deals_won_mtd) OVER (ORDER BY deals_won_mtd DESC NULLS LAST, closer_owner_id) - deals_won_mtd AS gap FROM rpt)"))
def w4_gap_to_next(spark, sf_dir):
    """Over a count, so that closers tie."""
    return R.gap_to_next(Models.of(spark, sf_dir).report().select("closer_owner_id", "deals_won_mtd"), "deals_won_mtd")


@register("w5_share_of_leader", sql(
    "SELECT closer_owner_id, total_cash, total_cash / NULLIF(max(total_cash) OVER (), 0) AS share_of_leader FROM bm"))
def w5_share_of_leader(spark, sf_dir):
    return R.share_of_leader(_board(spark, sf_dir), "total_cash")


@register("t1_leaderboard", sql("SELECT closer_owner_id, total_cash FROM bm ORDER BY total_cash DESC, closer_owner_id"))
def t1_leaderboard(spark, sf_dir):
    return R.leaderboard(_board(spark, sf_dir), "total_cash")


@register("t2_top_closer", sql(
    "SELECT closer_owner_id, closer_name, cash_mtd FROM rpt WHERE cash_mtd > 0 ORDER BY cash_mtd DESC, closer_owner_id LIMIT 1"))
def t2_top_closer(spark, sf_dir):
    return A.top_closer(Models.of(spark, sf_dir).report(), "cash_mtd", 0, cols=("closer_owner_id", "closer_name"))


# ---------------------------------------------------------------- K

_K = {
    "k1_pc_book": ("pc_booked", "pc_invited", "pc_book_pct"),
    "k2_pc_show": ("pc_completed", "pc_booked", "pc_show_pct"),
    "k3_pc_close": ("deals_won", "pc_completed", "pc_close_pct"),
    "k4_rc_book": ("rc_booked", "rc_invited", "rc_book_pct"),
    "k5_rc_show": ("rc_completed", "rc_booked", "rc_show_pct"),
    "k6_rc_close": ("deals_won", "rc_completed", "rc_close_pct"),
    "k7_pwc_close": ("pwc_deals_won", "pwc_completed", "pwc_close_pct"),
    "k8_wb_book": ("wb_booked", "wb_invited", "wb_book_pct"),
}


def _make_k(name, cols):
    @register(name, sql(f"SELECT closer_owner_id, {', '.join(cols)} FROM kpi"))
    def _q(spark, sf_dir):
        return kpis(spark, sf_dir).select("closer_owner_id", *cols)

    _q.__name__ = name
    return _q


for _name, _cols in _K.items():
    _make_k(_name, _cols)


@register("k9_live_close_pct", sql(
    "SELECT closer_owner_id, deals_won, rc_completed, pwc_completed, wb_completed, live_close_pct FROM kpi"))
def k9_live_close_pct(spark, sf_dir):
    return kpis(spark, sf_dir).select("closer_owner_id", "deals_won", "rc_completed", "pwc_completed", "wb_completed",
                                      "live_close_pct")


@register("k10_avg_dpl", sql("SELECT closer_owner_id, total_cash, avg_dpl FROM kpi"))
def k10_avg_dpl(spark, sf_dir):
    return kpis(spark, sf_dir).select("closer_owner_id", "total_cash", "avg_dpl")


@register("k11_first_call_variants", sql(
    "SELECT closer_owner_id, rc_completed, pwc_completed, wb_completed, live_close_pct, avg_dpl FROM kpi_first"))
def k11_first_call_variants(spark, sf_dir):
    return kpis(spark, sf_dir, first_only=True).select("closer_owner_id", "rc_completed", "pwc_completed",
                                                       "wb_completed", "live_close_pct", "avg_dpl")


@register("k12_vs_prior_mtd", sql(
    "SELECT closer_owner_id, cash_vs_prior_mtd, deals_vs_prior_mtd, cash_today_vs_yesterday FROM rpt"))
def k12_vs_prior_mtd(spark, sf_dir):
    return Models.of(spark, sf_dir).report().select("closer_owner_id", "cash_vs_prior_mtd", "deals_vs_prior_mtd",
                                                 "cash_today_vs_yesterday")


_n = (S.WINDOW[1] - S.WINDOW[0]).days + 1
_pe = S.WINDOW[0] - _dt.timedelta(days=1)
_PS, _PE = f"DATE '{(_pe - _dt.timedelta(days=_n - 1)).isoformat()}'", f"DATE '{_pe.isoformat()}'"


@register("k13_cash_vs_prior_window", sql(
    f"SELECT closer_owner_id, cash_window, cash_prior_window, cash_window - cash_prior_window AS cash_vs_prior FROM ("
    f"SELECT closer_owner_id, SUM(CASE WHEN cash_date_et {WIN} THEN cash_amount ELSE 0.0 END) AS cash_window, "
    f"SUM(CASE WHEN cash_date_et BETWEEN {_PS} AND {_PE} THEN cash_amount ELSE 0.0 END) AS cash_prior_window "
    f"FROM fct_cash WHERE cash_date_et BETWEEN {_PS} AND DATE '{W_END}' GROUP BY 1)"))
def k13_cash_vs_prior_window(spark, sf_dir):
    return A.cash_vs_prior_window(Models.of(spark, sf_dir).cash, *S.WINDOW)


@register("k14_close_pct_assigned", sql(
    f"SELECT a.closer_owner_id, a.assigned_deals, COALESCE(w.deals_won, 0) AS deals_won, "
    f"{safe_pct('COALESCE(w.deals_won, 0)', 'a.assigned_deals')} AS close_pct_assigned FROM ("
    f"SELECT d.closer_owner_id, count(*) AS assigned_deals FROM stg_deals d JOIN closers c ON d.closer_owner_id = c.owner_id "
    f"WHERE d.pipeline_id IN ({lst(C.PipelineConfig().renewal_pipeline_ids)}) GROUP BY 1) a "
    f"LEFT JOIN (SELECT closer_owner_id, count(*) AS deals_won FROM fct_won WHERE close_date_et {WIN} GROUP BY 1) w "
    "ON a.closer_owner_id = w.closer_owner_id"))
def k14_close_pct_assigned(spark, sf_dir):
    from dealflow.functions.ratios import safe_pct as spct

    m = Models.of(spark, sf_dir)
    a = A.assigned_deals(m.deals, m.closers)
    w = A.deals_won(m.won_fct, *S.WINDOW).select("closer_owner_id", "deals_won")
    j = a.join(w, "closer_owner_id", "left").fillna(0, subset=["deals_won"])
    return j.select("closer_owner_id", "assigned_deals", "deals_won",
                    spct("deals_won", "assigned_deals").alias("close_pct_assigned"))


@register("k15_change_vs_prior", sql(
    "SELECT closer_owner_id, live_close_pct - live_close_pct_prior_mtd AS live_close_pct_change, "
    "avg_dpl - avg_dpl_prior_mtd AS avg_dpl_change FROM rpt"))
def k15_change_vs_prior(spark, sf_dir):
    return Models.of(spark, sf_dir).report(extended=True).select("closer_owner_id", "live_close_pct_change", "avg_dpl_change")


# ---------------------------------------------------------------- B


def _bucket_sql() -> str:
    whens = []
    for r in B.DEFAULT_RULES:
        conds = []
        for vals, col in ((r.products, "renewal_product"), (r.year_counts, "renewal_year_count"),
                          (r.categories, "orig_product_category"), (r.pipeline_types, "renewal_pipeline_type")):
            if vals:
                conds.append(f"{col} IN ({lst(vals)})")
        whens.append(f"WHEN COALESCE({' AND '.join(conds)}, FALSE) THEN '{r.bucket}'")
    return "CASE " + " ".join(whens) + " END"


@register("b1_classify", sql(f"SELECT deal_id, cash_component, {_bucket_sql()} AS product_bucket FROM fct_cash"))
def b1_classify(spark, sf_dir):
    return B.classify(Models.of(spark, sf_dir).cash).select("deal_id", "cash_component", "product_bucket")


@register("b2_bucket_pivot", sql(
    "SELECT closer_owner_id, " + ", ".join(
        f"SUM(CASE WHEN product_bucket = '{b}' THEN cash_amount ELSE 0.0 END) AS {b.lower()}" for b in B.BUCKETS)
    + ", SUM(CASE WHEN product_bucket IS NOT NULL THEN cash_amount ELSE 0.0 END) AS bucketed_cash, "
    f"SUM(cash_amount) AS total_cash FROM (SELECT *, {_bucket_sql()} AS product_bucket FROM fct_cash) GROUP BY 1"))
def b2_bucket_pivot(spark, sf_dir):
    return B.bucket_pivot(B.classify(Models.of(spark, sf_dir).cash))

