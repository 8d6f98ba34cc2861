"""S1-S11 (scans, dimensions, sinks) and P1-P18 (projections, filters, predicates)."""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.functions import dates as D
from dealflow.functions import flags as FL
from dealflow.operators import models as M
from dealflow.operators import reconcile as RC
from dealflow.plans import standins as S
from dealflow.plans.context import Models
from dealflow.plans.oracle import AS_OF, W_END, W_START, et, live, lst, sql
from dealflow.plans.registry import register
from dealflow.session import ensure_checkpoint_dir
from dealflow.sources import dims, scans

def scratch(spark, tag: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local on a
    cluster: the checkpoint dir is the cluster's shared folder)."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- S


@register("s1_live_rows", sql(f"SELECT deal_id, owner_id FROM raw_deal WHERE {live()}"))
def s1_live_rows(spark, sf_dir):
    return scans.live_rows(Models.of(spark, sf_dir).raw_deal).select("deal_id", "owner_id")


@register("s2_optional_col", sql(
    "SELECT deal_id, property_collected_amount_additional_payment_11 AS ap11_amount, "
    "CAST(NULL AS DOUBLE) AS ap13_amount FROM raw_deal"))
def s2_optional_col(spark, sf_dir):
    raw = Models.of(spark, sf_dir).raw_deal
    return raw.select("deal_id",
                      scans.optional_col(raw, "PROPERTY_COLLECTED_AMOUNT_ADDITIONAL_PAYMENT_11", "double").alias("ap11_amount"),
                      scans.optional_col(raw, "property_collected_amount_additional_payment_13", "double").alias("ap13_amount"))


@register("s3_load_dim", sql(
    "SELECT s.stage_label, s.snapshot_col, count(*) AS deals FROM stg_deals d JOIN stages s ON d.dealstage_id = s.stage_id "
    "GROUP BY 1, 2"))
def s3_load_dim(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    st = dims.load_dim(spark, "dim_renewal_stages")
    return (m.deals.join(F.broadcast(st), m.deals["dealstage_id"] == st["stage_id"])
            .groupBy("stage_label", "snapshot_col").agg(F.count(F.lit(1)).alias("deals")))


@register("s4_targets", sql(
    "SELECT t.*, c.owner_id FROM targets t LEFT JOIN closers c ON t.closer_name = c.closer_name"))
def s4_targets(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    scans.publish(m.targets, "dim_renewal_targets", "view")
    t = dims.targets(spark, "dim_renewal_targets")
    return t.join(m.closers, "closer_name", "left")


@register("s5_assoc", sql("SELECT engagement_id AS meeting_id, deal_id FROM raw_engagement_deal"))
def s5_assoc(spark, sf_dir):
    return scans.assoc(Models.of(spark, sf_dir).raw_engagement_deal, "engagement_id", "deal_id", "meeting_id")


_landed = ("raw_deal", "raw_meeting", "raw_engagement_deal", "raw_deal_contact", "raw_contact")
_loads = " UNION ALL ".join(f"SELECT '{t}' AS source, max(_fivetran_synced) AS max_loaded_at FROM {t}" for t in _landed)


@register("s6_freshness", sql(
    f"SELECT source, max_loaded_at, round(hours, 2) AS age_hours, CASE WHEN hours <= 4 THEN 'pass' WHEN hours <= 8 THEN 'warn' ELSE 'error' END AS status "
    f"FROM (SELECT *, epoch(TIMESTAMP '{S.LOOKED_AT}' - max_loaded_at) / 3600 AS hours FROM ({_loads}))"))
def s6_freshness(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return scans.freshness({t: getattr(m, t) for t in _landed}, S.LOOKED_AT)


@register("s7_publish", sql("SELECT * FROM fct_won"))
def s7_publish(spark, sf_dir):
    return scans.publish(Models.of(spark, sf_dir).won_fct, "fct_renewal_won_deals", "view")


def _report_rows(spark, sf_dir):
    from dealflow.plans.queries.q_quality_reconcile import reconcile_report

    return reconcile_report(spark, sf_dir)


_REPORT = "r.metric_id, r.metric_name, r.owner_id, r.verdict, r.a_value, r.b_value, r.detail"


@register("s8_report_csv", sql(f"SELECT {_REPORT}, array_to_string(t.refs, ';') AS formula_refs FROM rec r JOIN report_lists t USING (metric_id)"))
def s8_report_csv(spark, sf_dir):
    path = scratch(spark, "report-csv")
    scans.write_report(RC.assert_no_pii(_report_rows(spark, sf_dir)), path, "csv")
    return scans.read_report(spark, path, "csv")


@register("s9_report_json", sql(f"SELECT {_REPORT}, t.refs AS formula_refs, t.caveats FROM rec r JOIN report_lists t USING (metric_id)"))
def s9_report_json(spark, sf_dir):
    path = scratch(spark, "report-json")
    scans.write_report(RC.assert_no_pii(_report_rows(spark, sf_dir)), path, "json")
    return scans.read_report(spark, path, "json")


@register("s10_other_side", sql("SELECT id, pipeline, dealstage, hubspot_owner_id FROM other_deals"))
def s10_other_side(spark, sf_dir):
    return scans.other_side(Models.of(spark, sf_dir).other_deals, ["pipeline", "dealstage", "hubspot_owner_id"])


@register("s11_scalar_metric", sql(
    f"SELECT CAST(count(*) AS DOUBLE) AS value FROM fct_won WHERE close_date_et BETWEEN DATE '{W_START}' AND DATE '{W_END}'"))
def s11_scalar_metric(spark, sf_dir):
    from dealflow.operators.metrics import in_window

    won = Models.of(spark, sf_dir).won_fct
    return scans.scalar_metric(won.filter(in_window("close_date_et", *S.WINDOW)), F.count(F.lit(1)).cast("double"))


# ---------------------------------------------------------------- P


@register("p1_stage_deals", sql(
    "SELECT deal_id, closer_owner_id, pipeline_id, dealstage_id, close_date, cash_collected FROM stg_deals"))
def p1_stage_deals(spark, sf_dir):
    return Models.of(spark, sf_dir).deals.select("deal_id", "closer_owner_id", "pipeline_id", "dealstage_id", "close_date",
                                              "cash_collected")


@register("p2_stage_meetings", sql("SELECT meeting_id, owner_id, activity_type FROM stg_meetings"))
def p2_stage_meetings(spark, sf_dir):
    return Models.of(spark, sf_dir).stg_meetings.select("meeting_id", "owner_id", "activity_type")


@register("p3_pick_by_pipeline", sql(
    "SELECT deal_id, pipeline_id, date_entered_pc_invited, date_entered_pc_scheduled, date_entered_rc_invited, "
    "date_entered_rc_scheduled FROM stg_deals"))
def p3_pick_by_pipeline(spark, sf_dir):
    return Models.of(spark, sf_dir).deals.select("deal_id", "pipeline_id", "date_entered_pc_invited",
                                              "date_entered_pc_scheduled", "date_entered_rc_invited",
                                              "date_entered_rc_scheduled")


_won_pred = (f"(pipeline_id IN ({lst(C.PipelineConfig().renewal_pipeline_ids)}) AND dealstage_id IN ({lst(C.WON_STAGE_IDS)})) "
             f"OR (pipeline_id = '{C.WINBACK_PIPELINE_ID}' AND dealstage_id IN ({lst(C.WINBACK_WON_STAGE_IDS)}))")


@register("p4_won_filter", sql(
    f"SELECT pipeline_id, dealstage_id, count(*) AS deals FROM stg_deals WHERE {_won_pred} GROUP BY 1, 2"))
def p4_won_filter(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    return d.filter(M.won_filter()).groupBy("pipeline_id", "dealstage_id").agg(F.count(F.lit(1)).alias("deals"))


@register("p5_in_pipelines", sql(
    f"SELECT deal_id, pipeline_id FROM stg_deals WHERE pipeline_id IN ({lst(C.PipelineConfig().renewal_pipeline_ids)})"))
def p5_in_pipelines(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    return M.in_pipelines(d, C.PipelineConfig().renewal_pipeline_ids).select("deal_id", "pipeline_id")


@register("p6_exclude_flagged", sql(
    "SELECT d.deal_id FROM stg_deals d LEFT JOIN stg_deal_contacts tc ON d.deal_id = tc.deal_id "
    "WHERE COALESCE(tc.is_test_contact, FALSE) = FALSE"))
def p6_exclude_flagged(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.exclude_flagged(m.deals, m.contact_flags).select("deal_id")


_cat_sql = (f"CASE WHEN activity_type IN ({lst(C.PC_ACTIVITY_TYPES)}) THEN 'PC' WHEN activity_type IN ({lst(C.RC_ACTIVITY_TYPES)}) "
            f"THEN 'RC' WHEN activity_type IN ({lst(C.PWC_ACTIVITY_TYPES)}) THEN 'PWC' "
            f"WHEN activity_type IN ({lst(C.WB_ACTIVITY_TYPES)}) THEN 'WB' END")


@register("p7_categorize", sql(f"SELECT meeting_id, activity_type, {_cat_sql} AS meeting_category FROM stg_meetings"))
def p7_categorize(spark, sf_dir):
    m = Models.of(spark, sf_dir).stg_meetings
    return m.select("meeting_id", "activity_type", FL.categorize("activity_type").alias("meeting_category"))


@register("p8_is_booked", sql(
    f"SELECT meeting_id, meeting_outcome, (meeting_outcome IS NOT NULL AND meeting_outcome NOT IN ({lst(C.CANCELED_OUTCOMES)})) "
    "AS is_booked FROM stg_meetings"))
def p8_is_booked(spark, sf_dir):
    m = Models.of(spark, sf_dir).stg_meetings
    return m.select("meeting_id", "meeting_outcome", FL.is_booked("meeting_outcome").alias("is_booked"))


@register("p9_is_completed", sql("SELECT meeting_id, (meeting_outcome = 'COMPLETED') AS is_completed FROM stg_meetings"))
def p9_is_completed(spark, sf_dir):
    m = Models.of(spark, sf_dir).stg_meetings
    return m.select("meeting_id", FL.is_completed("meeting_outcome").alias("is_completed"))


@register("p10_is_closing_call", sql(
    f"SELECT meeting_id, (({_cat_sql}) IN ('RC', 'PWC', 'WB') AND meeting_outcome = 'COMPLETED' "
    "AND COALESCE(activity_type, '') <> 'Renewal Follow-up') AS is_closing_call FROM stg_meetings"))
def p10_is_closing_call(spark, sf_dir):
    m = Models.of(spark, sf_dir).stg_meetings
    return m.select("meeting_id", FL.is_closing_call(FL.categorize("activity_type"), FL.is_completed("meeting_outcome"),
                                                     "activity_type").alias("is_closing_call"))


@register("p11_null_safe_flag", sql(
    "SELECT deal_id, renewal_traffic_source, COALESCE(renewal_traffic_source = 'Webinar', FALSE) AS is_post_webinar_close "
    "FROM stg_deals"))
def p11_null_safe_flag(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    return d.select("deal_id", "renewal_traffic_source",
                    FL.null_safe_flag("renewal_traffic_source", C.WEBINAR_TRAFFIC_SOURCE).alias("is_post_webinar_close"))


_comp_rows = [("base", "cash_collected", "close_date_et")] + [
    (c.name, c.amount_col, f"CAST({c.date_col} AS DATE)") for c in C.DEFAULT_COMPONENTS[1:]]
ALL_COMPONENTS_SQL = " UNION ALL ".join(
    f"SELECT deal_id, '{n}' AS cash_component, {dt} AS cash_date_et, {a} AS cash_amount FROM int_won" for n, a, dt in _comp_rows)


@register("p12_valid_component", sql(
    f"SELECT deal_id, cash_component, cash_date_et, cash_amount, (cash_amount > 0 AND cash_date_et IS NOT NULL) AS is_valid "
    f"FROM ({ALL_COMPONENTS_SQL})"))
def p12_valid_component(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    u = M.unpivot_components(m.won, keep=("deal_id",), cfg=m.cfg, only_valid=False)
    return u.select("deal_id", "cash_component", "cash_date_et", "cash_amount", M.valid_component().alias("is_valid"))


@register("p13_in_window", sql(
    f"SELECT deal_id, cash_component, cash_amount FROM fct_cash WHERE cash_date_et BETWEEN DATE '{W_START}' AND DATE '{W_END}'"))
def p13_in_window(spark, sf_dir):
    from dealflow.operators.metrics import in_window

    c = Models.of(spark, sf_dir).cash
    return c.filter(in_window("cash_date_et", *S.WINDOW)).select("deal_id", "cash_component", "cash_amount")


@register("p14_owner_filter", sql("SELECT deal_id, closer_owner_id FROM fct_won WHERE closer_owner_id = '1'"))
def p14_owner_filter(spark, sf_dir):
    from dealflow.operators.metrics import owner_filter

    return owner_filter(Models.of(spark, sf_dir).won_fct, "1").select("deal_id", "closer_owner_id")


_won_spec_sql = (f"pipeline IN ({lst(RC.TRACKED_PIPELINES)}) AND dealstage IN ({lst(RC.WON_STAGES_ALL)}) "
                 f"AND hubspot_owner_id = '2' AND CAST(upsell___close_date AS DATE) BETWEEN DATE '{W_START}' AND DATE '{W_END}'")


@register("p15_filter_by_spec", sql(f"SELECT id FROM other_deals WHERE {_won_spec_sql}"))
def p15_filter_by_spec(spark, sf_dir):
    deals = Models.of(spark, sf_dir).other_deals
    spec = next(m for m in RC.BASE_METRICS if m.id == "deals_won").filters
    return RC.filter_by_spec(deals, spec, S.WINDOW[0].isoformat(), S.WINDOW[1].isoformat(), "2").select("id")


@register("p16_candidate_stages", sql(
    f"SELECT d.deal_id, d.dealstage_id FROM stg_deals d WHERE d.dealstage_id IN (SELECT stage_id FROM stages "
    f"WHERE pipeline_id = '{C.NEW_RENEWAL_PIPELINE_ID}' AND snapshot_col IN ({lst(C.PRE_RC_SNAPSHOT_COLS)}))"))
def p16_candidate_stages(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    cand = M.candidate_stages(m.stages, C.NEW_RENEWAL_PIPELINE_ID, C.PRE_RC_SNAPSHOT_COLS)
    return m.deals.join(F.broadcast(cand), m.deals["dealstage_id"] == cand["stage_id"], "left_semi").select(
        "deal_id", "dealstage_id")


@register("p17_rc_due", sql(
    f"SELECT deal_id, CAST(membership_expiration_date AS DATE) AS expiration_date_et, "
    f"DATE '{AS_OF}' BETWEEN CAST(membership_expiration_date AS DATE) - {C.RC_DUE_DAYS} AND CAST(membership_expiration_date AS DATE) "
    f"AS is_rc_due FROM stg_deals"))
def p17_rc_due(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    exp = D.date_only("membership_expiration_date")
    return d.select("deal_id", exp.alias("expiration_date_et"), FL.rc_due_pred(S.AS_OF, exp).alias("is_rc_due"))


_start_sql = f"COALESCE(CAST(d.close_date AS DATE), {et('d.close_date_fallback')}, {et('tc.contact_true_renewal_close_date')})"
_mid_sql = f"{_start_sql} + CAST(floor(date_diff('day', {_start_sql}, CAST(d.membership_expiration_date AS DATE)) / 2) AS INTEGER)"


@register("p18_pc_due", sql(
    f"SELECT d.deal_id, {_mid_sql} AS midpoint_et, DATE '{AS_OF}' >= ({_mid_sql}) - {C.PC_DUE_LEAD_DAYS} AS is_pc_due "
    "FROM stg_deals d LEFT JOIN stg_deal_contacts tc ON d.deal_id = tc.deal_id"))
def p18_pc_due(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    d = m.deals.join(m.contact_flags, "deal_id", "left")
    mid = D.midpoint(D.start_date("close_date", "close_date_fallback", "contact_true_renewal_close_date"),
                     D.date_only("membership_expiration_date"))
    return d.select("deal_id", mid.alias("midpoint_et"), FL.pc_due_pred(S.AS_OF, mid).alias("is_pc_due"))

