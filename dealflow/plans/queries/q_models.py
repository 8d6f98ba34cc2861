"""Composite models M1-M13 and the reshaping operators U1-U4."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealflow.operators import models as M
from dealflow.plans.context import Models
from dealflow.plans.oracle import RPT_BASE_COLS, sql
from dealflow.plans.registry import register

STG_DEAL_COLS = (
    "deal_id, closer_owner_id, pipeline_id, dealstage_id, close_date, close_date_fallback, cash_collected, "
    "ap1_amount, ap1_stamped_at, ap2_amount, ap2_stamped_at, ap3_amount, ap3_stamped_at, ap4_amount, ap4_stamped_at, "
    "ap11_amount, ap11_stamped_at, ap12_amount, ap12_stamped_at, renewal_year_count, orig_product_category, "
    "upsell_plan, renewal_product_pitched, active_product_snapshot_at_won, renewal_traffic_source, "
    "date_entered_pc_invited, date_entered_pc_scheduled, date_entered_rc_invited, date_entered_rc_scheduled, "
    "date_entered_current_stage, membership_expiration_date, renewal_product, renewal_pipeline_type")


@register("m1_deals", sql(f"SELECT {STG_DEAL_COLS} FROM stg_deals"))
def m1_deals(spark, sf_dir):
    return Models.of(spark, sf_dir).deals


@register("m2_meetings_staging", sql("SELECT * FROM stg_meetings"))
def m2_meetings_staging(spark, sf_dir):
    return Models.of(spark, sf_dir).stg_meetings


@register("m3_meeting_deals", sql("SELECT meeting_id, deal_id FROM stg_meeting_deals"))
def m3_meeting_deals(spark, sf_dir):
    return Models.of(spark, sf_dir).meeting_deals


@register("m4_deal_contacts", sql("SELECT * FROM stg_deal_contacts"))
def m4_deal_contacts(spark, sf_dir):
    return Models.of(spark, sf_dir).contact_flags


@register("m5_won_deals", sql("SELECT * FROM int_won"))
def m5_won_deals(spark, sf_dir):
    return Models.of(spark, sf_dir).won


@register("m6_deal_cash", sql("SELECT * FROM int_cash"))
def m6_deal_cash(spark, sf_dir):
    return Models.of(spark, sf_dir).deal_cash


@register("m7_meetings", sql("SELECT * FROM int_meetings"))
def m7_meetings(spark, sf_dir):
    return Models.of(spark, sf_dir).meetings


@register("m8_cash", sql("SELECT * FROM fct_cash"))
def m8_cash(spark, sf_dir):
    return Models.of(spark, sf_dir).cash


@register("m9_won_deals_fct", sql("SELECT * FROM fct_won"))
def m9_won_deals_fct(spark, sf_dir):
    return Models.of(spark, sf_dir).won_fct


@register("m10_meetings_fct", sql("SELECT * FROM fct_meetings"))
def m10_meetings_fct(spark, sf_dir):
    return Models.of(spark, sf_dir).meetings_fct


@register("m11_stage_entries", sql("SELECT * FROM fct_stage_entries"))
def m11_stage_entries(spark, sf_dir):
    return Models.of(spark, sf_dir).entries


@register("m12_pipeline_snapshot", sql("SELECT * FROM fct_snapshot"))
def m12_pipeline_snapshot(spark, sf_dir):
    return Models.of(spark, sf_dir).snapshot


@register("m13_closer_report", sql(f"SELECT {RPT_BASE_COLS} FROM rpt"))
def m13_closer_report(spark, sf_dir):
    return Models.of(spark, sf_dir).report()


# ---------------------------------------------------------------- U1-U4


@register("u1_unpivot_components", sql("SELECT * FROM int_cash"))
def u1_unpivot_components(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.unpivot_components(m.won, cfg=m.cfg)


@register("u2_unpivot_entries", sql(
    "SELECT deal_id, closer_owner_id, stage_entry_type, entry_date_et FROM ("
    + " UNION ALL ".join(
        f"SELECT deal_id, closer_owner_id, '{e}' AS stage_entry_type, "
        f"CAST(((date_entered_{e}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS entry_date_et "
        f"FROM stg_deals WHERE date_entered_{e} IS NOT NULL"
        for e in ("pc_invited", "pc_scheduled", "rc_invited", "rc_scheduled")) + ")"))
def u2_unpivot_entries(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return M.unpivot_entries(m.deals, m.cfg)


@register("u3_pipeline_snapshot", sql(
    "SELECT snapshot_col, count(*) AS deals, count(DISTINCT deal_id) AS distinct_deals FROM fct_snapshot GROUP BY 1"))
def u3_pipeline_snapshot(spark, sf_dir):
    """One bucket per deal: bucket sizes and distinct deals per bucket agree."""
    s = Models.of(spark, sf_dir).snapshot
    return s.groupBy("snapshot_col").agg(F.count(F.lit(1)).alias("deals"),
                                         F.countDistinct("deal_id").alias("distinct_deals"))
