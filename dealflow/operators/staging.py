"""Staging models (M1-M4) and the projections / windows they use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow.config import DEFAULT, PipelineConfig
from dealflow.sources.scans import assoc as _assoc
from dealflow.sources.scans import live_rows, optional_col

# Raw CRM column -> staged name, per payment component (amount, stamped date).
_PAYMENT_SOURCES = (
    ("ap1", "property_additional_payment_1_amount", "property_additional_payment_1_stamped_date"),
    ("ap2", "property_additional_payment_2_amount", "property_additional_payment_2_stamped_date"),
    ("ap3", "property_collected_amount_additional_payment_3", "property_collected_date_additional_payment_3"),
    ("ap4", "property_collected_amount_additional_payment_4", "property_collected_date_additional_payment_4"),
)
# Payment columns that may not have been landed yet (typed NULL when absent).
_OPTIONAL_PAYMENT_SOURCES = (
    ("ap11", "property_collected_amount_additional_payment_11", "property_collected_date_additional_payment_11"),
    ("ap12", "property_collected_amount_additional_payment_12", "property_collected_date_additional_payment_12"),
)


def pick_by_pipeline(cfg: PipelineConfig, new_col: str, old_col: str,
                     pipeline: Column | None = None) -> Column:
    """Take the column of the deal's *current* pipeline (not COALESCE: the old
    pipeline's stamp is never cleared after a migration and would mask the new one)."""
    p = pipeline if pipeline is not None else F.col("deal_pipeline_id").cast("string")
    return F.when(p == F.lit(cfg.new_pipeline_id), F.col(new_col)).otherwise(F.col(old_col))


def stage_deals(raw: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M1 (S1, S2, P1, P3): one row per live deal with typed, renamed columns."""
    src = live_rows(raw)
    cols = [
        F.col("deal_id").cast("long").alias("deal_id"),
        F.col("owner_id").cast("string").alias("closer_owner_id"),
        F.col("deal_pipeline_id").cast("string").alias("pipeline_id"),
        F.col("deal_pipeline_stage_id").cast("string").alias("dealstage_id"),
        F.col("property_upsell_close_date").alias("close_date"),
        F.col("property_closedate").alias("close_date_fallback"),
        F.col("property_cash_collected").cast("double").alias("cash_collected"),
    ]
    for name, amt, dt in _PAYMENT_SOURCES:
        cols += [F.col(amt).cast("double").alias(f"{name}_amount"), F.col(dt).alias(f"{name}_stamped_at")]
    for name, amt, dt in _OPTIONAL_PAYMENT_SOURCES:
        cols += [optional_col(src, amt, "double").alias(f"{name}_amount"),
                 optional_col(src, dt, "timestamp_ntz").alias(f"{name}_stamped_at")]
    cols += [
        F.col("property_renewal_year_count").alias("renewal_year_count"),
        F.col("property_renewal_product_category_originally_purchased").alias("orig_product_category"),
        F.col("property_upsell_plan").alias("upsell_plan"),
        F.col("property_renewal_product_pitched").alias("renewal_product_pitched"),
        F.col("property_active_product_snapshot_at_won").alias("active_product_snapshot_at_won"),
        F.col("property_renewal_traffic_source").alias("renewal_traffic_source"),
    ]
    pipeline = F.col("deal_pipeline_id").cast("string")
    for entry, new_col, old_col in cfg.stage_entry_sources:
        cols.append(pick_by_pipeline(cfg, new_col, old_col, pipeline).alias(f"date_entered_{entry}"))
    cols += [
        F.col("property_hs_v_2_date_entered_current_stage").alias("date_entered_current_stage"),
        F.col("property_membership_expiration_date").alias("membership_expiration_date"),
    ]
    # Rule-bucket inputs of B1 (specified, optional in the landed table).
    for extra in cfg.extra_deal_columns:
        cols.append(optional_col(src, f"property_{extra}", "string").alias(extra))
    return src.select(cols)


def stage_meetings(raw: DataFrame) -> DataFrame:
    """M2 (S1, P2)."""
    return live_rows(raw).select(
        F.col("engagement_id").cast("long").alias("meeting_id"),
        F.col("property_hubspot_owner_id").cast("string").alias("owner_id"),
        F.col("property_hs_activity_type").alias("activity_type"),
        F.col("property_hs_meeting_outcome").alias("meeting_outcome"),
        F.col("property_hs_meeting_start_time").alias("meeting_start_at"),
    )


def assoc_priority(assoc: DataFrame, deals: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Association rows with the priority of their deal (0 = tracked pipeline)."""
    a = _assoc(assoc, "engagement_id", "deal_id", "meeting_id", "deal_id")
    # Only deals of a tracked pipeline can raise the priority, so only their ids take part
    # in the join (the filter reaches the deal scan; fewer rows cross the shuffle).
    tracked = deals.filter(F.col("pipeline_id").isin(*cfg.tracked_pipeline_ids)).select(
        "deal_id", F.lit(0).alias("_tracked"))
    # A NULL deal has priority 1 by definition; kept out of the join, those rows don't meet in one task.
    j = a.filter(F.col("deal_id").isNotNull()).join(tracked, "deal_id", "left").select(
        "meeting_id", "deal_id", F.coalesce(F.col("_tracked"), F.lit(1)).alias("priority"))
    return j.unionByName(a.filter(F.col("deal_id").isNull()).select("meeting_id", "deal_id", F.lit(1).alias("priority")))


def one_deal_per_meeting(assoc: DataFrame, deals: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Keep one deal per meeting - tracked pipelines first, then the highest
    deal_id (a NULL deal_id sorts first in descending order, as in the warehouse).

    Expressed as ``min(struct(...))`` per meeting rather than ROW_NUMBER: the aggregate
    combines map-side, so a meeting with a huge number of associations never has to be
    sorted inside one task.
    """
    p = assoc_priority(assoc, deals, cfg)
    order = F.struct(
        F.col("priority").alias("p"),
        F.col("deal_id").isNotNull().alias("has_deal"),
        (-F.col("deal_id")).alias("neg_deal"),
        F.col("deal_id").alias("deal_id"),
    )
    return p.groupBy("meeting_id").agg(F.min(order)["deal_id"].alias("deal_id"))



def contact_flags(assoc: DataFrame, contacts: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """J6 + A1 / M4: per deal, whether any live associated contact is a test record and
    the latest contact close date. Deals without a resolvable contact get no row."""
    dc = assoc.select(F.col("deal_id"), F.col("contact_id").cast("string").alias("contact_id"))
    c = live_rows(contacts).select(
        F.col("id").cast("string").alias("contact_id"),
        F.col("property_hs_lead_status").alias("lead_status"),
        F.col("property_true_renewal_close_date").alias("true_renewal_close_date"),
    )
    return (
        dc.join(c, "contact_id", "inner")
        .groupBy("deal_id")
        .agg(
            F.bool_or(F.col("lead_status") == F.lit(cfg.test_lead_status)).alias("is_test_contact"),
            F.max("true_renewal_close_date").alias("contact_true_renewal_close_date"),
        )
    )

