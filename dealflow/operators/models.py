"""Intermediate and fact models (M5-M12) with their joins, unpivots and windows.

Plan shape at scale: every dimension (roster, stages, product / tier maps) is joined with a
size-checked broadcast, so the cash, won-deal and meeting facts are shuffle-free apart from
the meeting<->deal association; unpivots are single-scan ``inline(array(struct))``
generators; the first-call flag is an aggregate joined back on the unique meeting id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.config import DEFAULT, PipelineConfig
from dealflow.functions.dates import date_only, et_date, midpoint, start_date
from dealflow.functions.flags import (
    categorize,
    is_booked,
    is_closing_call,
    is_completed,
    null_safe_flag,
    pc_due_pred,
    rc_due_pred,
)
from dealflow.sources.dims import bounded_broadcast

# ---------------------------------------------------------------- predicates / joins


def won_filter(cfg: PipelineConfig = DEFAULT) -> Column:
    """(renewal pipeline and won stage) or (win-back pipeline and its won stage)."""
    p, s = F.col("pipeline_id"), F.col("dealstage_id")
    return (p.isin(*cfg.renewal_pipeline_ids) & s.isin(*cfg.won_stage_ids)) | (
        (p == F.lit(cfg.winback_pipeline_id)) & s.isin(*cfg.winback_won_stage_ids)
    )


def in_pipelines(df: DataFrame, ids, col: str = "pipeline_id") -> DataFrame:
    """P5."""
    return df.filter(F.col(col).isin(*ids))


def roster(closers: DataFrame, cfg: PipelineConfig = DEFAULT, with_name: bool = False) -> DataFrame:
    cols = ["owner_id", "closer_name"] if with_name else ["owner_id"]
    return bounded_broadcast(closers.select(*cols))


def only_roster(df: DataFrame, closers: DataFrame, key: str = "closer_owner_id",
                cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Owner gate - rows whose owner is on the roster (semi join on a unique key)."""
    r = roster(closers, cfg)
    return df.join(r, df[key] == r["owner_id"], "left_semi")


def with_closer_name(df: DataFrame, closers: DataFrame, key: str = "closer_owner_id",
                     cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Left lookup of the closer's name."""
    r = roster(closers, cfg, with_name=True).withColumnRenamed("owner_id", "_cl_owner")
    return df.join(r, df[key] == r["_cl_owner"], "left").drop("_cl_owner")


def exclude_flagged(df: DataFrame, flags: DataFrame, key: str = "deal_id",
                    flag: str = "is_test_contact", cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Drop rows linked to a flagged contact; rows without a link are kept. Flagged deals
    grow with the data, so this is a plain anti join: the planner picks the strategy."""
    return df.join(flags.filter(F.col(flag)).select(key), key, "left_anti")


def product_column(df: DataFrame, product_map: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Win-back pipeline -> WINBACK, else the mapped column, else UNMAPPED."""
    pm = bounded_broadcast(
        product_map.select(F.col("upsell_plan").alias("_pm_plan"), F.col("product_column").alias("_pm_col")))
    j = df.join(pm, df["upsell_plan"] == pm["_pm_plan"], "left")
    col = F.when(F.col("pipeline_id") == F.lit(cfg.winback_pipeline_id), F.lit("WINBACK")).otherwise(
        F.coalesce(F.col("_pm_col"), F.lit("UNMAPPED")))
    return j.withColumn("product_column", col).drop("_pm_plan", "_pm_col")


def _norm(c: Column) -> Column:
    return F.upper(F.trim(c))


def tier_of_origin(df: DataFrame, tier_map: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Case-insensitive, trimmed lookup with UNMAPPED default. The map side is
    normalised once so the join stays an equi (hash) join."""
    tm = bounded_broadcast(
        tier_map.select(_norm(F.col("active_product_snapshot_at_won")).alias("_tm_key"),
                        F.col("tier_of_origin_column").alias("_tm_col")))
    j = df.withColumn("_tm_probe", _norm(F.col("active_product_snapshot_at_won")))
    j = j.join(tm, j["_tm_probe"] == tm["_tm_key"], "left")
    return j.withColumn("tier_of_origin_column", F.coalesce(F.col("_tm_col"), F.lit("UNMAPPED"))).drop(
        "_tm_probe", "_tm_key", "_tm_col")


def with_stage(df: DataFrame, stages: DataFrame, cfg: PipelineConfig = DEFAULT,
               key: str = "dealstage_id") -> DataFrame:
    """Inner join to the stage dimension; unknown stages drop out."""
    s = bounded_broadcast(
        stages.select(F.col("stage_id").alias("_st_id"), F.col("pipeline_id").alias("stage_pipeline_id"),
                      "stage_group", "snapshot_col"))
    return df.join(s, df[key] == s["_st_id"], "inner").drop("_st_id")


# ---------------------------------------------------------------- M5 won deals

WON_KEEP = (
    "deal_id", "closer_owner_id", "pipeline_id", "dealstage_id", "close_date_et", "cash_collected",
    "ap1_amount", "ap1_stamped_at", "ap2_amount", "ap2_stamped_at", "ap3_amount", "ap3_stamped_at",
    "ap4_amount", "ap4_stamped_at", "ap11_amount", "ap11_stamped_at", "ap12_amount", "ap12_stamped_at",
    "renewal_year_count", "orig_product_category", "upsell_plan", "renewal_product_pitched",
    "active_product_snapshot_at_won", "is_post_webinar_close",
)


def won_deals(deals: DataFrame, closers: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M5 (J1, P4, P11, F2): closed-won deals of roster closers."""
    w = only_roster(deals.filter(won_filter(cfg)), closers, cfg=cfg)
    extras = [c for c in cfg.extra_deal_columns if c in deals.columns]
    return w.select(
        *[F.col(c) for c in WON_KEEP[:4]],
        date_only("close_date").alias("close_date_et"),
        *[F.col(c) for c in WON_KEEP[5:-1]],
        null_safe_flag("renewal_traffic_source", cfg.webinar_source).alias("is_post_webinar_close"),
        *[F.col(c) for c in extras],
    )


# ---------------------------------------------------------------- M6 / U1 deal cash


def _component_date(comp, tz: str) -> Column:
    if comp.date_rule == "close":
        return F.col("close_date_et")
    if comp.date_rule == "instant":
        return et_date(comp.date_col, tz)
    return date_only(comp.date_col)


def unpivot_components(won: DataFrame, components=None, keep=("deal_id", "closer_owner_id"),
                       cfg: PipelineConfig = DEFAULT, only_valid: bool = True) -> DataFrame:
    """U1 + P12: dated payment components of a wide deal row -> one row each, in one scan
    (``inline(array(struct))``), keeping positive amounts that have a date."""
    comps = components if components is not None else cfg.components
    if not comps:
        return won.select(*keep, F.lit(None).cast("string").alias("cash_component"),
                          F.lit(None).cast("date").alias("cash_date_et"),
                          F.lit(None).cast("double").alias("cash_amount")).limit(0)
    structs = [
        F.struct(
            F.lit(c.name).alias("cash_component"),
            _component_date(c, cfg.timezone).alias("cash_date_et"),
            F.col(c.amount_col).cast("double").alias("cash_amount"),
        )
        for c in comps
    ]
    out = won.select(*keep, F.inline(F.array(*structs)))
    return out.filter(valid_component()) if only_valid else out


def valid_component() -> Column:
    """P12."""
    return (F.col("cash_amount") > 0) & F.col("cash_date_et").isNotNull()


def deal_cash(won: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M6: deal x component grain."""
    return unpivot_components(won, cfg=cfg)


# ---------------------------------------------------------------- M7 meetings


def first_call_flags(m: DataFrame) -> DataFrame:
    """First completed RC/PWC/WB call per (deal, category).

    Only linked, eligible calls are ranked: an unlinked call is its own partition and so
    always first, and a call that is not a completed live call is TRUE by default. The
    winner per group is ``min(struct(start IS NULL, start, meeting_id))`` - earliest start,
    NULL start last, meeting id as the deterministic tie-break - computed with a map-side
    combined aggregate (skew-safe), then joined back on the unique meeting id.
    """
    eligible = F.coalesce(F.col("is_completed") & F.col("meeting_category").isin("RC", "PWC", "WB"),
                          F.lit(False))
    firsts = (
        m.filter(eligible & F.col("deal_id").isNotNull())
        .groupBy("deal_id", "meeting_category")
        .agg(F.min(F.struct(F.col("meeting_start_at").isNull().alias("n"),
                            F.col("meeting_start_at").alias("s"),
                            F.col("meeting_id").alias("id")))["id"].alias("_first_id"))
        .select(F.col("_first_id").alias("meeting_id"), F.lit(True).alias("_is_first"))
    )
    j = m.join(firsts, "meeting_id", "left")
    flag = F.when(eligible & F.col("deal_id").isNotNull(), F.col("_is_first").isNotNull()).otherwise(F.lit(True))
    return j.withColumn("is_first_call", flag).drop("_is_first")


def meetings(stg_meetings: DataFrame, meeting_deals: DataFrame, closers: DataFrame,
             cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M7 (J1, J7, P7-P10, W2, J11, F1)."""
    m = only_roster(stg_meetings, closers, key="owner_id", cfg=cfg)
    m = m.join(meeting_deals.select("meeting_id", "deal_id"), "meeting_id", "left")
    m = m.select(
        "meeting_id",
        F.col("owner_id").alias("closer_owner_id"),
        "activity_type",
        "meeting_outcome",
        "meeting_start_at",
        et_date("meeting_start_at", cfg.timezone).alias("meeting_date_et"),
        "deal_id",
        categorize("activity_type").alias("meeting_category"),
        is_booked("meeting_outcome").alias("is_booked"),
        is_completed("meeting_outcome").alias("is_completed"),
    ).filter(F.col("meeting_category").isNotNull())
    m = first_call_flags(m)
    return m.select(
        "meeting_id", "closer_owner_id", "activity_type", "meeting_category", "meeting_outcome",
        "meeting_date_et", "deal_id", "is_booked", "is_completed", "is_first_call",
        is_closing_call("meeting_category", "is_completed", "activity_type").alias("is_closing_call"),
    )


# ---------------------------------------------------------------- M8-M10 facts

CASH_ATTRS = ("pipeline_id", "dealstage_id", "renewal_year_count", "orig_product_category", "upsell_plan",
              "active_product_snapshot_at_won")


def fct_cash(won: DataFrame, product_map: DataFrame, tier_map: DataFrame, closers: DataFrame,
             cfg: PipelineConfig = DEFAULT, extra: tuple = ()) -> DataFrame:
    """M8 (M6, J2-J5): payment-grain cash fact. The deal attributes are carried through
    the unpivot, so no join back to the deals (J5) is needed."""
    keep = ("deal_id", "closer_owner_id") + CASH_ATTRS + tuple(extra)
    c = unpivot_components(won, keep=keep, cfg=cfg)
    c = product_column(c, product_map, cfg)
    c = tier_of_origin(c, tier_map, cfg)
    c = with_closer_name(c, closers, cfg=cfg)
    return c.select(
        "deal_id", "closer_owner_id", "closer_name", "cash_component", "cash_date_et", "cash_amount",
        "pipeline_id", "dealstage_id", "renewal_year_count", "orig_product_category", "upsell_plan",
        "product_column", "active_product_snapshot_at_won", "tier_of_origin_column", *extra,
    )


def cash_with_attrs(cash: DataFrame, won: DataFrame) -> DataFrame:
    """J5 in its join form (kept for callers that hold component rows without the deal
    attributes): left join component rows to their won deal's attributes."""
    d = won.select("deal_id", *CASH_ATTRS)
    return cash.join(d, "deal_id", "left")


def fct_won_deals(won: DataFrame, closers: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M9."""
    w = with_closer_name(won, closers, cfg=cfg)
    return w.select("deal_id", "closer_owner_id", "closer_name", "pipeline_id", "dealstage_id",
                    "close_date_et", "is_post_webinar_close")


def fct_meetings(meetings_df: DataFrame, closers: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M10."""
    m = with_closer_name(meetings_df, closers, cfg=cfg)
    return m.select("meeting_id", "closer_owner_id", "closer_name", "activity_type", "meeting_category",
                    "meeting_outcome", "meeting_date_et", "deal_id", "is_booked", "is_completed",
                    "is_first_call", "is_closing_call")


# ---------------------------------------------------------------- M11 stage entries


def unpivot_entries(deals: DataFrame, cfg: PipelineConfig = DEFAULT,
                    keep=("deal_id", "closer_owner_id")) -> DataFrame:
    """The four stage-entry instants -> (type, ET day) rows, one scan."""
    structs = [
        F.struct(F.lit(e).alias("stage_entry_type"), et_date(f"date_entered_{e}", cfg.timezone).alias("entry_date_et"))
        for e, _, _ in cfg.stage_entry_sources
    ]
    return deals.select(*keep, F.inline(F.array(*structs))).filter(F.col("entry_date_et").isNotNull())


def fct_stage_entries(deals: DataFrame, closers: DataFrame, flags: DataFrame,
                      cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M11 (P5, J1, P6, U2, F1)."""
    d = in_pipelines(deals, cfg.renewal_pipeline_ids)
    d = only_roster(d, closers, cfg=cfg)
    d = exclude_flagged(d, flags, cfg=cfg)
    return unpivot_entries(d, cfg)


# ---------------------------------------------------------------- M12 pipeline snapshot


def snapshot_candidates(deals: DataFrame, flags: DataFrame, stages: DataFrame, closers: DataFrame,
                        cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Deals of roster closers, not flagged, on a known stage, with the derived dates the
    due rules need (F6, F7, J9, J14: the midpoint is a column, no join)."""
    r = roster(closers, cfg, with_name=True)
    d = deals.join(r, deals["closer_owner_id"] == r["owner_id"], "inner").drop("owner_id")
    d = with_stage(d, stages, cfg)
    # One join gives both the test flag and the contact's close date.
    linked = flags.select("deal_id", F.col("is_test_contact").alias("_test"), "contact_true_renewal_close_date")
    d = d.join(linked, "deal_id", "left").filter(~F.coalesce("_test", F.lit(False))).drop("_test")
    start = start_date("close_date", "close_date_fallback", "contact_true_renewal_close_date", cfg.timezone)
    exp = date_only("membership_expiration_date")
    return d.withColumn("membership_start_date_et", start).withColumn(
        "membership_expiration_date_et", exp).withColumn(
        "pc_due_midpoint_et", midpoint(F.col("membership_start_date_et"), F.col("membership_expiration_date_et")))


def due_flags(as_of, cfg: PipelineConfig = DEFAULT) -> tuple[Column, Column]:
    """(rc_due, pc_due) predicates on snapshot candidates; rc_due wins ties."""
    new_pipe = (F.col("pipeline_id") == F.lit(cfg.new_pipeline_id)) & (
        F.col("stage_pipeline_id") == F.lit(cfg.new_pipeline_id))
    exp = F.col("membership_expiration_date_et")
    rc = new_pipe & F.col("snapshot_col").isin(*C.PRE_RC_SNAPSHOT_COLS) & exp.isNotNull() & rc_due_pred(
        as_of, exp, cfg.rc_due_days)
    rc = F.coalesce(rc, F.lit(False))
    mid = F.col("pc_due_midpoint_et")
    pc = new_pipe & F.col("snapshot_col").isin(*C.PRE_PC_SNAPSHOT_COLS) & mid.isNotNull() & pc_due_pred(
        as_of, mid, cfg.pc_due_lead_days)
    pc = F.coalesce(pc, F.lit(False)) & ~rc
    return rc, pc


def fct_pipeline_snapshot(deals: DataFrame, flags: DataFrame, stages: DataFrame, closers: DataFrame,
                          as_of, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Every deal in exactly one bucket, precedence rc_due > pc_due > stage.

    One pass with a precedence CASE instead of three branches glued by NOT IN: equal to the
    union + anti-join form because deal_id is unique in staging and the candidate stages
    are a subset of the stage dimension. Deals are read once: roster and stages are broadcast
    (size-checked), and one join on deal_id gives the test flag and the contact's close date.
    """
    d = snapshot_candidates(deals, flags, stages, closers, cfg)
    rc, pc = due_flags(as_of, cfg)
    exp = F.col("membership_expiration_date_et")
    bucket = (
        F.when(rc, F.struct(F.col("pipeline_id").alias("p"), F.lit("renewal_call").alias("g"),
                            F.lit("rc_due").alias("s"), F.date_sub(exp, cfg.rc_due_days).alias("d")))
        .when(pc, F.struct(F.col("pipeline_id").alias("p"), F.lit("progress_call").alias("g"),
                           F.lit("pc_due").alias("s"),
                           F.date_sub(F.col("pc_due_midpoint_et"), cfg.pc_due_lead_days).alias("d")))
        .otherwise(F.struct(F.col("stage_pipeline_id").alias("p"), F.col("stage_group").alias("g"),
                            F.col("snapshot_col").alias("s"),
                            et_date("date_entered_current_stage", cfg.timezone).alias("d")))
    )
    return d.select(
        "closer_owner_id", "closer_name", bucket["p"].alias("pipeline_id"), bucket["g"].alias("stage_group"),
        bucket["s"].alias("snapshot_col"), "deal_id", bucket["d"].alias("entry_date_et"),
    )


def candidate_stages(stages: DataFrame, pipeline_id: str, snapshot_cols) -> DataFrame:
    """Stage ids of one pipeline whose bucket is in ``snapshot_cols``."""
    return stages.filter((F.col("pipeline_id") == F.lit(pipeline_id)) & F.col("snapshot_col").isin(*snapshot_cols)
                         ).select("stage_id")


def not_in(df: DataFrame, other: DataFrame, key: str = "deal_id") -> DataFrame:
    """Rows whose key is absent from ``other`` (non-null keys: a plain anti join)."""
    return df.join(other.select(key).filter(F.col(key).isNotNull()), key, "left_anti")
