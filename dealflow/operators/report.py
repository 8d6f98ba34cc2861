"""Wide per-closer report (M13) and leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealflow.config import DEFAULT, PipelineConfig
from dealflow.functions.dates import month_bounds
from dealflow.functions.ratios import report_pct, report_ratio
from dealflow.operators.metrics import count_if
from dealflow.sources.dims import bounded_broadcast

OWNER = "closer_owner_id"
BOUND_COLS = ("today_et", "mtd_start", "mtd_end", "prior_month_start", "prior_mtd_end")


def with_bounds(df: DataFrame, as_of) -> DataFrame:
    """Attach the month bounds as literal columns (no one-row cross join, so the date
    predicates stay foldable and can be pushed down)."""
    b = month_bounds(as_of)
    return df.select("*", *[b[k].alias(k) for k in ("today_et", "yesterday_et") + BOUND_COLS[1:]])


def _scoped(df: DataFrame, day: str, as_of, recent: bool) -> DataFrame:
    """Rows that the windows can count. Only ``recent`` rows are read where a caller fills in
    the closers that then have no row; else every closer with any row keeps its row of zeros."""
    b = month_bounds(as_of)
    return df.filter(F.col(day).between(b["prior_month_start"], b["today_et"])) if recent else df


def cash_agg(cash: DataFrame, as_of, recent: bool = False) -> DataFrame:
    """A2: MTD / prior-MTD / today / yesterday cash per closer in one pass."""
    b = month_bounds(as_of)
    d = F.col("cash_date_et")
    amt = F.col("cash_amount")
    c = _scoped(cash, "cash_date_et", as_of, recent)

    def s(cond):
        return F.sum(F.when(cond, amt).otherwise(F.lit(0.0)))

    return c.groupBy(OWNER).agg(
        s(d.between(b["mtd_start"], b["mtd_end"])).alias("cash_mtd"),
        s(d.between(b["prior_month_start"], b["prior_mtd_end"])).alias("cash_prior_mtd"),
        s(d == b["today_et"]).alias("cash_today"),
        s(d == b["yesterday_et"]).alias("cash_yesterday"),
    )


def deals_agg(won: DataFrame, as_of, recent: bool = False) -> DataFrame:
    """A3."""
    b = month_bounds(as_of)
    d = F.col("close_date_et")
    w = _scoped(won, "close_date_et", as_of, recent)
    return w.groupBy(OWNER).agg(
        count_if(d.between(b["mtd_start"], b["mtd_end"])).alias("deals_won_mtd"),
        count_if(d.between(b["prior_month_start"], b["prior_mtd_end"])).alias("deals_won_prior_mtd"),
        count_if(d == b["today_et"]).alias("deals_today"),
    )


def meetings_agg(meetings: DataFrame, as_of, first_only: bool = False, recent: bool = False) -> DataFrame:
    """A4 (K11 with ``first_only``): completed live calls MTD / prior MTD."""
    b = month_bounds(as_of)
    d = F.col("meeting_date_et")
    live = F.col("meeting_category").isin("RC", "PWC", "WB") & F.col("is_completed")
    if first_only:
        live = live & F.col("is_first_call")
    m = _scoped(meetings, "meeting_date_et", as_of, recent)
    return m.groupBy(OWNER).agg(
        count_if(live & d.between(b["mtd_start"], b["mtd_end"])).alias("live_meetings_mtd"),
        count_if(live & d.between(b["prior_month_start"], b["prior_mtd_end"])).alias("live_meetings_prior_mtd"),
    )


REPORT_COLUMNS = (
    "closer_owner_id", "closer_name", "today_et", "mtd_start", "mtd_end", "prior_month_start", "prior_mtd_end",
    "cash_mtd", "cash_prior_mtd", "cash_vs_prior_mtd", "cash_today", "cash_today_vs_yesterday",
    "deals_won_mtd", "deals_won_prior_mtd", "deals_vs_prior_mtd", "deals_today", "live_meetings_mtd",
    "live_close_pct", "avg_dpl", "goal_total_cash", "goal_deals_won", "goal_live_close_pct", "goal_avg_dpl",
)


def closer_report(cash: DataFrame, won: DataFrame, meetings: DataFrame, targets: DataFrame,
                  closers: DataFrame, as_of, cfg: PipelineConfig = DEFAULT,
                  first_only: bool = False, extended: bool = False) -> DataFrame:
    """One row per roster closer (even without activity); targets joined by
    name. ``extended`` adds the prior-MTD live metrics (K15)."""
    b = month_bounds(as_of)
    ca, da = cash_agg(cash, as_of, recent=True), deals_agg(won, as_of, recent=True)
    ma = meetings_agg(meetings, as_of, first_only, recent=True)
    t = bounded_broadcast(targets.select("closer_name", "goal_total_cash", "goal_deals_won",
                                         "goal_live_close_pct", "goal_avg_dpl").withColumnRenamed(
        "closer_name", "_t_name"))
    r = closers.select(F.col("owner_id").alias(OWNER), "closer_name")
    j = r.join(ca, OWNER, "left").join(da, OWNER, "left").join(ma, OWNER, "left")
    j = j.join(t, j["closer_name"] == t["_t_name"], "left")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0))

    cols = [
        F.col(OWNER), F.col("closer_name"),
        *[b[k].alias(k) for k in BOUND_COLS],
        z("cash_mtd").cast("double").alias("cash_mtd"),
        z("cash_prior_mtd").cast("double").alias("cash_prior_mtd"),
        (z("cash_mtd") - z("cash_prior_mtd")).cast("double").alias("cash_vs_prior_mtd"),
        z("cash_today").cast("double").alias("cash_today"),
        (z("cash_today") - z("cash_yesterday")).cast("double").alias("cash_today_vs_yesterday"),
        z("deals_won_mtd").alias("deals_won_mtd"),
        z("deals_won_prior_mtd").alias("deals_won_prior_mtd"),
        (z("deals_won_mtd") - z("deals_won_prior_mtd")).alias("deals_vs_prior_mtd"),
        z("deals_today").alias("deals_today"),
        z("live_meetings_mtd").alias("live_meetings_mtd"),
        report_pct(z("deals_won_mtd"), F.col("live_meetings_mtd")).alias("live_close_pct"),
        report_ratio(z("cash_mtd"), F.col("live_meetings_mtd")).alias("avg_dpl"),
        "goal_total_cash", "goal_deals_won", "goal_live_close_pct", "goal_avg_dpl",
    ]
    if extended:
        cols += [
            z("live_meetings_prior_mtd").alias("live_meetings_prior_mtd"),
            report_pct(z("deals_won_prior_mtd"), F.col("live_meetings_prior_mtd")).alias("live_close_pct_prior_mtd"),
            report_ratio(z("cash_prior_mtd"), F.col("live_meetings_prior_mtd")).alias("avg_dpl_prior_mtd"),
        ]
    out = j.select(*cols)
    if extended:
        out = out.withColumn("live_close_pct_change", F.col("live_close_pct") - F.col("live_close_pct_prior_mtd")
                             ).withColumn("avg_dpl_change", F.col("avg_dpl") - F.col("avg_dpl_prior_mtd"))
    return out


# ---------------------------------------------------------------- leaderboards

# Ranking windows run over one aggregated row per closer (a handful of rows), so their
# single global partition is tiny by construction.


def _board_window(metric: str):
    return Window.orderBy(F.col(metric).desc_nulls_last(), F.col(OWNER).asc())


def rank_closers(df: DataFrame, metric: str) -> DataFrame:
    """Leaderboard rank (competition rank: ties share a place) and position."""
    w = _board_window(metric)
    return df.select("*", F.rank().over(Window.orderBy(F.col(metric).desc_nulls_last())).alias("rank"),
                     F.row_number().over(w).alias("position"))


def gap_to_next(df: DataFrame, metric: str) -> DataFrame:
    """Distance to the closer ranked just above; equal values read 'tied'."""
    w = _board_window(metric)
    gap = F.lag(F.col(metric)).over(w) - F.col(metric)
    return df.select("*", gap.alias("gap_to_next"),
                     F.when(gap == 0, F.lit("tied")).when(gap.isNull(), F.lit("leader"))
                     .otherwise(F.lit("behind")).alias("gap_label"))


def share_of_leader(df: DataFrame, metric: str) -> DataFrame:
    """Bar length relative to the leader."""
    lead = F.max(F.col(metric)).over(Window.partitionBy(F.lit(1)))
    return df.select("*", (F.col(metric) / F.nullif(lead, F.lit(0))).alias("share_of_leader"))


def leaderboard(df: DataFrame, metric: str) -> DataFrame:
    """Rank-descending output order (owner id breaks ties)."""
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(OWNER).asc())
