"""Base metrics (A1-A23) and derived KPIs (K1-K15) over the row-grain facts.

Facts stay row-grain and dated; every metric is a filter + grouped aggregate applied at
query time, so any window can be asked for. Grouping is by closer (a handful of keys):
partial aggregation collapses each map task's output to a few rows before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.functions.dates import as_date, prior_window
from dealflow.functions.ratios import report_pct, report_ratio, safe_pct

OWNER = "closer_owner_id"


def in_window(col: str, start, end) -> Column:
    """Inclusive date window."""
    return F.col(col).between(as_date(start), as_date(end))


def owner_filter(df: DataFrame, owner: str | None, col: str = OWNER) -> DataFrame:
    """No owner = whole team."""
    return df if owner is None else df.filter(F.col(col) == F.lit(str(owner)))


def _group(df: DataFrame, by, *aggs) -> DataFrame:
    by = list(by or [])
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("long")


# ---------------------------------------------------------------- windowed base metrics


def total_cash(cash: DataFrame, start, end, owner=None, by=(OWNER,), name: str = "total_cash") -> DataFrame:
    """A5."""
    df = owner_filter(cash.filter(in_window("cash_date_et", start, end)), owner)
    return _group(df, by, F.sum("cash_amount").alias(name))


def deals_won(won: DataFrame, start, end, owner=None, by=(OWNER,), name: str = "deals_won") -> DataFrame:
    """A6 (and A14 with ``pwc_deals_won``)."""
    df = owner_filter(won.filter(in_window("close_date_et", start, end)), owner)
    return _group(df, by, F.count(F.lit(1)).alias(name), count_if(F.col("is_post_webinar_close")).alias("pwc_deals_won"))


def pwc_deals_won(won: DataFrame, start, end, owner=None, by=(OWNER,)) -> DataFrame:
    """A14."""
    df = owner_filter(won.filter(in_window("close_date_et", start, end)), owner)
    return _group(df, by, count_if(F.col("is_post_webinar_close")).alias("pwc_deals_won"))


def call_outcomes(meetings: DataFrame, start, end, by=(OWNER,)) -> DataFrame:
    """Meeting-basis invited / booked / completed for PC and RC, PWC completed."""
    m = meetings.filter(in_window("meeting_date_et", start, end))
    cat, bk, cp = F.col("meeting_category"), F.col("is_booked"), F.col("is_completed")
    return _group(
        m, by,
        count_if(cat == "PC").alias("pc_invited"),
        count_if((cat == "PC") & bk).alias("pc_booked"),
        count_if((cat == "PC") & cp).alias("pc_completed"),
        count_if(cat == "RC").alias("rc_invited"),
        count_if((cat == "RC") & bk).alias("rc_booked"),
        count_if((cat == "RC") & cp).alias("rc_completed"),
        count_if((cat == "PWC") & cp).alias("pwc_completed"),
    )


def completed(meetings: DataFrame, category: str, start, end, owner=None, by=(OWNER,),
              first_only: bool = False) -> DataFrame:
    """A8 (K11 with ``first_only``): completed calls of one category."""
    cond = (F.col("meeting_category") == category) & F.col("is_completed")
    if first_only:
        cond = cond & F.col("is_first_call")
    df = owner_filter(meetings.filter(in_window("meeting_date_et", start, end) & cond), owner)
    return _group(df, by, F.count(F.lit(1)).alias(f"{category.lower()}_completed"))


def completed_counts(meetings: DataFrame, start, end, by=(OWNER,), first_only: bool = False) -> DataFrame:
    """A8 for all four categories in one scan."""
    cp = F.col("is_completed")
    if first_only:
        cp = cp & F.col("is_first_call")
    m = meetings.filter(in_window("meeting_date_et", start, end))
    return _group(m, by, *[count_if((F.col("meeting_category") == c) & cp).alias(f"{c.lower()}_completed")
                           for c in ("PC", "RC", "PWC", "WB")])


def cash_by_product(cash: DataFrame, start, end, by=(OWNER,), products=C.PRODUCT_COLUMNS) -> DataFrame:
    """One cash column per product column (fixed list -> no distinct pass) + total."""
    df = cash.filter(in_window("cash_date_et", start, end))
    sums = [F.sum(F.when(F.col("product_column") == p, F.col("cash_amount")).otherwise(F.lit(0.0))).alias(p.lower())
            for p in products]
    return _group(df, by, *sums, F.sum("cash_amount").alias("total_cash"))


def cash_by_origin(cash: DataFrame, start, end, by=(OWNER,)) -> DataFrame:
    """A10: cash per tier of origin (long form)."""
    df = cash.filter(in_window("cash_date_et", start, end))
    return df.groupBy(*by, "tier_of_origin_column").agg(F.sum("cash_amount").alias("cash"))


def snapshot_counts(snap: DataFrame, start=None, end=None, by=(OWNER,), cols=C.SNAPSHOT_COLS) -> DataFrame:
    """Deals per closer x bucket as columns + row total over all buckets. Optional
    window on entry_date_et (D8)."""
    df = snap if start is None else snap.filter(in_window("entry_date_et", start, end))
    counts = [count_if(F.col("snapshot_col") == c).alias(c) for c in cols]
    return _group(df, by, *counts, F.count(F.lit(1)).alias("total"))


def snapshot_metrics(snap: DataFrame, stages: DataFrame, owner=None) -> DataFrame:
    """One count per distinct snapshot_col of the stage dimension (buckets sharing a
    column pooled; empty buckets give 0)."""
    s = owner_filter(snap, owner).groupBy("snapshot_col").agg(F.count(F.lit(1)).alias("deals"))
    dims = stages.select("snapshot_col").distinct()
    return dims.join(s, "snapshot_col", "left").select(
        F.concat(F.lit("pipeline_snapshot."), F.col("snapshot_col")).alias("metric_id"),
        "snapshot_col", F.coalesce(F.col("deals"), F.lit(0)).cast("long").alias("value"))


def stage_entry_counts(entries: DataFrame, start, end, by=(OWNER,)) -> DataFrame:
    """Stage-entry basis invited / booked (scheduled) for PC and RC."""
    df = entries.filter(in_window("entry_date_et", start, end))
    t = F.col("stage_entry_type")
    return _group(df, by,
                  count_if(t == "pc_invited").alias("pc_invited"),
                  count_if(t == "pc_scheduled").alias("pc_booked"),
                  count_if(t == "rc_invited").alias("rc_invited"),
                  count_if(t == "rc_scheduled").alias("rc_booked"))


def stage_bucket_count(snap: DataFrame, snapshot_col: str, owner=None, by=(OWNER,), name: str | None = None) -> DataFrame:
    """Current-stage row count of one bucket (live, not windowed; D1: rows)."""
    df = owner_filter(snap.filter(F.col("snapshot_col") == snapshot_col), owner)
    return _group(df, by, F.count(F.lit(1)).alias(name or snapshot_col))


def team_total(df: DataFrame, cols) -> DataFrame:
    """Team row = pooled sums of the closer rows."""
    return df.agg(*[F.sum(c).alias(c) for c in cols])


def pooled_ratio(df: DataFrame, num: str, den: str, name: str, kind: str = "safe") -> DataFrame:
    """Σnum / Σden (not the mean of ratios)."""
    n, d = F.sum(num), F.sum(den)
    expr = safe_pct(n, d) if kind == "safe" else report_pct(n, d)
    return df.agg(n.alias(num), d.alias(den), expr.alias(name))


def on_fire(report: DataFrame) -> DataFrame:
    """The closer with the most cash today, only if > 0; the lowest owner id wins
    ties. The report has one row per roster closer, so the top-1 is tiny."""
    return top_closer(report, "cash_today", 0)


def top_closer(report: DataFrame, metric: str = "cash_today", minimum: float = 0,
               cols=("closer_owner_id", "closer_name", "deals_today")) -> DataFrame:
    """Top-1 closer by ``metric`` above ``minimum`` (TakeOrderedAndProject over
    one row per closer)."""
    return (report.filter(F.col(metric) > minimum)
            .orderBy(F.col(metric).desc(), F.col("closer_owner_id").asc())
            .limit(1)
            .select(*[c for c in cols if c != metric], metric))


def today_calls(meetings: DataFrame, as_of, by=(OWNER,), closing_basis: str = "flag") -> DataFrame:
    """Closing and midway calls today and yesterday, with vs-yesterday deltas.

    ``closing_basis='flag'`` uses P10 (no follow-ups, WB included); ``'form'`` uses all
    completed RC/PWC calls as in the original formula sheet."""
    today = as_date(as_of)
    yday = F.date_sub(today, 1)
    df = meetings.filter(F.col("meeting_date_et").between(yday, today))
    if closing_basis == "flag":
        closing = F.col("is_closing_call")
    else:
        closing = F.col("meeting_category").isin("RC", "PWC") & F.col("is_completed")
    midway = (F.col("meeting_category") == "PC") & F.col("is_completed")
    d = F.col("meeting_date_et")
    out = _group(df, by,
                 count_if(closing & (d == today)).alias("closing_calls_today"),
                 count_if(closing & (d == yday)).alias("closing_calls_yesterday"),
                 count_if(midway & (d == today)).alias("midway_calls_today"),
                 count_if(midway & (d == yday)).alias("midway_calls_yesterday"))
    return (out.withColumn("closing_calls_vs_yesterday", F.col("closing_calls_today") - F.col("closing_calls_yesterday"))
            .withColumn("midway_calls_vs_yesterday", F.col("midway_calls_today") - F.col("midway_calls_yesterday")))


def assigned_deals(deals: DataFrame, closers: DataFrame, cfg=None) -> DataFrame:
    """Deals in the renewal pipelines per roster closer (denominator of K14)."""
    from dealflow.config import DEFAULT
    from dealflow.operators.models import only_roster

    cfg = cfg or DEFAULT
    d = only_roster(deals.filter(F.col("pipeline_id").isin(*cfg.renewal_pipeline_ids)), closers, cfg=cfg)
    return d.groupBy(OWNER).agg(F.count(F.lit(1)).alias("assigned_deals"))


# ---------------------------------------------------------------- KPI layer


def base_metrics(cash: DataFrame, won: DataFrame, meetings: DataFrame, entries: DataFrame,
                 snap: DataFrame, closers: DataFrame, start, end, first_only: bool = False) -> DataFrame:
    """Every base metric per roster closer for one window, one aggregate per fact,
    assembled on the (tiny) roster with zero defaults."""
    r = closers.select(F.col("owner_id").alias(OWNER))
    parts = [
        total_cash(cash, start, end),
        deals_won(won, start, end),
        completed_counts(meetings, start, end, first_only=first_only),
        stage_entry_counts(entries, start, end),
        _group(snap, [OWNER],
               count_if(F.col("snapshot_col") == "wb_booked").alias("wb_booked"),
               count_if(F.col("snapshot_col").isin("wb_eligible", "wb_attempting")).alias("wb_invited")),
    ]
    out = r
    for p in parts:
        out = out.join(p, OWNER, "left")
    fill = {c: 0 for c in out.columns if c != OWNER and c != "total_cash"}
    out = out.fillna(fill).fillna({"total_cash": 0.0})
    return out


def funnel_kpis(base: DataFrame) -> DataFrame:
    """K1-K10 on base-metric rows (per closer, or the pooled team row after A18)."""
    live = F.col("rc_completed") + F.col("pwc_completed") + F.col("wb_completed")
    return base.select(
        "*",
        safe_pct("pc_booked", "pc_invited").alias("pc_book_pct"),
        safe_pct("pc_completed", "pc_booked").alias("pc_show_pct"),
        safe_pct("deals_won", "pc_completed").alias("pc_close_pct"),
        safe_pct("rc_booked", "rc_invited").alias("rc_book_pct"),
        safe_pct("rc_completed", "rc_booked").alias("rc_show_pct"),
        safe_pct("deals_won", "rc_completed").alias("rc_close_pct"),
        safe_pct("pwc_deals_won", "pwc_completed").alias("pwc_close_pct"),
        safe_pct("wb_booked", "wb_invited").alias("wb_book_pct"),
        report_pct(F.col("deals_won"), live).alias("live_close_pct"),
        report_ratio(F.col("total_cash"), live).alias("avg_dpl"),
    )


def cash_vs_prior_window(cash: DataFrame, start, end, by=(OWNER,)) -> DataFrame:
    """Window cash minus equal-length prior-window cash, one scan."""
    ps, pe = prior_window(start, end)
    s, e = as_date(start), as_date(end)
    d = F.col("cash_date_et")
    df = cash.filter(d.between(ps, e))
    out = _group(df, by,
                 F.sum(F.when(d.between(s, e), F.col("cash_amount")).otherwise(0.0)).alias("cash_window"),
                 F.sum(F.when(d.between(ps, pe), F.col("cash_amount")).otherwise(0.0)).alias("cash_prior_window"))
    return out.withColumn("cash_vs_prior", F.col("cash_window") - F.col("cash_prior_window"))
