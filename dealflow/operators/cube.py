"""Day cube of running totals: any number of windows from one scan of each fact.

Measures are summed by closer and day, then made running totals over the days of a closer. What a
window holds is the difference of two rows, that of its last day and that of the day before its
first, so asking for another window reads the cube's few rows (closers x days) and no fact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealflow.functions.dates import WINDOW_PRESETS, as_date, window_bounds

OWNER, DAY = "closer_owner_id", "day"


def _cases(cond: dict[str, Column]) -> dict[str, Column]:
    return {name: F.count_if(c) for name, c in cond.items()}


def measures() -> dict[str, tuple[str, dict[str, Column]]]:
    """By fact: its date column, and what is summed by day. All are additive. Cash is summed as an exact
    decimal (six places), so that a difference of totals is the sum of the window's payments."""
    category, done, booked = F.col("meeting_category"), F.col("is_completed"), F.col("is_booked")
    calls = {f"{c.lower()}_completed": done & (category == c) for c in ("PC", "RC", "PWC", "WB")}
    calls |= {f"{c.lower()}_booked": booked & (category == c) for c in ("PC", "RC")}
    entry = F.col("stage_entry_type")
    return {
        "cash": ("cash_date_et", {"payments": F.count("cash_amount"), "total_cash": F.sum(F.col("cash_amount").cast("decimal(28,6)"))}),
        "won": ("close_date_et", {"deals_won": F.count(F.lit(1)), "pwc_deals_won": F.count_if(F.col("is_post_webinar_close"))}),
        "meetings": ("meeting_date_et", _cases(calls)),
        "entries": ("entry_date_et", _cases({f"{e}_entries": entry == e for e in ("pc_invited", "pc_scheduled", "rc_invited", "rc_scheduled")})),
    }


def day_cube(facts: dict[str, DataFrame], closers: DataFrame) -> DataFrame:
    """(closer_owner_id, day, measures): the running totals of every closer at each day with a row of any
    of ``facts`` (cash, won, meetings, entries). A roster owner without rows has one of zeros; rows
    without a day are in no window and left out. Each fact is aggregated with partial combine, so
    what is shuffled and then ordered is closers x days, whatever the facts' size."""
    by = measures()
    parts = [df.filter(F.col(by[f][0]).isNotNull()).groupBy(OWNER, F.col(by[f][0]).alias(DAY)).agg(*[c.alias(n) for n, c in by[f][1].items()])
             for f, df in facts.items()]
    parts.append(closers.select(F.col("owner_id").cast("string").alias(OWNER), F.lit("0001-01-01").cast("date").alias(DAY)))
    names = [n for f in facts for n in by[f][1]]
    daily = (reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy(OWNER, DAY)
             .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]))
    to_date = Window.partitionBy(OWNER).orderBy(DAY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(OWNER, DAY, *[F.sum(n).over(to_date).alias(n) for n in names])


def windows(cube: DataFrame, spans: dict[str, tuple]) -> DataFrame:
    """(window, closer_owner_id, measures) of each span (name -> first and last day, inclusive) and closer,
    from one pass over the cube. Counts are 0 without rows; ``total_cash`` is then NULL, as a sum of
    no rows is."""
    names = [c for c in cube.columns if c not in (OWNER, DAY)]
    until = lambda day: F.max_by(F.struct(*names), F.when(F.col(DAY) <= day, F.col(DAY)))
    ends = {w: (F.date_sub(as_date(s), 1), as_date(e)) for w, (s, e) in spans.items()}
    at = cube.groupBy(OWNER).agg(*[until(d).alias(f"{w}_{i}") for w, pair in ends.items() for i, d in enumerate(pair)])

    def value(w: str, n: str) -> Column:
        d = F.coalesce(F.col(f"{w}_1")[n], F.lit(0)) - F.coalesce(F.col(f"{w}_0")[n], F.lit(0))
        return d.cast("double") if n == "total_cash" else d.cast("bigint")

    rows = F.array(*[F.struct(F.lit(w).alias("window"), *[value(w, n).alias(n) for n in names]) for w in spans])
    out = at.select(OWNER, F.inline(rows))
    if "total_cash" in names:
        out = out.withColumn("total_cash", F.when(F.col("payments") > 0, F.col("total_cash")))
    return out.select("window", OWNER, *names)


def preset_windows(cube: DataFrame, as_of, start=None, end=None) -> DataFrame:
    """all window presets at ``as_of`` (``custom`` where it is given) of all closers."""
    given = [p for p in WINDOW_PRESETS if p != "custom" or (start is not None and end is not None)]
    return windows(cube, {p: window_bounds(p, as_of, start, end) for p in given})
