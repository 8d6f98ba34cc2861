"""Column date helpers against plain-Python statements of the same rules, over many
random dates in one job each (month ends, leap days and negative spans included)."""

import calendar
import datetime as dt
import math
import random

from pyspark.sql import functions as F

from dealflow import jobs
from dealflow.functions import dates as D

RND = random.Random(3)
DAYS = [dt.date(2019, 1, 1) + dt.timedelta(days=RND.randint(0, 3000)) for _ in range(300)]
DAYS += [dt.date(2024, 2, 29), dt.date(2026, 3, 31), dt.date(2026, 3, 1), dt.date(2025, 12, 31), dt.date(2026, 5, 31)]


def _prior_mtd_end(d: dt.date) -> dt.date:
    y, m = (d.year, d.month - 1) if d.month > 1 else (d.year - 1, 12)
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def test_month_bounds_match_python(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    b = D.month_bounds(F.col("d"))
    rows = df.select("d", *[v.alias(k) for k, v in b.items()]).collect()
    for r in rows:
        d = r.d
        pm = _prior_mtd_end(d)
        assert (r.today_et, r.yesterday_et, r.mtd_start, r.mtd_end) == (d, d - dt.timedelta(days=1), d.replace(day=1), d)
        assert (r.prior_month_start, r.prior_mtd_end) == (pm.replace(day=1), pm), d


def test_window_presets_match_the_python_twin(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    presets = ("today", "yesterday", "last3d", "last7d", "last14d", "last30d", "mtd")
    cols = []
    for p in presets:
        s, e = D.window_bounds(p, F.col("d"))
        cols += [s.alias(f"{p}_s"), e.alias(f"{p}_e")]
    for r in df.select("d", *cols).collect():
        for p in presets:
            assert (r[f"{p}_s"], r[f"{p}_e"]) == jobs.window_dates(p, r.d), (p, r.d)


def test_midpoint_and_prior_window_match_python(spark):
    pairs = [(RND.choice(DAYS), RND.choice(DAYS)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "s date, e date")
    ps, pe = D.prior_window("s", "e")
    for r in df.select("s", "e", D.midpoint("s", "e").alias("m"), ps.alias("ps"), pe.alias("pe")).collect():
        span = (r.e - r.s).days
        assert r.m == r.s + dt.timedelta(days=math.floor(span / 2))
        assert r.pe == r.s - dt.timedelta(days=1)
        assert r.ps == r.pe - dt.timedelta(days=span)


def test_et_date_matches_zoneinfo(spark):
    from zoneinfo import ZoneInfo

    utc, ny = dt.timezone.utc, ZoneInfo("America/New_York")
    start = dt.datetime(2015, 1, 1)
    stamps = [start + dt.timedelta(minutes=RND.randint(0, 12 * 365 * 24 * 60)) for _ in range(400)]
    # around every DST change of 2024-2026: 03:00-08:00 UTC on the changeover days
    for day in (dt.date(2024, 3, 10), dt.date(2024, 11, 3), dt.date(2025, 3, 9), dt.date(2025, 11, 2),
                dt.date(2026, 3, 8), dt.date(2026, 11, 1)):
        stamps += [dt.datetime.combine(day, dt.time(h, m)) for h in range(3, 9) for m in (0, 30)]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
    for r in df.select("t", D.et_date("t").alias("d")).collect():
        assert r.d == r.t.replace(tzinfo=utc).astimezone(ny).date(), r.t
