"""The batch jobs on a real-shaped landing folder give the same facts as the registry."""

import datetime as dt
import os

import pytest

from dealflow import jobs
from dealflow.plans import standins as S
from dealflow.plans.context import Models

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    lazy = Models(spark, SF)
    for attr, name in jobs.LANDED_TABLES.items():
        getattr(lazy, attr).write.parquet(f"{root}/{name}")
    return root, lazy


def test_models_from_landing_equal_stand_in_models(spark, landed):
    root, lazy = landed
    m = jobs.models_from_landing(spark, root, as_of=S.AS_OF, closers=lazy.closers, without_targets=True)
    for attr in ("cash", "won_fct", "meetings_fct", "entries", "snapshot"):
        a = sorted(map(tuple, getattr(m, attr).collect()), key=str)
        b = sorted(map(tuple, getattr(lazy, attr).collect()), key=str)
        assert a == b, attr


def test_build_quality_reconcile_audit(spark, landed, tmp_path):
    root, lazy = landed
    m = jobs.models_from_landing(spark, root, as_of=S.AS_OF, closers=lazy.closers, without_targets=True)
    out = str(tmp_path / "marts")
    jobs.build(m, out)
    assert jobs.read_mart(spark, out, jobs.REPORT).count() == 5
    assert not os.listdir(f"{out}/_stage")  # nothing of the staged models is left
    from pyspark.sql import functions as F

    cash = jobs.read_mart(spark, out, "fct_renewal_cash")
    win = cash.filter(F.col("cash_date_et").between(*S.WINDOW))
    plan = win._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cash_date_et" in plan
    lazy_win = m.cash.filter(F.col("cash_date_et").between(*S.WINDOW))
    assert sorted(map(tuple, win.select(*lazy_win.columns).collect()), key=str) == \
        sorted(map(tuple, lazy_win.collect()), key=str)
    q = {r.check: r.failing_rows for r in jobs.quality(m).collect()}
    assert q["first call dedup"] == 0 and q["deals.deal_id unique"] == 0
    od = S.other_deals(spark, SF, lazy.raw_deal)
    om = S.other_meetings(spark, SF, lazy.raw_meeting)
    rep = jobs.reconcile(m, od, om, window="custom", start=S.WINDOW[0], end=S.WINDOW[1],
                         metric_ids=["deals_won", "rc_close_pct"])
    rows = {r.metric_id: r for r in rep.collect()}
    assert set(rows) == {"deals_won", "rc_close_pct"} and all(r.owner_id is None for r in rows.values())
    jobs.write(rep.drop("caveats"), str(tmp_path / "rep"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "rep")).count() == 2
    diff = jobs.audit(m, od, om, "deals_won", window="custom", start=S.WINDOW[0], end=S.WINDOW[1])
    assert {r.side for r in diff.collect()} <= {"missing_in_other", "extra_in_other"}


def test_landing_graph_materializes_models_only(spark, landed, tmp_path):
    root, lazy = landed
    m = jobs.models_from_landing(spark, root, as_of=S.AS_OF, closers=lazy.closers, without_targets=True)
    out = m.materialize(str(tmp_path / "tables"))
    assert not os.path.exists(f"{out}/raw_deal") and os.path.exists(f"{out}/cash/_SUCCESS")
    with pytest.raises(ValueError):
        m.fingerprint()
    a = sorted(map(tuple, m.snapshot.collect()), key=str)
    b = sorted(map(tuple, lazy.snapshot.collect()), key=str)
    assert a == b


def test_targets_are_asked_for_and_freshness_covers_the_landing(spark, landed):
    root, lazy = landed
    with pytest.raises(ValueError):
        jobs.models_from_landing(spark, root, closers=lazy.closers)
    got = {r.source: r.status for r in jobs.freshness(spark, root, S.LOOKED_AT).collect()}
    assert got == {"DEAL": "pass", "ENGAGEMENT_MEETING": "warn", "ENGAGEMENT_DEAL": "pass", "DEAL_CONTACT": "error", "CONTACT": "pass"}


def test_window_dates():
    assert jobs.window_dates("mtd", dt.date(2026, 3, 1)) == (dt.date(2026, 2, 1), dt.date(2026, 2, 28))
    assert jobs.window_dates("last7d", dt.date(2026, 8, 17)) == (dt.date(2026, 8, 10), dt.date(2026, 8, 16))
    with pytest.raises(ValueError):
        jobs.window_dates("custom", dt.date(2026, 8, 17))
