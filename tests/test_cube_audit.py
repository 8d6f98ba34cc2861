"""The day cube against the windowed metrics, the bucketed audit against the join, and paged extracts."""

import datetime as dt
import json
import os
import random

import pytest

from dealflow import config as C
from dealflow.functions.dates import WINDOW_PRESETS, window_dates
from dealflow.operators import cube as K
from dealflow.operators import metrics as MT
from dealflow.operators import reconcile as RC
from dealflow.plans import standins as S
from dealflow.plans.context import Models
from dealflow.sources import scans

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_every_preset_equals_the_windowed_metrics(spark):
    m = Models(spark, SF)
    cube = K.day_cube({"cash": m.cash, "won": m.won_fct, "meetings": m.meetings_fct, "entries": m.entries}, m.closers)
    got = {(r.window, r.closer_owner_id): r for r in K.preset_windows(cube, m.as_of, *S.WINDOW).collect()}
    assert len(got) == len(WINDOW_PRESETS) * 5
    fact = lambda df, *cols: spark.createDataFrame(df.select("closer_owner_id", *cols).collect(), df.select("closer_owner_id", *cols).schema)
    cash, won = fact(m.cash, "cash_date_et", "cash_amount"), fact(m.won_fct, "close_date_et", "is_post_webinar_close")
    for p in WINDOW_PRESETS:
        s, e = window_dates(p, m.as_of, *S.WINDOW)
        paid = {r.closer_owner_id: r.total_cash for r in MT.total_cash(cash, s, e).collect()}
        deals = {r.closer_owner_id: (r.deals_won, r.pwc_deals_won) for r in MT.deals_won(won, s, e).collect()}
        for (w, owner), r in got.items():
            if w == p:
                assert r.total_cash == paid.get(owner) and (r.deals_won, r.pwc_deals_won) == deals.get(owner, (0, 0)), (p, owner)


def test_cube_edges(spark):
    cash = spark.createDataFrame([("1", dt.date(2024, 1, 5), 0.1), ("1", dt.date(2024, 1, 6), 0.2), ("1", None, 9.0), ("1", dt.date(2024, 3, 1), 0.7), (None, dt.date(2024, 1, 5), 4.0)],
                                 "closer_owner_id string, cash_date_et date, cash_amount double")
    closers = spark.createDataFrame([("1", "a"), ("2", "b")], "owner_id string, closer_name string")
    cube = K.day_cube({"cash": cash}, closers)
    spans = {"jan": ("2024-01-01", "2024-01-31"), "day": ("2024-01-06", "2024-01-06"), "before": ("2023-01-01", "2023-12-31"), "gap": ("2024-02-01", "2024-02-10")}
    got = {(r.window, r.closer_owner_id): (r.payments, r.total_cash) for r in K.windows(cube, spans).collect()}
    assert got["jan", "1"] == (2, 0.3) and got["day", "1"] == (1, 0.2) and got["gap", "1"] == (0, None) and got["before", "1"] == (0, None)
    assert got["jan", "2"] == (0, None) and got["jan", None] == (1, 4.0)
    assert K.windows(K.day_cube({"cash": cash.limit(0)}, closers.limit(0)), spans).collect() == []


def test_bucketed_audit_equals_the_join(spark):
    r = random.Random(4)
    ids = [(m, str(i)) for m in ("x", "y") for i in range(3000)]
    a = [t for t in ids if r.random() > 0.002] + ids[:3] + [("x", None)]
    b = [t for t in ids if r.random() > 0.002] + [("z", "1")]
    a, b = (spark.createDataFrame(x, "metric_id string, id string") for x in (a, b))
    want = {tuple(x) for x in RC.audit_diff(a, b, by=["metric_id"]).collect()}
    for buckets in (1, 64, 4096):
        got = RC.audit_diff_by_bucket(a, b, by=["metric_id"], buckets=buckets)
        assert {tuple(x) for x in got.collect()} == want
    assert RC.audit_diff_by_bucket(a, a.distinct().limit(0), by=["metric_id"]).count() == a.distinct().count()
    assert RC.audit_diff_by_bucket(a, a.repartition(3), by=["metric_id"]).collect() == []
    plan = RC.audit_diff_by_bucket(a, b, by=["metric_id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_a_rule_without_its_bound_is_an_error(spark):
    df = spark.createDataFrame([("1", dt.date(2024, 1, 1))], "hubspot_owner_id string, d date")
    with pytest.raises(ValueError, match="start"):
        RC.filter_sql(df, [RC.f("d", "GTE", RC.Bound.START)])
    assert RC.filter_sql(df, [RC.f("hubspot_owner_id", "EQ", RC.Bound.OWNER)]) == "true"


def test_paged_extract(spark, tmp_path):
    records = [{"id": str(i), "properties": {"dealstage": f"s{i % 3}", "amount": "x" if i == 4 else str(i * 1.5), "nested": None}} for i in range(25)]

    def land(name, pages, total=25):
        d = tmp_path / name
        d.mkdir()
        for k, own in enumerate(pages):
            page = {"results": own, "total": total} | ({"paging": {"next": {"after": str(k + 1)}}} if k < len(pages) - 1 else {})
            (d / f"page-{k:04d}.json").write_text(json.dumps(page, indent=1))
        return str(d)

    split = [records[:10], records[10:20], records[20:]]
    got = scans.paged_extract(spark, land("whole", split), ["dealstage", "amount", "missing"], {"amount": "double"})
    assert got.count() == 25 and {r.id: r.amount for r in got.collect()} == {str(i): None if i == 4 else i * 1.5 for i in range(25)}
    assert {r.dealstage for r in got.collect()} == {"s0", "s1", "s2"} and {r.missing for r in got.collect()} == {None}
    for name, pages, total in (("short", split[:2], 25), ("twice", [*split[:2], records[10:20]], 30), ("moved", split, 26)):
        with pytest.raises(scans.IncompleteExtract):
            scans.paged_extract(spark, land(name, pages, total), ["dealstage"])
    os.remove(f"{tmp_path}/whole/page-0002.json")
    with pytest.raises(scans.IncompleteExtract):
        scans.paged_extract(spark, str(tmp_path / "whole"), ["dealstage"])
    assert scans.other_side(got, ["dealstage"]).columns == ["id", "dealstage"]


def test_bucketed_audit_reads_unions_no_oftener_than_tables(spark, tmp_path):
    """Sums of both sides aren't computed anew for every branch of a side's union."""
    for name in "abcd":
        spark.createDataFrame([(f"m{i % 2}", f"{name}{i}") for i in range(20)], "metric_id string, id string").write.parquet(str(tmp_path / name))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    diff = RC.audit_diff_by_bucket(read("a").unionByName(read("b")), read("c").unionByName(read("d")), by=["metric_id"])
    plan = diff._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 4 + 2 * 4  # four for the ids, four for each side's list of buckets
    assert diff.count() == 80


def test_audit_ids_drops_rows_before_it_generates(spark):
    """Rows that no metric counts don't reach the generator; days are read as before."""
    deals = spark.createDataFrame([("1", C.OLD_RENEWAL_PIPELINE_ID, "175346331", "1", "2024-01-05T00:00:00Z", None), ("2", C.OLD_RENEWAL_PIPELINE_ID, "175346331", "1", "2024-1-5", None),
                                   ("3", C.OLD_RENEWAL_PIPELINE_ID, "1", "1", "2024-01-05", None), ("4", C.WINBACK_PIPELINE_ID, "1401758776", None, "2024-01-31 ", None)],
                                  "id string, pipeline string, dealstage string, hubspot_owner_id string, upsell___close_date string, renewal_traffic_source string")
    calls = spark.createDataFrame([("7", "Renewal 3 Month", "COMPLETED", "1", "2024-01-05T12:00:00Z"), ("8", "Renewal 3 Month", "NO_SHOW", "1", "2024-01-05T12:00:00Z"),
                                   ("9", "Renewal Post Webinar Call", "COMPLETED", None, "2024-02-01T03:00:00Z")],
                                  "id string, hs_activity_type string, hs_meeting_outcome string, hubspot_owner_id string, hs_meeting_start_time string")
    won = spark.createDataFrame([], "deal_id long, close_date_et date")
    mine = spark.createDataFrame([], "meeting_id long, meeting_category string, meeting_date_et date, is_completed boolean")
    _, theirs = RC.audit_ids(won, mine, deals, calls, "2024-01-01", "2024-01-31")
    assert sorted(map(tuple, theirs.collect())) == [("deals_won", "1"), ("deals_won", "4"), ("pc_completed", "7"), ("pwc_completed", "9")]
