"""Versioned tables and incremental builds: an increment equals a build of everything."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from dealflow import jobs
from dealflow.plans import standins as S
from dealflow.plans.context import Models
from dealflow.sources.versions import VersionedTable

SF = "/root/testdata/sf0.001"
SCHEMA = "id bigint, amount double, day date"
D = dt.date


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, path, data):
    t = VersionedTable(spark, str(path), "day", "id")
    df = spark.createDataFrame(data, SCHEMA)
    return t, df


BASE = [(1, 1.0, D(2024, 1, 1)), (2, 2.0, D(2024, 1, 1)), (3, 3.0, D(2024, 1, 2)), (4, 4.0, None), (5, 5.0, D(2024, 1, 3)), (5, 5.0, D(2024, 1, 3)), (5, 6.0, D(2024, 1, 4))]


def test_publish_writes_only_days_that_differ(spark, tmp_path):
    t, df = table(spark, tmp_path / "t", BASE)
    one = t.publish(df)
    assert rows(t.read()) == rows(df) and set(one["days"]) == {"", "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"}
    assert t.publish(df.repartition(3)) == one and t.versions() == [1]  # the same rows: no new version
    changed = [(1, 1.0, D(2024, 1, 1)), (2, None, D(2024, 1, 1)), (4, 4.0, None), (5, 5.0, D(2024, 1, 3)), (5, 5.0, D(2024, 1, 3)), (5, 6.0, D(2024, 1, 4)), (9, 9.0, D(2024, 2, 1))]
    two = t.publish(spark.createDataFrame(changed, SCHEMA))
    assert rows(t.read()) == rows(spark.createDataFrame(changed, SCHEMA)) and rows(t.read(1)) == rows(df)
    same = {"", "2024-01-03", "2024-01-04"}
    assert {d for d, e in two["days"].items() if e["at"] == one["days"].get(d, {}).get("at")} == same
    # only rows without a day differ
    t.publish(spark.createDataFrame([r for r in changed if r[2]] + [(4, 44.0, None)], SCHEMA))
    assert rows(t.read().filter("day is null")) == [(4, 44.0, None)] and t.read().count() == len(changed)
    # a null that changes its column is a change, though hashing skips nulls
    swapped = spark.createDataFrame([(1, None, 1.0), (1, 1.0, None)], "id bigint, a double, b double")
    u = VersionedTable(spark, str(tmp_path / "u"), None, "id")
    u.publish(swapped.limit(1))
    u.publish(swapped.filter("a is not null"))
    assert u.versions() == [1, 2] and rows(u.read()) == [(1, 1.0, None)]


def test_merge_moves_drops_and_adds(spark, tmp_path):
    t, df = table(spark, tmp_path / "t", BASE)
    one = t.publish(df)
    # 1 moves to a day that was not there, 2 loses its day, 3 vanishes, 4 gets a day, 7 is new; 8 never was
    new = spark.createDataFrame([(1, 1.5, D(2024, 5, 1)), (2, 2.0, None), (4, 4.0, D(2024, 1, 1)), (7, 7.0, D(2024, 1, 4)), (5, 99.0, D(2024, 1, 3))], SCHEMA)
    keys = spark.createDataFrame([(1,), (2,), (3,), (4,), (7,), (8,), (1,)], "id bigint")
    two = t.merge(new, keys)
    want = [(1, 1.5, D(2024, 5, 1)), (2, 2.0, None), (4, 4.0, D(2024, 1, 1)), (7, 7.0, D(2024, 1, 4)), (5, 5.0, D(2024, 1, 3)), (5, 5.0, D(2024, 1, 3)), (5, 6.0, D(2024, 1, 4))]
    assert rows(t.read()) == rows(spark.createDataFrame(want, SCHEMA))
    assert "2024-01-02" not in two["days"] and two["days"]["2024-01-03"] == one["days"]["2024-01-03"]
    assert {d: (e["rows"], e["digest"]) for d, e in two["days"].items()} == {d: (e["rows"], e["digest"]) for d, e in t.digests(spark.createDataFrame(want, SCHEMA)).items()}
    assert t.merge(new, keys.filter("id = 8")) == two  # nothing to do
    with pytest.raises(ValueError):
        t.merge(new.withColumn("more", F.lit(1)), keys)
    # the last rows vanish
    t.merge(new, spark.range(10).withColumnRenamed("id", "id"))
    assert {r.id for r in t.read().collect()} == {1, 2, 4, 5, 7}
    t.merge(new.limit(0), spark.range(10))
    assert t.read().collect() == [] and t.read().columns == ["id", "amount", "day"]


def test_another_writer_and_vacuum(spark, tmp_path):
    t, df = table(spark, tmp_path / "t", BASE)
    one = t.publish(df)
    two = t.publish(df.filter("id < 5"))
    with pytest.raises(RuntimeError):  # version 2 is there: a writer that began from 1 has lost
        t._commit(one, df.schema, one["days"], {})
    assert t.manifest() == two
    os.makedirs(f"{tmp_path}/t/data/v=000009-dead")
    t.publish(df.filter("id < 3"))
    gone = t.vacuum(keep=1)
    assert "_versions/000001.json" in gone and "data/v=000009-dead" in gone and t.versions() == [3]
    assert rows(t.read()) == rows(df.filter("id < 3"))
    with pytest.raises(FileNotFoundError):
        t.read(1)


def test_a_second_session_reads_the_view(spark, tmp_path):
    t, df = table(spark, tmp_path / "t", BASE)
    t.publish(df)
    t.create_view("days_table", "versions_db")
    other = spark.newSession()
    assert rows(other.table("versions_db.days_table")) == rows(df)
    plan = other.sql("SELECT id FROM versions_db.days_table WHERE day = DATE '2024-01-02'")
    assert [r.id for r in plan.collect()] == [3] and "PartitionFilters: [isnotnull(day" in plan._jdf.queryExecution().executedPlan().toString()
    t.publish(df.filter("id <> 3"))
    t.create_view("days_table", "versions_db")
    assert rows(other.table("versions_db.days_table")) == rows(df.filter("id <> 3"))


# ---- increments of the marts

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
SINCE = dt.datetime(2002, 1, 1)


def land(spark, root, tables):
    for attr, name in jobs.LANDED_TABLES.items():
        tables[attr].write.mode("overwrite").parquet(f"{root}/{name}")


def graph(spark, root, lazy, as_of=S.AS_OF):
    return jobs.models_from_landing(spark, root, as_of=as_of, closers=lazy.closers, without_targets=True)


def touch(df, when, **new):
    """``df`` with some columns changed where ``when`` holds, and a new load time there."""
    for c, v in new.items():
        df = df.withColumn(c, F.when(when, v).otherwise(F.col(c)).cast(df.schema[c].dataType))
    return df.withColumn(jobs.LOADED, F.when(when, F.expr("TIMESTAMP_NTZ '2002-01-02 00:00:00'")).otherwise(F.col(jobs.LOADED)))


@pytest.fixture(scope="module")
def two_landings(spark, tmp_path_factory):
    """A landing, and one that is later: deals that moved, vanished, lost or got a day or changed their
    pipeline, calls with another outcome, links and contacts that changed."""
    a, b = (str(tmp_path_factory.mktemp(n)) for n in ("before", "after"))
    lazy = Models(spark, SF)
    land(spark, a, {n: getattr(lazy, n) for n in jobs.LANDED_TABLES})
    raw = {n: spark.read.parquet(f"{a}/{t}") for n, t in jobs.LANDED_TABLES.items()}
    i = F.col("deal_id")
    deals = touch(raw["raw_deal"], i % 23 == 1, property_closedate=F.expr("property_closedate + INTERVAL 9 DAY"), property_upsell_close_date=F.expr("property_upsell_close_date + INTERVAL 9 DAY"))
    deals = touch(deals, i % 23 == 2, _fivetran_deleted=F.lit(True))
    deals = touch(deals, i % 23 == 3, property_hs_v_2_date_entered_current_stage=F.lit(None))
    deals = touch(deals, i % 23 == 4, deal_pipeline_id=F.lit("0"))
    deals = touch(deals, i % 23 == 5, property_cash_collected=F.lit(77))
    e = F.col("engagement_id")
    meetings = touch(raw["raw_meeting"], e % 29 == 1, property_hs_meeting_outcome=F.lit("COMPLETED"))
    meetings = touch(meetings, e % 29 == 2, property_hs_meeting_outcome=F.lit("NO_SHOW"))
    meetings = touch(meetings, e % 29 == 3, _fivetran_deleted=F.lit(True))
    meetings = touch(meetings, e % 29 == 4, property_hs_meeting_start_time=F.lit(None))
    links = touch(raw["raw_engagement_deal"], e % 31 == 1, deal_id=F.col("deal_id") + 1)
    contacts = touch(raw["raw_contact"], F.col("id").cast("long") % 19 == 1, property_hs_lead_status=F.lit(lazy.cfg.test_lead_status))
    contact_links = touch(raw["raw_deal_contact"], i % 37 == 1, contact_id=F.lit(None))
    land(spark, b, {"raw_deal": deals, "raw_meeting": meetings, "raw_engagement_deal": links, "raw_deal_contact": contact_links, "raw_contact": contacts})
    return a, b, lazy


@pytest.fixture(scope="module")
def built(spark, two_landings, tmp_path_factory):
    """The marts of the first landing; each test works on a copy."""
    a, _, lazy = two_landings
    out = str(tmp_path_factory.mktemp("built") / "marts")
    jobs.build(graph(spark, a, lazy), out)
    return out


@pytest.mark.parametrize("as_of", [S.AS_OF, S.AS_OF + dt.timedelta(days=40)])
def test_increment_equals_a_build_of_everything(spark, two_landings, built, tmp_path, as_of):
    _, b, lazy = two_landings
    out, whole = str(tmp_path / "marts"), str(tmp_path / "whole")
    shutil.copytree(built, out)
    before = {n: jobs.mart(spark, out, n).manifest() for n in [*jobs.MARTS.values(), jobs.REPORT]}
    jobs.increment(graph(spark, b, lazy, as_of), out, SINCE)
    jobs.build(graph(spark, b, lazy, as_of), whole)
    for n, was in before.items():
        assert rows(jobs.read_mart(spark, out, n)) == rows(jobs.read_mart(spark, whole, n)), n
        assert rows(jobs.read_mart(spark, out, n, was["version"])) != rows(jobs.read_mart(spark, out, n)), n
        now, full = jobs.mart(spark, out, n).manifest(), jobs.mart(spark, whole, n).manifest()
        assert {d: e["digest"] for d, e in now["days"].items()} == {d: e["digest"] for d, e in full["days"].items()}
        if n in ("fct_renewal_cash", "fct_renewal_stage_entries"):
            assert any(now["days"].get(d) == e for d, e in was["days"].items()), f"{n}: every day was written anew"
    # exactly one bucket a deal, one first call a group
    snap = jobs.read_mart(spark, out, "fct_renewal_pipeline_snapshot")
    assert snap.count() == snap.select("deal_id").distinct().count()
    if as_of == S.AS_OF:  # the same landing again: no new version
        there = {n: jobs.mart(spark, whole, n).versions() for n in before}
        jobs.build(graph(spark, b, lazy, as_of), whole)
        assert {n: jobs.mart(spark, whole, n).versions() for n in before} == there


def test_a_new_dimension_builds_everything(spark, two_landings, built, tmp_path):
    _, b, lazy = two_landings
    out = str(tmp_path / "marts")
    shutil.copytree(built, out)
    m = graph(spark, b, lazy)
    few = m.fork(product_map=m.product_map.filter("upsell_plan <> 'x'").withColumn("product_column", F.lit("other")))
    jobs.increment(few, out, SINCE)
    assert {r.product_column for r in jobs.read_mart(spark, out, "fct_renewal_cash").select("product_column").distinct().collect()} <= {"other", "WINBACK", "UNMAPPED"}
