"""Batch jobs over a real CRM landing: build the models, check quality, reconcile.

The landing folder holds the landed tables under their warehouse names (``DEAL``,
``ENGAGEMENT_MEETING``, ``ENGAGEMENT_DEAL``, ``DEAL_CONTACT``, ``CONTACT``), in any format
Spark reads. The roster, stage, product and tier dimensions default to the packaged seeds.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.config import DEFAULT, PipelineConfig
from dealflow.functions.dates import ntz_lit, window_dates
from dealflow.operators import quality as Q
from dealflow.operators import reconcile as RC
from dealflow.operators import staging as ST
from dealflow.plans.context import Models
from dealflow.sources import dims, scans
from dealflow.sources.versions import VersionedTable, digest_columns

LANDED_TABLES = {
    "raw_deal": "DEAL",
    "raw_meeting": "ENGAGEMENT_MEETING",
    "raw_engagement_deal": "ENGAGEMENT_DEAL",
    "raw_deal_contact": "DEAL_CONTACT",
    "raw_contact": "CONTACT",
}
MARTS = {"cash": "fct_renewal_cash", "won_fct": "fct_renewal_won_deals", "meetings_fct": "fct_renewal_meetings",
         "entries": "fct_renewal_stage_entries", "snapshot": "fct_renewal_pipeline_snapshot"}
REPORT = "rpt_renewal_closer_dashboard"
CHECKS = "checks"
LOADED = "_fivetran_synced"
# (date column, row key) per mart: rows are filed by the date, so window filters prune whole
# folders; they are range-partitioned on (date, key) before the write, so each task writes few
# dates and a hot day is spread over several tasks.
PARTITIONING = {"cash": ("cash_date_et", "deal_id"), "won_fct": ("close_date_et", "deal_id"),
                "meetings_fct": ("meeting_date_et", "meeting_id"), "entries": ("entry_date_et", "deal_id"),
                "snapshot": ("entry_date_et", "deal_id")}


def landing(spark: SparkSession, landing_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {k: spark.read.format(fmt).load(f"{landing_dir}/{v}") for k, v in LANDED_TABLES.items()}


def models_from_landing(spark: SparkSession, landing_dir: str, as_of: _dt.date | None = None,
                        cfg: PipelineConfig = DEFAULT, fmt: str = "parquet", targets_table: str | None = None,
                        closers: DataFrame | None = None, without_targets: bool = False) -> Models:
    """The model graph over a landing. Goals come from ``targets_table``; a report without goals
    must be asked for by ``without_targets``."""
    if (targets_table is None) != without_targets:
        raise ValueError("give targets_table, or without_targets=True for a report without goals")
    src = landing(spark, landing_dir, fmt)
    src["closers"] = closers if closers is not None else dims.load_dim(spark, "dim_closers")
    src["stages"] = dims.load_dim(spark, "dim_renewal_stages")
    src["product_map"] = dims.load_dim(spark, "dim_product_map")
    src["tier_map"] = dims.load_dim(spark, "dim_member_tier_map")
    src["targets"] = spark.createDataFrame([], dims.TARGETS_SCHEMA) if without_targets else dims.targets(spark, targets_table)
    return Models(spark, None, as_of or scans.today_et(), cfg, sources=src)


def freshness(spark: SparkSession, landing_dir: str, now: _dt.datetime, fmt: str = "parquet") -> DataFrame:
    """S6 over the landed tables: (source, max_loaded_at, age_hours, status)."""
    return scans.freshness({LANDED_TABLES[k]: df for k, df in landing(spark, landing_dir, fmt).items()}, now)


def mart(spark: SparkSession, out_dir: str, name: str) -> VersionedTable:
    """The published mart or report ``name`` under ``out_dir``."""
    if name in (REPORT, CHECKS):
        return VersionedTable(spark, f"{out_dir}/{name}", None, "closer_owner_id" if name == REPORT else "check")
    day, key = PARTITIONING[next(a for a, n in MARTS.items() if n == name)]
    return VersionedTable(spark, f"{out_dir}/{name}", day, key)


def read_mart(spark: SparkSession, out_dir: str, name: str, version: int | None = None) -> DataFrame:
    return mart(spark, out_dir, name).read(version)


def _facts(models: Models) -> dict:
    """What marts depend on besides the landed rows: the run's day, the configuration and the
    dimensions, which are small and whole in every build."""
    dims_ = {}
    for n in ("closers", "stages", "product_map", "tier_map"):
        df = getattr(models, n)
        r = df.agg(*digest_columns(df)).collect()[0]
        dims_[n] = f"{r['rows']},{r['one']},{r['two']}"
    return {"as_of": str(models.as_of), "config": repr(models.cfg), "dimensions": dims_}


class _Stage:
    """A scratch folder below ``out_dir`` that goes with the build."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.root = spark, f"{out_dir}/_stage/{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


class TestsFailed(RuntimeError):
    """Tests of severity error found rows: nothing was published."""


def build(models: Models, out_dir: str, partitions: int | None = None, database: str | None = None, tests: bool = False) -> dict[str, str]:
    """Publish the marts and the report as versioned tables (``mart``); returns name -> folder.

    The models are computed once, as tables in a folder that is deleted at the end. Each mart is filed
    by its date column (``PARTITIONING``); days whose rows did not change keep their files, so
    building again writes only what differs. ``partitions`` sets the number of write tasks
    (default: the session's shuffle partitions, adjusted by AQE). With ``database`` each is also a
    view there, which other sessions find. With ``tests`` the models are tested while they are
    written; the results are published as ``checks``, and where a test of severity error finds rows
    no mart is published (``TestsFailed``)."""
    spark, facts = models.spark, _facts(models)
    with _Stage(spark, out_dir) as stage:
        staged = models.fork()
        if tests:
            checks = stage.write(Q.staged_checks(staged, stage.root), "checks")
            VersionedTable(spark, f"{out_dir}/{CHECKS}", None, "check").publish(checks, facts)
            if bad := checks.filter("severity = 'error' and failing_rows > 0").collect():
                raise TestsFailed("; ".join(f"{r['check']}: {r['failing_rows']}" for r in bad))
        else:
            staged.materialize(stage.root)
        for attr, name in MARTS.items():
            mart(spark, out_dir, name).publish(getattr(staged, attr), facts, partitions)
    return _publish_report(models, out_dir, facts, database)


def _publish_report(models: Models, out_dir: str, facts: dict, database: str | None) -> dict[str, str]:
    """The report from the published marts, and all of them in the catalog."""
    spark = models.spark
    at = {a: read_mart(spark, out_dir, n) for a, n in MARTS.items()}
    report = models.fork(cash=at["cash"], won=at["won_fct"], meetings_fct=at["meetings_fct"]).report()
    mart(spark, out_dir, REPORT).publish(report, facts)
    names = [*MARTS.values(), REPORT]
    if database is not None:
        for n in names:
            mart(spark, out_dir, n).create_view(n, database)
    return {n: f"{out_dir}/{n}" for n in names}


def changed_keys(models: Models, published_meetings: DataFrame, since: _dt.datetime, stage) -> tuple[DataFrame, DataFrame]:
    """(deal_id), (meeting_id) whose mart rows may differ from the published ones, by the landed rows
    loaded at or after ``since`` (or without a load time).

    A deal changes with its row, its contact links and their contacts. A meeting changes with its
    row, its deal links, and the pipeline of a linked deal; then every meeting of the deals that
    such a meeting is, or was, linked to, because the first call among them may be another."""
    def recent(df: DataFrame) -> DataFrame:
        t = scans.optional_col(df, LOADED, "timestamp_ntz")
        return df.filter(t.isNull() | (t >= ntz_lit(since)))

    links, contact_links = models.raw_engagement_deal, models.raw_deal_contact
    contacts = recent(models.raw_contact).select(F.col("id").cast("string").alias("__contact")).distinct()
    by_contact = contact_links.join(contacts, F.col("contact_id").cast("string") == F.col("__contact"), "left_semi")
    own = recent(models.raw_deal).select(F.col("deal_id").cast("long").alias("deal_id"))
    linked = recent(contact_links).unionByName(by_contact).select(F.col("deal_id").cast("long").alias("deal_id"))
    # Soft-deleted rows are rows here: they have a new load time, and their deals' rows vanish.
    deals = stage.write(own.unionByName(linked).filter("deal_id is not null").distinct(), "changed_deals")
    meeting = lambda df: df.select(F.col("engagement_id").cast("long").alias("meeting_id"))
    of_deals = links.join(own.distinct(), links["deal_id"].cast("long") == own["deal_id"], "left_semi")
    first = stage.write(meeting(recent(models.raw_meeting)).unionByName(meeting(recent(links))).unionByName(meeting(of_deals))
                        .filter("meeting_id is not null").distinct(), "changed_meetings")
    now = ST.one_deal_per_meeting(links.join(first, links["engagement_id"].cast("long") == first["meeting_id"], "left_semi"), models.deals, models.cfg)
    was = published_meetings.join(first, "meeting_id", "left_semi")
    around = now.select("deal_id").unionByName(was.select("deal_id")).filter("deal_id is not null").distinct()
    same_deal = published_meetings.join(around, "deal_id", "left_semi").select("meeting_id")
    return deals, stage.write(first.unionByName(same_deal).distinct(), "touched_meetings")


def increment(models: Models, out_dir: str, since: _dt.datetime, partitions: int | None = None, database: str | None = None) -> dict[str, str]:
    """Bring published marts up to date with the landed rows loaded at or after ``since``: the rows of the
    deals and meetings that these touch are computed, and merged by key. The result equals a build
    of everything, whether rows changed, moved to another day, lost their day or vanished; only
    rows that were deleted from the landing without a trace need a ``build``, as do marts that were
    never built.

    Where the dimensions or the configuration differ from the published ones all is built, and where
    the run's day differs the snapshot is, as its due buckets depend on it."""
    spark, facts = models.spark, _facts(models)
    tables = {a: mart(spark, out_dir, n) for a, n in MARTS.items()}
    had = {a: t.manifest() for a, t in tables.items()}
    base = lambda f: {k: v for k, v in f.items() if k != "as_of"}
    if any(m is None or base(m["facts"]) != base(facts) for m in had.values()):
        return build(models, out_dir, partitions, database)
    with _Stage(spark, out_dir) as stage:
        deals, meetings = changed_keys(models, tables["meetings_fct"].read(), since, stage)
        only = lambda df, col, keys, key: df.join(keys, df[col].cast("long") == keys[key], "left_semi")
        by_deal = models.fork(raw_deal=only(models.raw_deal, "deal_id", deals, "deal_id"), raw_deal_contact=only(models.raw_deal_contact, "deal_id", deals, "deal_id"))
        by_meeting = models.fork(raw_meeting=only(models.raw_meeting, "engagement_id", meetings, "meeting_id"),
                                 raw_engagement_deal=only(models.raw_engagement_deal, "engagement_id", meetings, "meeting_id"))
        for attr, t in tables.items():
            if attr == "snapshot" and had[attr]["facts"] != facts:
                t.publish(stage.write(models.fork().snapshot, "snapshot"), facts, partitions)
            else:
                graph, keys = (by_meeting, meetings) if attr == "meetings_fct" else (by_deal, deals)
                t.merge(stage.write(getattr(graph, attr), attr), keys, facts, partitions)
    return _publish_report(models, out_dir, facts, database)


def quality(models: Models) -> DataFrame:
    """All column tests and singular tests as one (check, severity, failing_rows) table."""
    return Q.model_checks(models)


def reconcile(models: Models, other_deals: DataFrame, other_meetings: DataFrame, window: str = "yesterday",
              owner: str | None = None, metric_ids=None, start=None, end=None) -> DataFrame:
    """R4 / R5 over a window preset; ``owner`` narrows the output to one closer (team row
    otherwise), ``metric_ids`` to the requested metrics (their dependencies stay hidden)."""
    s, e = window_dates(window, models.as_of, start, end)
    defs = RC.snapshot_metrics_defs(dims.seed_rows("dim_renewal_stages"))
    metrics = RC.BASE_METRICS + defs
    cols = [d.id.split(".", 1)[1] for d in defs]
    al = RC.aligned_sides(models.cash, models.won_fct, models.meetings_fct, models.snapshot, other_deals, other_meetings, models.closers, metrics,
                          s.isoformat(), e.isoformat(), snapshot_cols=cols)
    out = RC.reconcile(None, None, metrics, requested=metric_ids, aligned=al)
    own = F.col("owner_id")
    out = out.filter(own.isNull() if owner is None else own == F.lit(str(owner)))
    return out.withColumn("window_start", F.lit(s)).withColumn("window_end", F.lit(e))


def audit(models: Models, other_deals: DataFrame, other_meetings: DataFrame, metric_id: str,
          window: str = "yesterday", owner: str | None = None, start=None, end=None) -> DataFrame:
    """R6 for one metric: ids on one side only, as (side, id) rows sorted."""
    if metric_id not in RC.AUDIT_SUPPORTED:
        raise ValueError(f"audit not wired for {metric_id!r}; supported: {RC.AUDIT_SUPPORTED}")
    s, e = window_dates(window, models.as_of, start, end)
    own = lambda df, col: df if owner is None else df.filter(F.col(col) == str(owner))
    a, b = RC.audit_ids(own(models.won_fct, "closer_owner_id"), own(models.meetings_fct, "closer_owner_id"),
                        own(other_deals, RC.OWNER_PROP), own(other_meetings, RC.OWNER_PROP), s, e)
    one = F.col("metric_id") == metric_id
    return RC.sorted_diff(RC.audit_diff(a.filter(one), b.filter(one)))


def write(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """S8 / S9 with the R8 allow-list."""
    scans.write_report(RC.assert_no_pii(df), path, fmt)

