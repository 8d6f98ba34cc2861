"""Lazily built model graph over the stand-in tables of one scale-factor directory.

Each property is a lazy DataFrame; nothing runs until an action. The graph mirrors the
warehouse layers: raw -> staging -> intermediate -> facts -> report.
"""

from __future__ import annotations

import hashlib
import os
import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from dealflow.config import DEFAULT, PipelineConfig
from dealflow.operators import models as M
from dealflow.operators import report as R
from dealflow.operators import staging as ST
from dealflow.plans import standins as S


# Tables written by ``materialize``, in dependency levels: the tables of one level only read
# tables of earlier levels, so each level is written by concurrent jobs.
LEVELS = (
    ("raw_deal", "raw_meeting", "raw_engagement_deal", "raw_deal_contact", "raw_contact"),
    ("deals", "stg_meetings", "contact_flags"),
    ("meeting_deals", "won", "entries", "snapshot"),
    ("cash", "won_fct", "meetings"),
    ("meetings_fct",),
)
LANDED = LEVELS[0]
MODELS = tuple(n for level in LEVELS[1:] for n in level)
# Date column each table is clustered on inside its files (row-group min/max pruning).
CLUSTER_BY = {"cash": "cash_date_et", "won": "close_date_et", "won_fct": "close_date_et",
              "meetings": "meeting_date_et", "meetings_fct": "meeting_date_et", "entries": "entry_date_et",
              "snapshot": "entry_date_et"}
INPUTS = ("orders", "lineitem", "events", "customer", "nation")
FORMAT_VERSION = "1"


def _fs_status(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_status(spark, path)
    return fs.exists(p)


def session_key(spark: SparkSession) -> tuple:
    """Identifies a live session: a new SparkContext has a new application id."""
    return (spark.sparkContext.applicationId, id(spark._jsparkSession))


CODE = ("dealflow", "dealflow.functions", "dealflow.operators", "dealflow.plans", "dealflow.sources")


def code_hash() -> str:
    """A hash of the code and seeds that tables are made by, read through the package loader, so
    that a zip works too."""
    import pkgutil
    from importlib import import_module, resources

    h = hashlib.sha1()
    for package in map(import_module, CODE):
        for name in sorted(m.name for m in pkgutil.iter_modules(package.__path__) if not m.ispkg):
            h.update((import_module(f"{package.__name__}.{name}").__spec__.loader.get_source(f"{package.__name__}.{name}") or "").encode())
    for f in sorted(resources.files("dealflow.sources").joinpath("seeds").iterdir(), key=lambda f: f.name):
        h.update(f.name.encode() + f.read_bytes())
    return h.hexdigest()


class Models:
    _cache: dict = {}
    _lock = threading.Lock()

    def __init__(self, spark: SparkSession, sf_dir: str | None, as_of=S.AS_OF, cfg: PipelineConfig = DEFAULT,
                 sources: dict | None = None):
        """``sources`` overrides any node by name (e.g. real landed ``raw_deal`` ... tables,
        the real roster as ``closers``, ``targets``); without it the stand-ins derived from
        the driver tables in ``sf_dir`` are used."""
        self.spark, self.sf_dir, self.as_of, self.cfg = spark, sf_dir, as_of, cfg
        self.materialized_at: str | None = None
        self.given = frozenset(sources or {})
        for name, df in (sources or {}).items():
            self.__dict__[name] = df

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, as_of=S.AS_OF, cfg: PipelineConfig = DEFAULT,
           materialize: bool = False) -> "Models":
        """One model graph per (live session, data dir, as_of, config).

        DataFrames are immutable descriptions of work, so queries of one session share
        them. Everything is a lazy view over the given tables; with ``materialize`` the
        landed tables and the models are first written as parquet tables in the session's
        shared checkpoint folder and read from there, the way the warehouse serves its marts.
        """
        key = session_key(spark) + (sf_dir, as_of, cfg, materialize)
        with cls._lock:
            m = cls._cache.get(key)
            if m is None:
                # Graphs of sessions that were stopped go, and beyond a few the oldest.
                cls._cache = {k: v for k, v in list(cls._cache.items())[-15:] if v.spark.sparkContext._jsc is not None}
                m = cls(spark, sf_dir, as_of, cfg)
                if materialize:
                    m.materialize()
                cls._cache[key] = m
        return m

    def fork(self, **nodes) -> "Models":
        """A graph of its own over the same inputs, with ``nodes`` put in place of its inputs; nodes of
        this graph that depend on others are built anew there, unless none of their inputs changed."""
        out = Models(self.spark, self.sf_dir, self.as_of, self.cfg, sources={n: self.__dict__[n] for n in self.given})
        if not nodes:
            out.__dict__.update({n: df for n, df in self.__dict__.items() if isinstance(df, DataFrame)})
        out.__dict__.update(nodes)
        out.given = out.given | frozenset(nodes)
        return out

    def fingerprint(self) -> str:
        """Inputs (path, size, modification time), as_of, config, format version and a hash
        of this package's code and seeds (a code change never reuses old tables)."""
        parts = [FORMAT_VERSION, code_hash(), str(self.sf_dir), str(self.as_of), repr(self.cfg)]
        if self.sf_dir is None:
            raise ValueError("a graph over given tables has no fingerprint: name the folder to write to")
        paths = [f"{self.sf_dir}/{name}.parquet" for name in INPUTS]
        for path in paths:
            fs, p = _fs_status(self.spark, path)
            st = fs.getContentSummary(p)
            parts.append(f"{path}:{st.getLength()}:{fs.getFileStatus(p).getModificationTime()}")
        return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]

    def materialize(self, root: str | None = None, levels: int = len(LEVELS), tests: bool = False):
        """Write landed tables and models once (skipped when already written for the same
        inputs), or the first ``levels`` of them, and re-point this graph at them; returns the folder. Writes go
        through the job commit protocol, so a lost executor only retries its tasks; a table
        counts as present only once its ``_SUCCESS`` marker exists.

        With ``tests`` the declared row-level tests of each table are counted while it is written (or
        in one aggregate, where it is there already) and returned instead: {table: {test: rows}}."""
        from dealflow.operators import quality as Q
        from dealflow.session import ensure_checkpoint_dir

        counted: dict[str, dict] = {}
        root = root or os.path.join(ensure_checkpoint_dir(self.spark), "dealflow-tables", self.fingerprint())

        def write(name: str) -> None:
            if name in self.given:  # already a table (e.g. a real landing)
                return
            path = f"{root}/{name}"
            if not exists(self.spark, f"{path}/_SUCCESS"):
                df = getattr(self, name)
                if name in CLUSTER_BY:
                    df = df.sortWithinPartitions(CLUSTER_BY[name])
                df, seen = Q.observed(name, df) if tests else (df, None)
                df.write.mode("overwrite").parquet(path)
                if seen is not None:
                    counted[name] = seen.get
            elif tests and (aggs := Q.row_tests(name)):
                counted[name] = self.spark.read.parquet(path).agg(*aggs).collect()[0].asDict()

        from concurrent.futures import ThreadPoolExecutor

        for shared in ("closers", "stages", "product_map", "tier_map"):  # built once, before the threads
            getattr(self, shared)
        for level in LEVELS[:levels]:
            with ThreadPoolExecutor(max_workers=len(level)) as pool:
                list(pool.map(write, level))
            for name in level:
                if name not in self.given:
                    self.__dict__[name] = self.spark.read.parquet(f"{root}/{name}")
        self.materialized_at = root
        return counted if tests else root

    # second system (reconciliation)
    @cached_property
    def other_deals(self) -> DataFrame:
        return S.other_deals(self.spark, self.sf_dir, self.raw_deal)

    @cached_property
    def other_meetings(self) -> DataFrame:
        return S.other_meetings(self.spark, self.sf_dir, self.raw_meeting)

    # raw landed tables (stand-ins)
    @cached_property
    def raw_deal(self) -> DataFrame:
        return S.raw_deal(self.spark, self.sf_dir)

    @cached_property
    def raw_meeting(self) -> DataFrame:
        return S.raw_meeting(self.spark, self.sf_dir)

    @cached_property
    def raw_engagement_deal(self) -> DataFrame:
        return S.raw_engagement_deal(self.spark, self.sf_dir)

    @cached_property
    def raw_deal_contact(self) -> DataFrame:
        return S.raw_deal_contact(self.spark, self.sf_dir)

    @cached_property
    def raw_contact(self) -> DataFrame:
        return S.raw_contact(self.spark, self.sf_dir)

    # dimensions
    @cached_property
    def closers(self) -> DataFrame:
        return S.closers(self.spark, self.sf_dir)

    @cached_property
    def targets(self) -> DataFrame:
        return S.targets(self.spark, self.sf_dir)

    @cached_property
    def stages(self) -> DataFrame:
        return S.stages(self.spark)

    @cached_property
    def product_map(self) -> DataFrame:
        return S.product_map(self.spark)

    @cached_property
    def tier_map(self) -> DataFrame:
        return S.tier_map(self.spark)

    # staging
    @cached_property
    def deals(self) -> DataFrame:
        return ST.stage_deals(self.raw_deal, self.cfg)

    @cached_property
    def stg_meetings(self) -> DataFrame:
        return ST.stage_meetings(self.raw_meeting)

    @cached_property
    def meeting_deals(self) -> DataFrame:
        return ST.one_deal_per_meeting(self.raw_engagement_deal, self.deals, self.cfg)

    @cached_property
    def contact_flags(self) -> DataFrame:
        return ST.contact_flags(self.raw_deal_contact, self.raw_contact, self.cfg)

    # intermediate
    @cached_property
    def won(self) -> DataFrame:
        return M.won_deals(self.deals, self.closers, self.cfg)

    @cached_property
    def deal_cash(self) -> DataFrame:
        return M.deal_cash(self.won, self.cfg)

    @cached_property
    def meetings(self) -> DataFrame:
        return M.meetings(self.stg_meetings, self.meeting_deals, self.closers, self.cfg)

    # facts
    @cached_property
    def cash(self) -> DataFrame:
        return M.fct_cash(self.won, self.product_map, self.tier_map, self.closers, self.cfg,
                          extra=("renewal_product", "renewal_pipeline_type"))

    @cached_property
    def won_fct(self) -> DataFrame:
        return M.fct_won_deals(self.won, self.closers, self.cfg)

    @cached_property
    def meetings_fct(self) -> DataFrame:
        return M.fct_meetings(self.meetings, self.closers, self.cfg)

    @cached_property
    def entries(self) -> DataFrame:
        return M.fct_stage_entries(self.deals, self.closers, self.contact_flags, self.cfg)

    @cached_property
    def snapshot(self) -> DataFrame:
        return M.fct_pipeline_snapshot(self.deals, self.contact_flags, self.stages, self.closers, self.as_of, self.cfg)

    def report(self, extended: bool = False, first_only: bool = False) -> DataFrame:
        return R.closer_report(self.cash, self.won, self.meetings_fct, self.targets, self.closers, self.as_of,
                               self.cfg, first_only=first_only, extended=extended)
