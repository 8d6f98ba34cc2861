"""Data-quality checks (Q1-Q6, plus the unmapped-stage and normalised-key checks the
reference lacks). Each check returns its offending rows as a lazy DataFrame; ``run_checks``
turns a list of them into one ``(check, severity, failing_rows)`` summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow import config as C

# Outcome values known to occur (warn-level accepted values).
KNOWN_OUTCOMES = ("COMPLETED", "COMPLETED - NURTURE", "COMPLETED - QUALIFIED", "COMPLETED - DQ", "CANCELED",
                  "CANCELLED", "NO_SHOW", "RESCHEDULED", "SCHEDULED")
MEETING_CATEGORIES = ("PC", "RC", "PWC", "WB")
STAGE_ENTRY_TYPES = ("pc_invited", "pc_scheduled", "rc_invited", "rc_scheduled")


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Q1: key values occurring more than once (NULLs ignored)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str, keep=None) -> DataFrame:
    """Q2: rows whose ``col`` is NULL, with the columns ``keep`` (all)."""
    bad = df.filter(F.col(col).isNull())
    return bad if keep is None else bad.select(*keep)


def check_values(df: DataFrame, col: str, values) -> DataFrame:
    """Q3 / Q4: values outside the accepted list (NULL is not a violation)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def groups_where(df: DataFrame, keys, condition, having, n: str = "n", hits: str = "hits") -> DataFrame:
    """Groups by ``keys`` with their rows ``n`` and the rows ``hits`` that meet ``condition``,
    where ``having(n, hits)`` holds."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.count_if(condition).alias(hits))
    return g.filter(having(F.col(n), F.col(hits)))


def check_first_call(meetings: DataFrame) -> DataFrame:
    """Q5: among completed, linked live calls exactly one first call per (deal, category);
    catches both 0 and > 1."""
    m = meetings.filter(F.col("is_completed") & F.col("meeting_category").isin(*C.LIVE_CATEGORIES) & F.col("deal_id").isNotNull())
    return groups_where(m, ["deal_id", "meeting_category"], F.col("is_first_call"), lambda n, hits: hits != 1, "completed_calls", "flagged_first")


def check_nonneg(df: DataFrame, col: str = "cash_amount", keep=("deal_id", "cash_component")) -> DataFrame:
    """Q6."""
    return df.filter(F.col(col) < 0).select(*keep, col)


def unmapped_stages(deals: DataFrame, stages: DataFrame) -> DataFrame:
    """Stage ids carried by deals but absent from the stage dimension, with counts."""
    from dealflow.sources.dims import bounded_broadcast

    known = bounded_broadcast(stages.select(F.col("stage_id").alias("dealstage_id")))
    return (deals.join(known, "dealstage_id", "left_anti")
            .groupBy("pipeline_id", "dealstage_id").agg(F.count(F.lit(1)).alias("deals")))


def normalised_key_conflicts(dim: DataFrame, key: str) -> DataFrame:
    """J4 guard: keys of a case-insensitive, trimmed lookup that collide after normalising."""
    return (dim.groupBy(F.upper(F.trim(F.col(key))).alias("normalised_key"))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def run_checks(checks) -> DataFrame:
    """``checks``: iterable of (name, severity, offending DataFrame) -> one summary row each."""
    parts = [df.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(name).alias("check"), F.lit(sev).alias("severity"), "failing_rows") for name, sev, df in checks]
    return reduce(DataFrame.unionByName, parts)


#: The column tests declared on the models: (table, column, test, severity). ``values`` names a list below.
DECLARED = (
    ("deals", "deal_id", "unique", "error"), ("deals", "deal_id", "not_null", "error"),
    ("stg_meetings", "meeting_id", "unique", "error"), ("stg_meetings", "meeting_id", "not_null", "error"),
    ("meeting_deals", "meeting_id", "unique", "error"), ("meeting_deals", "meeting_id", "not_null", "error"),
    ("contact_flags", "deal_id", "unique", "error"), ("contact_flags", "deal_id", "not_null", "error"),
    ("meetings_fct", "meeting_id", "unique", "error"), ("meetings_fct", "meeting_id", "not_null", "error"),
    ("meetings_fct", "meeting_category", "values", "error"), ("meetings_fct", "meeting_outcome", "values", "warn"),
    ("snapshot", "deal_id", "not_null", "error"), ("snapshot", "entry_date_et", "not_null", "error"),
    ("entries", "deal_id", "not_null", "error"), ("entries", "stage_entry_type", "not_null", "error"), ("entries", "stage_entry_type", "values", "error"),
    ("cash", "cash_amount", "nonneg", "error"),
    ("report", "closer_owner_id", "unique", "error"), ("report", "closer_owner_id", "not_null", "error"),
    ("closers", "owner_id", "unique", "error"), ("closers", "owner_id", "not_null", "error"),
    ("stages", "stage_id", "unique", "error"), ("stages", "stage_id", "not_null", "error"),
    ("product_map", "upsell_plan", "unique", "error"), ("product_map", "upsell_plan", "not_null", "error"),
    ("tier_map", "active_product_snapshot_at_won", "not_null", "error"),
)
ACCEPTED = {"meeting_category": MEETING_CATEGORIES, "meeting_outcome": KNOWN_OUTCOMES, "stage_entry_type": STAGE_ENTRY_TYPES}


def failing(column: str, test: str):
    """Whether a row fails a row-level test (a NULL fails only not_null)."""
    c = F.col(column)
    return {"not_null": lambda: c.isNull(), "values": lambda: ~c.isin(*ACCEPTED[column]), "nonneg": lambda: c < 0}[test]()


def test_name(declared) -> str:
    return f"{declared[0]}.{declared[1]} {declared[2]}"


def row_tests(table: str, declared=DECLARED) -> list:
    """The declared row-level tests of a table as aggregates: how many rows fail each."""
    return [F.count_if(failing(d[1], d[2])).alias(test_name(d)) for d in declared if d[0] == table and d[2] != "unique"]


def observed(table: str, df: DataFrame, declared=DECLARED):
    """(``df``, observation): the table's row-level tests counted while ``df`` is written, without a
    pass of their own. The observation is the last step before the write, in its result stage, so
    a task that runs again is counted once. (None: the table has no such test.)"""
    from pyspark.sql import Observation

    tests = row_tests(table, declared)
    if not tests:
        return df, None
    seen = Observation(f"tests of {table}")
    return df.observe(seen, *tests), seen


def duplicate_keys(tables: dict[str, DataFrame], declared=DECLARED) -> DataFrame:
    """(check, key, n) of every uniqueness test: the keys that occur more than once.

    All tables go through one aggregate of (test, 64-bit hash of the key), with partial combine. Only
    keys whose hash occurs twice are then grouped by the key itself; those hashes are few (real
    duplicates, and about n^2 / 2^65 chance ones), and a hash join brings their keys back."""
    key = lambda d: tables[d[0]].select(F.lit(test_name(d)).alias("check"), F.col(d[1]).cast("string").alias("key")).filter(F.col("key").isNotNull())
    keys = reduce(DataFrame.unionByName, [key(d) for d in declared if d[2] == "unique"]).withColumn("hash", F.xxhash64("key"))
    twice = keys.groupBy("check", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("check", "hash")
    return keys.join(twice, ["check", "hash"], "left_semi").groupBy("check", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def tally(spark, known, offenders: list[DataFrame]) -> DataFrame:
    """(check, severity, failing_rows) of all checks from ``known`` (check, severity, rows already counted)
    and the rows of ``offenders``, each with the name of its check: one aggregate for all."""
    zeros = spark.createDataFrame(list(known), "check string, severity string, n bigint")
    each = [df.select("check", F.lit(None).cast("string").alias("severity"), F.lit(1).cast("bigint").alias("n")) for df in offenders]
    return (reduce(DataFrame.unionByName, [zeros, *each]).groupBy("check")
            .agg(F.max("severity").alias("severity"), F.sum("n").alias("failing_rows")))


def failing_rows(tables: dict[str, DataFrame], declared=DECLARED) -> list[DataFrame]:
    """The row-level tests of each table as a DataFrame with a row for every (row, failed test), named."""
    out = []
    for table, df in tables.items():
        tests = [F.when(failing(d[1], d[2]), F.lit(test_name(d))) for d in declared if d[0] == table and d[2] != "unique"]
        if tests:
            out.append(df.select(F.explode(F.array(*tests)).alias("check")).filter(F.col("check").isNotNull()))
    return out


def declared_checks(tables: dict[str, DataFrame], declared=DECLARED, counted: dict | None = None) -> DataFrame:
    """The declared tests as (check, severity, failing_rows), lazily. ``counted`` ({table: {test: rows}}):
    row-level tests that were ``observed`` already."""
    return _checks(tables, declared, counted or {}, (), None)


def _checks(tables, declared, counted, more_names, more) -> DataFrame:
    known = [(test_name(d), d[3], int(counted.get(d[0], {}).get(test_name(d), 0))) for d in declared] + [(n, sev, 0) for n, sev in more_names]
    rest = {t: df for t, df in tables.items() if t not in counted}
    spark = next(iter(tables.values())).sparkSession
    return tally(spark, known, [duplicate_keys(tables, declared), *failing_rows(rest, declared), *(more or ())])


def undeclared(m) -> dict[tuple[str, str], DataFrame]:
    """The first-call rule, and checks that the models do not declare: (name, severity) -> offending rows."""
    return {
        ("first call dedup", "error"): check_first_call(m.meetings_fct),
        ("tier_map key unique after normalising", "error"): normalised_key_conflicts(m.tier_map, "active_product_snapshot_at_won"),
        ("deals on stages missing from stages", "warn"): unmapped_stages(m.deals, m.stages),
    }


def model_checks(m, counted: dict | None = None, report: DataFrame | None = None) -> DataFrame:
    """Declared and undeclared tests over a ``plans.context.Models`` graph, lazily: a model that is not
    written is computed anew for each test that needs it (``staged_checks`` writes each once)."""
    tables = {t: (report if report is not None else m.report()) if t == "report" else getattr(m, t) for t in dict.fromkeys(d[0] for d in DECLARED)}
    more = undeclared(m)
    return _checks(tables, DECLARED, counted or {}, list(more), [df.select(F.lit(n).alias("check")) for (n, _), df in more.items()])


def staged_checks(m, root: str | None = None) -> DataFrame:
    """The same rows as ``model_checks``, from models that are written once (``Models.materialize``; a
    ``root`` of None is the session's shared checkpoint folder) and observed while they are. What is
    left for the result is one aggregate of all keys, the dimensions' few rows and the first-call rule."""
    counted = m.materialize(root, tests=True)
    report, seen = observed("report", m.report())
    path = f"{m.materialized_at}/report"
    report.write.mode("overwrite").parquet(path)
    return model_checks(m, {**counted, "report": seen.get}, m.spark.read.parquet(path))
