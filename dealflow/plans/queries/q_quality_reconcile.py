"""Q1-Q6 (data quality), R1-R8 (reconciliation), U4 / T3 (audit differences)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.operators import formulas as FM
from dealflow.operators import models as M
from dealflow.operators import quality as Q
from dealflow.operators import reconcile as RC
from dealflow.plans import standins as S
from dealflow.plans.context import Models
from dealflow.plans.oracle import W_END, W_START, lst, q, sql
from dealflow.plans.queries.q_joins_aggs import aligned, metric_definitions
from dealflow.plans.queries.q_sources_predicates import scratch
from dealflow.plans.registry import register

REPORT_COLS = ("metric_id", "metric_name", "owner_id", "verdict", "a_value", "b_value", "detail")
WIN = f"BETWEEN DATE '{W_START}' AND DATE '{W_END}'"


def reconcile_full(spark, sf_dir, requested=None) -> DataFrame:
    return RC.reconcile(None, None, metric_definitions(), requested=requested, aligned=aligned(spark, sf_dir))


def reconcile_report(spark, sf_dir) -> DataFrame:
    """R7 rows as persisted (ids, numbers, enums, refs and caveats only)."""
    return reconcile_full(spark, sf_dir).select(*REPORT_COLS, "formula_refs", "caveats")


# ---------------------------------------------------------------- Q


@register("q1_unique", sql("SELECT engagement_id, count(*) AS n_records FROM raw_engagement_deal "
                           "WHERE engagement_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"))
def q1_unique(spark, sf_dir):
    return Q.check_unique(Models.of(spark, sf_dir).raw_engagement_deal, "engagement_id")


@register("q2_not_null", sql("SELECT engagement_id, deal_id FROM raw_engagement_deal WHERE deal_id IS NULL"))
def q2_not_null(spark, sf_dir):
    return Q.check_not_null(Models.of(spark, sf_dir).raw_engagement_deal, "deal_id", keep=("engagement_id", "deal_id"))


_ALL_TYPES = C.PC_ACTIVITY_TYPES + C.RC_ACTIVITY_TYPES + C.PWC_ACTIVITY_TYPES + C.WB_ACTIVITY_TYPES


@register("q3_values", sql(f"SELECT meeting_id, activity_type FROM stg_meetings WHERE activity_type IS NOT NULL "
                           f"AND activity_type NOT IN ({lst(_ALL_TYPES)})"))
def q3_values(spark, sf_dir):
    return Q.check_values(Models.of(spark, sf_dir).stg_meetings, "activity_type", _ALL_TYPES).select(
        "meeting_id", "activity_type")


@register("q4_values_warn", sql(
    "SELECT 'fct_meetings.meeting_outcome accepted' AS \"check\", 'warn' AS severity, count(*) AS failing_rows "
    f"FROM fct_meetings WHERE meeting_outcome IS NOT NULL AND meeting_outcome NOT IN ({lst(Q.KNOWN_OUTCOMES)}) "
    "UNION ALL SELECT 'stg_meetings.activity_type accepted', 'warn', count(*) FROM stg_meetings "
    f"WHERE activity_type IS NOT NULL AND activity_type NOT IN ({lst(_ALL_TYPES)})"))
def q4_values_warn(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    return Q.run_checks([
        ("fct_meetings.meeting_outcome accepted", "warn", Q.check_values(m.meetings_fct, "meeting_outcome", Q.KNOWN_OUTCOMES)),
        ("stg_meetings.activity_type accepted", "warn", Q.check_values(m.stg_meetings, "activity_type", _ALL_TYPES)),
    ])


def broken_meetings(spark, sf_dir) -> DataFrame:
    """The meetings with every fifth flag turned round, so that the first-call check has rows to find."""
    m = Models.of(spark, sf_dir).meetings_fct
    return m.withColumn("is_first_call", F.col("is_first_call") != (F.col("meeting_id") % 5 == 0))


@register("q5_first_call", sql("""SELECT deal_id, meeting_category, count(*) AS completed_calls,
    CAST(sum(CAST(is_first_call <> (meeting_id % 5 = 0) AS INTEGER)) AS BIGINT) AS flagged_first
  FROM fct_meetings WHERE is_completed AND deal_id IS NOT NULL AND meeting_category <> 'PC'
  GROUP BY ALL HAVING flagged_first <> 1"""))
def q5_first_call(spark, sf_dir):
    return Q.check_first_call(broken_meetings(spark, sf_dir))


def _components_sql() -> str:
    rows = [("base", "cash_collected", "close_date_et")] + [
        (c.name, c.amount_col, f"CAST({c.date_col} AS DATE)") for c in C.DEFAULT_COMPONENTS[1:]]
    return " UNION ALL ".join(f"SELECT deal_id, '{n}' AS cash_component, {a} AS cash_amount FROM int_won" for n, a, _ in rows)


@register("q6_nonneg", sql(f"SELECT deal_id, cash_component, cash_amount FROM ({_components_sql()}) WHERE cash_amount < 0"))
def q6_nonneg(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    u = M.unpivot_components(m.won, keep=("deal_id",), cfg=m.cfg, only_valid=False)
    return Q.check_nonneg(u)


_TABLES = {"deals": "stg_deals", "meeting_deals": "stg_meeting_deals", "contact_flags": "stg_deal_contacts", "meetings_fct": "fct_meetings",
           "snapshot": "fct_snapshot", "entries": "fct_stage_entries", "cash": "fct_cash", "report": "rpt"}


def _declared_sql(table: str, column: str, test: str, severity: str) -> str:
    fails = {"unique": f"count({column}) - count(DISTINCT {column}) > 0", "not_null": f"{column} IS NULL", "nonneg": f"{column} < 0",
             "values": f"{column} NOT IN ({lst(Q.ACCEPTED.get(column, ('',)))})"}[test]
    source = _TABLES.get(table, table)
    rows = f"(SELECT {column} FROM {source} GROUP BY {column} HAVING {fails})" if test == "unique" else f"{source} WHERE {fails}"
    return f"SELECT '{table}.{column} {test}' AS \"check\", '{severity}' AS severity, count(*) AS failing_rows FROM {rows}"


_EXTRA_CHECKS = (
    ("first call dedup", "error", "(SELECT 1 FROM fct_meetings WHERE is_completed AND meeting_category <> 'PC' AND deal_id IS NOT NULL "
     "GROUP BY deal_id, meeting_category HAVING count(*) FILTER (is_first_call) <> 1)"),
    ("tier_map key unique after normalising", "error", "(SELECT 1 FROM tier_map GROUP BY upper(trim(active_product_snapshot_at_won)) HAVING count(*) > 1)"),
    ("deals on stages missing from stages", "warn", "(SELECT DISTINCT pipeline_id, dealstage_id FROM stg_deals WHERE dealstage_id IS NULL OR dealstage_id NOT IN (SELECT stage_id FROM stages))"),
)


@register("q7_check_summary", sql(" UNION ALL ".join(
    [_declared_sql(*d) for d in Q.DECLARED] + [f"SELECT {q(n)}, '{sev}', count(*) FROM {rows}" for n, sev, rows in _EXTRA_CHECKS])))
def q7_check_summary(spark, sf_dir):
    """All tests of the models as one (check, severity, failing_rows) table; the models are written once, to
    the shared checkpoint folder, and tested as they are."""
    return Q.staged_checks(Models.of(spark, sf_dir).fork())


# ---------------------------------------------------------------- R


@register("r1_exact", sql(
    "SELECT metric_id, owner_id, CASE WHEN a_value IS NULL OR b_value IS NULL THEN 'not_checkable' "
    "WHEN abs(a_value - b_value) <= 0 THEN 'confirmed' ELSE 'discrepancy' END AS verdict, "
    "CASE WHEN a_value IS NULL OR b_value IS NULL THEN 'one side returned no data' WHEN abs(a_value - b_value) <= 0 THEN '' "
    "ELSE printf('diff=%+.2f (tolerance=0)', a_value - b_value) END AS detail FROM aligned"))
def r1_exact(spark, sf_dir):
    al = aligned(spark, sf_dir)
    v, d = RC.verdict_exact(F.col("a_value"), F.col("b_value"), 0)
    return al.select("metric_id", "owner_id", v.alias("verdict"), d.alias("detail"))


@register("r2_ratio", sql(
    "SELECT metric_id, owner_id, CASE WHEN a_value IS NULL OR b_value IS NULL THEN 'not_checkable' "
    "WHEN a_value = 0 AND b_value = 0 THEN 'confirmed' WHEN a_value = 0 OR b_value = 0 THEN 'discrepancy' "
    f"WHEN abs(a_value / b_value - 1) <= {C.RATIO_TOLERANCE} THEN 'confirmed' ELSE 'discrepancy' END AS verdict FROM aligned"))
def r2_ratio(spark, sf_dir):
    al = aligned(spark, sf_dir)
    v, _d = RC.verdict_ratio(F.col("a_value"), F.col("b_value"))
    return al.select("metric_id", "owner_id", v.alias("verdict"))


@register("r3_not_checkable", sql(f"SELECT {', '.join(REPORT_COLS)} FROM rec WHERE verdict = 'not_checkable'"))
def r3_not_checkable(spark, sf_dir):
    return reconcile_full(spark, sf_dir).filter(F.col("verdict") == "not_checkable").select(*REPORT_COLS)


@register("r4_reconcile", sql(f"SELECT {', '.join(REPORT_COLS)} FROM rec"))
def r4_reconcile(spark, sf_dir):
    return reconcile_full(spark, sf_dir).select(*REPORT_COLS)


@register("r4_formulas", sql("""SELECT metric_id, owner_id, max(value) FILTER (side = 'a') AS a_value, max(value) FILTER (side = 'b') AS b_value,
    coalesce(bool_or(div0), FALSE) AS div0 FROM derived_long GROUP BY ALL"""))
def r4_formulas(spark, sf_dir):
    """The derived metrics of both sides, from the formula table."""
    return FM.ratios(aligned(spark, sf_dir), FM.registry())


_R5_IDS = ("deals_won", "total_cash", "rc_completed", "rc_close_pct", "avg_dpl")


@register("r5_by_owner", sql(
    f"SELECT {', '.join(REPORT_COLS)} FROM rec WHERE owner_id IS NOT NULL AND metric_id IN "
    f"({lst(('deals_won', 'total_cash', 'rc_close_pct', 'avg_dpl'))})"))
def r5_by_owner(spark, sf_dir):
    """Per-closer scope; asking for rc_close_pct / avg_dpl pulls in rc/pwc/wb completed,
    which stay hidden because only deals_won and total_cash are requested as bases."""
    out = reconcile_full(spark, sf_dir, requested=["deals_won", "total_cash", "rc_close_pct", "avg_dpl"])
    return out.filter(F.col("owner_id").isNotNull()).select(*REPORT_COLS)


def audit_ids(spark, sf_dir):
    """(metric_id, id) on both sides for the audit-supported metrics, team scope."""
    m = Models.of(spark, sf_dir)
    return RC.audit_ids(m.won_fct, m.meetings_fct, m.other_deals, m.other_meetings, *S.WINDOW)


def _audit_sql() -> str:
    from dealflow.plans.oracle import _spec_sql

    mine = f"""SELECT 'deals_won' AS metric_id, deal_id::VARCHAR AS id FROM fct_won WHERE close_date_et {WIN}
  UNION ALL SELECT lower(meeting_category) || '_completed', meeting_id::VARCHAR FROM fct_meetings
    WHERE is_completed AND meeting_category <> 'WB' AND meeting_date_et {WIN}"""
    theirs = "\n  UNION ALL ".join(f"SELECT '{x.id}' AS metric_id, id FROM other_{x.obj} WHERE {_spec_sql(x.filters)}"
                                  for x in RC.BASE_METRICS if x.id in RC.AUDIT_SUPPORTED)
    return (f"SELECT metric_id, 'missing_in_other' AS side, id FROM (({mine}) EXCEPT ({theirs})) "
            f"UNION ALL SELECT metric_id, 'extra_in_other', id FROM (({theirs}) EXCEPT ({mine}))")


def audit(spark, sf_dir) -> DataFrame:
    """Record-level audit of every supported metric in one join by metric and id."""
    return RC.audit_diff(*audit_ids(spark, sf_dir), by=("metric_id",))


@register("r6_audit", sql(_audit_sql()))
def r6_audit(spark, sf_dir):
    return audit(spark, sf_dir)


@register("r6_audit_by_bucket", sql(_audit_sql()))
def r6_audit_by_bucket(spark, sf_dir):
    """The audit's differences, with only the ids of buckets that differ joined. The ids of both sides are
    written once, to the shared checkpoint folder: they are read for the sums and again for the join."""
    path = scratch(spark, "audit-ids")
    sides = [df.select(F.lit(of).alias("of"), "metric_id", F.col("id").cast("string").alias("id")) for of, df in zip("ab", audit_ids(spark, sf_dir), strict=True)]
    sides[0].unionByName(sides[1]).write.partitionBy("of").parquet(path)
    ids = spark.read.schema("metric_id string, id string, of string").parquet(path)
    return RC.audit_diff_by_bucket(*[ids.filter(F.col("of") == of).drop("of") for of in "ab"], by=["metric_id"])


@register("u4_audit_diff", sql(
    f"SELECT side, id FROM ({_audit_sql()}) WHERE metric_id = 'deals_won'"))
def u4_audit_diff(spark, sf_dir):
    a, b = audit_ids(spark, sf_dir)
    return RC.audit_diff(a.filter(F.col("metric_id") == "deals_won"), b.filter(F.col("metric_id") == "deals_won"))


@register("t3_sorted_diff", sql(
    f"SELECT side, id FROM ({_audit_sql()}) WHERE metric_id = 'pc_completed' ORDER BY side, id"))
def t3_sorted_diff(spark, sf_dir):
    a, b = audit_ids(spark, sf_dir)
    d = RC.audit_diff(a.filter(F.col("metric_id") == "pc_completed"), b.filter(F.col("metric_id") == "pc_completed"))
    return RC.sorted_diff(d)


@register("r7_report", sql(
    f"SELECT r.metric_id, r.metric_name, r.owner_id, r.verdict, r.a_value, r.b_value, r.detail, "
    "COALESCE(f.refs, '') AS formula_refs FROM rec r LEFT JOIN ref_text f ON r.metric_id = f.metric_id"))
def r7_report(spark, sf_dir):
    rep = reconcile_report(spark, sf_dir)
    return rep.select(*REPORT_COLS, F.concat_ws(";", "formula_refs").alias("formula_refs"))


@register("r8_allow_list", sql(f"SELECT {', '.join(REPORT_COLS)} FROM rec WHERE owner_id IS NULL"))
def r8_allow_list(spark, sf_dir):
    rep = RC.assert_no_pii(reconcile_report(spark, sf_dir).drop("formula_refs", "caveats"))
    return rep.filter(F.col("owner_id").isNull())
