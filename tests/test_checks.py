"""Declared tests: duplicates by hashes first, row tests observed while tables are written."""

import os
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dealflow import jobs
from dealflow.operators import quality as Q
from dealflow.plans.context import Models

SF = "/root/testdata/sf0.001"


def as_dict(df):
    return {r.check: (r.severity, r.failing_rows) for r in df.collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 12) | st.none(), max_size=40), st.lists(st.text("ab ", max_size=2) | st.none(), max_size=40))
def test_duplicate_keys_equal_grouping_by_key(spark, ids, names):
    tables = {"t": spark.createDataFrame([(i,) for i in ids], "id bigint"), "u": spark.createDataFrame([(n,) for n in names], "name string")}
    declared = (("t", "id", "unique", "error"), ("u", "name", "unique", "warn"))
    want = {Q.test_name(d): (d[3], Q.check_unique(tables[d[0]], d[1]).count()) for d in declared}
    assert as_dict(Q.declared_checks(tables, declared)) == want


def shuffles(df):
    """Shuffles of the plan before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"(?<!Broadcast)Exchange (?!LogicalQuery)", plan))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_observed_tests_equal_lazy_ones_and_gate_the_build(spark, tmp_path):
    m = Models(spark, SF)
    # rows that fail: a category outside the list, an entry without a type, a negative payment, a repeated deal
    broken = m.fork(deals=m.deals.unionByName(m.deals.filter("deal_id % 50 = 1")), cash=m.cash.withColumn("cash_amount", F.when(F.col("deal_id") % 7 == 0, -1.0).otherwise(F.col("cash_amount"))),
                    entries=m.entries.withColumn("stage_entry_type", F.when(F.col("deal_id") % 11 == 0, "other").when(F.col("deal_id") % 13 != 0, F.col("stage_entry_type"))))
    broken.given = frozenset()
    lazy = as_dict(Q.model_checks(broken))
    staged = Q.staged_checks(broken, str(tmp_path / "tables"))
    assert shuffles(staged) < 15 and as_dict(staged) == lazy
    assert lazy["deals.deal_id unique"][1] > 0 and lazy["cash.cash_amount nonneg"][1] > 0 and lazy["entries.stage_entry_type values"][1] > 0 and lazy["entries.stage_entry_type not_null"][1] > 0
    # again, over tables that are there: counted from them
    assert as_dict(Q.staged_checks(broken, str(tmp_path / "tables"))) == lazy


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_a_failed_test_publishes_nothing(spark, tmp_path):
    m, out = Models(spark, SF), str(tmp_path / "marts")
    jobs.build(m, out, tests=True)
    checks = as_dict(jobs.read_mart(spark, out, jobs.CHECKS))
    assert checks["first call dedup"] == ("error", 0) and len(checks) == len(Q.DECLARED) + 3
    before = {n: jobs.mart(spark, out, n).versions() for n in jobs.MARTS.values()}
    bad = m.fork()
    bad.__dict__["cash"] = m.cash.withColumn("cash_amount", -F.col("cash_amount"))
    with pytest.raises(jobs.TestsFailed, match="cash.cash_amount nonneg"):
        jobs.build(bad, out, tests=True)
    assert {n: jobs.mart(spark, out, n).versions() for n in jobs.MARTS.values()} == before
    assert as_dict(jobs.read_mart(spark, out, jobs.CHECKS))["cash.cash_amount nonneg"][1] > 0
