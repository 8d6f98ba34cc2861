"""Every registered query against its DuckDB oracle on the smallest driver tables, plus
the driver's smoke entry point."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _names():
    from dealflow.plans.registry import QUERIES, load_all

    load_all()
    return sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    from check_oracle import connect

    return connect(SF)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The landed tables written once, as a warehouse has them; every model stays lazy."""
    from dealflow.plans.context import Models

    Models.of(spark, SF).materialize(str(tmp_path_factory.mktemp("landed")), levels=1)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0
    assert {"closer_owner_id", "total_cash", "acc_tier"} <= set(df.columns)


def test_every_query_has_an_oracle():
    import __spark_entry__ as E

    missing = sorted(set(_names()) - set(E.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, landed, name):
    import __spark_entry__ as E
    from check_oracle import compare

    diff = compare(spark, duck, SF, E.queries()[name], E.oracle_sql().get(name))
    assert diff is None, diff
