"""Formula text compiled to columns."""

import pytest

from dealflow.operators import formulas as FM
from dealflow.operators import reconcile as RC


def test_the_table_says_what_the_definitions_say():
    got = FM.registry()
    assert got.keys() == {d.id for d in RC.DERIVED}
    assert all(FM.names_in(got[d.id]) == list(dict.fromkeys(d.num + d.den)) for d in RC.DERIVED)


def test_order_unknown_names_and_circles(spark):
    formulas = {"total": "`a b` + round(c, 1)", "share": "try_divide(c, total)", "twice": "CASE WHEN share > 0 AND c IS NOT NULL THEN share * 2 ELSE concat('total', '') END"}
    assert FM.names_in(formulas["twice"]) == ["share", "c"]
    assert FM.in_order(formulas, ["a b", "c"]) == [["total"], ["share"], ["twice"]]
    df = spark.createDataFrame([(1.0, 3.0), (-2.0, 2.0)], "`a b` double, c double")
    assert [r.share for r in FM.with_formulas(df, {k: formulas[k] for k in ("total", "share")}).collect()] == [0.75, None]
    assert FM.with_formulas(df, formulas | {"other": "zzz"}, wanted=["share"]).columns == ["a b", "c", "total", "share"]
    with pytest.raises(ValueError, match="unknown metrics.*zzz"):
        FM.in_order({"x": "c + zzz"}, ["c"])
    with pytest.raises(ValueError, match="x -> y -> x"):
        FM.in_order({"x": "y + c", "y": "x * 2", "z": "c"}, ["c"])
    with pytest.raises(ValueError, match="named like columns"):
        FM.in_order({"c": "1"}, ["c"])


def test_ratios_of_both_sides(spark):
    rows = [("won", "1", 3.0, 4.0), ("calls", "1", 6.0, 0.0), ("won", None, 1.0, None), ("calls", None, 2.0, 2.0), ("other", "1", 9.0, 9.0)]
    al = spark.createDataFrame(rows, "metric_id string, owner_id string, a_value double, b_value double")
    got = {(r.metric_id, r.owner_id): (r.a_value, r.b_value, r.div0) for r in FM.ratios(al, {"rate": "try_divide(won, calls)", "half": "rate / 2"}).collect()}
    assert got == {("rate", "1"): (0.5, None, True), ("half", "1"): (0.25, None, False), ("rate", None): (0.5, None, False), ("half", None): (0.25, None, False)}
