"""Derived metrics as formula text (K1-K10, R4): the registry is a table (id, name, formula), edited without
code, and Spark's own expression parser compiles it.

A formula names metrics, base ones or other formulas, in Spark SQL; ratios are ``try_divide(a, b)``, which
is NULL for a zero divisor. Formulas are put in order of what they use; a name that is neither a
column nor a formula, and formulas that use each other in a circle, are errors before anything runs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow.sources.dims import seed_rows

#: A name that isn't a function's, outside of quoted text.
NAME = re.compile(r"'[^']*'|`([^`]+)`|\b([A-Za-z_][A-Za-z0-9_]*)\b(?!\s*\()")
WORDS = {"and", "or", "not", "null", "is", "in", "between", "case", "when", "then", "else", "end", "true", "false", "as", "cast", "double", "bigint", "date", "like"}


def names_in(formula: str) -> list[str]:
    """The metrics that a formula uses, each once."""
    found = [a or b for a, b in NAME.findall(formula) if a or (b and b.lower() not in WORDS)]
    return list(dict.fromkeys(found))


def registry() -> dict[str, str]:
    """Formula by id: the packaged table of derived metrics."""
    return {r["metric_id"]: r["formula"] for r in seed_rows("metric_formulas")}


def in_order(formulas: dict[str, str], known) -> list[list[str]]:
    """Formula ids in levels: those of a level use only ``known`` columns and earlier levels."""
    used = {i: names_in(t) for i, t in formulas.items()}
    done, levels, rest = set(known), [], dict(used)
    if both := sorted(set(formulas) & done):
        raise ValueError(f"formulas named like columns: {both}")
    if unknown := sorted({n for ns in used.values() for n in ns} - done - set(formulas)):
        raise ValueError(f"unknown metrics in formulas: {unknown}")
    while rest:
        ready = [i for i, ns in rest.items() if done.issuperset(ns)]
        if not ready:
            at, path = next(iter(rest)), []
            while at not in path:
                path.append(at)
                at = next(n for n in rest[at] if n in rest)
            raise ValueError(f"formulas use each other: {' -> '.join([*path[path.index(at):], at])}")
        levels.append(ready)
        done |= set(ready)
        rest = {i: ns for i, ns in rest.items() if i not in ready}
    return levels


def with_formulas(df: DataFrame, formulas: dict[str, str], wanted=None) -> DataFrame:
    """``df`` with a column for each formula (those in ``wanted``, and what they use), a projection for
    each level, which Catalyst folds into one."""
    if wanted is not None:
        need, todo = set(), list(wanted)
        while todo:
            i = todo.pop()
            if i in formulas and i not in need:
                need.add(i)
                todo += names_in(formulas[i])
            elif i not in formulas and i not in df.columns:
                raise ValueError(f"unknown metrics in formulas: {[i]}")
        formulas = {i: t for i, t in formulas.items() if i in need}
    for level in in_order(formulas, df.columns):
        df = df.select("*", *[F.expr(formulas[i]).alias(i) for i in level])
    return df


def ratios(aligned: DataFrame, formulas: dict[str, str], wanted=None) -> DataFrame:
    """(metric_id, owner_id, a_value, b_value, div0) of the formulas over both sides of an aligned table
    (metric_id, owner_id, a_value, b_value): each side from its own base values. A value that is
    NULL though all that it uses is there is a division by zero, on either side."""
    wanted = list(formulas) if wanted is None else list(wanted)
    base = sorted({n for t in formulas.values() for n in names_in(t)} - set(formulas))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_value").alias("value")) for s in "ab"])
    wide = (aligned.filter(F.col("metric_id").isin(base)).select("metric_id", "owner_id", F.inline(sides)).groupBy("owner_id", "side")
            .agg(*[F.max(F.when(F.col("metric_id") == i, F.col("value"))).alias(i) for i in base]))
    got = with_formulas(wide, formulas, wanted)
    row = lambda i: F.struct(F.lit(i).alias("metric_id"), F.col(i).cast("double").alias("value"),
                             (F.col(i).isNull() & _all_there(formulas, i)).alias("zero"))
    each = got.select("owner_id", "side", F.inline(F.array(*[row(i) for i in wanted])))
    return each.groupBy("metric_id", "owner_id").agg(F.max(F.when(F.col("side") == "a", F.col("value"))).alias("a_value"),
                                                     F.max(F.when(F.col("side") == "b", F.col("value"))).alias("b_value"), F.bool_or("zero").alias("div0"))


def _all_there(formulas, i):
    out = F.lit(True)
    for n in names_in(formulas[i]):
        out = out & F.col(n).isNotNull()
    return out
