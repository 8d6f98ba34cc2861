"""Scans and sinks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.config import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS


def live_rows(df: DataFrame, flag: str = "_fivetran_deleted", required: bool = True) -> DataFrame:
    """Drop soft-deleted rows; a NULL flag counts as live. The flag is found whatever its
    case; a table without it is an error unless ``required`` is False.

    Written as ``flag IS NULL OR NOT flag`` (not ``coalesce(flag, false) = false``) so the
    predicate reaches the parquet reader as a pushed filter.
    """
    found = [c for c in df.columns if c.lower() == flag.lower()]
    if not found:
        if required:
            raise ValueError(f"no soft-delete flag {flag!r} among {df.columns}")
        return df
    c = F.col(f"`{found[0]}`")
    return df.filter(c.isNull() | ~c)


def optional_col(df: DataFrame, name: str, dtype: str) -> Column:
    """The column if the source has it (case-insensitive), else a typed NULL."""
    for c in df.columns:
        if c.lower() == name.lower():
            return F.col(c).cast(dtype)
    return F.lit(None).cast(dtype)


def assoc(df: DataFrame, left: str, right: str, left_as: str | None = None,
          right_as: str | None = None) -> DataFrame:
    """An association table as two columns, no soft-delete filter."""
    return df.select(F.col(left).alias(left_as or left), F.col(right).alias(right_as or right))


def freshness(sources: dict[str, DataFrame], now, ts_col: str = "_fivetran_synced", warn_hours: float = FRESHNESS_WARN_HOURS,
              error_hours: float = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Per source table the newest load time, its age in hours and pass / warn / error; a table
    without a load time is an error. ``now`` is a wall-clock time in the column's zone (naive
    datetime or Column); the difference is taken between wall clocks, whatever the session zone."""
    from dealflow.functions.dates import ntz_lit

    now_c = ntz_lit(now) if isinstance(now, _dt.datetime) else (now if isinstance(now, Column) else F.lit(now))
    rows = None
    for name, df in sources.items():
        one = df.agg(F.max(optional_col(df, ts_col, "timestamp_ntz")).alias("max_loaded_at")).select(F.lit(name).alias("source"), "max_loaded_at")
        rows = one if rows is None else rows.unionByName(one)
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now_c.cast("timestamp_ntz")) / 3600.0
    return rows.select(
        "source", "max_loaded_at", F.round(age, 2).alias("age_hours"),
        F.when(age.isNull() | (age > error_hours), F.lit("error")).when(age > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


def publish(df: DataFrame, name: str, mode: str = "view", database: str | None = None,
            partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Publish a model as a temp view (lazy, re-evaluated on read like a SQL view) or as a
    table in a per-layer database, which is created if need be. A view over a DataFrame belongs
    to its session and to no database, so a database asks for a table."""
    if mode == "view":
        if database is not None:
            raise ValueError("a session's view has no database: publish a table there")
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if mode != "table":
        raise ValueError(f"unknown publish mode {mode!r}")
    full = f"{database}.{name}" if database else name
    if database:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    w = df.write.mode("overwrite").format("parquet")
    w = w.partitionBy(*partition_by) if partition_by else w
    (w.option("path", path) if path else w).saveAsTable(full)
    return df.sparkSession.table(full)


REPORT_SCHEMA = ("metric_id string, metric_name string, owner_id string, verdict string, a_value double, b_value double, "
                 "detail string, formula_refs {refs}, caveats array<string>")


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Persist reconciliation rows. CSV joins list columns with ';' and drops
    caveats; JSON keeps lists, caveats and NULL values."""
    if fmt == "csv":
        lists = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
        df.select([F.concat_ws(";", c).alias(c) if c in lists else F.col(c) for c in df.columns if c != "caveats"]).write.mode(
            "overwrite").option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")


def read_report(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A report that ``write_report`` wrote, with its types (no inference pass)."""
    schema = REPORT_SCHEMA.format(refs="string" if fmt == "csv" else "array<string>")
    if fmt == "csv":
        # an unquoted empty field is NULL, a quoted one an empty text: no text stands for NULL
        return spark.read.schema(schema.rpartition(", caveats")[0]).option("header", True).option("nullValue", "\u0000").csv(path)
    return spark.read.schema(schema).json(path)


def other_side(records: DataFrame, cols: list[str]) -> DataFrame:
    """The second system's records: ``id`` plus requested properties."""
    return records.select(F.col("id").cast("string").alias("id"), *cols)


#: A page of the second system's extract, as it lands: the records with their nested properties, what comes
#: after it (none on the last page), and how many records the extract has in all.
PAGE = "results array<struct<id: string, properties: map<string, string>>>, total bigint, paging struct<next: struct<after: string>>"


class IncompleteExtract(RuntimeError):
    """The landed pages are not a whole extract."""


def paged_extract(spark: SparkSession, path: str, cols: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """S10 over pages as the second system gives them, one JSON file a page under ``path``: (id, *cols), with
    properties cast as ``types`` says (else text; malformed ones are NULL). A page is a file, so pages
    are read in parallel, and records never leave the executors.

    The extract must be whole: as many records as every page announces, one last page, and no record
    twice; else ``IncompleteExtract``. That check reads the pages once, before the result is used."""
    pages = spark.read.schema(PAGE).option("multiLine", True).json(path)
    heads = pages.agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(F.size("results")), F.lit(0)).alias("records"), F.min("total").alias("least"), F.max("total").alias("most"),
                      F.count_if(F.col("paging.next.after").isNull()).alias("last"), F.count_if(F.col("results").isNull()).alias("broken")).collect()[0]
    if heads["broken"] or heads["least"] != heads["most"] or heads["records"] != heads["most"] or heads["last"] != 1:
        raise IncompleteExtract(f"{path}: {heads['pages']} pages with {heads['records']} records of {heads['most']} announced, {heads['last']} last pages, {heads['broken']} unreadable")
    rows = pages.select(F.explode("results").alias("r"))
    if twice := rows.groupBy("r.id").count().filter("count > 1").limit(1).count():
        raise IncompleteExtract(f"{path}: {twice} record or more on two pages")
    kind = types or {}
    return rows.select(F.col("r.id").alias("id"), *[F.col("r.properties")[c].try_cast(kind.get(c, "string")).alias(c) for c in cols])


def scalar_metric(df: DataFrame, value: Column, group_by: list[str] | None = None) -> DataFrame:
    """A parametrised metric as a DataFrame with one ``value`` per group (one row
    without grouping). Parameters are Python values bound into the Column expression."""
    if group_by:
        return df.groupBy(*group_by).agg(value.alias("value"))
    return df.agg(value.alias("value"))


def today_et() -> _dt.date:
    """Default ``as_of``: today's calendar day in New York (driver clock)."""
    from zoneinfo import ZoneInfo

    return _dt.datetime.now(ZoneInfo("America/New_York")).date()
