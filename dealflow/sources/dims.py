"""Dimension tables (S3, S4) and the size-checked broadcast used for every lookup join."""

from __future__ import annotations

import csv
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED_DIR = Path(__file__).parent / "seeds"

CLOSERS_SCHEMA = T.StructType([
    T.StructField("owner_id", T.StringType(), False),
    T.StructField("closer_name", T.StringType(), True),
])
STAGES_SCHEMA = T.StructType([
    T.StructField("stage_id", T.StringType(), False),
    T.StructField("pipeline_id", T.StringType(), True),
    T.StructField("stage_label", T.StringType(), True),
    T.StructField("stage_group", T.StringType(), True),
    T.StructField("snapshot_col", T.StringType(), True),
])
PRODUCT_MAP_SCHEMA = T.StructType([
    T.StructField("upsell_plan", T.StringType(), False),
    T.StructField("product_column", T.StringType(), True),
    T.StructField("notes", T.StringType(), True),
])
TIER_MAP_SCHEMA = T.StructType([
    T.StructField("active_product_snapshot_at_won", T.StringType(), False),
    T.StructField("tier_of_origin_column", T.StringType(), True),
    T.StructField("notes", T.StringType(), True),
])
TARGETS_SCHEMA = T.StructType([
    T.StructField("closer_name", T.StringType(), True),
    T.StructField("goal_total_cash", T.DoubleType(), True),
    T.StructField("goal_deals_won", T.DoubleType(), True),
    T.StructField("goal_live_close_pct", T.DoubleType(), True),
    T.StructField("goal_avg_dpl", T.DoubleType(), True),
])

_SEEDS = {
    "dim_closers": CLOSERS_SCHEMA,
    "dim_renewal_stages": STAGES_SCHEMA,
    "dim_product_map": PRODUCT_MAP_SCHEMA,
    "dim_member_tier_map": TIER_MAP_SCHEMA,
}


def seed_rows(name: str) -> list[dict]:
    """Rows of a packaged seed CSV (a few dozen lines each)."""
    with open(SEED_DIR / f"{name}.csv", newline="", encoding="utf-8") as fh:
        return list(csv.DictReader(fh))


def load_dim(spark: SparkSession, name: str, path: str | None = None,
             schema: T.StructType | None = None) -> DataFrame:
    """S3: a dimension with declared types and lower-case, unquoted column names.

    With ``path`` the CSV is read by Spark (shared storage on a cluster). Without it the
    packaged seed is used; it is a bounded few-dozen-row file parsed on the driver, so it
    never depends on a driver-local path being visible to executors.
    """
    schema = schema or _SEEDS[name]
    if path is not None:
        df = spark.read.schema(schema).option("header", True).csv(path)
    else:
        # from Arrow a small table becomes a local relation, whose size Catalyst knows: the
        # lookups are then broadcast instead of shuffling the facts
        rows = seed_rows(name)
        df = spark.createDataFrame(pa.table({f.name: pa.array([r.get(f.name) for r in rows], pa.string()) for f in schema.fields}), schema)
    return df.select([F.col(f.name).alias(f.name.lower()) for f in schema.fields])


def targets(spark: SparkSession, table: str = "dim_renewal_targets") -> DataFrame:
    """Externally edited per-closer goals, read at query time from the catalog."""
    return spark.table(table).select(*[f.name for f in TARGETS_SCHEMA.fields])


MAX_BROADCAST_BYTES = 8 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (an upper bound for scans, filters
    and projections of files or local rows)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when Catalyst's own size estimate (no job) is within ``max_bytes``;
    beyond it the frame is returned without a hint, and the planner and adaptive execution
    choose the join by the sizes that they see."""
    est = estimated_bytes(df)
    return F.broadcast(df) if est <= max_bytes else df
