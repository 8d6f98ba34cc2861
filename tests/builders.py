"""Builders for staged-level inputs: columns a fixture does not name are NULL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

TS = T.TimestampNTZType()
DEAL_SCHEMA = T.StructType(
    [T.StructField("deal_id", T.LongType()), T.StructField("closer_owner_id", T.StringType()),
     T.StructField("pipeline_id", T.StringType()), T.StructField("dealstage_id", T.StringType()),
     T.StructField("close_date", TS), T.StructField("close_date_fallback", TS),
     T.StructField("cash_collected", T.DoubleType())]
    + [f for n in ("ap1", "ap2", "ap3", "ap4", "ap11", "ap12")
       for f in (T.StructField(f"{n}_amount", T.DoubleType()), T.StructField(f"{n}_stamped_at", TS))]
    + [T.StructField(c, T.StringType()) for c in ("renewal_year_count", "orig_product_category", "upsell_plan",
                                                   "renewal_product_pitched", "active_product_snapshot_at_won",
                                                   "renewal_traffic_source")]
    + [T.StructField(f"date_entered_{e}", TS) for e in ("pc_invited", "pc_scheduled", "rc_invited", "rc_scheduled")]
    + [T.StructField("date_entered_current_stage", TS), T.StructField("membership_expiration_date", TS),
       T.StructField("renewal_product", T.StringType()), T.StructField("renewal_pipeline_type", T.StringType())])
MEETING_SCHEMA = T.StructType([
    T.StructField("meeting_id", T.LongType()), T.StructField("owner_id", T.StringType()),
    T.StructField("activity_type", T.StringType()), T.StructField("meeting_outcome", T.StringType()),
    T.StructField("meeting_start_at", TS)])
MEETING_DEALS_SCHEMA = T.StructType([T.StructField("meeting_id", T.LongType()), T.StructField("deal_id", T.LongType())])
FLAGS_SCHEMA = T.StructType([
    T.StructField("deal_id", T.LongType()), T.StructField("is_test_contact", T.BooleanType()),
    T.StructField("contact_true_renewal_close_date", TS)])
CLOSERS_SCHEMA = T.StructType([T.StructField("owner_id", T.StringType()), T.StructField("closer_name", T.StringType())])
STAGES_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                              ("stage_id", "pipeline_id", "stage_label", "stage_group", "snapshot_col")])

A, B = "82672208", "82734543"
ROSTER = [(A, "Closer A"), (B, "Closer B")]


def ts(s):
    if s is None:
        return None
    s = s.replace("T", " ")
    if len(s) == 10:
        s += " 00:00:00"
    return dt.datetime.fromisoformat(s)


def frame(spark, schema, rows):
    out = []
    for r in rows:
        vals = []
        for f in schema.fields:
            v = r.get(f.name)
            if v is not None and isinstance(f.dataType, T.TimestampNTZType):
                v = ts(v)
            if v is not None and isinstance(f.dataType, T.DoubleType):
                v = float(v)
            vals.append(v)
        out.append(tuple(vals))
    return spark.createDataFrame(out, schema)


def deals(spark, rows):
    return frame(spark, DEAL_SCHEMA, rows)


def meetings(spark, rows):
    return frame(spark, MEETING_SCHEMA, rows)


def meeting_deals(spark, rows):
    return frame(spark, MEETING_DEALS_SCHEMA, rows)


def flags(spark, rows):
    return frame(spark, FLAGS_SCHEMA, rows)


def closers(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else ROSTER, CLOSERS_SCHEMA)


def stages(spark, rows):
    return frame(spark, STAGES_SCHEMA, rows)


def rows_of(df, cols, key="deal_id"):
    return sorted([tuple(r[c] for c in cols) for r in df.select(*cols).collect()], key=lambda t: str(t))
