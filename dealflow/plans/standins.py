"""CRM-shaped stand-in tables derived from the driver's parquet tables.

No CRM extract ships with the test data, so the raw landed tables are derived with plain
expressions (valid in Spark SQL and DuckDB alike) from ``orders``, ``lineitem``,
``events``, ``customer`` and ``nation``:

* DEAL                 <- orders (+ lineitem pivoted per order into the 7 dated payments)
* ENGAGEMENT_MEETING   <- events (start times shifted into the orders' era)
* ENGAGEMENT_DEAL      <- events (0-3 associations per meeting, incl. NULL deal ids)
* DEAL_CONTACT         <- orders (1-2 contacts per deal)
* CONTACT              <- customer (MACHINERY = internal test record)
* closers / targets    <- nation (keys 0-4 on the roster, 0-5 with targets)

The stage, product and tier dimensions are the packaged seeds. Every derivation scans the
whole input table; nothing is sampled. The only shuffle is the per-order pivot of
lineitem (partial aggregation) and its join to orders on the order key.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.sources.dims import load_dim, seed_rows

#: A day with cash on it and on the day before (sf0.01), inside the span of the meetings, so that windows cut some.
AS_OF = _dt.date(2001, 3, 13)
WINDOW = (_dt.date(2000, 4, 1), _dt.date(2001, 3, 12))
EVENT_SHIFT_DAYS = 8355
STAGE_SLOTS = 16
#: The pipeline of a deal by its order's priority; other priorities have none.
PIPELINES = {"1-URGENT": C.OLD_RENEWAL_PIPELINE_ID, "2-HIGH": C.NEW_RENEWAL_PIPELINE_ID,
             "3-MEDIUM": C.WINBACK_PIPELINE_ID, "4-NOT SPECIFIED": "100000001"}

# Stand-in vocabularies: the seeded values plus a few that are deliberately unmapped.
UNMAPPED_PLANS = ("Legacy Plan", "Custom Renewal")
UNMAPPED_TIERS = ("Legacy Tier", "Unknown Product")
RENEWAL_PRODUCTS = ("MM Gold", "MM Platinum", "MM Bronze", "Restart", "Accelerator", "Accelerator Upgrade",
                    "MM Upgrade — Bronze to Gold", "MM Upgrade — Gold to Platinum", "Other")


def plan_values() -> list[str]:
    return [r["upsell_plan"] for r in seed_rows("dim_product_map")] + list(UNMAPPED_PLANS)


def tier_values() -> list[str]:
    return [r["active_product_snapshot_at_won"] for r in seed_rows("dim_member_tier_map")] + list(UNMAPPED_TIERS)


def stage_slots() -> dict[tuple[str, int], str]:
    """(pipeline id, slot) -> stage id, slots numbered per pipeline in seed order."""
    out, seen = {}, {}
    for r in seed_rows("dim_renewal_stages"):
        i = seen.get(r["pipeline_id"], 0)
        out[(r["pipeline_id"], i)] = r["stage_id"]
        seen[r["pipeline_id"]] = i + 1
    return out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_str(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pick_text(idx_sql: str, values) -> str:
    """values[idx] (0-based) as SQL: a lookup in a constant array, whatever its length; NULL beyond it."""
    return f"get(array({', '.join('CAST(NULL AS STRING)' if v is None else _sql_str(v) for v in values)}), CAST({idx_sql} AS INT))"


def _pick_sql(idx_sql: str, values) -> Column:
    """``_pick_text`` as a Column (one JVM call, not one per literal)."""
    return F.expr(_pick_text(idx_sql, values))


def _case(key: Column, mapping: dict, default: Column | None = None) -> Column:
    expr = None
    for k, v in mapping.items():
        val = F.lit(v) if not isinstance(v, Column) else v
        expr = F.when(key == F.lit(k), val) if expr is None else expr.when(key == F.lit(k), val)
    return expr.otherwise(default) if default is not None else expr


def _shift(ts: Column, days: Column | int = 0, hours: Column | int = 0) -> Column:
    d = days if isinstance(days, Column) else F.lit(days)
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return ts + F.make_dt_interval(d.cast("int"), h.cast("int"), F.lit(0), F.lit(0))


def lineitem_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: amount of each line number 1..7 (returned lines negative) and, for lines
    2..7, the latest ship date among finished lines; plus the smallest part key."""
    li = read(spark, sf_dir, "lineitem")
    # whole dollars: sums are exact in any order, so engines agree bit for bit
    amt = F.when(F.col("l_returnflag") == "R", F.lit(-1.0)).otherwise(F.lit(1.0)) * F.floor(
        F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).cast("double")
    ln = F.col("l_linenumber")
    aggs = [F.sum(F.when(ln == k, amt)).alias(f"amt{k}") for k in range(1, 8)]
    aggs += [F.max(F.when((ln == k) & (F.col("l_linestatus") == "F"), F.col("l_shipdate"))).alias(f"dt{k}")
             for k in range(2, 8)]
    aggs.append(F.min("l_partkey").alias("min_partkey"))
    return li.groupBy("l_orderkey").agg(*aggs)


#: When the landing is looked at, and each table's least age in hours: one fresh, one to warn of, one too old.
LOOKED_AT = _dt.datetime(2001, 3, 17, 5, 0, 0)
LEAST_AGE = {"raw_deal": 2, "raw_meeting": 5, "raw_engagement_deal": 1, "raw_deal_contact": 9, "raw_contact": 3}


def synced(table: str, key: Column) -> Column:
    """The load time of a landed row."""
    return _shift(F.expr(f"TIMESTAMP_NTZ '{LOOKED_AT}'"), 0, -(F.lit(LEAST_AGE[table]) + key % 40)).alias("_fivetran_synced")


def raw_deal(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    pay = lineitem_payments(spark, sf_dir)
    d = o.join(pay, o["o_orderkey"] == pay["l_orderkey"], "left")
    k, c, od = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    pipe = _case(F.col("o_orderpriority"), PIPELINES)
    # A pipeline's stages are a constant array looked up by slot: filters repeat this expression, so that a
    # CASE over every pipeline and slot would be walked several times a row.
    slots = stage_slots()
    slot_sql = f"((o_orderkey * 7 + o_custkey) % {STAGE_SLOTS})"
    own = {p: [st for (of, _), st in slots.items() if of == p] for p, _ in slots}
    stage = F.expr("coalesce(CASE o_orderpriority " + " ".join(
        f"WHEN {_sql_str(prio)} THEN {_pick_text(slot_sql, own[p])}" for prio, p in PIPELINES.items() if p in own)
        + f" END, concat('x-', CAST({slot_sql} AS STRING)))")
    tiers = tier_values()
    tier = _pick_sql(f"o_custkey % {len(tiers)}", tiers)
    tier = F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(
        _case(k % 3, {0: tier, 1: F.upper(tier)}, F.concat(F.lit("  "), F.lower(tier), F.lit(" "))))
    cols = [
        k.alias("deal_id"),
        (c % 10).alias("owner_id"),
        pipe.alias("deal_pipeline_id"),
        stage.alias("deal_pipeline_stage_id"),
        F.when(k % 5 != 0, od).alias("property_upsell_close_date"),
        F.when(k % 7 != 0, _shift(od, 0, k % 24)).alias("property_closedate"),
        F.col("amt1").alias("property_cash_collected"),
        F.col("amt2").alias("property_additional_payment_1_amount"),
        F.col("dt2").alias("property_additional_payment_1_stamped_date"),
        F.col("amt3").alias("property_additional_payment_2_amount"),
        F.col("dt3").alias("property_additional_payment_2_stamped_date"),
        F.col("amt4").alias("property_collected_amount_additional_payment_3"),
        F.col("dt4").alias("property_collected_date_additional_payment_3"),
        F.col("amt5").alias("property_collected_amount_additional_payment_4"),
        F.col("dt5").alias("property_collected_date_additional_payment_4"),
        F.col("amt6").alias("property_collected_amount_additional_payment_11"),
        F.col("dt6").alias("property_collected_date_additional_payment_11"),
        F.col("amt7").alias("property_collected_amount_additional_payment_12"),
        F.col("dt7").alias("property_collected_date_additional_payment_12"),
        _case(c % 4, {0: "1st Year", 1: "2nd Year", 2: "3rd Year+"}).alias("property_renewal_year_count"),
        _case(c % 3, {0: "Mastermind", 1: "Accelerator"}).alias(
            "property_renewal_product_category_originally_purchased"),
        _pick_sql("min_partkey % 27", plan_values()).alias("property_upsell_plan"),
        F.col("o_orderpriority").alias("property_renewal_product_pitched"),
        tier.alias("property_active_product_snapshot_at_won"),
        _case(k % 6, {0: "Webinar", 1: "", 2: F.lit(None).cast("string")}, F.lit("Organic")).alias(
            "property_renewal_traffic_source"),
    ]
    for j, (_, new_col, old_col) in enumerate(C.STAGE_ENTRY_SOURCES):
        for v, name in ((0, new_col), (1, old_col)):
            ts = _shift(od, (k * (j + 2) + v * 11) % 60, (k + 5 * j + v) % 24)
            cols.append(F.when((k + 3 * j + v) % 4 != 0, ts).alias(name))
    cols += [
        _shift(od, k % 45, (k * 3) % 24).alias("property_hs_v_2_date_entered_current_stage"),
        F.when(k % 13 != 0, _shift(od, F.lit(180) + k % 240, 0)).alias("property_membership_expiration_date"),
        _pick_sql("min_partkey % 9", RENEWAL_PRODUCTS).alias("property_renewal_product"),
        F.when(k % 9 == 0, F.lit("Referral")).otherwise(F.lit("Renewal")).alias("property_renewal_pipeline_type"),
        _case(F.col("o_orderstatus"), {"P": k % 5 == 2, "F": F.lit(False)}).alias("_fivetran_deleted"),
        synced("raw_deal", k),
    ]
    return d.select(cols)


def _mod(r: int, n: int) -> int:
    """r % n as in SQL, with the sign of r."""
    return r % n if r >= 0 else -(-r % n)


#: The activity of a meeting by its event's type and what its id leaves when divided by 6 (-5 to 5).
ACTIVITIES = {
    "signup": lambda r: "Renewal 3 Month" if r % 2 == 0 else "Renewal Accelerator 3 month",
    "click": lambda r: {0: "Renewal Strategy", 1: "Renewal Accelerator"}.get(_mod(r, 3), "Renewal Follow-up"),
    "view": lambda r: "Renewal Post Webinar Call" if r % 2 == 0 else "Renewal Strategy Alignment",
    "purchase": lambda r: "Renewal Winback Call",
    "error": lambda r: "Renewal Accelerator Evergreen" if r % 2 == 0 else None,
}


def raw_meeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    e = F.col("event_id")
    # Lookups in constant arrays, as filters repeat these expressions many times over.
    kinds = ", ".join(map(_sql_str, ACTIVITIES))
    activity = _pick_sql(f"(array_position(array({kinds}), event_type) - 1) * 11 + coalesce(event_id % 6, -1) + 5",
                         [of(r) for of in ACTIVITIES.values() for r in range(-5, 6)])
    done, lost = "COMPLETED", ("CANCELED", "CANCELLED")
    outcome = F.when(e % 5 == 0, F.lit(done)).otherwise(
        _pick_sql("event_id % 10", (done, lost[1], None, done, "NO_SHOW", done, lost[0], None, done, "COMPLETED - NURTURE")))
    start = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz") - F.make_dt_interval(F.lit(EVENT_SHIFT_DAYS))
    return ev.select(
        e.alias("engagement_id"),
        (F.col("user_id") % 10).alias("property_hubspot_owner_id"),
        activity.alias("property_hs_activity_type"),
        outcome.alias("property_hs_meeting_outcome"),
        F.when(e % 17 != 0, start).alias("property_hs_meeting_start_time"),
        _case(e % 11, {0: F.lit(True), 1: F.lit(None).cast("boolean")}, F.lit(False)).alias("_fivetran_deleted"),
        synced("raw_meeting", e),
    )


def raw_engagement_deal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0-3 association rows per meeting from one scan of events (generator, no union)."""
    ev = read(spark, sf_dir, "events")
    e, u = F.col("event_id"), F.col("user_id")
    linked = e % 7 != 0
    rows = F.array(
        F.struct(linked.alias("keep"), (u * 100 + e % 3).alias("deal_id")),
        F.struct((linked & (e % 2 == 0)).alias("keep"), (u * 100 + 3 + e % 4).alias("deal_id")),
        F.struct((linked & (e % 13 == 0)).alias("keep"), F.lit(None).cast("long").alias("deal_id")),
    )
    return ev.select(e.alias("engagement_id"), F.inline(rows), synced("raw_engagement_deal", e)).filter(F.col("keep")).drop("keep")


def raw_deal_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = F.array(F.struct(F.lit(True).alias("keep"), c.alias("contact_id")),
                   F.struct((k % 50 == 0).alias("keep"), (c + 1).alias("contact_id")))
    return o.select(k.alias("deal_id"), F.inline(rows), synced("raw_deal_contact", k)).filter(F.col("keep")).drop("keep")


def raw_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    base = F.expr("TIMESTAMP_NTZ '1999-01-01 02:00:00'")
    return cu.select(
        ck.alias("id"),
        _case(F.col("c_mktsegment"), {"MACHINERY": F.lit(C.TEST_LEAD_STATUS), "BUILDING": F.lit(None).cast("string")},
              F.col("c_mktsegment")).alias("property_hs_lead_status"),
        F.when(F.col("c_acctbal") > 0, _shift(base, ck % 700, ck % 6)).alias("property_true_renewal_close_date"),
        F.when(F.col("c_nationkey") == 7, F.lit(True)).alias("_fivetran_deleted"),
        synced("raw_contact", ck),
    )


def closers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.filter(F.col("n_nationkey") < 5).select(
        F.col("n_nationkey").cast("string").alias("owner_id"), F.col("n_name").alias("closer_name"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    nk = F.col("n_nationkey")
    return n.filter(nk < 6).select(
        F.col("n_name").alias("closer_name"),
        (F.lit(50000.0) + F.lit(5000.0) * nk).alias("goal_total_cash"),
        (F.lit(4.0) + nk).cast("double").alias("goal_deals_won"),
        F.lit(30.0).alias("goal_live_close_pct"),
        F.lit(3500.0).alias("goal_avg_dpl"),
    )


def stages(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return load_dim(spark, "dim_renewal_stages")


def product_map(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return load_dim(spark, "dim_product_map")


def tier_map(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return load_dim(spark, "dim_member_tier_map")


# ---------------------------------------------------------------- second system (R*)


def iso_text(col: str) -> Column:
    """A time as the second system writes it."""
    return F.date_format(F.col(col), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def other_deals(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Second system's deal records: live deals under its own property names, with ids
    % 97 = 0 missing and the base cash of ids % 89 = 0 shifted by 100."""
    from dealflow.sources.scans import live_rows

    d = live_rows(raw if raw is not None else raw_deal(spark, sf_dir)).filter(F.col("deal_id") % 97 != 0)
    k = F.col("deal_id")
    return d.select(
        k.cast("string").alias("id"),
        F.col("deal_pipeline_id").alias("pipeline"),
        F.col("deal_pipeline_stage_id").alias("dealstage"),
        F.col("owner_id").cast("string").alias("hubspot_owner_id"),
        iso_text("property_upsell_close_date").alias("upsell___close_date"),
        F.when(k % 89 == 0, F.col("property_cash_collected") + 100.0).otherwise(
            F.col("property_cash_collected")).alias("cash_collected"),
        F.col("property_additional_payment_1_amount").alias("additional_payment_1_amount"),
        F.col("property_additional_payment_1_stamped_date").alias("additional_payment_1_stamped_date"),
        F.col("property_additional_payment_2_amount").alias("additional_payment_2_amount"),
        F.col("property_additional_payment_2_stamped_date").alias("additional_payment_2_stamped_date"),
        F.col("property_collected_amount_additional_payment_3").alias("collected_amount__additional_payment_3"),
        F.col("property_collected_date_additional_payment_3").alias("collected_date__additional_payment_3"),
        F.col("property_collected_amount_additional_payment_4").alias("collected_amount__additional_payment_4"),
        F.col("property_collected_date_additional_payment_4").alias("collected_date__additional_payment_4"),
        F.col("property_upsell_plan").alias("upsell_plan"),
        F.col("property_renewal_traffic_source").alias("renewal_traffic_source"),
    )


def other_meetings(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    from dealflow.sources.scans import live_rows

    m = live_rows(raw if raw is not None else raw_meeting(spark, sf_dir)).filter(F.col("engagement_id") % 97 != 0)
    return m.select(
        F.col("engagement_id").cast("string").alias("id"),
        F.col("property_hs_activity_type").alias("hs_activity_type"),
        F.col("property_hs_meeting_outcome").alias("hs_meeting_outcome"),
        F.col("property_hubspot_owner_id").cast("string").alias("hubspot_owner_id"),
        iso_text("property_hs_meeting_start_time").alias("hs_meeting_start_time"),
    )
