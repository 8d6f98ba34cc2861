"""Scalar Column functions evaluated over whole stand-in tables (every deal,
meeting day or cash row), so time-zone, month-end and rounding edge cases all occur."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.functions import dates as D
from dealflow.functions import flags as FL
from dealflow.functions import ratios as RT
from dealflow.operators import metrics as A
from dealflow.plans import standins as S
from dealflow.operators.cube import day_cube, preset_windows
from dealflow.plans.context import Models
from dealflow.plans.oracle import W_END, W_START, et, lst, report_pct, safe_pct, sql
from dealflow.plans.registry import register


def _daily(m: Models):
    """Per closer and meeting day: PC invited / booked / completed."""
    c = F.col("meeting_category")
    return m.meetings_fct.groupBy("closer_owner_id", "meeting_date_et").agg(
        A.count_if(c == "PC").alias("pc_invited"),
        A.count_if((c == "PC") & F.col("is_booked")).alias("pc_booked"),
        A.count_if((c == "PC") & F.col("is_completed")).alias("pc_completed"))


DAILY_SQL = ("(SELECT closer_owner_id, meeting_date_et, count_if(meeting_category = 'PC') AS pc_invited, "
             "count_if(meeting_category = 'PC' AND is_booked) AS pc_booked, "
             "count_if(meeting_category = 'PC' AND is_completed) AS pc_completed FROM fct_meetings GROUP BY 1, 2)")


@register("f1_et_date", sql(f"SELECT deal_id, property_closedate, {et('property_closedate')} AS close_day_et FROM raw_deal"))
def f1_et_date(spark, sf_dir):
    r = Models.of(spark, sf_dir).raw_deal
    return r.select("deal_id", "property_closedate", D.et_date("property_closedate").alias("close_day_et"))


@register("f2_date_only", sql(
    "SELECT deal_id, CAST(property_upsell_close_date AS DATE) AS close_day, "
    "CAST(property_membership_expiration_date AS DATE) AS expiration_day FROM raw_deal"))
def f2_date_only(spark, sf_dir):
    r = Models.of(spark, sf_dir).raw_deal
    return r.select("deal_id", D.date_only("property_upsell_close_date").alias("close_day"),
                    D.date_only("property_membership_expiration_date").alias("expiration_day"))


@register("f3_effective_cash", sql("SELECT deal_id, COALESCE(NULLIF(cash_collected, 0), ap1_amount) AS effective_cash "
                                   "FROM stg_deals"))
def f3_effective_cash(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    return d.select("deal_id", FL.effective_cash("cash_collected", "ap1_amount").alias("effective_cash"))


@register("f4_casts", sql(
    "SELECT CAST(deal_id AS VARCHAR) AS deal_key, CAST(owner_id AS VARCHAR) AS owner_key, "
    "CAST(property_upsell_close_date AS DATE) AS close_day, CAST(property_cash_collected AS DOUBLE) AS cash FROM raw_deal"))
def f4_casts(spark, sf_dir):
    r = Models.of(spark, sf_dir).raw_deal
    return r.select(F.col("deal_id").cast("string").alias("deal_key"), F.col("owner_id").cast("string").alias("owner_key"),
                    F.col("property_upsell_close_date").cast("date").alias("close_day"),
                    F.col("property_cash_collected").cast("double").alias("cash"))


@register("f5_null_handling", sql(
    "SELECT deal_id, COALESCE(renewal_traffic_source, 'none') AS source_or_none, "
    "NULLIF(renewal_traffic_source, '') AS source_or_null, renewal_traffic_source IS NULL AS source_missing FROM stg_deals"))
def f5_null_handling(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    s = F.col("renewal_traffic_source")
    return d.select("deal_id", F.coalesce(s, F.lit("none")).alias("source_or_none"),
                    F.nullif(s, F.lit("")).alias("source_or_null"), s.isNull().alias("source_missing"))


_start = f"COALESCE(CAST(d.close_date AS DATE), {et('d.close_date_fallback')}, {et('tc.contact_true_renewal_close_date')})"


@register("f6_start_date", sql(f"SELECT d.deal_id, {_start} AS start_date_et FROM stg_deals d "
                               "LEFT JOIN stg_deal_contacts tc ON d.deal_id = tc.deal_id"))
def f6_start_date(spark, sf_dir):
    m = Models.of(spark, sf_dir)
    d = m.deals.join(m.contact_flags, "deal_id", "left")
    return d.select("deal_id", D.start_date("close_date", "close_date_fallback",
                                            "contact_true_renewal_close_date").alias("start_date_et"))


@register("f7_midpoint", sql(
    "SELECT deal_id, CAST(close_date AS DATE) + CAST(floor(date_diff('day', CAST(close_date AS DATE), "
    "CAST(membership_expiration_date AS DATE)) / 2) AS INTEGER) AS midpoint_et FROM stg_deals"))
def f7_midpoint(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    return d.select("deal_id", D.midpoint(D.date_only("close_date"), D.date_only("membership_expiration_date"))
                    .alias("midpoint_et"))


@register("f8_date_shift", sql(
    "SELECT deal_id, CAST(close_date AS DATE) + 45 AS plus_45, CAST(close_date AS DATE) - 15 AS minus_15, "
    "CAST(CAST(close_date AS DATE) - INTERVAL 1 MONTH AS DATE) AS minus_1_month FROM stg_deals"))
def f8_date_shift(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    c = D.date_only("close_date")
    return d.select("deal_id", D.add_days(c, 45).alias("plus_45"), D.add_days(c, -15).alias("minus_15"),
                    F.add_months(c, -1).alias("minus_1_month"))


@register("f9_month_parts", sql(
    "SELECT deal_id, CAST(date_trunc('month', CAST(close_date AS DATE)) AS DATE) AS month_start, "
    "last_day(CAST(close_date AS DATE)) AS month_end, CAST(day(CAST(close_date AS DATE)) AS INTEGER) AS day_of_month, "
    "LEAST(CAST(close_date AS DATE), CAST(membership_expiration_date AS DATE)) AS earlier FROM stg_deals"))
def f9_month_parts(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    c, e = D.date_only("close_date"), D.date_only("membership_expiration_date")
    return d.select("deal_id", F.trunc(c, "MM").alias("month_start"), F.last_day(c).alias("month_end"),
                    F.dayofmonth(c).alias("day_of_month"), F.least(c, e).alias("earlier"))


@register("f10_month_bounds", sql(
    "SELECT d AS as_of, d - 1 AS yesterday_et, CAST(date_trunc('month', d) AS DATE) AS mtd_start, "
    "CAST(date_trunc('month', d - INTERVAL 1 MONTH) AS DATE) AS prior_month_start, "
    "LEAST(CAST(date_trunc('month', d - INTERVAL 1 MONTH) AS DATE) + CAST(day(d) - 1 AS INTEGER), "
    "last_day(CAST(d - INTERVAL 1 MONTH AS DATE))) AS prior_mtd_end "
    "FROM (SELECT DISTINCT CAST(close_date AS DATE) AS d FROM stg_deals WHERE close_date IS NOT NULL)"))
def f10_month_bounds(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals.filter(F.col("close_date").isNotNull()).select(
        D.date_only("close_date").alias("as_of")).distinct()
    b = D.month_bounds(F.col("as_of"))
    return d.select("as_of", b["yesterday_et"].alias("yesterday_et"), b["mtd_start"].alias("mtd_start"),
                    b["prior_month_start"].alias("prior_month_start"), b["prior_mtd_end"].alias("prior_mtd_end"))


@register("f11_prior_window", sql(
    "SELECT deal_id, s - 1 - CAST(date_diff('day', s, e) AS INTEGER) AS prior_start, s - 1 AS prior_end FROM ("
    "SELECT deal_id, CAST(close_date AS DATE) AS s, CAST(membership_expiration_date AS DATE) AS e FROM stg_deals)"))
def f11_prior_window(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    ps, pe = D.prior_window(D.date_only("close_date"), D.date_only("membership_expiration_date"))
    return d.select("deal_id", ps.alias("prior_start"), pe.alias("prior_end"))


_F12 = {"today": ("d", "d"), "yesterday": ("d - 1", "d - 1"), **{f"last{n}d": (f"d - {n}", "d - 1") for n in (3, 7, 14, 30)},
        "mtd": ("d - CAST(day(d - 1) AS INTEGER)", "d - 1"), "custom": (f"DATE '{W_START}'", f"DATE '{W_END}'")}


@register("f12_window_bounds", sql(" UNION ALL ".join(
    f"SELECT d AS as_of, '{k}' AS preset, {a} AS window_start, {b} AS window_end FROM (SELECT DISTINCT meeting_date_et AS d FROM fct_meetings WHERE d IS NOT NULL)"
    for k, (a, b) in _F12.items())))
def f12_window_bounds(spark, sf_dir):
    """Every preset for every day with a meeting."""
    d = Models.of(spark, sf_dir).meetings_fct.filter(F.col("meeting_date_et").isNotNull()).select(F.col("meeting_date_et").alias("as_of")).distinct()
    rows = []
    for k in D.WINDOW_PRESETS:
        s, e = D.window_bounds(k, F.col("as_of"), *(S.WINDOW if k == "custom" else ()))
        rows.append(F.struct(F.lit(k).alias("preset"), s.alias("window_start"), e.alias("window_end")))
    return d.select("as_of", F.inline(F.array(*rows)))


def _cube_sql() -> str:
    """Each window by a scan of each fact."""
    facts = (("fct_cash", "cash_date_et", {"payments": "count(cash_amount)", "total_cash": "sum(cash_amount)"}),
             ("fct_won", "close_date_et", {"deals_won": "count(*)", "pwc_deals_won": "count(*) FILTER (is_post_webinar_close)"}),
             ("fct_meetings", "meeting_date_et", {f"{c.lower()}_{k}": f"count(*) FILTER (is_{k} AND meeting_category = '{c}')"
                                                  for k, cs in (("completed", ("PC", "RC", "PWC", "WB")), ("booked", ("PC", "RC"))) for c in cs}),
             ("fct_stage_entries", "entry_date_et", {f"{e}_entries": f"count(*) FILTER (stage_entry_type = '{e}')" for e in ("pc_invited", "pc_scheduled", "rc_invited", "rc_scheduled")}))
    spans = " UNION ALL ".join(f"SELECT '{k}' AS span, {a} AS first, {b} AS last FROM (SELECT DATE '{S.AS_OF}' AS d)" for k, (a, b) in _F12.items())
    cells = ", ".join(f"(SELECT {e} FROM {t} f WHERE f.closer_owner_id = c.owner_id AND f.{day} BETWEEN first AND last) AS {n}" for t, day, ms in facts for n, e in ms.items())
    return f'SELECT span AS "window", owner_id AS closer_owner_id, {cells} FROM ({spans}) w, closers c'


@register("f12_window_cube", sql(_cube_sql()))
def f12_window_cube(spark, sf_dir):
    """Every preset of every closer from one cube of running totals."""
    m = Models.of(spark, sf_dir)
    cube = day_cube({"cash": m.cash, "won": m.won_fct, "meetings": m.meetings_fct, "entries": m.entries}, m.closers)
    return preset_windows(cube, m.as_of, *S.WINDOW)


@register("f13_round_floor", sql(
    "SELECT deal_id, cash_component, round(cash_amount / 7, 2) AS seventh, floor(cash_amount / 7) AS seventh_floor "
    "FROM fct_cash"))
def f13_round_floor(spark, sf_dir):
    c = Models.of(spark, sf_dir).cash
    return c.select("deal_id", "cash_component", F.round(F.col("cash_amount") / 7, 2).alias("seventh"),
                    F.floor(F.col("cash_amount") / 7).cast("double").alias("seventh_floor"))


@register("f14_string_ops", sql(
    "SELECT deal_id, upper(trim(active_product_snapshot_at_won)) AS tier_key, 'plan:' || upsell_plan AS plan_label, "
    f"upsell_plan IN ({lst(('Gold', 'Bronze', 'Platinum'))}) AS is_metal FROM stg_deals"))
def f14_string_ops(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    return d.select("deal_id", F.upper(F.trim("active_product_snapshot_at_won")).alias("tier_key"),
                    F.concat(F.lit("plan:"), F.col("upsell_plan")).alias("plan_label"),
                    F.col("upsell_plan").isin("Gold", "Bronze", "Platinum").alias("is_metal"))


@register("f15_case", sql(
    f"SELECT deal_id, CASE WHEN pipeline_id = '{C.WINBACK_PIPELINE_ID}' THEN 'WINBACK' "
    f"WHEN pipeline_id IN ({lst(C.PipelineConfig().renewal_pipeline_ids)}) THEN 'RENEWAL' ELSE 'OTHER' END AS pipeline_kind "
    "FROM stg_deals"))
def f15_case(spark, sf_dir):
    d = Models.of(spark, sf_dir).deals
    p = F.col("pipeline_id")
    kind = (F.when(p == C.WINBACK_PIPELINE_ID, F.lit("WINBACK"))
            .when(p.isin(*C.PipelineConfig().renewal_pipeline_ids), F.lit("RENEWAL")).otherwise(F.lit("OTHER")))
    return d.select("deal_id", kind.alias("pipeline_kind"))


@register("f16_iso_day", sql(
    "SELECT deal_id, CASE WHEN length(t) >= 10 THEN CAST(substring(t, 1, 10) AS DATE) END AS iso_day FROM ("
    "SELECT deal_id, CASE WHEN deal_id % 5 = 0 THEN '' ELSE CAST(property_closedate AS VARCHAR) END AS t FROM raw_deal)"))
def f16_iso_day(spark, sf_dir):
    r = Models.of(spark, sf_dir).raw_deal
    t = F.when(F.col("deal_id") % 5 == 0, F.lit("")).otherwise(F.col("property_closedate").cast("string"))
    return r.select("deal_id", D.iso_day(t).alias("iso_day"))


@register("f17_safe_pct", sql(
    f"SELECT closer_owner_id, meeting_date_et, {safe_pct('pc_booked', 'pc_invited')} AS pc_book_pct FROM {DAILY_SQL}"))
def f17_safe_pct(spark, sf_dir):
    d = _daily(Models.of(spark, sf_dir))
    return d.select("closer_owner_id", "meeting_date_et", RT.safe_pct("pc_booked", "pc_invited").alias("pc_book_pct"))


@register("f18_ratio_or_zero", sql(
    "SELECT closer_owner_id, meeting_date_et, CASE WHEN pc_booked > 0 THEN pc_completed / pc_booked ELSE 0.0 END "
    f"AS show_ratio FROM {DAILY_SQL}"))
def f18_ratio_or_zero(spark, sf_dir):
    d = _daily(Models.of(spark, sf_dir))
    return d.select("closer_owner_id", "meeting_date_et", RT.ratio_or_zero("pc_completed", "pc_booked").alias("show_ratio"))


@register("f19_report_pct", sql(
    f"SELECT closer_owner_id, meeting_date_et, {report_pct('pc_completed', 'pc_invited')} AS pc_done_pct FROM {DAILY_SQL}"))
def f19_report_pct(spark, sf_dir):
    d = _daily(Models.of(spark, sf_dir))
    return d.select("closer_owner_id", "meeting_date_et",
                    RT.report_pct("pc_completed", "pc_invited").alias("pc_done_pct"))


@register("f20_to_ratio", sql(
    f"SELECT closer_owner_id, meeting_date_et, CASE WHEN p > 1 THEN p / 100.0 ELSE p END AS book_ratio FROM ("
    f"SELECT closer_owner_id, meeting_date_et, {safe_pct('pc_booked', 'pc_invited')} AS p FROM {DAILY_SQL})"))
def f20_to_ratio(spark, sf_dir):
    d = _daily(Models.of(spark, sf_dir))
    return d.select("closer_owner_id", "meeting_date_et", RT.to_ratio(RT.safe_pct("pc_booked", "pc_invited")).alias("book_ratio"))


def _int_txt(x: str) -> str:
    return f"CAST(CAST(round({x}) AS BIGINT) AS VARCHAR)"


def _money_k(x: str) -> str:
    return (f"CASE WHEN {x} >= 100000 THEN '$' || {_int_txt(f'{x} / 1000.0')} || 'K' "
            f"WHEN {x} >= 1000 THEN '$' || printf('%.1f', round({x} / 1000.0, 1)) || 'K' ELSE '$' || {_int_txt(x)} END")


@register("f21_labels", sql(
    f"SELECT deal_id, cash_component, {_money_k('cash_amount')} AS money_k, "
    f"CASE WHEN cash_amount - 5000 >= 0 THEN '+' ELSE '-' END || ({_money_k('abs(cash_amount - 5000)')}) AS money_k_signed, "
    "'$' || format('{:,}', CAST(round(cash_amount) AS BIGINT)) AS money, "
    f"{_int_txt('(CASE WHEN cash_amount / 100000.0 > 1 THEN cash_amount / 100000.0 / 100.0 ELSE cash_amount / 100000.0 END) * 100.0')} || '%' AS pct "
    "FROM fct_cash"))
def f21_labels(spark, sf_dir):
    c = Models.of(spark, sf_dir).cash
    a = F.col("cash_amount")
    return c.select("deal_id", "cash_component", RT.money_k(a).alias("money_k"),
                    RT.money_k_signed(a - 5000).alias("money_k_signed"), RT.money(a).alias("money"),
                    RT.pct_label(a / 100000.0).alias("pct"))


@register("f22_status", sql(
    "SELECT closer_owner_id, meeting_date_et, CASE WHEN r IS NULL THEN NULL WHEN r >= 1 THEN 'green' "
    f"WHEN r >= {C.STATUS_YELLOW_FROM} THEN 'yellow' ELSE 'red' END AS status FROM ("
    f"SELECT closer_owner_id, meeting_date_et, pc_completed / NULLIF(2.0, 0) AS r FROM {DAILY_SQL})"))
def f22_status(spark, sf_dir):
    d = _daily(Models.of(spark, sf_dir))
    return d.select("closer_owner_id", "meeting_date_et", RT.status("pc_completed", F.lit(2.0)).alias("status"))


@register("f23_progress", sql(
    "SELECT closer_owner_id, cash_date_et, SUM(cash_amount) / 1000.0 AS progress FROM fct_cash GROUP BY 1, 2"))
def f23_progress(spark, sf_dir):
    c = Models.of(spark, sf_dir).cash.groupBy("closer_owner_id", "cash_date_et").agg(F.sum("cash_amount").alias("cash"))
    return c.select("closer_owner_id", "cash_date_et", RT.progress("cash", F.lit(1000.0)).alias("progress"))


@register("f24_is_inactive", sql(
    f"SELECT closer_owner_id, meeting_date_et, COALESCE(pc_completed, 0) = 0 AS is_inactive FROM {DAILY_SQL}"))
def f24_is_inactive(spark, sf_dir):
    d = _daily(Models.of(spark, sf_dir))
    return d.select("closer_owner_id", "meeting_date_et", RT.is_inactive("pc_completed").alias("is_inactive"))

