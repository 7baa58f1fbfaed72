"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)``, reads the warehouse built from the
given tables at ``sf_dir`` and returns a DataFrame (never collected here).
Thresholds marked "fixture" are lowered from the reference's defaults where
the default leaves (almost) no group on the test data; the function default
stays the reference's value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deliverylens.operators import kpis, quality
from deliverylens.operators.fact import apply_engine_defaults
from deliverylens.plans.oracle import (
    PCT, WEEKDAY_CASE, avgx, avgd, r2, rate_div, rate_mul, with_base,
)
from deliverylens.plans.warehouse import warehouse_for
from deliverylens.functions.translate import CATEGORY_LABELS_EN
from deliverylens.sources.schemas import FACT_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}

# Fixture thresholds (reference default in the function signature).
STATE_MIN_ORDERS = 500
CITY_MIN_ORDERS = 100
ROUTE_MIN_ORDERS = 50
DAY_MICROS = "CAST(86400000000 AS DOUBLE)"


def register(name: str, sql: str | None, extra_ctes: str = ""):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, with_base(sql, extra_ctes) if sql is not None else None)
        return fn
    return deco


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse_for(spark, sf_dir).fact


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return warehouse_for(spark, sf_dir).table(name)


def fact_query(name: str, fn, sql: str | None, extra_ctes: str = "", **kw) -> None:
    register(name, sql, extra_ctes)(lambda spark, d: fn(fact(spark, d), **kw))


# ---- J8 / D1-D5 --------------------------------------------------------------

register("j08_fact", "SELECT * FROM fact")(
    lambda spark, d: fact(spark, d).select(*FACT_COLUMNS))

def _fact_defaults_sql() -> str:
    from deliverylens.sources.schemas import FACT
    keep_null = {"review_score"}
    cols = []
    for f in FACT.fields:
        t = f.dataType.simpleString()
        if f.name in keep_null or t not in ("string", "double", "int"):
            cols.append(f.name)
        else:
            default = {"string": "''", "double": "CAST(0 AS DOUBLE)", "int": "0"}[t]
            cols.append(f"coalesce({f.name}, {default}) AS {f.name}")
    return "SELECT " + ", ".join(cols) + " FROM fact"


register("j08_fact_engine_defaults", _fact_defaults_sql())(
    lambda spark, d: apply_engine_defaults(fact(spark, d).select(*FACT_COLUMNS)))

register("d_quality_report", f"""
SELECT 1 AS check_id, 'fact row count > 0' AS check_name, count(*) AS value,
       count(*) > 0 AS passed FROM fact
UNION ALL SELECT 2, 'No NULL order_id', count_if(order_id IS NULL OR order_id = ''),
       count_if(order_id IS NULL OR order_id = '') = 0 FROM fact
UNION ALL SELECT 3, 'No negative actual_delivery_days', count_if(actual_delivery_days < 0),
       count_if(actual_delivery_days < 0) = 0 FROM fact
UNION ALL SELECT 4, 'review_score in range 1-5 or NULL',
       count_if(review_score NOT IN (1,2,3,4,5) AND review_score IS NOT NULL),
       count_if(review_score NOT IN (1,2,3,4,5) AND review_score IS NOT NULL) = 0 FROM fact
UNION ALL SELECT 5, 'is_delayed only 0 or 1', count(*) - count_if(coalesce(is_delayed, -1) IN (0, 1)),
       count(*) = count_if(coalesce(is_delayed, -1) IN (0, 1)) FROM fact
""")(lambda spark, d: quality.quality_report(fact(spark, d)))

# ---- Q01 - Q12 ----------------------------------------------------------------

fact_query("q01_delivery_summary", kpis.delivery_summary, f"""
SELECT count(*) AS total_orders,
  {r2(avgd('actual_delivery_days'))} AS avg_delivery_days,
  {r2(avgd('approval_time_days'))} AS avg_approval_days,
  {r2(avgd('seller_processing_days'))} AS avg_seller_processing_days,
  {r2(avgd('carrier_transit_days'))} AS avg_carrier_transit_days,
  {r2(avgd('delay_days'))} AS avg_delay_days,
  {r2(rate_div('is_delayed = 0'))} AS on_time_rate_pct,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct
FROM fact""")

fact_query("q02_state_performance", kpis.state_performance, f"""
SELECT customer_state, count(*) AS total_orders, count_if(is_delayed = 1) AS delayed_orders,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct,
  {r2(avgd('actual_delivery_days'))} AS avg_delivery_days,
  {r2(avgd('carrier_transit_days'))} AS avg_carrier_transit_days,
  {r2('avg(review_score)')} AS avg_review_score
FROM fact GROUP BY customer_state ORDER BY delay_rate_pct DESC, customer_state""")

fact_query("q03_seller_ranking", kpis.seller_ranking, f"""
SELECT seller_id, seller_city, seller_state, count(*) AS total_orders,
  count_if(is_delayed = 1) AS delayed_orders,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct,
  {r2(avgd('seller_processing_days'))} AS avg_processing_days,
  {r2('avg(review_score)')} AS avg_review_score
FROM fact GROUP BY seller_id, seller_city, seller_state HAVING count(*) >= 10
ORDER BY delay_rate_pct DESC, seller_id""")

fact_query("q04_stage_bottleneck", kpis.stage_bottleneck, f"""
SELECT {r2(avgd('approval_time_days'))} AS avg_approval_days,
  {r2(avgd('seller_processing_days'))} AS avg_seller_processing_days,
  {r2(avgd('carrier_transit_days'))} AS avg_carrier_transit_days,
  {r2('quantile_cont(approval_time_days, 0.5)')} AS median_approval_days,
  {r2('quantile_cont(seller_processing_days, 0.5)')} AS median_seller_processing_days,
  {r2('quantile_cont(carrier_transit_days, 0.5)')} AS median_carrier_transit_days
FROM fact""")

fact_query("q05_delay_vs_review", kpis.delay_vs_review, f"""
SELECT is_delayed, {r2('avg(review_score)', 3)} AS avg_review_score, count(*) AS total_orders,
  {r2(avgd('delay_days'))} AS avg_delay_days
FROM fact WHERE review_score IS NOT NULL GROUP BY is_delayed ORDER BY is_delayed""")

fact_query("q06_monthly_trend", kpis.monthly_trend, f"""
SELECT CAST(year(order_purchase_timestamp) * 100 + month(order_purchase_timestamp) AS INTEGER)
    AS year_month,
  count(*) AS total_orders, {r2(avgd('actual_delivery_days'))} AS avg_delivery_days,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct, {r2('avg(review_score)')} AS avg_review_score
FROM fact GROUP BY 1 ORDER BY 1""")

fact_query("q07_on_time_rate", kpis.on_time_rate,
            f"SELECT {r2(rate_div('is_delayed = 0'))} AS on_time_rate_pct FROM fact")
fact_query("q08_delay_rate", kpis.delay_rate,
            f"SELECT {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct FROM fact")
fact_query("q09_total_orders", kpis.total_orders, "SELECT count(*) AS total_orders FROM fact")
fact_query("q10_avg_delivery_days", kpis.avg_delivery_days,
            f"SELECT {r2(avgd('actual_delivery_days'))} AS avg_delivery_days FROM fact")
fact_query("q11_avg_review_score", kpis.avg_review_score,
            f"SELECT {r2('avg(review_score)')} AS avg_review_score FROM fact "
            "WHERE review_score IS NOT NULL")

fact_query("q12_monthly_delay", kpis.monthly_delay, f"""
SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS bulan,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct, count(*) AS total_orders
FROM fact GROUP BY 1 ORDER BY 1""")

# ---- Q13 - Q17 ----------------------------------------------------------------

fact_query("q13_delivery_days_distribution", kpis.delivery_days_distribution, f"""
SELECT CASE WHEN actual_delivery_days <= 5 THEN '0-5 hari'
            WHEN actual_delivery_days <= 10 THEN '6-10 hari'
            WHEN actual_delivery_days <= 15 THEN '11-15 hari'
            WHEN actual_delivery_days <= 20 THEN '16-20 hari'
            WHEN actual_delivery_days <= 30 THEN '21-30 hari'
            ELSE '>30 hari' END AS delivery_bucket,
  count(*) AS total_orders,
  round(count(*) * {PCT} / (SELECT count(*) FROM fact), 2) AS percentage
FROM fact GROUP BY 1""")

fact_query("q14_stage_breakdown", kpis.stage_breakdown, f"""
SELECT 'Approval Time' AS stage_name, round({avgd('approval_time_days')}, 2) AS avg_days,
  round(min(approval_time_days), 2) AS min_days, round(max(approval_time_days), 2) AS max_days,
  count(*) AS total_orders FROM fact
UNION ALL
SELECT 'Seller Processing', round({avgd('seller_processing_days')}, 2),
  round(min(seller_processing_days), 2), round(max(seller_processing_days), 2), count(*) FROM fact
UNION ALL
SELECT 'Carrier Transit', round({avgd('carrier_transit_days')}, 2),
  round(min(carrier_transit_days), 2), round(max(carrier_transit_days), 2), count(*) FROM fact
ORDER BY avg_days DESC""")

fact_query("q15_top_sellers_by_delay", kpis.top_sellers_by_delay, f"""
SELECT 'Seller ' || left(seller_id, 6) AS seller_label, seller_city, seller_state,
  {r2(rate_mul('is_delayed = 1'))} AS delay_rate_pct, count(*) AS total_orders
FROM fact GROUP BY seller_id, seller_city, seller_state HAVING count(*) >= 20
ORDER BY delay_rate_pct DESC, seller_id NULLS LAST, seller_city NULLS LAST,
  seller_state NULLS LAST
LIMIT 15""")

fact_query("q16_stage_by_state", kpis.stage_by_state, f"""
SELECT customer_state, {r2(avgd('approval_time_days'))} AS approval_days,
  {r2(avgd('seller_processing_days'))} AS seller_processing_days,
  {r2(avgd('carrier_transit_days'))} AS carrier_transit_days,
  {r2(avgd('actual_delivery_days'))} AS total_delivery_days, count(*) AS total_orders
FROM fact GROUP BY customer_state HAVING count(*) >= {STATE_MIN_ORDERS}
ORDER BY total_delivery_days DESC, customer_state NULLS LAST LIMIT 10""",
            min_orders=STATE_MIN_ORDERS)

fact_query("q17_processing_bucket_delay", kpis.processing_bucket_delay, f"""
SELECT CASE WHEN avg_processing_days <= 3 THEN '1. 0-3 Hari'
            WHEN avg_processing_days <= 6 THEN '2. 4-6 Hari'
            WHEN avg_processing_days <= 9 THEN '3. 7-9 Hari'
            WHEN avg_processing_days <= 12 THEN '4. 10-12 Hari'
            ELSE '5. > 12 Hari' END AS processing_bucket,
  round(avg(delay_rate_pct), 2) AS avg_delay_rate_pct, count(*) AS total_sellers
FROM (SELECT seller_id, {avgd('seller_processing_days')} AS avg_processing_days,
             {rate_div('is_delayed = 1')} AS delay_rate_pct
      FROM fact GROUP BY seller_id HAVING count(*) >= 10)
GROUP BY 1 ORDER BY 1""")

# ---- Q18 - Q22 ----------------------------------------------------------------


def _category_case(code: str) -> str:
    whens = "\n".join(
        "    WHEN '{}' THEN '{}'".format(k, v.replace("'", "''"))
        for k, v in CATEGORY_LABELS_EN.items())
    return f"CASE {code}\n{whens}\n    ELSE replace({code}, '_', ' ') END"


register("q18_category_delay", f"""
SELECT {_category_case('product_category_name')} AS product_category_en,
  CAST(sum(n) AS BIGINT) AS total_orders, round(sum(late) * {PCT} / sum(n), 2) AS delay_rate_pct,
  round(sum(micros) / {DAY_MICROS} / sum(timed), 2) AS avg_delivery_days,
  round(sum(score) / sum(scored), 2) AS avg_review_score
FROM (SELECT product_id, sum(n) AS n, sum(late) AS late, sum(micros) AS micros, sum(timed) AS timed,
             sum(score) AS score, sum(scored) AS scored
      FROM stg_order_items JOIN (
        SELECT order_id, count(*) AS n, sum(is_delayed) AS late, sum(review_score) AS score,
               count(review_score) AS scored, count(actual_delivery_days) AS timed,
               sum(CAST(round(actual_delivery_days * {DAY_MICROS}) AS BIGINT)) AS micros
        FROM fact GROUP BY order_id) USING (order_id)
      GROUP BY product_id)
JOIN stg_products USING (product_id)
WHERE product_category_name IS NOT NULL
GROUP BY ALL HAVING sum(n) >= 100
ORDER BY delay_rate_pct DESC, product_category_en LIMIT 10""")(
    lambda spark, d: kpis.category_delay(fact(spark, d), table(spark, d, "stg_order_items"),
                                         table(spark, d, "stg_products")))

fact_query("q19_seller_risk", kpis.seller_risk, f"""
SELECT seller_id, seller_city, seller_state, count(*) AS total_orders,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct,
  {r2(avgd('seller_processing_days'))} AS avg_processing_days,
  {r2(avgd('carrier_transit_days'))} AS avg_transit_days,
  {r2('avg(review_score)')} AS avg_review_score,
  CASE WHEN {rate_div('is_delayed = 1')} >= 30 THEN '🚨 Kritis'
       WHEN {rate_div('is_delayed = 1')} >= 20 THEN '🔴 Tinggi'
       WHEN {rate_div('is_delayed = 1')} >= 10 THEN '🟠 Sedang'
       ELSE '🟢 Baik' END AS risk_level
FROM fact GROUP BY seller_id, seller_city, seller_state HAVING count(*) >= 10
ORDER BY delay_rate_pct DESC, seller_id""")

# each at the reference's threshold and at one that leaves rows at small scale

for _name, _least in (("q20_city_map", CITY_MIN_ORDERS), ("q20_city_map_from_10", 10)):
    fact_query(_name, kpis.city_map, f"""
SELECT customer_city, customer_state, count(*) AS total_orders,
  {r2(avgd('actual_delivery_days'))} AS avg_delivery_days,
  {r2(rate_mul('is_delayed = 1'))} AS delay_rate_pct,
  {avgx('customer_lat')} AS lat, {avgx('customer_lng')} AS lng
FROM fact GROUP BY customer_city, customer_state HAVING count(*) >= {_least}
ORDER BY total_orders DESC, customer_city NULLS LAST, customer_state NULLS LAST LIMIT 100""",
               min_orders=_least)

for _name, _least in (("q21_route_performance", ROUTE_MIN_ORDERS), ("q21_route_performance_from_20", 20)):
    register(_name, f"""
SELECT origin_state, destination_state, origin_state || ' → ' || destination_state AS delivery_route,
  CAST(sum(n) AS BIGINT) AS total_orders,
  round(sum(micros) / {DAY_MICROS} / sum(timed), 2) AS avg_delivery_days,
  round(sum(late) * {PCT} / sum(n), 2) AS delay_rate_pct,
  round(sum(transit) / {DAY_MICROS} / sum(carried), 2) AS avg_transit_days
FROM (SELECT seller_id, customer_id, count(*) AS n, sum(is_delayed) AS late,
             count(actual_delivery_days) AS timed, count(carrier_transit_days) AS carried,
             sum(CAST(round(actual_delivery_days * {DAY_MICROS}) AS BIGINT)) AS micros,
             sum(CAST(round(carrier_transit_days * {DAY_MICROS}) AS BIGINT)) AS transit
      FROM fact GROUP BY seller_id, customer_id)
JOIN (SELECT seller_id, seller_state AS origin_state FROM stg_sellers) USING (seller_id)
JOIN (SELECT customer_id, customer_state AS destination_state FROM stg_customers) USING (customer_id)
GROUP BY ALL HAVING sum(n) >= {_least}
ORDER BY delay_rate_pct DESC, origin_state NULLS LAST, destination_state NULLS LAST LIMIT 10""")(
        lambda spark, d, least=_least: kpis.route_performance(
            fact(spark, d), table(spark, d, "stg_sellers"), table(spark, d, "stg_customers"), min_orders=least))

fact_query("q22_customer_frequency_segments", kpis.customer_frequency_segments, f"""
SELECT CASE WHEN n >= 5 THEN '1. High Frequency (≥5 orders)'
            WHEN n >= 2 THEN '2. Medium Frequency (2-4 orders)'
            ELSE '3. Low Frequency (1 order)' END AS customer_segment,
  count(customer_id) AS total_customers, CAST(sum(n) AS BIGINT) AS total_orders,
  round(sum(score) / sum(scored), 2) AS avg_review_score,
  round(sum(late) * {PCT} / sum(n), 2) AS delay_rate_pct,
  round(sum(micros) / {DAY_MICROS} / sum(timed), 2) AS avg_delivery_days
FROM (SELECT customer_id, count(*) AS n, sum(is_delayed) AS late, sum(review_score) AS score,
             count(review_score) AS scored, count(actual_delivery_days) AS timed,
             sum(CAST(round(actual_delivery_days * {DAY_MICROS}) AS BIGINT)) AS micros
      FROM fact GROUP BY customer_id)
GROUP BY ALL ORDER BY customer_segment""")

# ---- Q23 - Q29, R1 - R3 -----------------------------------------------------

fact_query("q23_review_by_status", kpis.review_by_status, """
SELECT CASE WHEN is_delayed = 0 THEN 'Tepat Waktu' ELSE 'Terlambat' END AS status_pengiriman,
  round(avg(review_score), 2) AS avg_review_score, count(*) AS total_orders,
  CAST(min(review_score) AS INTEGER) AS min_score, CAST(max(review_score) AS INTEGER) AS max_score
FROM fact WHERE review_score IS NOT NULL GROUP BY is_delayed ORDER BY is_delayed""")

fact_query("q24_review_by_delay_bucket", kpis.review_by_delay_bucket, """
SELECT CASE WHEN delay_days <= 0 THEN '1 - Tepat Waktu'
            WHEN delay_days > 0 AND delay_days <= 3 THEN '2 - Terlambat 1-3 Hari'
            WHEN delay_days > 3 AND delay_days <= 7 THEN '3 - Terlambat 4-7 Hari'
            WHEN delay_days > 7 AND delay_days <= 14 THEN '4 - Terlambat 8-14 Hari'
            ELSE '5 - Terlambat >14 Hari' END AS delay_bucket,
  round(avg(review_score), 2) AS avg_review_score, count(*) AS total_orders,
  CAST(min(review_score) AS INTEGER) AS min_score, CAST(max(review_score) AS INTEGER) AS max_score
FROM fact WHERE review_score IS NOT NULL GROUP BY 1 ORDER BY 1""")

_DOW = "CAST(isodow(order_purchase_timestamp) AS INTEGER)"

fact_query("q25_weekday_volume", kpis.weekday_volume, f"""
SELECT {_DOW} AS day_of_week, {WEEKDAY_CASE} AS nama_hari, count(*) AS total_orders,
  {r2('avg(review_score)')} AS avg_review_score
FROM fact GROUP BY 1, 2 ORDER BY 1""")

fact_query("q26_weekday_delay", kpis.weekday_delay, f"""
SELECT {_DOW} AS day_of_week, {WEEKDAY_CASE} AS nama_hari,
  {r2(rate_mul('is_delayed = 1'))} AS delay_rate_pct, count(*) AS total_orders,
  {r2(avgd('actual_delivery_days'))} AS avg_delivery_days
FROM fact GROUP BY 1, 2 ORDER BY 1""")

fact_query("q27_weekday_delivery_time", kpis.weekday_delivery_time, f"""
SELECT {_DOW} AS day_of_week, {WEEKDAY_CASE} AS nama_hari,
  {r2(avgd('actual_delivery_days'))} AS avg_delivery_days,
  round(min(actual_delivery_days), 0) AS min_days, round(max(actual_delivery_days), 0) AS max_days,
  count(*) AS total_orders
FROM fact GROUP BY 1, 2 ORDER BY 1""")

fact_query("q28_daypart_delay", kpis.daypart_delay, f"""
SELECT CASE WHEN hour(order_purchase_timestamp) BETWEEN 0 AND 5 THEN '1. 00:00 - 05:59 (Dini Hari)'
            WHEN hour(order_purchase_timestamp) BETWEEN 6 AND 11 THEN '2. 06:00 - 11:59 (Pagi)'
            WHEN hour(order_purchase_timestamp) BETWEEN 12 AND 17 THEN '3. 12:00 - 17:59 (Siang)'
            ELSE '4. 18:00 - 23:59 (Malam)' END AS time_period,
  count(*) AS total_orders, count_if(is_delayed = 1) AS delayed_orders,
  {r2(rate_mul('is_delayed = 1'))} AS delay_rate_pct
FROM fact GROUP BY 1 ORDER BY 1""")

fact_query("q29_late_share_by_state", kpis.late_share_by_state, f"""
SELECT customer_state, count(*) AS total_orders,
  {r2(rate_mul('is_delayed = 1'))} AS delay_rate_pct,
  {r2(avgd('actual_delivery_days'))} AS avg_delivery_days,
  {r2('avg(review_score)')} AS avg_review_score
FROM fact GROUP BY customer_state ORDER BY delay_rate_pct DESC, customer_state""")

fact_query("r1_top_states_by_delay", kpis.top_states_by_delay, f"""
SELECT customer_state, count(*) AS total_orders,
  {r2(rate_mul('is_delayed = 1'))} AS delay_rate_pct,
  {r2(avgd('actual_delivery_days'))} AS avg_delivery_days
FROM fact GROUP BY customer_state HAVING count(*) >= {STATE_MIN_ORDERS}
ORDER BY delay_rate_pct DESC, customer_state NULLS LAST LIMIT 10""",
            min_orders=STATE_MIN_ORDERS)

fact_query("r2_stage_averages", kpis.stage_averages, f"""
SELECT 'Approval Time' AS stage, round({avgd('approval_time_days')}, 2) AS avg_days FROM fact
UNION ALL SELECT 'Seller Processing', round({avgd('seller_processing_days')}, 2) FROM fact
UNION ALL SELECT 'Carrier Transit', round({avgd('carrier_transit_days')}, 2) FROM fact""")

fact_query("r3_review_by_status_simple", kpis.review_by_status_simple, """
SELECT CASE WHEN is_delayed = 0 THEN 'Tepat Waktu' ELSE 'Terlambat' END AS status,
  round(avg(review_score), 2) AS avg_review_score, count(*) AS total_orders
FROM fact WHERE review_score IS NOT NULL GROUP BY is_delayed""")

fact_query("q07_11_scorecards", kpis.scorecards, f"""
SELECT {r2(rate_div('is_delayed = 0'))} AS on_time_rate_pct,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct, count(*) AS total_orders,
  {r2(avgd('actual_delivery_days'))} AS avg_delivery_days,
  round(avg(review_score), 2) AS avg_review_score
FROM fact""")


def _load_all() -> None:
    # the other query families register themselves on import
    from deliverylens.plans import analysis_queries, profile_queries, text_queries  # noqa: F401


def queries() -> dict[str, Query]:
    _load_all()
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
