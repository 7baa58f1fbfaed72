"""Registered notebook-analysis (N1-N17) and map-layer (G1-G9) queries."""

from __future__ import annotations

from deliverylens.operators import analysis as A
from deliverylens.operators import geo as G
from deliverylens.plans.oracle import (
    avgx, avgc, avgd, box_sql, clip_sql, describe_sql, histogram_sql, r2, rate_div, wavgc,
)
from deliverylens.plans.registry import fact_query, register, warehouse_for

STAGES = ["approval_time_days", "seller_processing_days", "carrier_transit_days"]
STAGE_NAMES = ["Approval", "Seller Processing", "Carrier Transit"]

# ---- N1 - N7 -------------------------------------------------------------------

fact_query("n01_on_time_counts", A.on_time_counts, f"""
SELECT count(*) AS total_orders, count_if(is_delayed = 0) AS on_time_orders,
  count_if(is_delayed = 1) AS delayed_orders,
  {r2(rate_div('is_delayed = 0'))} AS on_time_rate_pct,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct
FROM fact""")

fact_query("n02_late_delay_stats", A.late_delay_stats, """
SELECT round(quantile_cont(delay_days, 0.5), 2) AS median_delay_days,
  round(max(delay_days), 2) AS max_delay_days
FROM fact WHERE is_delayed = 1""")

_c, _s = histogram_sql(clip_sql("delay_days", 0, 30), "fact WHERE is_delayed = 1", 30)
fact_query("n03_late_delay_histogram", A.late_delay_histogram, _s, _c)

fact_query("n04_stage_mean_median", A.stage_mean_median, "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS stage_order, '{n}' AS stage, round({avgd(c)}, 2) AS mean_days, "
    f"round(quantile_cont({c}, 0.5), 2) AS median_days FROM fact"
    for i, (c, n) in enumerate(zip(STAGES, STAGE_NAMES))))

fact_query("n05_stage_describe", A.stage_describe, describe_sql(STAGES, "fact"))

_means = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS stage_order, '{n}' AS stage, {avgd(c)} AS mean_days FROM fact"
    for i, (c, n) in enumerate(zip(STAGES, STAGE_NAMES)))
fact_query("n06_bottleneck_stage", A.bottleneck_stage, f"""
SELECT stage AS bottleneck_stage, round(mean_days, 2) AS mean_days FROM ({_means})
ORDER BY mean_days DESC, stage_order LIMIT 1""")

_c, _s = box_sql(STAGES, "fact", 0, 20)
fact_query("n07_stage_box_stats", A.stage_box_stats, _s, _c)

# ---- N8 - N13 ------------------------------------------------------------------

SELLER_PROFILE_CTE = f"""
sp0 AS (
  SELECT seller_id, count(order_id) AS total_orders,
    CAST(sum(is_delayed) AS BIGINT) AS delayed_orders,
    {avgd('seller_processing_days')} AS avg_processing_days,
    {avgd('delay_days')} AS avg_delay_days, avg(review_score) AS avg_review_score,
    min(seller_state) AS seller_state, min(seller_city) AS seller_city
  FROM fact WHERE seller_id IS NOT NULL GROUP BY seller_id HAVING count(order_id) >= 10),
sp AS (
  SELECT seller_id, total_orders, delayed_orders,
    round(avg_processing_days, 2) AS avg_processing_days,
    round(avg_delay_days, 2) AS avg_delay_days, round(avg_review_score, 2) AS avg_review_score,
    seller_state, seller_city,
    round(delayed_orders / total_orders * CAST(100 AS DOUBLE), 2) AS delay_rate_pct,
    delayed_orders / total_orders AS share
  FROM sp0),
sps AS (SELECT {avgc('delay_rate_pct')} AS mean_rate, stddev_samp(delay_rate_pct) AS std_rate FROM sp)
"""

fact_query("n08_seller_profile", A.seller_profile,
            "SELECT * EXCLUDE (share) FROM sp ORDER BY share DESC, seller_id", SELLER_PROFILE_CTE)

fact_query("n09_top_sellers", A.top_sellers, """
SELECT left(seller_id, 10) AS label, seller_id, seller_city, seller_state, total_orders,
  delayed_orders, delay_rate_pct, avg_processing_days, avg_review_score,
  delay_rate_pct > mean_rate AS above_mean
FROM sp CROSS JOIN sps ORDER BY share DESC, seller_id LIMIT 15""", SELLER_PROFILE_CTE)

_c, _s = histogram_sql("delay_rate_pct", "sp", 30)
fact_query("n10_seller_rate_histogram", A.seller_rate_histogram, _s,
            SELLER_PROFILE_CTE.strip() + "," + _c)

fact_query("n10_seller_rate_stats", A.seller_rate_stats, f"""
SELECT count(*) AS sellers, round({avgc('delay_rate_pct')}, 2) AS mean_rate,
  round(quantile_cont(delay_rate_pct, 0.5), 2) AS median_rate FROM sp""", SELLER_PROFILE_CTE)

fact_query("n11_problem_sellers", A.problem_sellers, """
SELECT seller_id, seller_city, seller_state, total_orders, delay_rate_pct,
  round(mean_rate + std_rate, 2) AS threshold_pct
FROM sp CROSS JOIN sps WHERE delay_rate_pct >= mean_rate + std_rate""", SELLER_PROFILE_CTE)

STATE_PROFILE_CTE = f"""
st0 AS (
  SELECT customer_state, count(order_id) AS total_orders,
    CAST(sum(is_delayed) AS BIGINT) AS delayed_orders,
    {avgd('actual_delivery_days')} AS avg_delivery_days,
    {avgd('carrier_transit_days')} AS avg_carrier_transit,
    {avgd('seller_processing_days')} AS avg_seller_proc, avg(review_score) AS avg_review_score
  FROM fact WHERE customer_state IS NOT NULL GROUP BY customer_state),
st AS (
  SELECT customer_state, total_orders, delayed_orders,
    round(avg_delivery_days, 2) AS avg_delivery_days,
    round(avg_carrier_transit, 2) AS avg_carrier_transit,
    round(avg_seller_proc, 2) AS avg_seller_proc, round(avg_review_score, 2) AS avg_review_score,
    round(delayed_orders / total_orders * CAST(100 AS DOUBLE), 2) AS delay_rate_pct,
    delayed_orders / total_orders AS share, avg_delivery_days AS days
  FROM st0)
"""

fact_query("n12_state_profile", A.state_profile,
            "SELECT * EXCLUDE (share, days) FROM st ORDER BY share DESC, customer_state", STATE_PROFILE_CTE)

fact_query("n13_state_vs_national", A.state_vs_national, f"""
SELECT customer_state, delay_rate_pct, avg_delivery_days,
  round(nd, 2) AS national_avg_delay_rate, delay_rate_pct > nd AS above_national,
  round(nt, 2) AS national_avg_delivery_days,
  CAST(row_number() OVER (ORDER BY avg_delivery_days, customer_state) AS INTEGER) AS delivery_rank
FROM st CROSS JOIN (SELECT {avgc('delay_rate_pct')} AS nd, {avgc('avg_delivery_days')} AS nt
                    FROM st)""",
            STATE_PROFILE_CTE)

fact_query("n13_top_states", A.top_states, """
SELECT customer_state, total_orders, delay_rate_pct, avg_delivery_days, avg_carrier_transit,
  avg_review_score
FROM st ORDER BY share DESC, customer_state LIMIT 5""", STATE_PROFILE_CTE)

# ---- N14 - N17 -----------------------------------------------------------------

fact_query("n14_score_by_late_flag", A.score_by_late_flag, """
SELECT is_delayed, round(avg(CAST(review_score AS DOUBLE)), 3) AS mean,
  round(quantile_cont(CAST(review_score AS DOUBLE), 0.5), 3) AS median, count(*) AS count,
  round(stddev_samp(CAST(review_score AS DOUBLE)), 3) AS std
FROM fact WHERE review_score IS NOT NULL GROUP BY is_delayed ORDER BY is_delayed""")

fact_query("n14_score_drop", A.score_drop, """
SELECT round(avg(CASE WHEN is_delayed = 0 THEN CAST(review_score AS DOUBLE) END), 3) AS mean_on_time,
  round(avg(CASE WHEN is_delayed = 1 THEN CAST(review_score AS DOUBLE) END), 3) AS mean_late,
  round(round(avg(CASE WHEN is_delayed = 0 THEN CAST(review_score AS DOUBLE) END), 3)
        - round(avg(CASE WHEN is_delayed = 1 THEN CAST(review_score AS DOUBLE) END), 3), 3) AS score_drop
FROM fact WHERE review_score IS NOT NULL""")

fact_query("n15_score_by_delay_interval", A.score_by_delay_interval, """
SELECT delay_bucket, round(avg(review_score), 2) AS mean, count(*) AS count,
  CAST(CASE delay_bucket WHEN 'Tepat Waktu' THEN 1 WHEN 'Terlambat 1-3 hari' THEN 2
       WHEN 'Terlambat 4-7 hari' THEN 3 WHEN 'Terlambat 8-14 hari' THEN 4 ELSE 5 END AS INTEGER)
    AS bucket_order
FROM (SELECT review_score, CASE
        WHEN delay_days > -9999 AND delay_days <= 0 THEN 'Tepat Waktu'
        WHEN delay_days > 0 AND delay_days <= 3 THEN 'Terlambat 1-3 hari'
        WHEN delay_days > 3 AND delay_days <= 7 THEN 'Terlambat 4-7 hari'
        WHEN delay_days > 7 AND delay_days <= 14 THEN 'Terlambat 8-14 hari'
        WHEN delay_days > 14 AND delay_days <= 9999 THEN 'Terlambat >14 hari' END AS delay_bucket
      FROM fact WHERE review_score IS NOT NULL)
WHERE delay_bucket IS NOT NULL GROUP BY delay_bucket ORDER BY bucket_order""")

fact_query("n16_delay_score_sample", A.delay_score_sample, """
SELECT order_id, CASE WHEN delay_days < -5 THEN CAST(-5 AS DOUBLE)
                      WHEN delay_days > 30 THEN CAST(30 AS DOUBLE) ELSE delay_days END AS delay_days_clipped,
       review_score
FROM fact WHERE review_score IS NOT NULL
ORDER BY md5('42|' || order_id || '|' || CAST(review_score AS VARCHAR)), order_id, review_score, delay_days
LIMIT 3000""")

_SUMMARY_SQL = (f"""
SELECT o.*, b.bottleneck_stage, s.*, w.worst_state, w.worst_state_delay_rate,
  sl.slowest_state, sl.slowest_state_days, sc.*
FROM (SELECT count(*) AS total_orders, {r2(rate_div('is_delayed = 0'))} AS on_time_rate_pct,
        {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct,
        round({avgd('approval_time_days')}, 2) AS avg_approval_time_days,
        round({avgd('seller_processing_days')}, 2) AS avg_seller_processing_days,
        round({avgd('carrier_transit_days')}, 2) AS avg_carrier_transit_days FROM fact) o
CROSS JOIN (SELECT stage AS bottleneck_stage FROM ({_means})
            ORDER BY mean_days DESC, stage_order LIMIT 1) b
CROSS JOIN (SELECT count(*) AS active_sellers,
              round({avgc('delay_rate_pct')}, 2) AS mean_seller_delay_rate,
              count_if(delay_rate_pct > 50) AS sellers_over_50_pct FROM sp) s
CROSS JOIN (SELECT customer_state AS worst_state, delay_rate_pct AS worst_state_delay_rate FROM st
            ORDER BY share DESC, customer_state DESC LIMIT 1) w
CROSS JOIN (SELECT customer_state AS slowest_state, avg_delivery_days AS slowest_state_days FROM st
            ORDER BY days DESC, customer_state DESC LIMIT 1) sl
CROSS JOIN (SELECT round(avg(CASE WHEN is_delayed = 0 THEN CAST(review_score AS DOUBLE) END), 2)
                     AS score_on_time,
                   round(avg(CASE WHEN is_delayed = 1 THEN CAST(review_score AS DOUBLE) END), 2)
                     AS score_late,
                   round(avg(CASE WHEN is_delayed = 0 THEN CAST(review_score AS DOUBLE) END)
                         - avg(CASE WHEN is_delayed = 1 THEN CAST(review_score AS DOUBLE) END), 2)
                     AS score_drop
            FROM fact WHERE review_score IS NOT NULL) sc""",
                SELLER_PROFILE_CTE.strip() + "," + STATE_PROFILE_CTE)
fact_query("n17_executive_summary", A.executive_summary, *_SUMMARY_SQL)
register("n17_summary_from_rollup", *_SUMMARY_SQL)(
    lambda spark, d: A.summary_of(warehouse_for(spark, d).table("rollup")))

# ---- G1 - G9 -------------------------------------------------------------------

fact_query("g01_state_layer", G.state_layer, f"""
SELECT customer_state, count(*) AS total_orders, {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct,
  round({avgd('actual_delivery_days')}, 2) AS avg_delivery_days,
  round({avgd('carrier_transit_days')}, 2) AS avg_carrier_days,
  round(avg(review_score), 2) AS avg_review_score,
  round({avgx('customer_lat')}, 4) AS lat, round({avgx('customer_lng')}, 4) AS lng
FROM fact WHERE customer_lat IS NOT NULL AND customer_lng IS NOT NULL
GROUP BY customer_state ORDER BY delay_rate_pct DESC, customer_state""")

fact_query("g02_state_layer_after", G.state_layer, f"""
SELECT * FROM (
  SELECT customer_state, count(order_id) AS total_orders,
    round(avg(is_delayed) * CAST(100 AS DOUBLE), 2) AS delay_rate_pct,
    round({avgd('actual_delivery_days')}, 2) AS avg_delivery_days,
    round({avgd('carrier_transit_days')}, 2) AS avg_carrier_days,
    round(avg(review_score), 2) AS avg_review_score,
    {avgx('customer_lat')} AS lat, {avgx('customer_lng')} AS lng
  FROM fact WHERE customer_state IS NOT NULL GROUP BY customer_state)
WHERE lat IS NOT NULL AND lng IS NOT NULL ORDER BY delay_rate_pct DESC, customer_state""",
            variant="after")

COORD_SQL = f"""
SELECT customer_state, customer_lat AS lat, customer_lng AS lng, count(*) AS total_orders,
  {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct
FROM fact WHERE customer_lat IS NOT NULL
GROUP BY customer_state, customer_lat, customer_lng HAVING count(*) >= 5"""

fact_query("g03_coordinate_layer", G.coordinate_layer, COORD_SQL)

fact_query("g03_coordinate_layer_after", G.coordinate_layer, """
SELECT * FROM (
  SELECT customer_state, customer_lat AS lat, customer_lng AS lng, count(order_id) AS total_orders,
    round(avg(is_delayed) * CAST(100 AS DOUBLE), 2) AS delay_rate_pct
  FROM fact WHERE customer_state IS NOT NULL GROUP BY ALL)
WHERE lat IS NOT NULL AND lng IS NOT NULL AND total_orders >= 5""", variant="after")

fact_query("g04_heat_points", G.heat_points, f"""
SELECT lat, lng, delay_rate_pct / CAST(100 AS DOUBLE) AS weight FROM ({COORD_SQL})
WHERE lat IS NOT NULL AND lng IS NOT NULL""")

STATE_LAYER_SQL = f"""
SELECT customer_state, count(*) AS total_orders, {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct,
  round({avgd('actual_delivery_days')}, 2) AS avg_delivery_days,
  round({avgd('carrier_transit_days')}, 2) AS avg_carrier_days,
  round(avg(review_score), 2) AS avg_review_score,
  round({avgx('customer_lat')}, 4) AS lat, round({avgx('customer_lng')}, 4) AS lng
FROM fact WHERE customer_lat IS NOT NULL AND customer_lng IS NOT NULL GROUP BY customer_state"""


def _tier(col: str, pick: int) -> str:
    tiers = [(5, "#1a9641", "Sangat Baik"), (15, "#a6d96a", "Baik"),
             (25, "#ffffbf", "Perlu Perhatian"), (40, "#fdae61", "Bermasalah")]
    top = ("#d7191c", "Kritis")
    whens = " ".join(f"WHEN {col} < {e} THEN '{t[pick]}'" for e, *t in tiers)
    return f"CASE {whens} ELSE '{top[pick]}' END"


fact_query("g05_state_markers", G.state_markers, f"""
SELECT customer_state, total_orders, delay_rate_pct, avg_delivery_days, avg_carrier_days,
  avg_review_score, lat, lng, {_tier('delay_rate_pct', 0)} AS color,
  {_tier('delay_rate_pct', 1)} AS label,
  least(CAST(30 AS DOUBLE), greatest(CAST(8 AS DOUBLE), total_orders / CAST(500 AS DOUBLE))) AS radius,
  delay_rate_pct > nat AS above_national
FROM ({STATE_LAYER_SQL}) CROSS JOIN
  (SELECT avg(is_delayed) * CAST(100 AS DOUBLE) AS nat FROM fact)""")

fact_query("g07_national_averages", G.national_averages, f"""
SELECT round(avg(is_delayed) * CAST(100 AS DOUBLE), 4) AS national_delay_rate,
  round({avgd('actual_delivery_days')}, 4) AS national_delivery_days,
  round(any_value(w.wr), 4) AS weighted_delay_rate, round(any_value(w.wd), 4) AS weighted_delivery_days
FROM fact CROSS JOIN (
  SELECT {wavgc('delay_rate_pct', 'total_orders')} AS wr,
         {wavgc('avg_delivery_days', 'total_orders')} AS wd
  FROM ({STATE_LAYER_SQL})) w""")

fact_query("g09_title_stats", G.title_stats, f"""
SELECT w.customer_state AS worst_state, w.delay_rate_pct AS worst_delay_rate,
  b.customer_state AS best_state, b.delay_rate_pct AS best_delay_rate, c.critical_states,
  round(CAST(100 AS DOUBLE) - n.nat, 2) AS on_time_rate_pct
FROM (SELECT * FROM ({STATE_LAYER_SQL}) ORDER BY delay_rate_pct DESC, customer_state DESC LIMIT 1) w
CROSS JOIN (SELECT * FROM ({STATE_LAYER_SQL}) ORDER BY delay_rate_pct, customer_state LIMIT 1) b
CROSS JOIN (SELECT count_if(delay_rate_pct > 40) AS critical_states FROM ({STATE_LAYER_SQL})) c
CROSS JOIN (SELECT avg(is_delayed) * CAST(100 AS DOUBLE) AS nat FROM fact) n""")
