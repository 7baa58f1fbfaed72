"""Dashboard queries over the delivery fact.

Each function is ``(fact, ...) -> DataFrame``. Shared rules:
* rates are doubles; "div first" = count_if / count * 100, "mul first" =
  count_if * 100.0 / count, following each original statement;
* rounding happens last, and threshold tests use the unrounded value when the
  original does;
* every ranked result ends with a unique tie-break so LIMIT is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.functions.exprs import (
    avg_days, avg_exact, bucket, daypart, days_of, iso_weekday, month_start, pct, pct_div_first,
    rnd, seconds_of, spare_micros, weekday_name, yyyymm,
)
from deliverylens.functions.translate import CATEGORY_LABELS_EN, translate_column
from deliverylens.operators.hot_join import split_join
from deliverylens.operators.quantiles import exact_median



def _late() -> Column:
    return F.col("is_delayed") == 1


def _on_time() -> Column:
    return F.col("is_delayed") == 0


def _n() -> Column:
    return F.count(F.lit(1))


DURATIONS = {"approval_time_days", "seller_processing_days", "carrier_transit_days",
             "actual_delivery_days", "delay_days"}


def _avg(c: str) -> Column:
    """Mean; durations use the exact integer-seconds mean (``avg_days``)."""
    return avg_days(c) if c in DURATIONS else F.avg(c)


def _avg2(c: str) -> Column:
    return rnd(_avg(c), 2)


# ---- Q01 - Q12 ----------------------------------------------------------------

def delivery_summary(fact: DataFrame) -> DataFrame:
    """Q01."""
    return fact.agg(
        _n().alias("total_orders"),
        _avg2("actual_delivery_days").alias("avg_delivery_days"),
        _avg2("approval_time_days").alias("avg_approval_days"),
        _avg2("seller_processing_days").alias("avg_seller_processing_days"),
        _avg2("carrier_transit_days").alias("avg_carrier_transit_days"),
        _avg2("delay_days").alias("avg_delay_days"),
        rnd(pct_div_first(_on_time())).alias("on_time_rate_pct"),
        rnd(pct_div_first(_late())).alias("delay_rate_pct"),
    )


def state_performance(fact: DataFrame) -> DataFrame:
    """Q02: per customer state, worst delay rate first."""
    return (fact.groupBy("customer_state").agg(
        _n().alias("total_orders"),
        F.count_if(_late()).alias("delayed_orders"),
        rnd(pct_div_first(_late())).alias("delay_rate_pct"),
        _avg2("actual_delivery_days").alias("avg_delivery_days"),
        _avg2("carrier_transit_days").alias("avg_carrier_transit_days"),
        _avg2("review_score").alias("avg_review_score"))
        .orderBy(F.desc("delay_rate_pct"), F.asc_nulls_last("customer_state")))


def seller_ranking(fact: DataFrame, min_orders: int = 10) -> DataFrame:
    """Q03: per (seller id, city, state) with at least ``min_orders`` rows."""
    return (fact.groupBy("seller_id", "seller_city", "seller_state").agg(
        _n().alias("total_orders"),
        F.count_if(_late()).alias("delayed_orders"),
        rnd(pct_div_first(_late())).alias("delay_rate_pct"),
        _avg2("seller_processing_days").alias("avg_processing_days"),
        _avg2("review_score").alias("avg_review_score"))
        .filter(F.col("total_orders") >= min_orders)
        .orderBy(F.desc("delay_rate_pct"), F.asc_nulls_last("seller_id"),
                 F.asc_nulls_last("seller_city"), F.asc_nulls_last("seller_state")))


def stage_bottleneck(fact: DataFrame, approx: bool = False) -> DataFrame:
    """Q04: mean and median of the three stages.

    Exact medians by default, from ``exact_quantiles`` (bounded memory);
    ``approx=True`` uses a fixed-size sketch instead (one pass).
    """
    stages = ["approval_time_days", "seller_processing_days", "carrier_transit_days"]
    names = ["approval_days", "seller_processing_days", "carrier_transit_days"]
    means = fact.agg(*[_avg2(c).alias(f"avg_{n}") for c, n in zip(stages, names)])
    if approx:
        med = fact.agg(*[rnd(F.percentile_approx(c, 0.5, 10000), 2).alias(f"median_{n}")
                         for c, n in zip(stages, names)])
    else:
        m = exact_median(fact, stages, prefix="_m_")
        med = m.select(*[rnd(F.col(f"_m_{c}"), 2).alias(f"median_{n}")
                         for c, n in zip(stages, names)])
    return means.crossJoin(F.broadcast(med))


def delay_vs_review(fact: DataFrame) -> DataFrame:
    """Q05: scored rows by late flag."""
    return (fact.filter(F.col("review_score").isNotNull()).groupBy("is_delayed").agg(
        rnd(F.avg("review_score"), 3).alias("avg_review_score"),
        _n().alias("total_orders"),
        _avg2("delay_days").alias("avg_delay_days"))
        .orderBy("is_delayed"))


def monthly_trend(fact: DataFrame) -> DataFrame:
    """Q06: keyed by the yyyymm integer."""
    return (fact.groupBy(yyyymm("order_purchase_timestamp").alias("year_month")).agg(
        _n().alias("total_orders"),
        _avg2("actual_delivery_days").alias("avg_delivery_days"),
        rnd(pct_div_first(_late())).alias("delay_rate_pct"),
        _avg2("review_score").alias("avg_review_score"))
        .orderBy("year_month"))


def on_time_rate(fact: DataFrame) -> DataFrame:
    """Q07."""
    return fact.agg(rnd(pct_div_first(_on_time())).alias("on_time_rate_pct"))


def delay_rate(fact: DataFrame) -> DataFrame:
    """Q08."""
    return fact.agg(rnd(pct_div_first(_late())).alias("delay_rate_pct"))


def total_orders(fact: DataFrame) -> DataFrame:
    """Q09."""
    return fact.agg(_n().alias("total_orders"))


def avg_delivery_days(fact: DataFrame) -> DataFrame:
    """Q10."""
    return fact.agg(_avg2("actual_delivery_days").alias("avg_delivery_days"))


def avg_review_score(fact: DataFrame) -> DataFrame:
    """Q11."""
    return (fact.filter(F.col("review_score").isNotNull())
            .agg(_avg2("review_score").alias("avg_review_score")))


def scorecards(fact: DataFrame) -> DataFrame:
    """Q07-Q11 in one scan (the five cards read the fact five times otherwise)."""
    return fact.agg(
        rnd(pct_div_first(_on_time())).alias("on_time_rate_pct"),
        rnd(pct_div_first(_late())).alias("delay_rate_pct"),
        _n().alias("total_orders"),
        _avg2("actual_delivery_days").alias("avg_delivery_days"),
        _avg2("review_score").alias("avg_review_score"))


def monthly_delay(fact: DataFrame) -> DataFrame:
    """Q12: keyed by the first day of the month (a date)."""
    return (fact.groupBy(month_start("order_purchase_timestamp").alias("bulan")).agg(
        rnd(pct_div_first(_late())).alias("delay_rate_pct"),
        _n().alias("total_orders"))
        .orderBy("bulan"))


# ---- Q13 - Q17 ----------------------------------------------------------------

# Delivery-time bucket edges (days, right-closed) and labels.
DELIVERY_EDGES = [5, 10, 15, 20, 30]
DELIVERY_LABELS = ["0-5 hari", "6-10 hari", "11-15 hari", "16-20 hari", "21-30 hari",
                   ">30 hari"]


def delivery_days_distribution(fact: DataFrame) -> DataFrame:
    """Q13: six buckets, count and share of all rows, in bucket order.

    The share's denominator is the sum of the (at most six) bucket counts,
    appended as a one-row broadcast: no second scan of the fact.
    """
    b = bucket("actual_delivery_days", DELIVERY_EDGES, DELIVERY_LABELS)
    order = F.lit(len(DELIVERY_LABELS))
    for i, label in reversed(list(enumerate(DELIVERY_LABELS[:-1], start=1))):
        order = F.when(F.col("delivery_bucket") == label, F.lit(i)).otherwise(order)
    counts = fact.groupBy(b.alias("delivery_bucket")).agg(_n().alias("total_orders"))
    total = counts.agg(F.sum("total_orders").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select("delivery_bucket", "total_orders",
                    rnd(F.col("total_orders") * F.lit(100.0) / F.col("_total")).alias("percentage"))
            .orderBy(order))


STAGES = [("Approval Time", "approval_time_days"),
          ("Seller Processing", "seller_processing_days"),
          ("Carrier Transit", "carrier_transit_days")]


def stage_breakdown(fact: DataFrame) -> DataFrame:
    """Q14: avg / min / max / count per stage; one aggregation, then three rows."""
    aggs = []
    for i, (_, c) in enumerate(STAGES):
        aggs += [rnd(_avg(c)).alias(f"a{i}"), rnd(F.min(c)).alias(f"mn{i}"),
                 rnd(F.max(c)).alias(f"mx{i}")]
    one = fact.agg(*aggs, _n().alias("n"))
    rows = F.array(*[F.struct(F.lit(name).alias("stage_name"), F.col(f"a{i}").alias("avg_days"),
                              F.col(f"mn{i}").alias("min_days"), F.col(f"mx{i}").alias("max_days"),
                              F.col("n").alias("total_orders"))
                     for i, (name, _) in enumerate(STAGES)])
    return one.select(F.inline(rows)).orderBy(F.desc("avg_days"), "stage_name")


def top_sellers_by_delay(fact: DataFrame, n: int = 15, min_orders: int = 20) -> DataFrame:
    """Q15: top-``n`` sellers by delay rate, labelled 'Seller ' + 6 id chars."""
    g = (fact.groupBy("seller_id", "seller_city", "seller_state").agg(
        rnd(pct(_late())).alias("delay_rate_pct"), _n().alias("total_orders"))
        .filter(F.col("total_orders") >= min_orders))
    return (g.orderBy(F.desc("delay_rate_pct"), F.asc_nulls_last("seller_id"),
                      F.asc_nulls_last("seller_city"), F.asc_nulls_last("seller_state"))
            .limit(n)
            .select(F.concat(F.lit("Seller "), F.substring("seller_id", 1, 6)).alias("seller_label"),
                    "seller_city", "seller_state", "delay_rate_pct", "total_orders"))


def stage_by_state(fact: DataFrame, n: int = 10, min_orders: int = 500) -> DataFrame:
    """Q16: stage averages of the ``n`` slowest states with enough rows."""
    return (fact.groupBy("customer_state").agg(
        _avg2("approval_time_days").alias("approval_days"),
        _avg2("seller_processing_days").alias("seller_processing_days"),
        _avg2("carrier_transit_days").alias("carrier_transit_days"),
        _avg2("actual_delivery_days").alias("total_delivery_days"),
        _n().alias("total_orders"))
        .filter(F.col("total_orders") >= min_orders)
        .orderBy(F.desc("total_delivery_days"), F.asc_nulls_last("customer_state"))
        .limit(n))


# Seller processing-time bucket edges (days) and labels.
PROCESSING_EDGES = [3, 6, 9, 12]
PROCESSING_LABELS = ["1. 0-3 Hari", "2. 4-6 Hari", "3. 7-9 Hari", "4. 10-12 Hari",
                     "5. > 12 Hari"]


def processing_bucket_delay(fact: DataFrame, min_orders: int = 10) -> DataFrame:
    """Q17: sellers bucketed by mean processing time; mean of their unrounded
    delay rates and seller count per bucket (two-level aggregation)."""
    sellers = (fact.groupBy("seller_id").agg(
        _avg("seller_processing_days").alias("avg_processing_days"),
        pct_div_first(_late()).alias("delay_rate_pct"),
        _n().alias("n"))
        .filter(F.col("n") >= min_orders))
    b = bucket("avg_processing_days", PROCESSING_EDGES, PROCESSING_LABELS)
    return (sellers.groupBy(b.alias("processing_bucket")).agg(
        _avg2("delay_rate_pct").alias("avg_delay_rate_pct"),
        _n().alias("total_sellers"))
        .orderBy("processing_bucket"))


# ---- Q18 - Q22 ----------------------------------------------------------------

_SUMS = ["n_rows", "n_late", "s_secs", "s_micros", "n_days", "s_score", "n_score", "s_transit", "s_transit_micros",
         "n_transit"]


def _states() -> list[Column]:
    """Partial states of fact rows: counts and exact sums, which add up."""
    return [_n().alias("n_rows"), F.count_if(_late()).alias("n_late"),
            F.sum(seconds_of("actual_delivery_days")).alias("s_secs"),
            F.sum(spare_micros("actual_delivery_days")).alias("s_micros"),
            F.count("actual_delivery_days").alias("n_days"),
            F.sum("review_score").alias("s_score"), F.count("review_score").alias("n_score"),
            F.sum(seconds_of("carrier_transit_days")).alias("s_transit"),
            F.sum(spare_micros("carrier_transit_days")).alias("s_transit_micros"),
            F.count("carrier_transit_days").alias("n_transit")]


def _merged() -> list[Column]:
    """States of a coarser group from those of finer ones."""
    return [F.sum(c).alias(c) for c in _SUMS]


def category_delay(fact: DataFrame, items: DataFrame, products: DataFrame, n: int = 10,
                   min_orders: int = 100, mapping: dict[str, str] | None = None) -> DataFrame:
    """Q18: fact rows fanned out to every item of the order, by translated
    product category; top ``n`` by delay rate among categories with at least
    ``min_orders`` (item) rows. ``total_orders`` counts items, as the original.

    Partial states (row count, late count, exact sums and counts of days and
    scores) are merged level by level: per order, the join key with the items,
    so that side needs no further exchange and the items are shuffled once; per
    product, before the products are joined, so a hot product crosses that join
    as one row; then per label.
    """
    mapping = CATEGORY_LABELS_EN if mapping is None else mapping
    per_order = fact.groupBy("order_id").agg(*_states())
    own = items.select("order_id", F.col("product_id").alias("i_product_id")).where("i_product_id IS NOT NULL")
    per_product = own.join(per_order, "order_id").groupBy("i_product_id").agg(*_merged())
    known = products.select(F.col("product_id").alias("i_product_id"), "product_category_name").where(
        "product_category_name IS NOT NULL")
    label = translate_column("product_category_name", mapping, fallback="humanize")
    g = (per_product.join(known, "i_product_id").groupBy(label.alias("product_category_en")).agg(*_merged())
         .withColumnRenamed("n_rows", "total_orders"))
    return (g.filter(F.col("total_orders") >= min_orders)
            .select("product_category_en", "total_orders",
                    rnd(F.col("n_late") * F.lit(100.0) / F.col("total_orders")).alias("delay_rate_pct"),
                    rnd(days_of(F.col("s_secs"), F.col("s_micros"), F.col("n_days"))).alias("avg_delivery_days"),
                    rnd(F.try_divide(F.col("s_score").cast("double"), F.col("n_score")))
                    .alias("avg_review_score"))
            .orderBy(F.desc("delay_rate_pct"), F.asc_nulls_last("product_category_en"))
            .limit(n))


# Seller risk tiers on the unrounded delay rate (%).
RISK_TIERS = [(30, "🚨 Kritis"), (20, "🔴 Tinggi"), (10, "🟠 Sedang")]
RISK_DEFAULT = "🟢 Baik"


def seller_risk(fact: DataFrame, min_orders: int = 10) -> DataFrame:
    """Q19: Q03's measures plus transit and a risk tier."""
    g = fact.groupBy("seller_id", "seller_city", "seller_state").agg(
        _n().alias("total_orders"),
        pct_div_first(_late()).alias("_rate"),
        _avg2("seller_processing_days").alias("avg_processing_days"),
        _avg2("carrier_transit_days").alias("avg_transit_days"),
        _avg2("review_score").alias("avg_review_score"))
    tier = F.lit(RISK_DEFAULT)
    for edge, label in reversed(RISK_TIERS):
        tier = F.when(F.col("_rate") >= edge, F.lit(label)).otherwise(tier)
    return (g.filter(F.col("total_orders") >= min_orders)
            .select("seller_id", "seller_city", "seller_state", "total_orders",
                    rnd(F.col("_rate")).alias("delay_rate_pct"), "avg_processing_days",
                    "avg_transit_days", "avg_review_score", tier.alias("risk_level"))
            .orderBy(F.desc("delay_rate_pct"), F.asc_nulls_last("seller_id"),
                     F.asc_nulls_last("seller_city"), F.asc_nulls_last("seller_state")))


def city_map(fact: DataFrame, n: int = 100, min_orders: int = 100) -> DataFrame:
    """Q20: busiest cities with unrounded mean coordinates (exact sums, so the
    value does not depend on row order)."""
    return (fact.groupBy("customer_city", "customer_state").agg(
        _n().alias("total_orders"),
        _avg2("actual_delivery_days").alias("avg_delivery_days"),
        rnd(pct(_late())).alias("delay_rate_pct"),
        avg_exact("customer_lat").alias("lat"),
        avg_exact("customer_lng").alias("lng"))
        .filter(F.col("total_orders") >= min_orders)
        .orderBy(F.desc("total_orders"), F.asc_nulls_last("customer_city"),
                 F.asc_nulls_last("customer_state"))
        .limit(n))


def route_performance(fact: DataFrame, sellers: DataFrame, customers: DataFrame,
                      n: int = 10, min_orders: int = 50) -> DataFrame:
    """Q21: seller state -> customer state routes (the inner joins of J12).

    Fact rows meet their customer, hot ones split; the states of a seller's rows
    into one customer state are merged before the sellers are joined, so a
    hot seller crosses that join as one row for each state."""
    c = customers.select(F.col("customer_id").alias("c_customer_id"), F.col("customer_state").alias("destination_state"))
    s = sellers.select("seller_id", F.col("seller_state").alias("origin_state"))
    sold = fact.where("seller_id IS NOT NULL AND customer_id IS NOT NULL")
    per_seller = split_join(sold, c, "customer_id", "c_customer_id", ["order_id"], "inner").groupBy(
        "seller_id", "destination_state").agg(*_states())
    routes = per_seller.join(s, "seller_id").groupBy("origin_state", "destination_state").agg(*_merged())
    return (routes.where(F.col("n_rows") >= min_orders)
            .select("origin_state", "destination_state",
                    F.concat(F.col("origin_state"), F.lit(" → "), F.col("destination_state")).alias("delivery_route"),
                    F.col("n_rows").alias("total_orders"),
                    rnd(days_of(F.col("s_secs"), F.col("s_micros"), F.col("n_days"))).alias("avg_delivery_days"),
                    rnd(F.col("n_late") * F.lit(100.0) / F.col("n_rows")).alias("delay_rate_pct"),
                    rnd(days_of(F.col("s_transit"), F.col("s_transit_micros"), F.col("n_transit")))
                    .alias("avg_transit_days"))
            .orderBy(F.desc("delay_rate_pct"), F.asc_nulls_last("origin_state"),
                     F.asc_nulls_last("destination_state"))
            .limit(n))


# Customer frequency segments (fact rows per customer).
SEGMENT_HIGH = "1. High Frequency (≥5 orders)"
SEGMENT_MEDIUM = "2. Medium Frequency (2-4 orders)"
SEGMENT_LOW = "3. Low Frequency (1 order)"


def customer_frequency_segments(fact: DataFrame, key: str = "customer_id") -> DataFrame:
    """Q22: customers segmented by their fact-row count.

    The original tests membership in two grouped subqueries and then counts
    distinct customers per segment. Here one aggregation per customer carries
    everything the segment needs (rows, late rows, sums and counts of score and
    days), and a second, tiny aggregation per segment adds them up: a single
    shuffle by customer, no join back and no distinct count.
    """
    per = fact.groupBy(key).agg(
        _n().alias("n"), F.count_if(_late()).alias("late"),
        F.sum("review_score").alias("s_score"), F.count("review_score").alias("n_score"),
        F.sum(seconds_of("actual_delivery_days")).alias("s_secs"),
        F.sum(spare_micros("actual_delivery_days")).alias("s_micros"),
        F.count("actual_delivery_days").alias("n_days"))
    seg = (F.when(F.col("n") >= 5, F.lit(SEGMENT_HIGH))
           .when(F.col("n").between(2, 4), F.lit(SEGMENT_MEDIUM))
           .otherwise(F.lit(SEGMENT_LOW)))
    g = per.groupBy(seg.alias("customer_segment")).agg(
        F.count(key).alias("total_customers"), F.sum("n").alias("total_orders"),
        F.sum("s_score").alias("s_score"), F.sum("n_score").alias("n_score"),
        F.sum("late").alias("late"), F.sum("s_secs").alias("s_secs"), F.sum("s_micros").alias("s_micros"),
        F.sum("n_days").alias("n_days"))
    return (g.select(
        "customer_segment", "total_customers", "total_orders",
        rnd(F.try_divide(F.col("s_score").cast("double"), F.col("n_score"))).alias("avg_review_score"),
        rnd(F.col("late") * F.lit(100.0) / F.col("total_orders")).alias("delay_rate_pct"),
        rnd(days_of(F.col("s_secs"), F.col("s_micros"), F.col("n_days"))).alias("avg_delivery_days"))
        .orderBy("customer_segment"))


# ---- Q23 - Q29, R1 - R3 -----------------------------------------------------

def _status_label() -> Column:
    return F.when(F.col("is_delayed") == 0, F.lit("Tepat Waktu")).otherwise(F.lit("Terlambat"))


def review_by_status(fact: DataFrame) -> DataFrame:
    """Q23: score statistics on time vs late."""
    return (fact.filter(F.col("review_score").isNotNull()).groupBy("is_delayed").agg(
        _avg2("review_score").alias("avg_review_score"),
        _n().alias("total_orders"),
        F.round(F.min("review_score"), 0).alias("min_score"),
        F.round(F.max("review_score"), 0).alias("max_score"))
        .orderBy("is_delayed")
        .select(_status_label().alias("status_pengiriman"), "avg_review_score", "total_orders",
                "min_score", "max_score"))


# Delay buckets (days late, right-closed) and labels.
DELAY_EDGES = [0, 3, 7, 14]
DELAY_LABELS = ["1 - Tepat Waktu", "2 - Terlambat 1-3 Hari", "3 - Terlambat 4-7 Hari",
                "4 - Terlambat 8-14 Hari", "5 - Terlambat >14 Hari"]


def review_by_delay_bucket(fact: DataFrame) -> DataFrame:
    """Q24."""
    b = bucket("delay_days", DELAY_EDGES, DELAY_LABELS)
    return (fact.filter(F.col("review_score").isNotNull()).groupBy(b.alias("delay_bucket")).agg(
        _avg2("review_score").alias("avg_review_score"),
        _n().alias("total_orders"),
        F.round(F.min("review_score"), 0).alias("min_score"),
        F.round(F.max("review_score"), 0).alias("max_score"))
        .orderBy("delay_bucket"))


def _by_weekday(fact: DataFrame, *aggs: Column) -> DataFrame:
    return (fact.groupBy(iso_weekday("order_purchase_timestamp").alias("day_of_week"),
                         weekday_name("order_purchase_timestamp").alias("nama_hari"))
            .agg(*aggs).orderBy("day_of_week"))


def weekday_volume(fact: DataFrame) -> DataFrame:
    """Q25."""
    return _by_weekday(fact, _n().alias("total_orders"), _avg2("review_score").alias("avg_review_score"))


def weekday_delay(fact: DataFrame) -> DataFrame:
    """Q26."""
    return _by_weekday(fact, rnd(pct(_late())).alias("delay_rate_pct"), _n().alias("total_orders"),
                       _avg2("actual_delivery_days").alias("avg_delivery_days"))


def weekday_delivery_time(fact: DataFrame) -> DataFrame:
    """Q27."""
    return _by_weekday(fact, _avg2("actual_delivery_days").alias("avg_delivery_days"),
                       F.round(F.min("actual_delivery_days"), 0).alias("min_days"),
                       F.round(F.max("actual_delivery_days"), 0).alias("max_days"),
                       _n().alias("total_orders"))


def daypart_delay(fact: DataFrame) -> DataFrame:
    """Q28: purchase hour bands."""
    return (fact.groupBy(daypart("order_purchase_timestamp").alias("time_period")).agg(
        _n().alias("total_orders"), F.count_if(_late()).alias("delayed_orders"),
        rnd(pct(_late())).alias("delay_rate_pct"))
        .orderBy("time_period"))


def late_share_by_state(fact: DataFrame) -> DataFrame:
    """Q29."""
    return (fact.groupBy("customer_state").agg(
        _n().alias("total_orders"), rnd(pct(_late())).alias("delay_rate_pct"),
        _avg2("actual_delivery_days").alias("avg_delivery_days"),
        _avg2("review_score").alias("avg_review_score"))
        .orderBy(F.desc("delay_rate_pct"), F.asc_nulls_last("customer_state")))


def top_states_by_delay(fact: DataFrame, n: int = 10, min_orders: int = 500) -> DataFrame:
    """R1."""
    return (fact.groupBy("customer_state").agg(
        _n().alias("total_orders"), rnd(pct(_late())).alias("delay_rate_pct"),
        _avg2("actual_delivery_days").alias("avg_delivery_days"))
        .filter(F.col("total_orders") >= min_orders)
        .orderBy(F.desc("delay_rate_pct"), F.asc_nulls_last("customer_state"))
        .limit(n))


def stage_averages(fact: DataFrame) -> DataFrame:
    """R2: three rows (stage, avg_days) from one aggregation."""
    one = fact.agg(*[rnd(_avg(c)).alias(f"a{i}") for i, (_, c) in enumerate(STAGES)])
    rows = F.array(*[F.struct(F.lit(name).alias("stage"), F.col(f"a{i}").alias("avg_days"))
                     for i, (name, _) in enumerate(STAGES)])
    return one.select(F.inline(rows))


def review_by_status_simple(fact: DataFrame) -> DataFrame:
    """R3."""
    return (fact.filter(F.col("review_score").isNotNull()).groupBy("is_delayed").agg(
        _avg2("review_score").alias("avg_review_score"),
        _n().alias("total_orders"))
        .select(_status_label().alias("status"), "avg_review_score", "total_orders"))
