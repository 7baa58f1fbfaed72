"""Map-ready geographic layers.

The reference renders these with a single-machine HTML map; here they are
the layer tables themselves (the rendering is out of scope, S9 writes them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.functions.exprs import avg_days, avg_exact, weighted_avg_fixed


def _rate_div() -> Column:
    return F.count_if(F.col("is_delayed") == 1) / F.count(F.lit(1)) * F.lit(100.0)


def state_layer(fact: DataFrame, variant: str = "before") -> DataFrame:
    """One marker row per customer state.

    ``before`` (the SQL path): rows without coordinates are removed before
    aggregating; mean lat / lng rounded to 4 decimals.
    ``after`` (the CSV path): all rows are aggregated (NULL state dropped, as
    pandas does), unrounded mean coordinates, and states without any
    coordinate are dropped afterwards, so counts include coordinate-less rows.
    """
    if variant == "before":
        src = fact.filter(F.col("customer_lat").isNotNull() & F.col("customer_lng").isNotNull())
        lat = F.round(avg_exact("customer_lat"), 4)
        lng = F.round(avg_exact("customer_lng"), 4)
        total = F.count(F.lit(1))
        rate = F.round(_rate_div(), 2)
    elif variant == "after":
        src = fact.filter(F.col("customer_state").isNotNull())
        lat, lng = avg_exact("customer_lat"), avg_exact("customer_lng")
        total = F.count("order_id")
        rate = F.round(F.avg("is_delayed") * F.lit(100.0), 2)
    else:
        raise ValueError("variant must be 'before' or 'after'")
    g = src.groupBy("customer_state").agg(
        total.alias("total_orders"), rate.alias("delay_rate_pct"),
        F.round(avg_days("actual_delivery_days"), 2).alias("avg_delivery_days"),
        F.round(avg_days("carrier_transit_days"), 2).alias("avg_carrier_days"),
        F.round(F.avg("review_score"), 2).alias("avg_review_score"),
        lat.alias("lat"), lng.alias("lng"))
    if variant == "after":
        g = g.dropna(subset=["lat", "lng"])
    return g.orderBy(F.desc("delay_rate_pct"), "customer_state")


def coordinate_layer(fact: DataFrame, min_orders: int = 5, variant: str = "before") -> DataFrame:
    """Per (state, lat, lng) with at least ``min_orders`` rows.

    ``before`` (the SQL path): rows without a latitude are left out.
    ``after`` (the CSV path): a NULL state or either coordinate drops the group,
    orders are counted by their id and the rate is the mean of the flag.
    """
    if variant == "before":
        src, total, rate = fact.filter(F.col("customer_lat").isNotNull()), F.count(F.lit(1)), _rate_div()
    elif variant == "after":
        src = fact.dropna(subset=["customer_state", "customer_lat", "customer_lng"])
        total, rate = F.count("order_id"), F.avg("is_delayed") * F.lit(100.0)
    else:
        raise ValueError("variant must be 'before' or 'after'")
    return (src.groupBy("customer_state", F.col("customer_lat").alias("lat"),
                        F.col("customer_lng").alias("lng"))
            .agg(total.alias("total_orders"), F.round(rate, 2).alias("delay_rate_pct"))
            .filter(F.col("total_orders") >= min_orders))


def heat_points(fact: DataFrame, min_orders: int = 5) -> DataFrame:
    """Heat-map points (lat, lng, weight = rate / 100), coordinates present."""
    c = coordinate_layer(fact, min_orders)
    return (c.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
            .select("lat", "lng", (F.col("delay_rate_pct") / F.lit(100.0)).alias("weight")))


# Delay-rate tiers (upper bounds, %), colours and labels of the map.
DELAY_TIERS = [
    (5, "#1a9641", "Sangat Baik"),
    (15, "#a6d96a", "Baik"),
    (25, "#ffffbf", "Perlu Perhatian"),
    (40, "#fdae61", "Bermasalah"),
]
DELAY_TIER_TOP = ("#d7191c", "Kritis")


def delay_color(rate: str | Column) -> Column:
    """Colour by delay-rate tier (below 5, 15, 25, 40, else)."""
    r = F.col(rate) if isinstance(rate, str) else rate
    out = F.lit(DELAY_TIER_TOP[0])
    for edge, color, _ in reversed(DELAY_TIERS):
        out = F.when(r < edge, F.lit(color)).otherwise(out)
    return out


def delay_label(rate: str | Column) -> Column:
    """Label by delay-rate tier."""
    r = F.col(rate) if isinstance(rate, str) else rate
    out = F.lit(DELAY_TIER_TOP[1])
    for edge, _, label in reversed(DELAY_TIERS):
        out = F.when(r < edge, F.lit(label)).otherwise(out)
    return out


def marker_radius(total: str | Column) -> Column:
    """clamp(total / 500, 8, 30)."""
    t = F.col(total) if isinstance(total, str) else total
    return F.least(F.lit(30.0), F.greatest(F.lit(8.0), t / F.lit(500.0)))


def national_averages(fact: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """National delay rate and delivery days, overall (row means, the CSV
    path) and order-weighted from the state layer's rounded values (the
    fallback path)."""
    overall = fact.agg(
        (F.avg("is_delayed") * F.lit(100.0)).alias("national_delay_rate"),
        avg_days("actual_delivery_days").alias("national_delivery_days"))
    states = state_layer(fact) if states is None else states
    w = states.agg(
        weighted_avg_fixed("delay_rate_pct", "total_orders").alias("weighted_delay_rate"),
        weighted_avg_fixed("avg_delivery_days", "total_orders").alias("weighted_delivery_days"))
    return overall.crossJoin(F.broadcast(w)).select(*[F.round(c, 4).alias(c) for c in
                                         ["national_delay_rate", "national_delivery_days",
                                          "weighted_delay_rate", "weighted_delivery_days"]])


def state_markers(fact: DataFrame) -> DataFrame:
    """G5 + G6 + G8: state layer with colour, label, radius and an
    above-national flag (national = overall row mean, as the CSV path)."""
    s = state_layer(fact)
    nat = fact.agg((F.avg("is_delayed") * F.lit(100.0)).alias("national_delay_rate"))
    return (s.crossJoin(F.broadcast(nat))
            .select("customer_state", "total_orders", "delay_rate_pct", "avg_delivery_days",
                    "avg_carrier_days", "avg_review_score", "lat", "lng",
                    delay_color("delay_rate_pct").alias("color"),
                    delay_label("delay_rate_pct").alias("label"),
                    marker_radius("total_orders").alias("radius"),
                    (F.col("delay_rate_pct") > F.col("national_delay_rate"))
                    .alias("above_national")))


def title_stats(fact: DataFrame, critical_pct: float = 40.0) -> DataFrame:
    """Worst and best state with their rates, number of states above
    ``critical_pct`` and the on-time rate (100 - national rate)."""
    s = state_layer(fact)
    agg = s.agg(
        F.max(F.struct(F.col("delay_rate_pct"), F.col("customer_state"))).alias("w"),
        F.min(F.struct(F.col("delay_rate_pct"), F.col("customer_state"))).alias("b"),
        F.count_if(F.col("delay_rate_pct") > critical_pct).alias("critical_states"))
    nat = fact.agg((F.avg("is_delayed") * F.lit(100.0)).alias("nat"))
    return agg.crossJoin(F.broadcast(nat)).select(
        F.col("w.customer_state").alias("worst_state"),
        F.col("w.delay_rate_pct").alias("worst_delay_rate"),
        F.col("b.customer_state").alias("best_state"),
        F.col("b.delay_rate_pct").alias("best_delay_rate"),
        "critical_states", F.round(F.lit(100.0) - F.col("nat"), 2).alias("on_time_rate_pct"))
