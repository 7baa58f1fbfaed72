"""Operational-analysis notebook operators.

The notebook works on a pandas frame; here each step is a DataFrame
function. pandas ``groupby`` drops NULL keys, so the grouped operators filter
NULL keys first. "First" values use an explicit order (smallest value), as
Spark has no row order. One-row statistics are joined back as broadcasts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.functions.exprs import avg_days, avg_fixed, clip, days_of, interval_bucket, seconds_of, spare_micros
from deliverylens.operators.distribution import box_stats, describe, histogram
from deliverylens.operators.quantiles import exact_median

STAGES = ["approval_time_days", "seller_processing_days", "carrier_transit_days"]
# The notebook's stage display names, in stage order.
STAGE_NAMES = ["Approval", "Seller Processing", "Carrier Transit"]


def _n() -> Column:
    return F.count(F.lit(1))


def _rate(cond: Column) -> Column:
    return F.count_if(cond) / F.count(F.lit(1)) * F.lit(100.0)


def on_time_counts(fact: DataFrame) -> DataFrame:
    """Totals and shares of on-time and late rows."""
    late = F.col("is_delayed") == 1
    on_time = F.col("is_delayed") == 0
    return fact.agg(_n().alias("total_orders"), F.count_if(on_time).alias("on_time_orders"),
                    F.count_if(late).alias("delayed_orders"),
                    F.round(_rate(on_time), 2).alias("on_time_rate_pct"),
                    F.round(_rate(late), 2).alias("delay_rate_pct"))


def late_delay_stats(fact: DataFrame) -> DataFrame:
    """Median and maximum delay among late rows."""
    late = fact.filter(F.col("is_delayed") == 1)
    med = exact_median(late, ["delay_days"], prefix="_m_")
    return med.crossJoin(F.broadcast(late.agg(F.max("delay_days").alias("_mx")))).select(
        F.round("_m_delay_days", 2).alias("median_delay_days"),
        F.round("_mx", 2).alias("max_delay_days"))


def late_delay_histogram(fact: DataFrame, bins: int = 30) -> DataFrame:
    """Delay of late rows clipped to 0..30 days, 30 bins."""
    return histogram(fact.filter(F.col("is_delayed") == 1), "delay_days", bins, 0, 30)


def stage_mean_median(fact: DataFrame) -> DataFrame:
    """Mean and median per stage, one row per stage (one aggregation)."""
    means = fact.agg(*[avg_days(c).alias(f"m{i}") for i, c in enumerate(STAGES)])
    meds = exact_median(fact, STAGES, prefix="_d_").select(
        *[F.col(f"_d_{c}").alias(f"d{i}") for i, c in enumerate(STAGES)])
    one = means.crossJoin(F.broadcast(meds))
    rows = F.array(*[F.struct(F.lit(i + 1).alias("stage_order"), F.lit(name).alias("stage"),
                              F.round(F.col(f"m{i}"), 2).alias("mean_days"),
                              F.round(F.col(f"d{i}"), 2).alias("median_days"))
                     for i, name in enumerate(STAGE_NAMES)])
    return one.select(F.inline(rows))


def stage_describe(fact: DataFrame) -> DataFrame:
    """describe() of the three stages, 2 decimals."""
    return describe(fact, STAGES)


def bottleneck_stage(fact: DataFrame) -> DataFrame:
    """The stage with the largest mean (ties: the earlier stage); one
    aggregation of the three means, then a pick over three values."""
    means = fact.agg(*[avg_days(c).alias(f"m{i}") for i, c in enumerate(STAGES)])
    cands = F.array(*[F.struct(F.col(f"m{i}").alias("mean_days"), F.lit(-(i + 1)).alias("neg_order"),
                               F.lit(name).alias("stage"))
                      for i, name in enumerate(STAGE_NAMES)])
    best = F.array_max(cands)
    return means.select(best["stage"].alias("bottleneck_stage"),
                        F.round(best["mean_days"], 2).alias("mean_days"))


def stage_box_stats(fact: DataFrame) -> DataFrame:
    """Box-plot statistics of the stages clipped to 0..20 days."""
    return box_stats(fact, STAGES, 0, 20)


def seller_profile(fact: DataFrame, min_orders: int = 10) -> DataFrame:
    """Per seller id (NULL dropped): rows, late rows, three means, first
    state / city, late rate; sellers with ``min_orders`` rows; rate desc,
    rounded last (2 decimals)."""
    return _seller_profile(fact, min_orders).orderBy(F.desc("_rate"), "seller_id").drop("_rate")


def _seller_profile(fact: DataFrame, min_orders: int) -> DataFrame:
    """N8 with the unrounded rate ``_rate``, by which sellers are ranked."""
    g = (fact.filter(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("is_delayed").cast("long").alias("delayed_orders"),
        avg_days("seller_processing_days").alias("avg_processing_days"),
        avg_days("delay_days").alias("avg_delay_days"),
        F.avg("review_score").alias("avg_review_score"),
        F.min("seller_state").alias("seller_state"),
        F.min("seller_city").alias("seller_city"))
        .filter(F.col("total_orders") >= min_orders))
    rate = F.col("delayed_orders") / F.col("total_orders") * F.lit(100.0)
    return (g.select("seller_id", "total_orders", "delayed_orders",
                     F.round("avg_processing_days", 2).alias("avg_processing_days"),
                     F.round("avg_delay_days", 2).alias("avg_delay_days"),
                     F.round("avg_review_score", 2).alias("avg_review_score"),
                     "seller_state", "seller_city", F.round(rate, 2).alias("delay_rate_pct"), rate.alias("_rate")))


def _with_seller_mean(profile: DataFrame) -> DataFrame:
    stats = profile.agg(avg_fixed("delay_rate_pct").alias("mean_rate"),
                        F.stddev_samp("delay_rate_pct").alias("std_rate"))
    return profile.crossJoin(F.broadcast(stats))


def top_sellers(fact: DataFrame, n: int = 15, min_orders: int = 10) -> DataFrame:
    """Top ``n`` sellers by (unrounded) rate with a 10-character label and
    a flag for a rate above the mean of all profiled sellers."""
    p = _with_seller_mean(_seller_profile(fact, min_orders))
    return (p.orderBy(F.desc("_rate"), "seller_id").limit(n)
            .select(F.substring("seller_id", 1, 10).alias("label"), "seller_id",
                    "seller_city", "seller_state", "total_orders", "delayed_orders",
                    "delay_rate_pct", "avg_processing_days", "avg_review_score",
                    (F.col("delay_rate_pct") > F.col("mean_rate")).alias("above_mean")))


def seller_rate_histogram(fact: DataFrame, bins: int = 30, min_orders: int = 10) -> DataFrame:
    """N10 (a): 30-bin histogram of the profiled sellers' delay rates."""
    return histogram(seller_profile(fact, min_orders), "delay_rate_pct", bins)


def seller_rate_stats(fact: DataFrame, min_orders: int = 10) -> DataFrame:
    """N10 (b): mean and median of the sellers' delay rates, seller count."""
    p = seller_profile(fact, min_orders)
    med = exact_median(p, ["delay_rate_pct"], prefix="_m_")
    return p.agg(F.count(F.lit(1)).alias("sellers"),
                 F.round(avg_fixed("delay_rate_pct"), 2).alias("mean_rate")).crossJoin(F.broadcast(med)) \
        .select("sellers", "mean_rate", F.round("_m_delay_rate_pct", 2).alias("median_rate"))


def problem_sellers(fact: DataFrame, min_orders: int = 10) -> DataFrame:
    """Sellers whose rate >= mean + 1 sample std of all seller rates."""
    p = _with_seller_mean(_seller_profile(fact, min_orders))
    thr = F.col("mean_rate") + F.col("std_rate")
    return (p.filter(F.col("delay_rate_pct") >= thr)
            .select("seller_id", "seller_city", "seller_state", "total_orders",
                    "delay_rate_pct", F.round(thr, 2).alias("threshold_pct"), "_rate")
            .orderBy(F.desc("_rate"), "seller_id").drop("_rate"))


def state_profile(fact: DataFrame) -> DataFrame:
    """Per customer state (NULL dropped), six aggregates and the rate,
    sorted by rate (desc), 2 decimals."""
    return _state_profile(fact).orderBy(F.desc("_rate"), "customer_state").drop("_rate", "_days")


def _state_profile(fact: DataFrame) -> DataFrame:
    """N12 with the unrounded rate and delivery time, by which states are ranked."""
    g = fact.filter(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("is_delayed").cast("long").alias("delayed_orders"),
        avg_days("actual_delivery_days").alias("avg_delivery_days"),
        avg_days("carrier_transit_days").alias("avg_carrier_transit"),
        avg_days("seller_processing_days").alias("avg_seller_proc"),
        F.avg("review_score").alias("avg_review_score"))
    rate = F.col("delayed_orders") / F.col("total_orders") * F.lit(100.0)
    return (g.select("customer_state", "total_orders", "delayed_orders",
                     *[F.round(c, 2).alias(c) for c in ["avg_delivery_days", "avg_carrier_transit",
                                                        "avg_seller_proc", "avg_review_score"]],
                     F.round(rate, 2).alias("delay_rate_pct"), rate.alias("_rate"),
                     F.col("avg_delivery_days").alias("_days")))


def state_vs_national(fact: DataFrame) -> DataFrame:
    """Each state against the national figures of the notebook (the
    unweighted mean of the states' rounded rates and of their mean delivery
    days), with its delivery-time rank (1 = fastest). States are a bounded
    geographic domain, so the rank window sees one small partition."""
    from pyspark.sql import Window
    s = state_profile(fact)
    nat = s.agg(avg_fixed("delay_rate_pct").alias("national_avg_delay_rate"),
                avg_fixed("avg_delivery_days").alias("national_avg_delivery_days"))
    w = Window.orderBy("avg_delivery_days", "customer_state")
    return (s.crossJoin(F.broadcast(nat))
            .select("customer_state", "delay_rate_pct", "avg_delivery_days",
                    F.round("national_avg_delay_rate", 2).alias("national_avg_delay_rate"),
                    (F.col("delay_rate_pct") > F.col("national_avg_delay_rate"))
                    .alias("above_national"),
                    F.round("national_avg_delivery_days", 2).alias("national_avg_delivery_days"),
                    F.row_number().over(w).alias("delivery_rank")))


def top_states(fact: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` states with the highest delay rate."""
    return (_state_profile(fact).orderBy(F.desc("_rate"), "customer_state").limit(n)
            .select("customer_state", "total_orders", "delay_rate_pct", "avg_delivery_days",
                    "avg_carrier_transit", "avg_review_score"))


def score_by_late_flag(fact: DataFrame) -> DataFrame:
    """Review score mean / median / count / std by late flag (3 dp)."""
    rev = fact.filter(F.col("review_score").isNotNull())
    s = F.col("review_score").cast("double")
    stats = rev.groupBy("is_delayed").agg(
        F.round(F.avg(s), 3).alias("mean"), F.count(F.lit(1)).alias("count"),
        F.round(F.stddev_samp(s), 3).alias("std"))
    # one row per flag value on each side: a join of two tiny aggregates
    med = exact_median(rev, ["review_score"], group=["is_delayed"], prefix="_m_", few_groups=True)
    return (stats.join(F.broadcast(med), "is_delayed")
            .select("is_delayed", "mean", F.round("_m_review_score", 3).alias("median"),
                    "count", "std")
            .orderBy("is_delayed"))


def score_drop(fact: DataFrame) -> DataFrame:
    """On-time mean minus late mean, both rounded first; one pass."""
    rev = fact.filter(F.col("review_score").isNotNull())
    s = F.col("review_score").cast("double")
    on = F.avg(F.when(F.col("is_delayed") == 0, s))
    late = F.avg(F.when(F.col("is_delayed") == 1, s))
    return rev.agg(F.round(on, 3).alias("mean_on_time"), F.round(late, 3).alias("mean_late"),
                   F.round(F.round(on, 3) - F.round(late, 3), 3).alias("score_drop"))


# The notebook's delay intervals (days, right-closed) and labels.
DELAY_INTERVAL_EDGES = [-9999, 0, 3, 7, 14, 9999]
DELAY_INTERVAL_LABELS = ["Tepat Waktu", "Terlambat 1-3 hari", "Terlambat 4-7 hari",
                         "Terlambat 8-14 hari", "Terlambat >14 hari"]


def score_by_delay_interval(fact: DataFrame) -> DataFrame:
    """Mean score and count per delay interval; values outside the
    outer edges get no interval and empty intervals are not reported."""
    rev = fact.filter(F.col("review_score").isNotNull())
    b = interval_bucket("delay_days", DELAY_INTERVAL_EDGES, DELAY_INTERVAL_LABELS)
    order = F.lit(None).cast("int")
    for i, label in enumerate(DELAY_INTERVAL_LABELS, start=1):
        order = F.when(F.col("delay_bucket") == label, F.lit(i)).otherwise(order)
    return (rev.select(b.alias("delay_bucket"), "review_score")
            .filter(F.col("delay_bucket").isNotNull())
            .groupBy("delay_bucket").agg(F.round(F.avg("review_score"), 2).alias("mean"),
                                         F.count(F.lit(1)).alias("count"))
            .withColumn("bucket_order", order).orderBy("bucket_order"))


def delay_score_sample(fact: DataFrame, n: int = 3000, seed: int = 42) -> DataFrame:
    """Deterministic sample of at most ``n`` scored rows (smallest seeded
    hash of the row's identity), delay clipped to -5..30 for display.
    A top-n by hash: each task keeps its n smallest, so the sample never
    gathers more than n rows per task."""
    rev = fact.filter(F.col("review_score").isNotNull())
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), "order_id", F.col("review_score").cast("string")))
    return (rev.select("order_id", "review_score", "delay_days", h.alias("_h"))
            .orderBy("_h", "order_id", "review_score", "delay_days").limit(n)
            .select("order_id", clip("delay_days", -5, 30).alias("delay_days_clipped"),
                    "review_score"))


ROLLUP_KEYS = ["purchase_ym", "customer_state", "seller_id"]
_ROLLUP_DURATIONS = [*STAGES, "actual_delivery_days", "delay_days"]


def rollup(fact: DataFrame, keys: Sequence[str] = tuple(ROLLUP_KEYS)) -> DataFrame:
    """Mergeable states of the fact per ``keys``: counts and exact integer sums
    (whole seconds and microseconds of durations, scores on time and late), from
    which every mean and rate over these keys is had by adding up."""
    late, score = F.col("is_delayed") == 1, F.col("review_score").cast("long")
    sums = [F.count(F.lit(1)).alias("n"), F.count("order_id").alias("n_orders"),
            F.count_if(late).alias("n_late"), F.count_if(F.col("is_delayed") == 0).alias("n_on_time"),
            F.sum("is_delayed").cast("long").alias("delayed")]
    for c in _ROLLUP_DURATIONS:
        sums += [F.sum(seconds_of(c)).alias(f"s_{c}"), F.sum(spare_micros(c)).alias(f"u_{c}"), F.count(c).alias(f"n_{c}")]
    for name, rows in (("score", F.lit(True)), ("on_time", F.col("is_delayed") == 0), ("late", late)):
        sums += [F.sum(F.when(rows, score)).alias(f"s_{name}"), F.count(F.when(rows, score)).alias(f"c_{name}")]
    return fact.groupBy(*keys).agg(*sums)


def merged(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A coarser rollup from a finer one."""
    sums = [c for c in states.columns if c not in ROLLUP_KEYS]
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def mean_days(c: str) -> Column:
    """The mean of a duration of a rollup's row."""
    return days_of(F.col(f"s_{c}"), F.col(f"u_{c}"), F.col(f"n_{c}"))


def executive_summary(fact: DataFrame, min_orders: int = 10) -> DataFrame:
    """The notebook's closing summary as one row, with one read of the fact."""
    return summary_of(rollup(fact, ["customer_state", "seller_id"]), min_orders)


def summary_of(states: DataFrame, min_orders: int = 10) -> DataFrame:
    """N17 from a rollup by (customer_state, seller_id) or finer: one merge into
    the grouping sets of all, of sellers and of states, read once."""
    sums = [c for c in states.columns if c not in ROLLUP_KEYS]
    seller, state = F.col("seller_id"), F.col("customer_state")
    sets = states.groupingSets([[], [seller], [state]], seller, state).agg(
        F.grouping_id().alias("_set"), *[F.sum(c).alias(c) for c in sums])
    rate = F.col("delayed") / F.col("n_orders") * F.lit(100.0)
    rows = sets.withColumn("_rate", rate).withColumn("_days", mean_days("actual_delivery_days"))
    for i, c in enumerate(STAGES):
        rows = rows.withColumn(f"_m{i}", mean_days(c))
    # the set's bits: seller_id, customer_state; set where a column is summed over
    whole = F.col("_set") == 3
    active = (F.col("_set") == 1) & seller.isNotNull() & (F.col("n_orders") >= min_orders)
    place = (F.col("_set") == 2) & state.isNotNull()
    shown = F.when(active, F.round(F.col("_rate"), 2))

    def share(c: str) -> Column:
        return F.round(F.col(f"w.{c}") / F.col("w.n") * F.lit(100.0), 2)

    def score(name: str) -> Column:
        return F.try_divide(F.col(f"w.s_{name}").cast("double"), F.col(f"w.c_{name}"))

    one = rows.agg(F.max(F.when(whole, F.struct(*sums, *[f"_m{i}" for i in range(len(STAGES))]))).alias("w"),
                   F.count_if(active).alias("active_sellers"),
                   F.round(avg_fixed(shown), 2).alias("mean_seller_delay_rate"),
                   F.count_if(shown > 50).alias("sellers_over_50_pct"),
                   F.max(F.when(place, F.struct("_rate", "customer_state"))).alias("r"),
                   F.max(F.when(place, F.struct("_days", "customer_state"))).alias("d"))
    best = F.array_max(F.array(*[F.struct(F.col(f"w._m{i}").alias("m"), F.lit(-i).alias("order"), F.lit(name).alias("stage"))
                                 for i, name in enumerate(STAGE_NAMES)]))
    return one.select(
        F.coalesce("w.n", F.lit(0)).alias("total_orders"), share("n_on_time").alias("on_time_rate_pct"),
        share("n_late").alias("delay_rate_pct"),
        *[F.round(F.col(f"w._m{i}"), 2).alias(f"avg_{c}") for i, c in enumerate(STAGES)],
        best["stage"].alias("bottleneck_stage"),
        "active_sellers", "mean_seller_delay_rate", "sellers_over_50_pct",
        F.col("r.customer_state").alias("worst_state"), F.round("r._rate", 2).alias("worst_state_delay_rate"),
        F.col("d.customer_state").alias("slowest_state"), F.round("d._days", 2).alias("slowest_state_days"),
        F.round(score("on_time"), 2).alias("score_on_time"), F.round(score("late"), 2).alias("score_late"),
        F.round(score("on_time") - score("late"), 2).alias("score_drop"))
