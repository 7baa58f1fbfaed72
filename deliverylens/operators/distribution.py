"""Distribution summaries shared by the analysis and profiling operators.

``histogram`` (N3, N10, P12-P14), ``describe`` (N5, P5), ``box_stats`` (N7,
P18) and ``value_counts`` (P8). All are aggregations; the only data brought
to one place are one-row statistics (joined back as a broadcast) and
per-bin / per-column results whose size is set by the parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.functions.exprs import avg_days, clip
from deliverylens.operators.quantiles import exact_quantiles

DURATION_COLUMNS = {"approval_time_days", "seller_processing_days", "carrier_transit_days",
                    "actual_delivery_days", "delay_days"}


def _mean(c: str) -> Column:
    return avg_days(c) if c in DURATION_COLUMNS else F.avg(c)


def histogram(df: DataFrame, value: str, bins: int, lo: float | None = None,
              hi: float | None = None) -> DataFrame:
    """Equal-width histogram of ``value`` after an optional clip to [lo, hi].

    Like numpy / matplotlib: NULLs are ignored, the range is the (clipped)
    data's min..max (widened by 0.5 each side if they are equal), the last
    bin is closed on the right, and empty bins are reported with count 0.
    Output: bin (0-based), bin_start, bin_end, count.
    """
    v = df.select(clip(value, lo, hi).alias("v")).filter(F.col("v").isNotNull())
    stats = v.agg(F.min("v").alias("mn"), F.max("v").alias("mx")).select(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    # one-row statistics: a broadcast cross join is a map-side column append
    scale = F.lit(float(bins)) / (F.col("hi") - F.col("lo"))
    idx = F.floor((F.col("v") - F.col("lo")) * scale).cast("int")
    idx = F.when(idx >= bins, F.lit(bins - 1)).otherwise(idx)
    counts = (v.crossJoin(F.broadcast(stats)).groupBy(idx.alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    axis = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(
        F.broadcast(stats))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (axis.join(F.broadcast(counts), "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
            .orderBy("bin"))


def histograms(df: DataFrame, cols: Sequence[str], bins: int, lo: float | None = None,
               hi: float | None = None) -> DataFrame:
    """``histogram`` of several columns in two scans: one for the ranges of all,
    one that counts (column, bin) pairs, combined map-side. Output as
    ``histogram`` with ``column_name`` first."""
    clipped = df.select(*[clip(c, lo, hi).alias(c) for c in cols])
    ends = clipped.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("mn", F.min), ("mx", F.max))])
    ranges = ends.select(F.expr("inline(array(" + ", ".join(
        f"struct({i} AS c, {c!r} AS column_name, if(mn{i} = mx{i}, mn{i} - 0.5D, mn{i}) AS lo, "
        f"if(mn{i} = mx{i}, mx{i} + 0.5D, mx{i}) AS hi)" for i, c in enumerate(cols)) + "))")).where("lo IS NOT NULL")
    values = clipped.select(F.posexplode(F.array(*cols)).alias("c", "v")).where("v IS NOT NULL")
    at = F.expr(f"least(cast(floor((v - lo) * ({float(bins)}D / (hi - lo))) AS int), {bins - 1})")
    counts = values.join(F.broadcast(ranges), "c").groupBy("c", at.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    axis = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = F.expr(f"(hi - lo) / {float(bins)}D")
    return (axis.join(F.broadcast(counts), ["c", "bin"], "left")
            .select("column_name", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
            .orderBy("column_name", "bin"))


def describe(df: DataFrame, cols: Sequence[str], digits: int | None = 2) -> DataFrame:
    """pandas ``describe`` for numeric columns, one row per column:
    count (non-null), mean, sample std, min, exact 25/50/75 % (linear
    interpolation) and max. One aggregation pass for the moments, two for the exact quartiles."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), _mean(c).alias(f"m{i}"),
                 F.stddev_samp(c).alias(f"s{i}"), F.min(c).cast("double").alias(f"lo{i}"),
                 F.max(c).cast("double").alias(f"hi{i}")]
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], prefix="_q_")
    one = df.agg(*aggs).crossJoin(F.broadcast(
        q.select(*[F.col(f"_q_{c}").alias(f"q{i}") for i, c in enumerate(cols)])))

    def r(x: Column) -> Column:
        return F.round(x, digits) if digits is not None else x

    rows = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
        r(F.col(f"m{i}")).alias("mean"), r(F.col(f"s{i}")).alias("std"),
        r(F.col(f"lo{i}")).alias("min"), r(F.col(f"q{i}")[0]).alias("p25"),
        r(F.col(f"q{i}")[1]).alias("p50"), r(F.col(f"q{i}")[2]).alias("p75"),
        r(F.col(f"hi{i}")).alias("max")) for i, c in enumerate(cols)])
    return one.select(F.inline(rows))


def box_stats(df: DataFrame, cols: Sequence[str], lo: float | None = None,
              hi: float | None = None, whisker: float = 1.5) -> DataFrame:
    """Box-plot statistics per column after a display clip: quartiles, IQR,
    whiskers (most extreme values within ``whisker`` x IQR of the box) and the
    number of points beyond them. Two aggregation passes; the quartiles are a
    one-row broadcast between them."""
    clipped = df.select(*[clip(c, lo, hi).alias(c) for c in cols])
    q = exact_quantiles(clipped, cols, [0.25, 0.5, 0.75], prefix="_q_").select(
        *[F.col(f"_q_{c}").alias(f"q{i}") for i, c in enumerate(cols)])
    joined = clipped.crossJoin(F.broadcast(q))
    aggs = []
    for i, c in enumerate(cols):
        q1, q3 = F.col(f"q{i}")[0], F.col(f"q{i}")[2]
        lo_f, hi_f = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
        v = F.col(c)
        aggs += [F.first(F.col(f"q{i}")).alias(f"q{i}"),
                 F.min(F.when(v >= lo_f, v)).alias(f"wl{i}"),
                 F.max(F.when(v <= hi_f, v)).alias(f"wh{i}"),
                 F.count_if((v < lo_f) | (v > hi_f)).alias(f"o{i}"),
                 F.count(v).alias(f"n{i}")]
    one = joined.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
        F.round(F.col(f"q{i}")[0], 4).alias("q1"), F.round(F.col(f"q{i}")[1], 4).alias("median"),
        F.round(F.col(f"q{i}")[2], 4).alias("q3"),
        F.round(F.col(f"q{i}")[2] - F.col(f"q{i}")[0], 4).alias("iqr"),
        F.round(F.col(f"wl{i}"), 4).alias("whisker_low"),
        F.round(F.col(f"wh{i}"), 4).alias("whisker_high"),
        F.col(f"o{i}").alias("outliers")) for i, c in enumerate(cols)])
    return one.select(F.inline(rows))


def value_counts(df: DataFrame, col: str, top: int | None = None, normalize: bool = False,
                 sort: str = "count") -> DataFrame:
    """pandas ``value_counts``: NULLs dropped; ``sort="count"`` (descending,
    ties by value) or ``"value"`` (ascending); ``normalize`` adds the share
    in % of non-null rows; ``top`` keeps the first n.

    The share's denominator is the sum of the group counts over the grouped
    result; for an unbounded number of distinct values it is joined as a
    one-row broadcast rather than a global window.
    """
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = g.agg(F.sum("count").alias("_total"))
        g = (g.crossJoin(F.broadcast(total))
             .withColumn("share_pct", F.round(F.col("count") * F.lit(100.0) / F.col("_total"), 2))
             .drop("_total"))
    g = g.orderBy(F.desc("count"), F.asc(col)) if sort == "count" else g.orderBy(F.asc(col))
    return g.limit(top) if top is not None else g
