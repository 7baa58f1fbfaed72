"""Exact quantiles by distributed rank selection (medians, quartiles, describe).

Spark's exact ``percentile`` keeps one buffer entry per distinct value, so for
a continuous column its final aggregation grows with the data. Here the wanted
ranks are narrowed down by counting, and no value is collected or shuffled that
can't be one of them:

1. rows are counted in buckets of a fixed monotone scale (a logarithm; some
   thousandths of the value wide) with map-side combining. Running totals over
   a column's buckets, of which there are a bounded number, say which bucket
   holds each wanted rank;
2. rows of these buckets alone are counted again in 65,536 equal steps between
   the bucket's least and greatest value;
3. rows of the steps that hold a wanted rank are counted by value, and running
   totals give the value at the rank.

A bucket or step whose least and greatest value agree is answered at once, so
ties and a value holding a third of the rows cost nothing. Each pass reads the
input's needed columns; what is shuffled is counts. Ranks are interpolated
as ``F.percentile`` does (linear, position p * (n - 1)), so results equal it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets for each factor e of the value, and the size from which on the scale
#: is logarithmic; steps that a bucket is divided into.
PER_E = 1024
SMALL = 1e-3
STEPS = 65_536
_INFINITE = 1 << 40


def _bucket(v: str) -> str:
    """A bucket number that never falls as ``v`` rises; NaN is the greatest."""
    return (f"CASE WHEN isnan({v}) THEN {_INFINITE + 1}L "
            f"WHEN abs({v}) = double('infinity') THEN cast(signum({v}) AS bigint) * {_INFINITE}L "
            f"ELSE floor(signum({v}) * log1p(abs({v}) / {SMALL}D) * {float(PER_E)}D) END")


def _on(a: str, b: str, keys: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{a}.{k} <=> {b}.{k}" for k in keys))


def _narrowed(counts: DataFrame, within: Sequence[str], by: str) -> DataFrame:
    """Of counted parts (``n`` rows each, in the order of ``by``) those that hold
    a wanted rank, with the rank of their first row and the ranks in them."""
    before = f"sum(n) OVER (PARTITION BY {', '.join(within)} ORDER BY {by} ROWS UNBOUNDED PRECEDING)"
    placed = counts.withColumn("start", F.expr(f"start + {before} - n"))
    inside = F.expr("filter(wanted, w -> w.rank >= start AND w.rank < start + n)")
    return placed.withColumn("wanted", inside).where("size(wanted) > 0")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group: Sequence[str] = (), prefix: str = "q_", few_groups: bool = False) -> DataFrame:
    """One row per group with, per column ``c``, ``{prefix}{c}``: an array of
    the exact quantiles at ``probs`` (NULLs ignored; NULL for no values).

    ``few_groups``: the caller knows that the groups are a few at any size of
    the data (a flag, say), so what is wanted of them may be broadcast."""
    cols, probs, group = list(cols), [float(p) for p in probs], list(group)
    names = [f"_g{i}" for i in range(len(group))]
    keys = [*names, "c"]
    # -0.0 + 0.0 is 0.0: one zero
    values = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in cols])
    every = df.select(*[F.col(g).alias(n) for g, n in zip(group, names)], F.posexplode(values).alias("c", "v"))
    base = every.selectExpr("*", f"{_bucket('v')} AS bucket").where("v IS NOT NULL")

    def near(rows: DataFrame) -> DataFrame:
        """Wanted parts: a few rows for each column and probability, and for
        each group."""
        return F.broadcast(rows) if few_groups or not group else rows

    counted = [F.expr(e) for e in ("count(1) AS n", "min(v) AS lo", "max(v) AS hi")]
    ranks = ", ".join(f"struct({j} AS j, {s} AS side, least(floor({p!r}D * (total - 1)) + {s}, total - 1) AS rank)"
                      for j, p in enumerate(probs) for s in (0, 1))
    buckets = (base.groupBy(*keys, "bucket").agg(*counted)
               .selectExpr("*", f"sum(n) OVER (PARTITION BY {', '.join(keys)}) AS total")
               .selectExpr("*", f"array({ranks}) AS wanted", "0L AS start"))
    first = _narrowed(buckets, keys, "bucket")

    # what is known of a part goes along as grouping keys, so no join follows the count
    part, known = [*keys, "bucket"], ["least", "most", "total", "start", "wanted"]
    step = f"floor((v - least) / (most - least) * {float(STEPS)}D)"
    open1 = first.where("lo < hi").selectExpr(*part, "lo AS least", "hi AS most", "total", "start", "wanted")
    steps = (base.alias("a").join(near(open1).alias("b"), _on("a", "b", part)).selectExpr("a.*", *known, f"{step} AS step")
             .groupBy(*part, *known, "step").agg(*counted))
    second = _narrowed(steps, part, "step")

    open2 = second.where("lo < hi").select(*part, *known, "step")
    single = (base.alias("a").join(near(open2).alias("b"), _on("a", "b", part) & F.expr(f"b.step = {step}"))
              .select("a.*", *known, "step").groupBy(*part, *known, "step", "v").agg(F.expr("count(1) AS n")))
    third = _narrowed(single, [*part, "step"], "v")

    # NaN is not less than NaN, so NOT lo < hi rather than lo = hi
    done = [d.where("NOT lo < hi").withColumnRenamed("lo", "v") for d in (first, second)]
    found = reduce(DataFrame.unionByName, [d.selectExpr(*keys, "total", "v", "explode(wanted) AS w")
                                           for d in (*done, third)]).selectExpr(*keys, "total", "v", "w.j", "w.side")
    if group:  # groups without a value have a row as well
        found = found.unionByName(every.select(*names).distinct(), allowMissingColumns=True)

    picked = found.groupBy(*names).agg(*[F.expr(e) for e in (
        *(f"max(total) FILTER (WHERE c = {i}) AS n{i}" for i in range(len(cols))),
        *(f"max(v) FILTER (WHERE c = {i} AND j = {j} AND side = {s}) AS v{i}_{j}_{s}"
          for i in range(len(cols)) for j in range(len(probs)) for s in (0, 1)))])

    def between(i: int, j: int) -> str:
        pos, low, high = f"{probs[j]!r}D * (n{i} - 1)", f"v{i}_{j}_0", f"v{i}_{j}_1"
        return (f"CASE WHEN {pos} = floor({pos}) OR {high} = {low} THEN {low} "
                f"ELSE (floor({pos}) + 1 - {pos}) * {low} + ({pos} - floor({pos})) * {high} END")

    return picked.select(*[F.col(n).alias(g) for g, n in zip(group, names)],
                         *[F.expr(f"array({', '.join(between(i, j) for j in range(len(probs)))})").alias(f"{prefix}{c}")
                           for i, c in enumerate(cols)])


def exact_median(df: DataFrame, cols: Sequence[str], group: Sequence[str] = (),
                 prefix: str = "median_", few_groups: bool = False) -> DataFrame:
    """Exact medians, one column ``{prefix}{c}`` per column."""
    q = exact_quantiles(df, cols, [0.5], group, prefix="_q_", few_groups=few_groups)
    return q.select(*group, *[F.col(f"_q_{c}")[0].alias(f"{prefix}{c}") for c in cols])
