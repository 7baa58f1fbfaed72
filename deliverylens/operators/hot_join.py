"""Joins of a large table with a dimension on a key that may be hot.

A hash join sends all rows of a key to one task. Here a bounded sketch of
frequent items finds the keys that hold more than one task's share of the rows;
only their rows are dealt over several tasks, and only their dimension rows are
repeated, once for each. Rows whose key is NULL, which match nothing, are dealt
over all tasks instead of meeting in one. A dimension that Spark would broadcast
is joined as it is.

The sketch is read to the driver (at most one key for each shuffle partition)
before the join is planned: both sides must see the same keys, and a merged
sketch need not come out twice the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items that the sketch tracks for each key it may find.
TRACKED = 16
#: Parts for each task's share of rows that a key holds (parts are hashed to
#: tasks, and many small ones come out even), and the most parts of one key.
FINER = 32
MOST_PARTS = 1 << 16


def small_enough(dim: DataFrame) -> bool:
    """Whether the plan's own size estimate lets Spark broadcast ``dim``."""
    most = dim.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= most


def hot_keys(keys: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """(hot, parts): the keys with at least 1 / partitions of all rows, at most
    ``partitions`` of them, and how many parts their rows should be dealt to."""
    spark = keys.sparkSession
    n = min(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), 50_000)
    found = (keys.where(F.col(key).isNotNull())
             .agg(F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(`{key}`, {n}, {n * TRACKED})").alias("top"))
             .select("total", F.inline("top")).where(F.col("count") * n >= F.col("total"))
             .select(F.col("item").alias("hot"),
                     F.least(F.ceil(F.col("count") * n * FINER / F.col("total")), F.lit(MOST_PARTS)).cast("int").alias("parts")))
    return spark.createDataFrame(found.collect(), found.schema)  # at most n rows


def split_join(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str, spread: Sequence[str],
               how: str = "left", keys: DataFrame | None = None) -> DataFrame:
    """``big`` LEFT or INNER JOIN ``dim`` on big_key = dim_key, hot keys split.

    ``spread``: columns of ``big`` that tell a key's rows apart; their hash, the
    same on every attempt, deals the rows. ``keys``: a cheaper table with the
    same keys to sketch (a scan of one column) instead of ``big`` itself.
    """
    on = F.col(big_key) == F.col(dim_key)
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    if small_enough(dim):
        return big.join(dim, on, how)
    source = keys if keys is not None else big
    hot = F.broadcast(hot_keys(source, big_key if big_key in source.columns else dim_key))
    partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = F.xxhash64(*spread)

    def part(parts: Column) -> Column:
        return (F.when(F.col(big_key).isNull(), F.pmod(deal, F.lit(partitions * FINER)))
                .when(parts.isNotNull(), F.pmod(deal, parts)).otherwise(F.lit(0))).cast("int")

    left = (big.join(hot, F.col(big_key) == F.col("hot"), "left")
            .withColumn("_part", part(F.col("parts"))).drop("hot", "parts"))
    right = (dim.join(hot, F.col(dim_key) == F.col("hot"), "left")
             .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
             .drop("hot", "parts"))
    return left.join(right, on & (F.col("_part") == F.col("_copy")), how).drop("_part", "_copy")
