"""Skew-safe ``row_number() OVER (PARTITION BY key ORDER BY cols)``.

A plain window sends every row of a key to one task; a key holding a third
of the table would make one task do a third of the work. A sketch of frequent
items (``hot_join.hot_keys``) finds the keys with more than one task's share of
the rows. All other keys take the plain window, in one shuffle. Rows of hot keys,
and rows without a key:

1. range-partition on (key, cols): the sampled bounds cut a hot key's rows
   into several balanced partitions; the partition id is stored and the
   result written to the shared folder (range sampling is not repeatable,
   and the write cuts the lineage so a lost executor re-reads files);
2. number rows within (partition, key): each window group is at most one
   balanced partition;
3. only keys at partition boundaries can continue from earlier partitions:
   at most two per partition (and the missing key), so the table of their
   per-partition counts and running offsets is bounded by the partition count
   and is broadcast.

``cols`` must make rows unique within a key (as a deterministic
``row_number`` needs anyway).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deliverylens.operators.hot_join import hot_keys

PID = "_range_pid"


def number_within_groups(df: DataFrame, key: str, cols: Sequence[str], out: str,
                         stage_path: str, partitions: int | None = None) -> DataFrame:
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = [r["hot"] for r in hot_keys(df.select(key), key, n).collect()]  # at most n
    is_hot = F.col(key).isNull() | F.col(key).isin(hot)
    plain = df.where(~is_hot).withColumn(
        out, F.row_number().over(Window.partitionBy(key).orderBy(*cols)).cast("int"))
    spread = df.where(is_hot)
    if not hot and spread.isEmpty():
        return plain
    return plain.unionByName(_number_by_ranges(spread, key, cols, out, stage_path, n))


def _number_by_ranges(df: DataFrame, key: str, cols: Sequence[str], out: str, stage_path: str, n: int) -> DataFrame:
    ranged = (df.repartitionByRange(n, key, *cols)
              .withColumn(PID, F.spark_partition_id()))
    ranged.write.mode("overwrite").parquet(stage_path)
    staged = df.sparkSession.read.parquet(stage_path)

    local = staged.withColumn(
        "_local_rn", F.row_number().over(Window.partitionBy(PID, key).orderBy(*cols)))

    bounds = staged.groupBy(PID).agg(F.min(key).alias("_kmin"), F.max(key).alias("_kmax"))
    boundary_keys = (bounds.select(F.col("_kmin").alias("_k"))
                     .union(bounds.select(F.col("_kmax"))).union(bounds.select(F.lit(None))).distinct())
    counts = (staged.join(F.broadcast(boundary_keys), F.col(key).eqNullSafe(F.col("_k")), "left_semi")
              .groupBy(F.col(key).alias("_k"), F.col(PID).alias("_p")).agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_k", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))

    return (local.join(F.broadcast(offsets), F.col(key).eqNullSafe(F.col("_k")) & (F.col(PID) == F.col("_p")), "left")
            .withColumn(out, (F.col("_local_rn") + F.coalesce(F.col("_offset"), F.lit(0)))
                        .cast("int"))
            .drop("_local_rn", "_offset", "_k", "_p", PID))
