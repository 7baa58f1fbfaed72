"""Data-quality gate over the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The five checks, in order, with the condition a bad row meets.
CHECKS = [
    ("fact row count > 0", "row_count"),
    ("No NULL order_id", "empty_order_id"),
    ("No negative actual_delivery_days", "negative_delivery"),
    ("review_score in range 1-5 or NULL", "invalid_score"),
    ("is_delayed only 0 or 1", "invalid_flag"),
]


def quality_counts() -> list[Column]:
    """The counts of D1-D5 as aggregates; they add up over parts of the fact."""
    oid, score, flag = F.col("order_id"), F.col("review_score"), F.col("is_delayed")
    return [F.count(F.lit(1)).alias("row_count"),
            F.count_if(oid.isNull() | (oid == "")).alias("empty_order_id"),
            F.count_if(F.col("actual_delivery_days") < 0).alias("negative_delivery"),
            F.count_if(~score.isin(1, 2, 3, 4, 5) & score.isNotNull()).alias("invalid_score"),
            F.count_if(flag.isNull() | ~flag.isin(0, 1)).alias("invalid_flag")]


def quality_report(fact: DataFrame) -> DataFrame:
    """D1-D5 in one aggregation pass: (check_name, value, passed)."""
    one = fact.agg(*quality_counts())
    rows = F.array(*[F.struct(F.lit(i).alias("check_id"), F.lit(name).alias("check_name"),
                              F.col(c).alias("value"))
                     for i, (name, c) in enumerate(CHECKS, start=1)])
    long = one.select(F.inline(rows))
    passed = F.when(F.col("check_id") == 1, F.col("value") > 0).otherwise(F.col("value") == 0)
    return long.withColumn("passed", passed)


def assert_quality(report: DataFrame) -> list[tuple[str, int]]:
    """Raise ``ValueError`` naming every failed check (the report has five
    rows, so collecting it is bounded)."""
    rows = report.orderBy("check_id").collect()
    return _judged([(r.check_name, r.value) for r in rows])


def assert_counts(counts: dict[str, int]) -> list[tuple[str, int]]:
    """D6 on counts that were observed while the fact was written."""
    return _judged([(name, counts[c]) for name, c in CHECKS])


def _judged(checks: list[tuple[str, int]]) -> list[tuple[str, int]]:
    failed = [name for i, (name, value) in enumerate(checks) if (value <= 0 if i == 0 else value != 0)]
    if failed:
        raise ValueError(f"data quality check failed for: {failed}")
    return checks
