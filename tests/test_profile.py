"""Duplicates by fingerprint: collisions, NULL patterns and false alarms count nothing."""

import pytest
from pyspark.sql import functions as F

from deliverylens.operators import profile as P
from tests.conftest import rows


def plain(df):
    g = df.groupBy(*df.columns).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]


@pytest.fixture
def table(spark):
    """Copies, a third of the rows alike, NULLs in every place, a clashing column name."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700).alias("k"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 5 = 1 THEN NULL ELSE concat('v', id % 40) END").alias("_a"),
        F.expr("CASE WHEN id % 7 = 2 THEN 'v' || id % 40 END").alias("a b"))


def test_equal_to_grouping_by_all_columns(table):
    (got,) = rows(P.duplicate_rows(table.withColumnRenamed("_a", "x"), "t"))
    assert got[1] == plain(table) > 1000


def test_forced_collisions_count_nothing(spark, monkeypatch):
    """Every row has one fingerprint: all are suspects, and compared whole."""
    df = spark.range(200).select((F.col("id") % 150).alias("k"), F.lit(None).cast("string").alias("s"))
    monkeypatch.setattr(P, "_fingerprints", lambda d: d.select("*", F.lit(1).cast("long").alias("_a"),
                                                               F.lit(2).cast("long").alias("_b")))
    assert rows(P.duplicate_rows(df, "t"))[0][1] == 50
    assert rows(P.duplicate_rows(df.distinct(), "t"))[0][1] == 0


def test_a_filter_of_one_word_lets_nothing_by(spark, monkeypatch):
    monkeypatch.setattr(P, "FILTER_WORDS", 1)
    df = spark.range(2000).select((F.col("id") % 1900).alias("k"))
    assert rows(P.duplicate_rows(df, "t"))[0][1] == 100


def test_nulls_in_different_places_are_different_rows(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), (None, None), (None, None)], "a string, b string")
    assert rows(P.duplicate_rows(df, "t")) == [("t", 1, 25.0)]
    assert rows(P.duplicate_rows(df.where("false"), "t")) == [("t", 0, None)]


def test_whole_rows_are_shuffled_only_behind_the_filter(spark):
    df = spark.range(100).select((F.col("id") % 97).alias("k"), F.concat(F.lit("payload"), "id").alias("payload"))
    plan = P.duplicate_rows(df, "t")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    whole = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x and "payload" in x]
    assert whole and all("BroadcastHashJoin" in "\n".join(lines[i:i + 6]) for i in whole)
