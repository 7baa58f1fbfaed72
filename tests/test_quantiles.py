import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from deliverylens.operators import quantiles
from deliverylens.operators.quantiles import exact_median, exact_quantiles
from tests.conftest import rows

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("per_e, steps", [(1024, 65_536), (1, 2), (0.01, 7)])
def test_matches_percentile_with_ties_nulls_and_groups(spark, monkeypatch, per_e, steps):
    monkeypatch.setattr(quantiles, "PER_E", per_e)   # coarse: every pass has work to do
    monkeypatch.setattr(quantiles, "STEPS", steps)
    rng = np.random.default_rng(11)
    n = 4000
    x = np.round(rng.normal(10, 3, n), 1)       # many ties
    x[rng.random(n) < 0.3] = 0.0                 # a value holding 30 % of rows
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "x": x, "y": rng.exponential(2, n)})
    pdf.loc[::17, "y"] = np.nan
    df = spark.createDataFrame(pdf).withColumn(
        "y", F.when(F.isnan("y"), None).otherwise(F.col("y")))
    got = exact_quantiles(df, ["x", "y"], PROBS)
    ref = df.agg(F.percentile("x", PROBS).alias("q_x"), F.percentile("y", PROBS).alias("q_y"))
    assert rows(got) == rows(ref)
    g = exact_quantiles(df, ["x", "y"], PROBS, group=["g"]).orderBy("g")
    gref = df.groupBy("g").agg(F.percentile("x", PROBS).alias("q_x"),
                               F.percentile("y", PROBS).alias("q_y")).orderBy("g")
    assert rows(g) == rows(gref)
    assert np.allclose(rows(exact_median(df, ["y"]))[0][0], pdf["y"].median())


def test_values_of_every_size(spark):
    """Tiny, huge, negative, signed zeros, infinities and neighbours in the last bit."""
    r = random.Random(2)
    vals = [r.choice((-1, 1)) * r.random() * 10.0 ** r.randint(-300, 300) for _ in range(800)]
    vals += [0.0, -0.0, float("inf"), float("-inf"), 5e-324, -5e-324, 1.0] * 3
    vals += (np.nextafter(1.0, 2.0) + np.arange(50) * np.spacing(1.0)).tolist()
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    probs = [i / 64 for i in range(65)]
    assert rows(exact_quantiles(df, ["x"], probs)) == rows(df.agg(F.percentile("x", probs)))


def test_nan_is_the_greatest(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "x double")
    (got,), = rows(exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]))
    assert got[:2] == [1.0, 2.0] and np.isnan(got[2])


def test_empty_and_single(spark):
    df = spark.createDataFrame([(None, "a"), (2.5, "b"), (None, None)], "x double, g string")
    assert rows(exact_quantiles(df, ["x"], [0.5])) == [([2.5],)]
    assert rows(exact_quantiles(df.filter("x > 5"), ["x"], [0.5])) == [([None],)]
    assert sorted(rows(exact_quantiles(df, ["x"], [0.5], group=["g"])), key=str) == sorted(
        [("a", [None]), ("b", [2.5]), (None, [None])], key=str)
    assert rows(exact_quantiles(df.filter("x > 5"), ["x"], [0.5], group=["g"])) == []


def test_small_n_rank_offsets(spark):
    r = random.Random(5)
    for n in [1, 2, 3, 4, 5, 7, 10, 13, 40, 486]:
        vals = [round(r.uniform(0, 10), 3) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        probs = [0.1, 0.25, 0.5, 0.75, 0.9]
        assert rows(exact_quantiles(df, ["x"], probs)) == rows(
            df.agg(F.percentile("x", probs)))


def test_nothing_is_collected(spark):
    """Counts are combined before the shuffle; no list of values, no sketch, no forced failure."""
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    plan = exact_quantiles(df, ["x"], [0.5])._jdf.queryExecution().executedPlan().toString()
    for word in ("collect_list", "percentile", "raise_error", "CartesianProduct"):
        assert word not in plan
    assert "partial_count" in plan
