import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from deliverylens.operators.distribution import box_stats, describe, histogram, value_counts
from tests.conftest import rows


def _data(spark, n=500, seed=7):
    rng = np.random.default_rng(seed)
    vals = np.round(rng.gamma(2.0, 3.0, n), 3)
    pdf = pd.DataFrame({"x": vals, "k": rng.integers(0, 12, n).astype(str)})
    pdf.loc[::37, "x"] = np.nan
    sdf = spark.createDataFrame(pdf).withColumn("x", F.when(F.isnan("x"), None).otherwise(F.col("x")))
    return pdf, sdf


def test_histogram_matches_numpy(spark):
    pdf, sdf = _data(spark)
    for lo, hi, bins in [(None, None, 30), (0.0, 10.0, 40), (None, 5.0, 7)]:
        v = pdf["x"].dropna().clip(lo, hi)
        expected, edges = np.histogram(v, bins=bins)
        got = rows(histogram(sdf, "x", bins, lo, hi), "bin", "bin_start", "count")
        assert [r[2] for r in got] == list(expected)
        assert np.allclose([r[1] for r in got], edges[:-1])


def test_histogram_single_value(spark):
    sdf = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    got = rows(histogram(sdf, "x", 4), "bin_start", "count")
    assert got[0] == (1.5, 0) and sum(r[1] for r in got) == 2


def test_describe_matches_pandas(spark):
    pdf, sdf = _data(spark)
    d = pdf["x"].describe()
    got = rows(describe(sdf, ["x"], digits=None))[0]
    assert got[0] == "x" and got[1] == int(d["count"])
    assert np.allclose(got[2:], [d["mean"], d["std"], d["min"], d["25%"], d["50%"], d["75%"],
                                 d["max"]])


def test_box_stats_whiskers(spark):
    pdf, sdf = _data(spark)
    v = pdf["x"].dropna().clip(0, 20)
    q1, q3 = np.percentile(v, [25, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    got = rows(box_stats(sdf, ["x"], 0, 20))[0]
    assert got[-3] == round(v[v >= lo].min(), 4) and got[-2] == round(v[v <= hi].max(), 4)
    assert got[-1] == int(((v < lo) | (v > hi)).sum())


def test_value_counts_matches_pandas(spark):
    pdf, sdf = _data(spark)
    exp = pdf["k"].value_counts()
    got = rows(value_counts(sdf, "k", top=5, normalize=True))
    assert [r[1] for r in got] == list(exp.values[:5])
    assert abs(sum(r[2] for r in rows(value_counts(sdf, "k", normalize=True))) - 100) < 0.1
