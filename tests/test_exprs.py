import datetime as dt

from pyspark.sql import functions as F

from deliverylens.functions import exprs as X
from tests.conftest import rows


def test_days_between_and_null(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 2, 6)), (dt.datetime(2024, 1, 1), None)],
        "a timestamp_ntz, b timestamp_ntz")
    assert rows(df.select(X.days_between("a", "b"))) == [(1.25,), (None,)]


def test_clip_lower_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "x double")
    assert rows(df.select(X.clip_lower("x"))) == [(0.0,), (None,), (2.0,)]
    assert rows(df.select(X.clip("x", -0.5, 1.0))) == [(-0.5,), (None,), (1.0,)]


def test_bucket_edges_are_right_closed(spark):
    vals = [0.0, 5.0, 5.000001, 10.0, 15.0, 20.0, 30.0, 30.5, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    labels = ["a", "b", "c", "d", "e", "f"]
    got = [r[0] for r in rows(df.select(X.bucket("x", [5, 10, 15, 20, 30], labels)))]
    assert got == ["a", "a", "b", "b", "c", "d", "e", "f", "f"]


def test_interval_bucket_outside_is_null(spark):
    df = spark.createDataFrame([(-10000.0,), (0.0,), (3.0,), (3.5,), (10000.0,)], "x double")
    got = [r[0] for r in rows(df.select(
        X.interval_bucket("x", [-9999, 0, 3, 7, 14, 9999], ["a", "b", "c", "d", "e"])))]
    assert got == [None, "a", "b", "c", None]


def test_weekday_monday_and_sunday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 3),), (dt.datetime(2024, 1, 7, 23),)],
                               "t timestamp_ntz")
    assert rows(df.select(X.iso_weekday("t"), X.weekday_name("t"))) == [
        (1, "Senin"), (7, "Minggu")]


def test_daypart_hour_edges(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in hours], "t timestamp_ntz")
    got = [r[0][0] for r in rows(df.select(X.daypart("t")))]
    assert got == ["1", "1", "2", "2", "3", "3", "4", "4"]


def test_avg_days_is_exact_mean(spark):
    # three durations whose double sum is not exact; the mean is exactly 0.125 days
    vals = [1 / 24, 2 / 24, 6 / 24]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert rows(df.agg(X.avg_days("x"))) == [(3 / 24,)]
    assert rows(spark.createDataFrame([(None,)], "x double").agg(X.avg_days("x"))) == [(None,)]


def test_rates(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (1,)], "d int")
    got = rows(df.agg(X.pct(F.col("d") == 1), X.pct_div_first(F.col("d") == 0)))
    assert got == [(50.0, 50.0)]


def test_days_between_ignores_session_time_zone(spark):
    # 1998-10-11 00:00 does not exist in Sao Paulo local time (DST start)
    df = spark.createDataFrame([(dt.datetime(1998, 10, 10, 20), dt.datetime(1998, 10, 11, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert rows(df.select(X.days_between("a", "b"))) == [(4 / 24,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
