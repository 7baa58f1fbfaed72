import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from deliverylens.operators.sequence import number_within_groups


def test_numbering_matches_window_with_a_hot_key(spark, tmp_path):
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        key = 7 if i % 3 == 0 else rnd.randint(0, 400)   # key 7 holds a third of the rows
        data.append((key, rnd.randint(1, 5), i))
    df = spark.createDataFrame(data, "k long, a int, b long")
    got = number_within_groups(df, "k", ["a", "b"], "rn", str(tmp_path / "stage"), partitions=12)
    w = Window.partitionBy("k").orderBy("a", "b")
    expected = df.withColumn("rn", F.row_number().over(w))
    diff = got.select("k", "a", "b", "rn").exceptAll(expected.select("k", "a", "b", "rn"))
    assert diff.count() == 0 and got.count() == 3000
    # the hot key really was spread over several range partitions
    staged = spark.read.parquet(str(tmp_path / "stage"))
    assert staged.filter("k = 7").select("_range_pid").distinct().count() > 2


def test_only_hot_and_missing_keys_are_staged(spark, tmp_path):
    data = [(i % 500 if i % 4 else None, i % 3, i) for i in range(4000)]   # no hot key; a quarter has none
    df = spark.createDataFrame(data, "k long, a int, b long")
    expected = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("a", "b")))
    got = number_within_groups(df, "k", ["a", "b"], "rn", str(tmp_path / "stage"), partitions=12)
    assert got.count() == 4000 and got.exceptAll(expected).count() == 0
    assert spark.read.parquet(str(tmp_path / "stage")).where("k IS NOT NULL").isEmpty()
    some = df.where("k IS NOT NULL")
    got = number_within_groups(some, "k", ["a", "b"], "rn", str(tmp_path / "none"), partitions=12)
    assert got.exceptAll(expected.where("k IS NOT NULL")).count() == 0
    assert not (tmp_path / "none").exists()
