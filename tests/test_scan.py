"""The chunked prefix scans equal plain windows (they exist for hot keys)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from slotwise.operators import scan


def _data(spark, n=3000, keys=3, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.6 else rnd.randrange(1, keys)   # key 0 is hot
        v = rnd.choice([None, None, rnd.randrange(100)])
        rows.append((k, rnd.randrange(10_000), i, v))
    return spark.createDataFrame(rows, "k long, t long, id long, v long").withColumn("b", F.floor(F.col("t") / 500))


def test_carry_last_matches_window(spark):
    df = _data(spark)
    got = scan.carry_last(df, ["k"], ["t", "id"], F.col("v"), "out", bucket="b")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("out", F.last("v", ignorenulls=True).over(w))
    assert sorted(got.select("id", "out").collect()) == sorted(want.select("id", "out").collect())


def test_carry_last_inclusive(spark):
    df = _data(spark, seed=3)
    got = scan.carry_last(df, ["k"], ["t", "id"], F.col("v"), "out", bucket="b", inclusive=True)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("out", F.last("v", ignorenulls=True).over(w))
    assert sorted(got.select("id", "out").collect()) == sorted(want.select("id", "out").collect())


def test_carry_next_matches_window(spark):
    df = _data(spark, seed=11)
    got = scan.carry_next(df, ["k"], ["t", "id"], F.col("v"), "out", bucket="b")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(1, Window.unboundedFollowing)
    want = df.withColumn("out", F.first("v", ignorenulls=True).over(w))
    assert sorted(got.select("id", "out").collect()) == sorted(want.select("id", "out").collect())


def test_position_matches_row_number(spark):
    df = _data(spark, seed=5)
    got = scan.position(df, ["k"], ["t", "id"], "pos", bucket="b")
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    assert sorted(got.select("id", "pos").collect()) == sorted(want.select("id", "pos").collect())


def test_carry_max_matches_window(spark):
    df = _data(spark, seed=13)
    got = scan.carry_max(df, ["k"], ["t", "id"], F.col("v"), "out", bucket="b")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("out", F.max("v").over(w))
    assert sorted(got.select("id", "out").collect()) == sorted(want.select("id", "out").collect())
