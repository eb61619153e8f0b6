"""The skew-safe bucketed windows equal plain per-key windows, including a
hot key and rows that cross bucket borders."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from vaultline.functions import windows as W
from vaultline.functions.columns import epoch_micros


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.4 else rnd.randint(1, 30)     # key 0 is hot
        t = base + dt.timedelta(seconds=rnd.randint(0, 10 * 86400))
        rows.append((i, k if rnd.random() > 0.02 else None, t, rnd.randint(1, 5)))
    return spark.createDataFrame(rows, "id long, k long, t timestamp_ntz, v int")


def test_prev_next_rownum_runningsum(spark):
    df = _frame(spark)
    order = ["t", "id"]
    b = F.to_date("t")
    w = Window.partitionBy("k").orderBy(*order)
    expect = df.select("id",
                       F.lag("v").over(w).alias("e_prev"),
                       F.lead("t").over(w).alias("e_next"),
                       F.row_number().over(w).alias("e_rn"),
                       F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("e_sum"))
    got = W.with_prev(df, "k", order, ["v"], b)
    got = W.with_next(got, "k", order, ["t"], b)
    got = W.with_row_number(got, "k", order, b)
    got = W.with_running_sum(got, "k", order, "v", b, "s")
    j = got.join(expect, "id")
    bad = j.filter(~F.col("prev_v").eqNullSafe(F.col("e_prev"))
                   | ~F.col("next_t").eqNullSafe(F.col("e_next"))
                   | (F.col("rn") != F.col("e_rn")) | (F.col("s") != F.col("e_sum")))
    assert j.count() == df.count()
    assert bad.count() == 0


def test_range_window_matches_plain(spark):
    df = _frame(spark).withColumn("us", epoch_micros("t"))
    width = 6 * 3600 * 1_000_000
    plain = Window.partitionBy("k").orderBy("us").rangeBetween(-width, 0)
    expect = df.select("id", F.count(F.lit(1)).over(plain).alias("e_n"),
                       F.size(F.collect_set("v").over(plain)).alias("e_d"))
    got = W.range_window(df, "k", "us", width, 86400 * 1_000_000,
                         {"n": lambda s: F.count(F.lit(1)).over(s),
                          "d": lambda s: F.size(F.collect_set("v").over(s))})
    j = got.join(expect, "id")
    assert j.count() == df.count()
    assert j.filter((F.col("n") != F.col("e_n")) | (F.col("d") != F.col("e_d"))).count() == 0


def test_as_of_matches_range_join(spark):
    left = _frame(spark, 1500, seed=1).select("id", "k", "t")
    right = (_frame(spark, 800, seed=2)
             .select(F.col("id").alias("rid"), "k", F.col("t").alias("rt"), "v"))
    got = W.as_of(left, right, "k", "t", "rt", ["rt", "rid"], ["rid", "v"], F.to_date)
    w = Window.partitionBy("id").orderBy(F.col("rt").desc(), F.col("rid").desc())
    expect = (left.join(right, (left.k == right.k) & (right.rt <= left.t), "left")
                  .withColumn("rn", F.row_number().over(w)).filter("rn = 1")
                  .select("id", F.col("rid").alias("e_rid")))
    j = got.join(expect, "id")
    assert j.count() == left.count()
    assert j.filter(~F.col("rid").eqNullSafe(F.col("e_rid"))).count() == 0


def test_islands_match_two_pass(spark):
    df = _frame(spark)
    order = ["t", "id"]
    b = F.to_date("t")

    def breaks(p):
        gap = F.timestamp_diff("SECOND", F.col(p + "t"), F.col("t"))
        return F.col(p + "t").isNull() | (gap > 3600) | (F.col("v") > F.col(p + "v"))

    one = W.with_islands(df, "k", order, ["t", "v"], b, breaks, "isl")
    two = W.with_prev(df, "k", order, ["t", "v"], b)
    two = two.withColumn("__b", F.when(breaks("prev_"), 1).otherwise(0))
    two = W.with_running_sum(two, "k", order, "__b", b, "e_isl").select("id", "e_isl")
    j = one.join(two, "id")
    assert j.count() == df.count()
    assert j.filter(F.col("isl") != F.col("e_isl")).count() == 0


def test_hot_key_is_spread_over_tasks(spark):
    """A key holding 40 % of the rows lands in many shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _frame(spark, 6000, seed=3)
        out = W.with_next(df, "k", ["t", "id"], ["t"], F.to_date("t"))
        parts = (out.filter(F.col("k") == 0).select(F.spark_partition_id().alias("p"))
                    .distinct().count())
        assert parts >= 4
        us = epoch_micros("t")
        rng = W.range_window(df.withColumn("us", us), "k", "us", 3600 * 1_000_000,
                             86400 * 1_000_000, {"n": lambda s: F.count(F.lit(1)).over(s)})
        parts = (rng.filter(F.col("k") == 0).select(F.spark_partition_id().alias("p"))
                    .distinct().count())
        assert parts >= 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_sum_carries_over_null_buckets(spark):
    d = spark.createDataFrame([(1, 1, 5), (1, 2, None), (1, 3, 2), (2, 1, None)], "k int, t int, v int")
    got = W.with_running_sum(d, ["k"], ["t"], "v", F.col("t"), "s")
    assert {(r.k, r.t): r.s for r in got.collect()} == {(1, 1): 5, (1, 2): 5, (1, 3): 7, (2, 1): None}
