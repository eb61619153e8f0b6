"""Property test: the bucketed helpers equal plain windows on generated frames
(random keys incl. NULL, tied and NULL times, several bucket widths)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from vaultline.functions import windows as W

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)),           # key (NULL allowed)
                st.one_of(st.none(), st.integers(0, 200)),         # time in hours (NULL allowed)
                st.integers(-5, 5))                                 # value


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(ROW, min_size=1, max_size=60), hours=st.sampled_from([1, 6, 24, 72]))
def test_lag_lead_runsum_equal_plain(spark, rows, hours):
    base = dt.datetime(2024, 1, 1)
    data = [(i, k, None if h is None else base + dt.timedelta(hours=h), v)
            for i, (k, h, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k long, t timestamp_ntz, v long")
    order = ["t", "id"]
    bucket = F.floor(F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"),
                                      F.col("t")) / hours)
    w = Window.partitionBy("k").orderBy(*order)
    expect = df.select("id", F.lag("v").over(w).alias("e_prev"),
                       F.lead("v").over(w).alias("e_next"),
                       F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("e_s"))
    got = W.with_prev(df, "k", order, ["v"], bucket)
    got = W.with_next(got, "k", order, ["v"], bucket)
    got = W.with_running_sum(got, "k", order, "v", bucket, "s")
    j = got.join(expect, "id")
    assert j.count() == len(rows)
    bad = j.filter(~F.col("prev_v").eqNullSafe(F.col("e_prev"))
                   | ~F.col("next_v").eqNullSafe(F.col("e_next"))
                   | ~F.col("s").eqNullSafe(F.col("e_s")))
    assert bad.count() == 0


@settings(max_examples=6, deadline=None)
@given(left=st.lists(ROW, min_size=1, max_size=40), right=st.lists(ROW, min_size=0, max_size=40))
def test_as_of_equals_latest_earlier_right_row(spark, left, right):
    base = dt.datetime(2024, 1, 1)

    def frame(rows, offset):
        return [(offset + i, k, None if h is None else base + dt.timedelta(hours=h), v)
                for i, (k, h, v) in enumerate(rows)]
    lf = spark.createDataFrame(frame(left, 0), "id long, k long, t timestamp_ntz, v long") \
        .select("id", "k", "t")
    rf = spark.createDataFrame(frame(right, 10_000), "rid long, k long, rt timestamp_ntz, v long")
    got = W.as_of(lf, rf, "k", "t", "rt", ["rt", "rid"], ["rid"], F.to_date)
    w = Window.partitionBy("id").orderBy(F.col("rt").desc(), F.col("rid").desc())
    expect = (lf.join(rf, (lf.k == rf.k) & (rf.rt <= lf.t), "left")
                .withColumn("rn", F.row_number().over(w)).filter("rn = 1")
                .select("id", F.col("rid").alias("e_rid")))
    j = got.join(expect, "id")
    assert j.count() == len(left)
    assert j.filter(~F.col("rid").eqNullSafe(F.col("e_rid"))).count() == 0


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(ROW, min_size=1, max_size=60), hours=st.sampled_from([1, 24]))
def test_islands_equal_plain(spark, rows, hours):
    base = dt.datetime(2024, 1, 1)
    data = [(i, k, None if h is None else base + dt.timedelta(hours=h), v)
            for i, (k, h, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k long, t timestamp_ntz, v long")
    order = ["t", "id"]
    bucket = F.floor(F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"),
                                      F.col("t")) / hours)

    def breaks(p):
        return (F.col(p + "t").isNull()
                | (F.timestamp_diff("HOUR", F.col(p + "t"), F.col("t")) > 3)
                | (F.col("v") > F.col(p + "v")))

    w = Window.partitionBy("k").orderBy(*order)
    plain = (df.withColumn("prev_t", F.lag("t").over(w)).withColumn("prev_v", F.lag("v").over(w))
               .withColumn("b", F.when(breaks("prev_"), 1).otherwise(0))
               .withColumn("e_isl", F.sum("b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
               .select("id", "e_isl"))
    got = W.with_islands(df, "k", order, ["t", "v"], bucket, breaks, "isl")
    j = got.join(plain, "id")
    assert j.count() == len(rows)
    assert j.filter(~F.col("isl").eqNullSafe(F.col("e_isl"))).count() == 0
