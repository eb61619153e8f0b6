"""Radix selection, footer watermarks, offset ranges of a stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from vaultline.operators import incremental as inc, intervals, monitoring, relational
from vaultline.streaming import landing


@pytest.mark.parametrize("k", [0, 1, 37, 999, 1200, 2999, 3000, 4000])
def test_smallest_equals_the_sorted_rows(spark, monkeypatch, k):
    monkeypatch.setattr(relational, "FAN", 8)
    monkeypatch.setattr(relational, "LEAF", 20)
    rnd = random.Random(k)
    rows = [(rnd.choice([rnd.randrange(-10 ** 12, 10 ** 12), rnd.randrange(50), 7]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "v long, i long").repartition(5)
    got = relational.smallest(df, k, F.col("v"), ["v", "i"]).collect()
    assert sorted(map(tuple, got)) == sorted(rows)[:k]


def test_rows_without_a_value_come_first(spark):
    df = spark.createDataFrame([(None, 1), (5, 2), (3, 3), (None, 4)], "v long, i long")
    assert sorted(r.i for r in relational.smallest(df, 3, F.col("v"), ["v", "i"]).collect()) == [1, 3, 4]


@pytest.mark.parametrize("k", [25, 60_000])
def test_sample_of_any_size(spark, k):
    df = spark.range(150_000).select(F.col("id").alias("txn_id"))
    out = relational.sample_k(df, k, 42, "txn_id")
    want = df.withColumn("h", F.md5(F.concat_ws("|", F.col("txn_id").cast("string"), F.lit("42")))).orderBy("h").limit(k)
    assert sorted(r.txn_id for r in out.collect()) == sorted(r.txn_id for r in want.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("TakeOrderedAndProject" in plan) == (k == 25)
    first = relational.first_n(df, k, ["txn_id"])
    assert first.agg(F.max("txn_id"), F.count("*")).first()[:] == (k - 1, k)


def test_watermark_from_footers(spark, scratch):
    df = spark.range(1000).select("id", (F.col("id") % 4).cast("int").alias("m"), F.col("id").cast("string").alias("s"))
    df.write.partitionBy("m").parquet(f"{scratch}/t")

    def plan(w):
        return w._jdf.queryExecution().executedPlan().toString()
    w = inc.footer_watermark(spark, f"{scratch}/t", "id", 0, "wm")
    assert w.first()["wm"] == 999 and "PushedAggregation: [MAX(id)]" in plan(w)
    part = inc.footer_watermark(spark, f"{scratch}/t", "id", 0, "wm", where=F.col("m") == 2)
    assert part.first()["wm"] == 998 and "PushedAggregation: [MAX(id)]" in plan(part)
    some = inc.footer_watermark(spark, f"{scratch}/t", "id", 0, "wm", where=F.col("s") < "5")
    assert some.first()["wm"] == 499 and "PushedAggregation: [MAX(id)]" not in plan(some)
    assert inc.footer_watermark(spark, f"{scratch}/t", "id", 0, where=F.col("m") == 9).first()[0] == 0
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""          # the caller's session is as before


def test_coverage_and_holes(spark):
    rnd = random.Random(2)
    rows = [(g, rnd.randrange(40)) for g in ("a", "b") for _ in range(50)] + [("a", None), ("c", 5)]
    df = spark.createDataFrame(rows, "g string, i long")
    got = {(r.g, i): r.times for r in intervals.id_coverage(df, "i", ["g"]).collect() for i in range(r.lo, r.hi + 1)}
    want = {}
    for g, i in rows:
        if i is not None:
            want[g, i] = want.get((g, i), 0) + 1
    assert got == want
    holes = {(r.g, i) for r in intervals.holes(intervals.merge(df, "i", by=["g"]), ["g"]).collect() for i in range(r.lo, r.hi + 1)}
    for g in ("a", "b"):
        held = {i for h, i in want if h == g}
        assert {i for h, i in holes if h == g} == set(range(min(held), max(held))) - held
    assert not [h for h in holes if h[0] == "c"]


def _records(spark, offsets, topic="x.card", partition=0):
    return spark.createDataFrame([(topic, partition, o, None, "{}") for o in offsets],
                                 "topic string, partition int, offset long, timestamp timestamp_ntz, value string")


def test_offsets_of_a_drained_stream(spark, scratch):
    """A gap between two batches, a replay over two, a replay inside one, and two topic partitions."""
    batches = [_records(spark, range(10)), _records(spark, [*range(15, 20), 8, 9]),
               _records(spark, [20, 20, 21]).union(_records(spark, [100, 101], partition=1))]
    src = os.path.join(scratch, "src")
    spark.createDataFrame([], batches[0].schema).write.json(src)
    ckpt, ctl = os.path.join(scratch, "ckpt"), os.path.join(scratch, landing.CTL_OFFSETS)
    for b in batches:
        b.coalesce(1).write.mode("append").json(src)
        landing.start_landing(landing.read_cdc_stream(spark, fmt="json", path=src), os.path.join(scratch, "c"), os.path.join(scratch, "t"),
                              ckpt, offsets_path=ctl).awaitTermination()
    ranges = spark.read.parquet(ctl)
    got = sorted((r.partition, r.kind, r.from_offset, r.to_offset, r.records) for r in monitoring.offset_breaks(ranges).collect())
    assert got == [(0, "gap", 10, 14, 5), (0, "replay", 8, 9, 2), (0, "replay", 20, 20, 1)]
    assert {(r.partition, r.last_offset) for r in monitoring.last_offsets(ranges).collect()} == {(0, 21), (1, 101)}
    end = monitoring.end_offsets(spark, {"sources": [{"latestOffset": '{"x.card": {"0": 30, "1": 102}}'}, {"endOffset": {"logOffset": 3}}]})
    lag = monitoring.kafka_lag(end, monitoring.committed_offsets(ranges))
    assert {(r.partition, r.lag) for r in lag.collect()} == {(0, 8), (1, 0)}
    metrics = {(r.metric, r.value) for r in monitoring.break_metrics(monitoring.offset_breaks(ranges)).collect()}
    assert metrics == {("cdc_offset_gap", 5.0), ("cdc_offset_replay", 3.0)}
    # a batch that runs again replaces its ranges
    landing.write_batch(batches[0], 0, os.path.join(scratch, "c"), os.path.join(scratch, "t"), offsets_path=ctl)
    assert sorted((r.partition, r.kind, r.from_offset) for r in monitoring.offset_breaks(spark.read.parquet(ctl)).collect()) == \
        [(0, "gap", 10), (0, "replay", 8), (0, "replay", 20)]
