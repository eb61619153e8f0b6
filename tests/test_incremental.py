"""Watermarks, delta, upsert and latest-wins (traps T1-T4)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from vaultline.operators import incremental as inc, intervals
from vaultline.sources.extract import extract_incremental


def _t(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, updated_at timestamp_ntz")


D = dt.datetime


def test_empty_target_selects_everything(spark):
    src = _t(spark, [(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 2))])
    empty = src.filter(F.lit(False))
    assert inc.delta(src, empty, "updated_at").count() == 2
    assert inc.high_watermark(empty, "id", 0).first()[0] == 0


def test_strict_and_inclusive_cursor(spark):
    src = _t(spark, [(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 2)), (3, "c", D(2024, 1, 2)),
                     (4, "d", None)])
    target = src.filter(F.col("id") == 2)
    strict = {r.id for r in inc.delta(src, target, "updated_at").collect()}
    assert strict == {4}                       # equal cursor lost, NULL cursor kept
    incl = {r.id for r in inc.delta(src, target, "updated_at", inclusive=True).collect()}
    assert incl == {2, 3, 4}


def test_lookback_catches_late_ids(spark):
    src = spark.createDataFrame([(i,) for i in range(1, 11)], "txn_id long")
    assert extract_incremental(src, "txn_id", 8).count() == 2
    assert extract_incremental(src, "txn_id", 8, lookback=3).count() == 5
    assert extract_incremental(src, "txn_id", None).count() == 10


def test_upsert_replaces_and_dedupes(spark):
    target = _t(spark, [(1, "old", D(2024, 1, 1)), (2, "keep", D(2024, 1, 1))])
    batch = _t(spark, [(1, "new1", D(2024, 1, 2)), (1, "new2", D(2024, 1, 3)),
                       (3, "add", D(2024, 1, 2))])
    out = {r.id: r.v for r in inc.upsert(target, batch, "id", order=["updated_at"]).collect()}
    assert out == {1: "new2", 2: "keep", 3: "add"}


def test_latest_per_key_tiebreak(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 5, "a"), (1, D(2024, 1, 1), 9, "b"),
                                (2, D(2024, 1, 1), 1, "c")],
                               "k long, ts timestamp_ntz, off long, v string")
    out = {r.k: r.v for r in inc.latest_per_key(df, "k", ["ts", "off"]).collect()}
    assert out == {1: "b", 2: "c"}


def test_read_watermark_ties_and_default(spark):
    ctl = spark.createDataFrame([("p", "transaction", 5, D(2024, 1, 1)),
                                 ("p", "transaction", 7, D(2024, 1, 1)),
                                 ("p", "transaction", 3, D(2023, 1, 1)),
                                 ("q", "transaction", 99, D(2025, 1, 1))],
                                "process_name string, src_table string, last_id long, "
                                "updated_at timestamp_ntz")
    assert inc.read_watermark_value(ctl, "p", "transaction") == 7
    assert inc.read_watermark_value(ctl, "p", "card", 0) == 0
    assert inc.read_watermark_value(ctl, "p", "card", None) is None


def _runs(df):
    return sorted((r.lo, r.hi) for r in df.collect())


def test_runs_of_ids(spark):
    rnd = random.Random(4)
    big = intervals.BUCKET
    for ids in ([], [5], [1, 2, 3, 7, 8, 2, 2], [big - 1, big, big + 1, 3 * big], [rnd.randrange(300) for _ in range(150)], [None, -3, -2, 0]):
        df = spark.createDataFrame([(i,) for i in ids], "txn_id long")
        want, known = [], sorted({i for i in ids if i is not None})
        for i in known:
            if want and want[-1][1] == i - 1:
                want[-1] = (want[-1][0], i)
            else:
                want.append((i, i))
        runs = intervals.merge(df, "txn_id")
        assert _runs(runs) == want
        more = spark.createDataFrame([(4,), (6,), (2,)], "txn_id long")
        again = intervals.merge(more, "txn_id", runs)
        assert _runs(again) == _runs(intervals.merge(df.union(more), "txn_id"))


def test_unloaded_finds_late_ids(spark):
    src = spark.range(1, 11).withColumnRenamed("id", "txn_id")
    target = src.filter("txn_id in (1, 2, 4, 6, 8)")
    runs = intervals.merge(target, "txn_id")
    got = lambda **kw: sorted(r.txn_id for r in intervals.unloaded(src, runs, "txn_id", target, **kw).collect())
    assert got() == got(widest=1) == got(widest=2) == [3, 5, 7, 9, 10]
    assert got(lookback=3) == [7, 9, 10]
    assert got(lookback=0) == [9, 10]
    assert intervals.unloaded(src, runs.limit(0), "txn_id", target.limit(0)).count() == 10


def test_unloaded_ids_are_asked_by_pushed_ranges(spark, scratch):
    spark.range(1, 1001).withColumnRenamed("id", "txn_id").withColumn("v", F.lit("x")).write.parquet(f"{scratch}/src")
    src = spark.read.parquet(f"{scratch}/src")
    target = src.filter("txn_id <= 900 and txn_id != 77")
    out = intervals.unloaded(src, intervals.merge(target, "txn_id"), "txn_id", target)
    assert sorted(r.txn_id for r in out.collect()) == [77, *range(901, 1001)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "LessThan(txn_id,78)" in pushed and "GreaterThan(txn_id,900)" in pushed
    assert "Join" not in plan and "Exchange" not in plan and plan.count("FileScan") == 1


def test_unloaded_looks_up_many_runs_without_a_shuffle(spark, scratch, monkeypatch):
    """More runs than a predicate names: the others are looked up where the rows
    are; with too many blocks of runs the loaded ids decide. Same rows."""
    path = f"{scratch}/many"
    spark.range(300_000).selectExpr("if(id % 1000 = 7, null, id) as txn_id", "id as v").write.parquet(path)
    src = spark.read.parquet(path)
    target = src.filter("txn_id % 3000 < 2900 and txn_id < 290000 or txn_id in (299000, 299002)")
    runs = spark.createDataFrame([tuple(r) for r in intervals.merge(target, "txn_id").collect()], "lo long, hi long")
    expect = sorted(r.txn_id for r in src.filter("txn_id is not null").join(target, "txn_id", "left_anti").collect())
    for widest in (1, intervals.WIDEST):
        out = intervals.unloaded(src, runs, "txn_id", target, widest=widest)
        assert sorted(r.txn_id for r in out.collect()) == expect
        plan = out._jdf.queryExecution().executedPlan().toString()
        # the final and the initial plan each read the source only, not the loaded rows
        assert plan.count("FileScan") == 2 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    monkeypatch.setattr(intervals, "MOST_BLOCKS", 0)
    out = intervals.unloaded(src, runs, "txn_id", target)
    assert sorted(r.txn_id for r in out.collect()) == expect
