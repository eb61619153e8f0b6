"""Table store: full refresh, append, partition-scoped upsert, writers at the same time."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vaultline.sinks.tables import TableStore, materialize


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id long, m int, v string")


def test_overwrite_versions_and_self_read(spark, scratch):
    store = TableStore(spark, scratch)
    store.overwrite("t", _rows(spark, [(1, 1, "a"), (2, 1, "b")]))
    v1 = store.current_version("t")
    # a refresh computed from the table itself never destroys its input
    store.overwrite("t", store.read("t").withColumn("v", F.upper("v")))
    assert store.current_version("t") != v1
    assert sorted(r.v for r in store.read("t").collect()) == ["A", "B"]
    # the previous version is untouched on disk
    assert os.path.exists(store.location("t", v1))


def test_append_and_empty_partitioned(spark, scratch):
    store = TableStore(spark, scratch)
    empty = _rows(spark, [(1, 1, "a")]).filter(F.lit(False))
    store.overwrite("e", empty, partition_by="m")
    assert store.read("e").count() == 0
    store.append("e", _rows(spark, [(1, 1, "a")]), partition_by="m")
    store.append("e", _rows(spark, [(2, 2, "b")]), partition_by="m")
    assert store.read("e").count() == 2


def test_partitioned_upsert_touches_only_needed_partitions(spark, scratch):
    store = TableStore(spark, scratch)
    store.overwrite("u", _rows(spark, [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]), partition_by="m")
    loc = store.location("u")
    untouched = sorted(os.listdir(os.path.join(loc, "m=3")))
    store.upsert("u", _rows(spark, [(2, 2, "B"), (4, 1, "d")]), "id", partition_by="m")
    got = {r.id: (r.m, r.v) for r in store.read("u").collect()}
    assert got == {1: (1, "a"), 2: (2, "B"), 3: (3, "c"), 4: (1, "d")}
    assert sorted(os.listdir(os.path.join(loc, "m=3"))) == untouched


def test_unpartitioned_upsert_and_materialize(spark, scratch):
    store = TableStore(spark, scratch)
    df = _rows(spark, [(1, 1, "a")])
    materialize(df, "x", "incremental", store, keys="id")
    out = materialize(_rows(spark, [(1, 1, "z"), (2, 1, "b")]), "x", "incremental", store,
                      keys="id")
    assert {r.id: r.v for r in out.collect()} == {1: "z", 2: "b"}
    view = materialize(df, "x_view", "view")
    assert spark.table("x_view").count() == view.count() == 1


def test_read_between_prunes_partitions(spark, scratch):
    store = TableStore(spark, scratch)
    rows = [(i, dt.datetime(2024, 1 + i % 3, 10)) for i in range(30)]
    df = spark.createDataFrame(rows, "txn_id long, txn_ts timestamp_ntz") \
        .withColumn("txn_month", (F.year("txn_ts") * 100 + F.month("txn_ts")).cast("int"))
    store.overwrite("f", df, partition_by="txn_month", sort_by="txn_id")
    sel = store.read_between("f", "txn_ts", "2024-02-01 00:00:00", "2024-03-01 00:00:00")
    assert sel.count() == 10
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "txn_month" in plan


def test_only_the_previous_version_is_kept(spark, scratch):
    store = TableStore(spark, scratch)
    for i in range(4):
        store.overwrite("h", _rows(spark, [(i, 1, "a")]))
    assert [r.id for r in store.read("h").collect()] == [3]
    assert len([f for f in os.listdir(os.path.join(scratch, "h")) if f.startswith("v=")]) == 2
    assert store.state("h") == 3 and store.state("none") is None


def test_append_of_a_second_store_is_kept(spark, scratch):
    a, b = TableStore(spark, scratch), TableStore(spark, scratch)
    a.overwrite("t", _rows(spark, [(1, 1, "a")]))
    assert a.read("t").count() == 1
    b.upsert("t", _rows(spark, [(2, 1, "b")]), "id")
    a.append("t", _rows(spark, [(3, 1, "c")]))
    assert sorted(r.id for r in b.read("t").collect()) == [1, 2, 3]


def test_upsert_sees_an_append_made_meanwhile(spark, scratch, monkeypatch):
    a, b = TableStore(spark, scratch), TableStore(spark, scratch)
    a.overwrite("t", _rows(spark, [(1, 1, "a")]))
    write, once = TableStore._write, []

    def slow(self, df, *args):
        write(self, df, *args)
        if self is a and not once:
            once.append(1)
            b.append("t", _rows(spark, [(3, 1, "c")]))
    monkeypatch.setattr(TableStore, "_write", slow)
    a.upsert("t", _rows(spark, [(2, 1, "b")]), "id")
    assert sorted(r.id for r in b.read("t").collect()) == [1, 2, 3]


def test_append_into_a_replaced_table_fails(spark, scratch, monkeypatch):
    a, b = TableStore(spark, scratch), TableStore(spark, scratch)
    a.overwrite("t", _rows(spark, [(1, 1, "a")]))
    write, once = TableStore._write, []

    def slow(self, df, *args):
        write(self, df, *args)
        if self is a and not once:
            once.append(1)
            b.overwrite("t", _rows(spark, [(9, 1, "z")]))
    monkeypatch.setattr(TableStore, "_write", slow)
    with pytest.raises(RuntimeError, match="replaced"):
        a.append("t", _rows(spark, [(3, 1, "c")]))


def test_unfinished_replacement_is_read_and_finished(spark, scratch, monkeypatch):
    store = TableStore(spark, scratch)
    store.overwrite("c", _rows(spark, [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]), partition_by="m")
    with monkeypatch.context() as m:
        m.setattr(TableStore, "_settled", TableStore._pointer)     # ends before the months are put in place
        store.upsert("c", _rows(spark, [(1, 2, "A")]), "id", partition_by="m")
    want = {1: 2, 2: 2, 3: 3}
    other = TableStore(spark, scratch)
    assert {r.id: r.m for r in other.read("c").collect()} == want
    other.append("c", _rows(spark, [(4, 1, "d")]), partition_by="m")
    assert {r.id: r.m for r in store.read("c").collect()} == {**want, 4: 1} and store.read("c").count() == 4


def test_many_upserts_rewrite_their_month_only(spark, scratch):
    store = TableStore(spark, scratch)
    store.overwrite("c", _rows(spark, [(1, 1, "a"), (2, 2, "b")]), partition_by="m")
    month = os.path.join(store.location("c"), "m=1")
    before = sorted(os.listdir(month))
    for i in range(20):
        store.upsert("c", _rows(spark, [(2, 2, f"v{i}")]), "id", partition_by="m")
    assert {r.id: r.v for r in store.read("c").collect()} == {1: "a", 2: "v19"}
    assert sorted(os.listdir(month)) == before
    assert len(os.listdir(os.path.join(scratch, "c"))) == 2        # the table and the last replacement


def test_partitioned_upsert_moves_empties_and_null_partitions(spark, scratch):
    store = TableStore(spark, scratch)
    store.overwrite("p", _rows(spark, [(1, 1, "a"), (2, 2, "b"), (5, None, "n")]), partition_by="m")
    # key 1 moves and leaves month 1 empty; key 3 joins the NULL month
    store.upsert("p", _rows(spark, [(1, 2, "A"), (3, None, "c")]), "id", partition_by="m")
    got = {r.id: (r.m, r.v) for r in store.read("p").collect()}
    assert got == {1: (2, "A"), 2: (2, "b"), 3: (None, "c"), 5: (None, "n")}
    assert store.read("p").count() == 4
    store.append("p", _rows(spark, [(9, 1, "z")]), partition_by="m")
    assert store.read("p").count() == 5


def test_two_writers_keep_both_rows(spark, scratch):
    a, b = TableStore(spark, scratch), TableStore(spark, scratch)
    a.overwrite("w", _rows(spark, [(1, 1, "a")]))
    assert b.read("w").count() == 1
    a.upsert("w", _rows(spark, [(2, 1, "b")]), "id")
    b.upsert("w", _rows(spark, [(3, 1, "c")]), "id")
    assert sorted(r.id for r in TableStore(spark, scratch).read("w").collect()) == [1, 2, 3]


@pytest.mark.parametrize("sort_by", [None, "id"])
def test_partitioned_write_runs_once_and_bounds_files(spark, scratch, sort_by):
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    df = spark.range(12_000, numPartitions=16).select("id", (F.col("id") % 12).alias("m"))
    store = TableStore(spark, scratch)
    store.overwrite("b", df.mapInArrow(count, df.schema), partition_by="m", sort_by=sort_by)
    assert rows.value == 12_000                      # no second run to sample ranges
    files = [f for _, _, names in os.walk(store.location("b")) for f in names if f.endswith(".parquet")]
    assert len(files) == 12
    assert store.read("b").count() == 12_000


@pytest.mark.parametrize("partition_by", [None, "txn_month"])
def test_clustered_files_are_skipped_by_either_key(spark, scratch, partition_by):
    """Of 64 files, a read of one card, or of one day, opens few."""
    import pyarrow.parquet as pq
    d = spark.range(64_000, numPartitions=7).select(
        "id", (F.col("id") * 7919 % 1000).cast("long").alias("card_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, (id * 104729) % 86400)").alias("txn_ts"),
        F.lit(202401).alias("txn_month"))
    d = d.withColumn("card_id", F.when(F.col("id") % 1000 != 0, F.col("card_id")))
    store = TableStore(spark, scratch)
    store.overwrite("c", d, partition_by=partition_by, cluster_by=["card_id", "txn_ts"], rows_per_file=1000)
    assert store.read("c").count() == 64_000 and store.read("c").distinct().count() == 64_000
    files = [os.path.join(p, f) for p, _, names in os.walk(store.location("c")) for f in names if f.endswith(".parquet")]
    assert 32 <= len(files) <= 80

    def opened(column, value):
        n = 0
        for f in files:
            meta = pq.ParquetFile(f).metadata
            i = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == column)
            stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
            n += any(s.min <= value <= s.max for s in stats if s is not None and s.has_min_max)
        return n
    for card in (5, 500, 998):
        assert opened("card_id", card) <= len(files) / 4
    assert opened("txn_ts", dt.datetime(2024, 1, 1, 12, 34)) <= len(files) / 4
    assert not [f for f in os.listdir(os.path.join(scratch, "c")) if f.startswith("stage=")]


def test_clustering_of_empty_and_null_keys(spark, scratch):
    store = TableStore(spark, scratch)
    rows = _rows(spark, [(1, None, "a"), (2, None, "b")])
    store.overwrite("n", rows, cluster_by=["m"])
    assert store.read("n").count() == 2
    store.overwrite("n", rows.limit(0), cluster_by=["m", "id"])
    assert store.read("n").count() == 0


def test_upsert_deals_its_keys_and_computes_its_batch_once(spark, scratch, monkeypatch):
    """The keys of a large batch are dealt to tasks by their number, those of a
    small one are broadcast; both give the same rows, and the batch runs once."""
    from vaultline.operators import incremental as inc
    from vaultline.sinks import tables
    rows = spark.range(300).selectExpr("if(id % 50 = 0, null, id) as k", "id as v", "cast(id % 3 as string) as m")
    seen = spark.sparkContext.accumulator(0)

    def counted(parts):
        for p in parts:
            seen.add(len(p))
            yield p
    changes = spark.range(250, 400).selectExpr("if(id % 50 = 0, null, id) as k", "-id as v", "cast(id % 4 as string) as m")
    expect = sorted(map(str, inc.upsert(rows, changes, "k").collect()))
    for few in (0, 1000):
        monkeypatch.setattr(tables, "FEW_KEYS", few)
        monkeypatch.setattr(tables, "ROWS_PER_TASK", 40)
        for by in (None, "m"):
            store = TableStore(spark, os.path.join(scratch, f"dealt{few}{by}"))
            store.overwrite("t", rows, partition_by=by)
            seen.value = 0
            store.upsert("t", changes.mapInPandas(counted, changes.schema), "k", partition_by=by)
            assert seen.value == 150
            assert sorted(map(str, store.read("t").select("k", "v", "m").collect())) == expect
            assert not [f for f in os.listdir(os.path.join(scratch, f"dealt{few}{by}", "t")) if f.startswith("stage=")]
    plan = inc.with_keys(rows, changes, "k", "left_anti", 12)._jdf.queryExecution().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2
