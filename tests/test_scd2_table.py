"""The stored SCD2: batches in any order equal the full build, with work that does not grow with the history."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from vaultline.operators import scd2
from vaultline.sinks import scd2_table
from vaultline.sinks.tables import TableStore

D = dt.datetime(2024, 1, 1)
SCHEMA = ("card_id long, card_number string, account_id long, status string, opened_at timestamp_ntz, "
          "closed_at timestamp_ntz, is_deleted int, src_ts timestamp_ntz, kafka_partition int, kafka_offset long")


def _row(card, minutes, offset, status="s"):
    return (card, str(card), card * 3, f"{status}{offset}", None, None, 0, D + dt.timedelta(minutes=minutes), offset % 3, offset)


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted(map(str, df.drop("loaded_at").select(sorted(c for c in df.columns if c != "loaded_at")).collect()))


def _full(spark, rows):
    return scd2.scd2(_frame(spark, sorted(set(rows))), dedupe_by=["kafka_partition", "kafka_offset"])


def test_batches_in_any_order_equal_the_full_build(spark, scratch):
    rnd, offset, rows = random.Random(3), 0, []
    for card in range(12):
        for _ in range(rnd.randrange(1, 9)):
            offset += 1
            rows.append(_row(card, rnd.randrange(6) * 700, offset))          # ties included
    rnd.shuffle(rows)
    store = TableStore(spark, scratch)
    seen = []
    for b in range(4):
        batch = rows[b::4] + rows[:2]                                        # two rows come in every batch
        seen += batch
        scd2_table.apply_batch(store, "d", _frame(spark, batch), b, buckets=4)
        got = scd2_table.read_dimension(store, "d")
        assert _rows(got) == _rows(_full(spark, seen))
        assert _rows(scd2_table.read_current(store, "d")) == _rows(got.filter("is_current = 1"))
    scd2_table.apply_batch(store, "d", _frame(spark, []), 9, buckets=4)
    assert _rows(scd2_table.read_dimension(store, "d")) == _rows(_full(spark, seen))


def test_a_batch_may_be_applied_again(spark, scratch, monkeypatch):
    store = TableStore(spark, scratch)
    first = [_row(c, i * 60, c * 100 + i) for c in range(3) for i in range(4)]
    second = [_row(0, 30, 900, "late"), _row(1, 9000, 901), _row(7, 5, 902)]
    scd2_table.apply_batch(store, "d", _frame(spark, first), 0, buckets=4)
    replace = TableStore.replace

    def ends_after_closed(self, name, *args, **kw):
        if name == "d_open":
            raise KeyboardInterrupt
        replace(self, name, *args, **kw)
    with monkeypatch.context() as m:
        m.setattr(TableStore, "replace", ends_after_closed)
        with pytest.raises(KeyboardInterrupt):
            scd2_table.apply_batch(store, "d", _frame(spark, second), 1, buckets=4)
    for _ in range(2):
        scd2_table.apply_batch(store, "d", _frame(spark, second), 1, buckets=4)
        assert _rows(scd2_table.read_dimension(store, "d")) == _rows(_full(spark, first + second))


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("history", [5, 200])
def test_work_of_a_batch_does_not_grow_with_the_history(spark, scratch, history):
    """One batch of two cards: the closed versions written before stay as they
    are, the new partition holds the two versions that end, and only the open
    buckets of the two cards are written."""
    store = TableStore(spark, scratch)
    cards = 40
    scd2_table.apply_batch(store, "d", _frame(spark, [_row(c, i, c * 1000 + i) for c in range(cards) for i in range(history)]), 0,
                           buckets=16)
    closed, opened = (store.location(f"d_{t}") for t in ("closed", "open"))
    before = _files(closed)
    open_before = _files(opened)
    scd2_table.apply_batch(store, "d", _frame(spark, [_row(3, 10_000, 1), _row(4, 10_000, 2)]), 1, buckets=16)
    new = _files(closed) - before
    assert before <= _files(closed) and {os.path.basename(os.path.dirname(f)) for f in new} == {"batch_id=1"}
    assert spark.read.parquet(*new).count() == 2
    buckets = {os.path.basename(os.path.dirname(f)) for f in _files(opened) - open_before}
    want = spark.createDataFrame([(3,), (4,)], "card_id long").select(scd2_table._bucket("card_id", 16).alias("b"))
    assert buckets == {f"key_bucket={r.b}" for r in want.collect()}
    assert store.read("d_merged").count() == 4                   # two cards, two versions each: no history


def test_a_late_row_rewrites_the_batch_it_splits_only(spark, scratch):
    store = TableStore(spark, scratch)
    for b in range(4):
        scd2_table.apply_batch(store, "d", _frame(spark, [_row(c, b * 100, b * 10 + c) for c in range(5)]), b, buckets=4)
    closed = store.location("d_closed")
    before = _files(closed)
    late = [_row(2, 150, 77, "late")]                            # inside the version that batch 2 ended
    scd2_table.apply_batch(store, "d", _frame(spark, late), 4, buckets=4)
    gone = {os.path.basename(os.path.dirname(f)) for f in before - _files(closed)}
    assert gone == {"batch_id=2"}
    every = [_row(c, b * 100, b * 10 + c) for b in range(4) for c in range(5)] + late
    assert _rows(scd2_table.read_dimension(store, "d")) == _rows(_full(spark, every))
    assert store.read("d_closed").filter(F.col("card_id") == 2).count() == 4
