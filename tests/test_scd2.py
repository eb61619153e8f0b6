"""SCD2 invariants, replays, ties, key-only deletes and point-in-time lookup."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from vaultline import bindings as B
from vaultline.operators import cdc, scd2

D = dt.datetime
LANDED = ("kafka_partition int, kafka_offset long, op string, card_id long, "
          "payload_before string, payload_after string, src_ts timestamp_ntz")


def _after(status, number="4444"):
    return json.dumps({"card_id": 1, "card_number": number, "account_id": 3, "status": status,
                       "opened_at": "2024-01-01T00:00:00Z", "is_deleted": False})


def _log(spark, rows):
    return spark.createDataFrame(rows, LANDED)


def test_invariants_on_test_data(spark, sf_dir):
    landed = cdc.land_cards(cdc.decode_envelope(B.cdc_records(spark, sf_dir)))
    dim = scd2.scd2_from_landing(landed)
    assert scd2.check_invariants(dim).count() == 0
    assert scd2.scd2_current(dim).count() == landed.select("card_id").distinct().count()


def test_replay_dedupe_and_tie_order(spark):
    t = D(2024, 1, 1, 10)
    rows = [(0, 5, "c", 1, "{}", _after("active"), t),
            (0, 6, "u", 1, "{}", _after("blocked"), t),              # tie on src_ts
            (0, 7, "d", 1, json.dumps({"card_id": 1}), "{}", D(2024, 1, 2))]
    log = _log(spark, rows + rows[:1])                               # replayed row
    dim = scd2.scd2_from_landing(log).orderBy("valid_from", "valid_to").collect()
    assert len(dim) == 3
    # offset 5 then 6 at the same instant: the first is zero-length
    assert dim[0].status == "active" and dim[0].valid_from == dim[0].valid_to
    assert dim[1].status == "blocked" and dim[1].valid_to == D(2024, 1, 2)
    assert dim[2].is_current == 1 and dim[2].is_deleted == 1 and dim[2].status is None
    parity = scd2.scd2_from_landing(log, dedupe=False)
    assert parity.count() == 4


def test_carry_forward_fills_key_only_delete(spark):
    rows = [(0, 1, "c", 1, "{}", _after("active", "9999"), D(2024, 1, 1)),
            (0, 2, "d", 1, json.dumps({"card_id": 1}), "{}", D(2024, 1, 3))]
    dim = scd2.scd2_from_landing(_log(spark, rows), carry_forward=True) \
        .orderBy("valid_from").collect()
    assert dim[1].card_number == "9999" and dim[1].status == "active"
    assert dim[1].is_deleted == 1


def test_as_of_picks_valid_version(spark):
    t = D(2024, 1, 1, 10)
    rows = [(0, 5, "c", 1, "{}", _after("active"), t),
            (0, 6, "u", 1, "{}", _after("blocked"), t),
            (0, 7, "u", 1, "{}", _after("closed"), D(2024, 1, 5))]
    dim = scd2.scd2_from_landing(_log(spark, rows))
    facts = spark.createDataFrame([(100, 1, D(2023, 12, 31)), (101, 1, t),
                                   (102, 1, D(2024, 1, 4, 23)), (103, 1, D(2024, 2, 1)),
                                   (104, 2, t)],
                                  "txn_id long, card_id long, txn_ts timestamp_ntz")
    got = {r.txn_id: r.status for r in scd2.as_of(facts, dim).collect()}
    assert got == {100: None, 101: "blocked", 102: "blocked", 103: "closed", 104: None}


def test_incremental_equals_full_with_late_rows(spark):
    t0 = D(2024, 1, 1)
    rows = [(0, i, "u", k, "{}", _after(f"s{i}"), t0 + dt.timedelta(hours=i * (k + 1)))
            for k in range(3) for i in range(5)]
    old = _log(spark, rows)
    dim = scd2.scd2_from_landing(old)
    # new rows: one late change for card 0 (inside its history), one new card
    new = _log(spark, [(0, 100, "u", 0, "{}", _after("late"), t0 + dt.timedelta(minutes=30)),
                       (1, 101, "c", 9, "{}", _after("new"), t0 + dt.timedelta(days=3))])
    full = scd2.scd2_from_landing(old.unionByName(new))
    inc = scd2.scd2_incremental(dim, old.unionByName(new), new)
    cols = [c for c in full.columns if c != "loaded_at"]
    assert sorted(map(tuple, inc.select(cols).collect())) == \
        sorted(map(tuple, full.select(cols).collect()))


def test_invariant_check_reports_gaps_and_double_current(spark):
    t = D(2024, 1, 1)
    bad = spark.createDataFrame([
        ("a", 1, t, D(2024, 1, 2), 0),
        ("b", 1, D(2024, 1, 3), D(2999, 12, 31), 1),      # gap between Jan 2 and Jan 3
        ("c", 2, t, D(2999, 12, 31), 1),
        ("d", 2, D(2024, 1, 5), D(2999, 12, 31), 1),      # two current versions, overlap
    ], "card_sk string, card_id long, valid_from timestamp_ntz, valid_to timestamp_ntz, "
       "is_current int")
    got = {(r.card_id, r.violation) for r in scd2.check_invariants(bad).collect()}
    assert (1, "gap_or_overlap") in got
    assert (2, "current_count") in got


def test_as_of_equals_range_join(spark):
    """Versions over many months and many versions of one key in one month,
    facts at, between, before and after them, beyond the horizon, NULLs."""
    rnd = random.Random(5)
    rows, offset = [], 0
    for card, span, n in ((1, 900, 40), (2, 20, 300), (3, 1, 5), (4, 400, 2)):
        for _ in range(n):
            offset += 1
            rows.append((offset % 3, offset, "u", card, "{}", _after(f"s{offset}"),
                         D(2023, 1, 1) + dt.timedelta(hours=rnd.randrange(span * 24))))
    rows.append((0, 9000, "u", 4, "{}", _after("first of a month"), D(2023, 6, 1)))
    dim = scd2.scd2_from_landing(_log(spark, rows)).cache()
    starts = [r.valid_from for r in dim.collect()]
    facts = [(i, rnd.randrange(1, 6), rnd.choice(starts) + dt.timedelta(seconds=rnd.choice([0, 0, -1, 1, 86400 * 40]))) for i in range(800)]
    facts += [(900, 1, D(2022, 1, 1)), (901, 4, D(2023, 6, 1)), (902, 1, D(2060, 1, 1)), (903, None, D(2024, 1, 1)), (904, 1, None)]
    f = spark.createDataFrame(facts, "txn_id long, card_id long, txn_ts timestamp_ntz")
    d = dim.select(F.col("card_id").alias("k"), "valid_from", "valid_to", "card_sk")
    want = {r.txn_id: r.card_sk for r in f.join(d, (f.card_id == d.k) & (d.valid_from <= f.txn_ts) & (f.txn_ts < d.valid_to), "left").collect()}
    for kw in ({}, {"horizon": "2023-03-01 00:00:00"}, {"unit": "day"}):
        out = scd2.as_of(f, dim, cols=("card_sk",), **kw)
        got = {r.txn_id: r.card_sk for r in out.collect()}
        assert got == want and out.count() == len(facts)
    bare = spark.createDataFrame(dim.limit(9).collect(), dim.schema)
    plan = scd2.as_of(f, bare, cols=("card_sk",))._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.find("Initial Plan")]
    assert plan.count("Exchange") == 1 and "Join" not in plan and plan.count("Scan") <= 2
