"""Lifecycle, fraud, quality and monitoring edge cases on literal frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from vaultline.operators import fraud, lifecycle, monitoring, quality, relational

D = dt.datetime
CARD = ("card_id long, card_number string, account_id long, status string, "
        "opened_at timestamp_ntz, closed_at timestamp_ntz, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, is_deleted boolean")
TXN = ("txn_id long, card_id long, terminal_id long, txn_ts timestamp_ntz, amount decimal(18,2), "
       "currency_code string, txn_type string, status string")


def _cards(spark):
    t = D(2024, 1, 1)
    return spark.createDataFrame([
        (1, "1", 10, "active", t, None, t, t, False),
        (2, "2", 10, "blocked", t, None, t, t, False),
        (3, "3", 20, "active", t, None, t, t, None),
        (4, "4", 30, "active", t, None, t, t, False)], CARD)


def test_close_accounts_cascades_to_active_cards_only(spark):
    acc = spark.createDataFrame([(10, "active", None, D(2024, 1, 1), False),
                                 (20, "active", None, D(2024, 1, 1), False),
                                 (30, "active", None, D(2024, 1, 1), False)],
                                "account_id long, status string, closed_at timestamp_ntz, "
                                "updated_at timestamp_ntz, is_deleted boolean")
    keys = spark.createDataFrame([(10,), (20,), (10,)], "account_id long")
    a, c = lifecycle.close_accounts(acc, _cards(spark), keys, ts="2024-02-01 00:00:00")
    assert {r.account_id: r.status for r in a.collect()} == {10: "closed", 20: "closed",
                                                            30: "active"}
    cards = {r.card_id: (r.status, r.closed_at) for r in c.collect()}
    assert cards[1] == ("closed", D(2024, 2, 1))
    assert cards[2] == ("blocked", None)           # blocked card keeps its state
    assert cards[3][0] == "closed"                 # NULL is_deleted counts as live
    assert cards[4] == ("active", None)


def test_block_keeps_closed_at_null(spark):
    out = lifecycle.block_cards(_cards(spark), spark.createDataFrame([(1,)], "card_id long"),
                                ts="2024-02-01 00:00:00")
    r = [x for x in out.collect() if x.card_id == 1][0]
    assert r.status == "blocked" and r.closed_at is None and r.updated_at == D(2024, 2, 1)


def test_amount_probe_repeats_at_floor(spark):
    base = D(2024, 1, 1, 12)
    rows = [(i, 1, 5, base + dt.timedelta(seconds=60 * i), Decimal(amt), "RUB", "atm_withdrawal",
             st)
            for i, (amt, st) in enumerate([(9000, "declined"), (3000, "declined"),
                                           (500, "declined"), (500, "approved")])]
    rows.append((9, 1, 5, base + dt.timedelta(hours=2), Decimal(100), "RUB", "atm_withdrawal",
                 "declined"))
    txn = spark.createDataFrame(rows, TXN)
    runs = fraud.amount_probe(txn).collect()
    assert len(runs) == 1
    r = runs[0]
    assert r.n_attempts == 4 and r.probing and float(r.last_amount) == 500.0


def test_rapid_withdrawals_minutes(spark):
    base = D(2024, 1, 1, 23, 50)       # crosses midnight (a bucket border)
    rows = [(i, 1, 1 + i % 2, base + dt.timedelta(minutes=3 * i), Decimal(5000), "RUB",
             "atm_withdrawal", "approved") for i in range(4)]
    rows.append((10, 1, 1, base + dt.timedelta(hours=3), Decimal(5000), "RUB", "atm_withdrawal",
                 "approved"))
    got = fraud.rapid_withdrawals(spark.createDataFrame(rows, TXN), window_s=15 * 60)
    assert sorted(r.txn_id for r in got.collect()) == [2, 3]


def test_lag_without_commit_and_negative(spark):
    end = spark.createDataFrame([("t", 0, 100), ("t", 1, 50), ("t", 2, 10)],
                                "topic string, partition int, end_offset long")
    com = spark.createDataFrame([("t", 0, 90), ("t", 2, 20)],
                                "topic string, partition int, committed_offset long")
    lag = {r.partition: r.lag for r in monitoring.kafka_lag(end, com).collect()}
    assert lag == {0: 10, 1: 50, 2: 0}
    m = monitoring.lag_metrics(monitoring.kafka_lag(end, com), "g", ts="2025-01-01 00:00:00")
    assert monitoring.assert_lag(m, 5000) == 60.0
    try:
        monitoring.assert_lag(m, 10)
        raise AssertionError("expected alert")
    except RuntimeError as e:
        assert "60" in str(e)


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "RUBX", None), (1, "USD", "x"), (2, None, "y")],
                               "id long, cur string, s string")
    assert quality.duplicate_keys(df, "id").collect()[0].n == 2
    nulls = {r.column_name: (r.null_count, r.violation)
             for r in quality.null_counts(df, "t", not_null=["cur"]).collect()}
    assert nulls == {"id": (0, False), "cur": (1, True), "s": (1, False)}
    lv = quality.length_violations(df, "t", {"cur": ("eq", 3)}).collect()[0]
    assert lv.n_violations == 1
    dv = quality.domain_violations(df, "t", "cur", ["USD", "RUB"]).collect()
    assert [(r.value, r.n) for r in dv] == [("RUBX", 1)]
    parent = spark.createDataFrame([(1,)], "pk long")
    orph = quality.orphans(df.withColumn("fk", F.col("id")), parent, "fk", "pk", "id")
    assert [r.fk_value for r in orph.collect()] == [2]


def test_relational_helpers(spark):
    df = spark.createDataFrame([(1, 2), (2, 0), (3, None)], "id long, n int")
    assert relational.fan_out(df, "n").count() == 2
    nums = spark.range(1000).withColumn("k", F.col("id") % 7)
    ids = relational.global_row_id(nums, ["k", "id"]).collect()
    assert sorted(r.row_id for r in ids) == list(range(1, 1001))
    first = sorted(ids, key=lambda r: r.row_id)[:3]
    assert [(r.k, r.id) for r in first] == [(0, 0), (0, 7), (0, 14)]
    s1 = [r.id for r in relational.sample_k(nums, 5, 42, "id").collect()]
    s2 = [r.id for r in relational.sample_k(nums, 5, 42, "id").collect()]
    assert s1 == s2 and len(s1) == 5


def test_connector_gauge(spark):
    status = spark.createDataFrame([("txn", "RUNNING"), ("card", "FAILED")],
                                   "connector string, state string")
    m = monitoring.connector_metrics(status, ts="2025-01-01 00:00:00")
    got = {r.labels: r.value for r in m.collect()}
    assert got == {'{"connector":"txn"}': 1.0, '{"connector":"card"}': 0.0}
    try:
        monitoring.assert_connectors(m)
        raise AssertionError("expected alert")
    except RuntimeError as e:
        assert "card" in str(e)


def test_source_defaults(spark):
    from vaultline.operators.staging import apply_defaults
    df = spark.createDataFrame([(1, None, None, None), (2, "closed", 5.0, True)],
                               "account_id long, status string, daily_transfer_limit double, "
                               "is_deleted boolean")
    out = {r.account_id: r for r in apply_defaults(df, "account", ts="2025-01-01 00:00:00")
           .collect()}
    assert (out[1].status, out[1].daily_transfer_limit, out[1].is_deleted) == \
        ("active", 100000.0, False)
    assert (out[2].status, out[2].daily_transfer_limit, out[2].is_deleted) == ("closed", 5.0, True)
    assert out[1].opened_at == D(2025, 1, 1)


def test_soft_close_is_seen_by_incremental_delta(spark):
    """T5: closing a card moves its updated_at, so the next delta extracts it."""
    from vaultline.operators import incremental as inc
    cards = _cards(spark)
    closed = lifecycle.close_cards(cards, spark.createDataFrame([(4,)], "card_id long"),
                                   ts="2024-02-01 00:00:00")
    got = [r.card_id for r in inc.delta(closed, cards, "updated_at").collect()]
    assert got == [4]


def test_small_helpers(spark):
    from vaultline.operators.cdc import filter_ops
    from vaultline.session import cluster_conf
    df = spark.createDataFrame([("c",), ("u",), ("x",)], "op string")
    assert sorted(r.op for r in filter_ops(df, ("c", "u")).collect()) == ["c", "u"]
    conf = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert conf["spark.sql.adaptive.enabled"] == "true"


def test_rapid_withdrawals_events_equal_frame_on_dense_ties(spark):
    import random
    rnd = random.Random(11)
    base = D(2024, 1, 1, 22)
    rows = []
    for i in range(3000):
        card = 1 if rnd.random() < 0.5 else rnd.randint(2, 20)          # dense hot card
        t = base + dt.timedelta(minutes=rnd.randint(0, 8 * 60))          # many exact ties
        term = None if rnd.random() < 0.1 else rnd.randint(1, 4)
        typ = "atm_withdrawal" if rnd.random() < 0.8 else "atm_deposit"
        rows.append((i, card, term, t, Decimal(100), "RUB", typ, "approved"))
    txn = spark.createDataFrame(rows, TXN)
    cols = ["txn_id", "card_id", "txn_ts", "n_ops", "n_terminals"]
    for w in (15 * 60, 3600):
        a = fraud.rapid_withdrawals(txn, w, method="frame").select(cols)
        b = fraud.rapid_withdrawals(txn, w, method="events").select(cols)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_orphans_many_single_scan(spark):
    child = spark.createDataFrame([(1, 10, 100), (2, 11, None), (3, 99, 999)],
                                  "id long, a long, b long")
    pa = spark.createDataFrame([(10,), (11,)], "pk long")
    pb = spark.createDataFrame([(100,)], "pk long")
    got = sorted((r.relation, r.child_id, r.fk_value) for r in quality.orphans_many(
        child, "id", [("c.a", "a", pa, "pk"), ("c.b", "b", pb, "pk")]).collect())
    assert got == [("c.a", 3, 99), ("c.b", 3, 999)]


def test_close_customers_restricted_to_keys(spark):
    cust = spark.createDataFrame([(1, False, D(2024, 1, 1)), (2, False, D(2024, 1, 1))],
                                 "customer_id long, is_deleted boolean, updated_at timestamp_ntz")
    acc = spark.createDataFrame([(10, 1, "closed", False)],
                                "account_id long, customer_id long, status string, "
                                "is_deleted boolean")
    keys = spark.createDataFrame([(2,)], "customer_id long")
    out = {r.customer_id: r.is_deleted for r in
           lifecycle.close_customers(cust, acc, ts="2024-02-01 00:00:00", keys=keys).collect()}
    assert out == {1: False, 2: True}


def test_used_after_block_versions_keeps_the_first_block(spark):
    """Blocked on the 10th, closed on the 20th, unblocked on the 25th."""
    end = D(2999, 12, 31)
    dim = spark.createDataFrame([
        (1, "active", D(2024, 1, 1), D(2024, 1, 10)), (1, "blocked", D(2024, 1, 10), D(2024, 1, 20)),
        (1, "closed", D(2024, 1, 20), D(2024, 1, 25)), (1, "active", D(2024, 1, 25), end)],
        "card_id long, status string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    txn = spark.createDataFrame([(i, c, 5, D(2024, 1, d), Decimal(1), "RUB", "atm_withdrawal", "approved")
                                 for i, c, d in [(1, 1, 5), (2, 1, 12), (3, 1, 20), (4, 1, 26), (5, 2, 12),
                                                 (6, None, 12)]], TXN)
    got = {r.txn_id: (r.card_status, r.blocked_at)
           for r in fraud.used_after_block_versions(txn, dim).collect()}
    assert got == {2: ("blocked", D(2024, 1, 10)), 3: ("closed", D(2024, 1, 20))}
