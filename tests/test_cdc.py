"""Envelope decoding and landing on hand-written edge frames."""

import json

from pyspark.sql import functions as F

from vaultline.operators import cdc
from vaultline.schemas import CDC_RECORD


def _records(spark, rows):
    return spark.createDataFrame(rows, CDC_RECORD)


def _env(op, before=None, after=None, ts_ms=1704067200000, wrap=False):
    e = {"before": before, "after": after, "op": op}
    if ts_ms is not None:
        e["ts_ms"] = ts_ms
    return json.dumps({"payload": e} if wrap else e)


def test_wrapped_bare_heartbeat_malformed(spark):
    import datetime as dt
    ts = dt.datetime(2024, 1, 1, 0, 0, 5)
    rows = [
        ("bankcdc.bank.card", 0, 1, ts, _env("c", after={"card_id": 7}, wrap=True)),
        ("bankcdc.bank.card", 0, 2, ts, _env("u", after={"card_id": 7})),
        ("bankcdc.bank.card", 0, 3, ts, json.dumps({"ts_ms": 1})),          # heartbeat
        ("bankcdc.bank.card", 0, 4, ts, "{broken"),                         # malformed
        ("bankcdc.bank.card", 0, 5, ts, "[1, 2]"),                          # not an object
        ("bankcdc.bank.card", 0, 6, ts, json.dumps({"payload": 5})),        # bad payload
        ("bankcdc.bank.card", 0, 7, ts, None),                              # tombstone
    ]
    d = cdc.decode_envelope(_records(spark, rows)).orderBy("offset").collect()
    assert [r["decoded"] for r in d] == [True, True, True, False, False, False, False]
    assert [r["op"] for r in d] == ["c", "u", None, None, None, None, None]
    assert cdc.rejects(cdc.decode_envelope(_records(spark, rows))).count() == 4


def test_src_ts_from_ts_ms_and_fallback(spark):
    import datetime as dt
    ts = dt.datetime(2024, 3, 1, 12, 0, 0, 123456)
    rows = [("x.card", 0, 1, ts, _env("c", after={"card_id": 1}, ts_ms=1704067200123)),
            ("x.card", 0, 2, ts, _env("c", after={"card_id": 1}, ts_ms=None))]
    d = cdc.decode_envelope(_records(spark, rows)).orderBy("offset").collect()
    assert d[0]["src_ts"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    # missing ts_ms: the record timestamp (broker time) truncated to ms
    assert d[1]["src_ts"] == dt.datetime(2024, 3, 1, 12, 0, 0, 123000)


def test_key_zero_delete_and_routing(spark):
    import datetime as dt
    ts = dt.datetime(2024, 1, 1)
    rows = [
        ("bankcdc.bank.card", 0, 1, ts, _env("c", after={"card_id": 0})),        # key 0 is valid
        ("bankcdc.bank.card", 0, 2, ts, _env("d", before={"card_id": 0})),       # key-only before
        ("bankcdc.bank.card", 0, 3, ts, _env("u", after={"status": "x"})),       # no key -> drop
        ("bankcdc.bank.card", 0, 4, ts, _env("t", after={"card_id": 1})),        # unknown op
        ("bankcdc.bank.transaction", 1, 5, ts, _env("u", after={"txn_id": 3})),  # txn update
        ("bankcdc.bank.transaction", 1, 6, ts, _env("r", after={"txn_id": 3})),
        ("bankcdc.bank.transaction", 1, 7, ts, _env("c", before={"txn_id": 4})),
        ("bankcdc.bank.terminal", 0, 8, ts, _env("c", after={"terminal_id": 1})),
    ]
    d = cdc.decode_envelope(_records(spark, rows))
    cards = cdc.land_cards(d).orderBy("kafka_offset").collect()
    assert [(r["kafka_offset"], r["card_id"], r["op"]) for r in cards] == [(1, 0, "c"), (2, 0, "d")]
    assert cards[1]["payload_after"] == "{}"
    txns = cdc.land_transactions(d).orderBy("kafka_offset").collect()
    assert [(r["kafka_offset"], r["txn_id"]) for r in txns] == [(6, 3), (7, 4)]
    # after missing -> payload_after falls back to before
    assert json.loads(txns[1]["payload_after"]) == {"txn_id": 4}


def test_card_versions_parse(spark):
    import datetime as dt
    rows = [(0, 1, "c", 5, "{}", json.dumps({"card_id": 5, "card_number": "1", "account_id": 2,
                                            "status": "active", "opened_at": "2024-01-02T03:04:05Z",
                                            "closed_at": "", "is_deleted": False}),
             dt.datetime(2024, 1, 1)),
            (0, 2, "d", 5, json.dumps({"card_id": 5}), "{}", dt.datetime(2024, 1, 2)),
            (0, 3, "u", 5, "{}", json.dumps({"card_id": 5, "opened_at": "garbage",
                                            "is_deleted": True}), dt.datetime(2024, 1, 3))]
    landed = spark.createDataFrame(rows, "kafka_partition int, kafka_offset long, op string, "
                                         "card_id long, payload_before string, "
                                         "payload_after string, src_ts timestamp_ntz")
    v = cdc.card_versions(landed).orderBy("kafka_offset").collect()
    assert v[0]["opened_at"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert v[0]["closed_at"] is None and v[0]["is_deleted"] == 0
    assert v[1]["is_deleted"] == 1 and v[1]["status"] is None
    assert v[2]["opened_at"] is None and v[2]["is_deleted"] == 1
    dflt = cdc.card_versions(landed, defaults=True).orderBy("kafka_offset").collect()
    assert dflt[1]["status"] == "" and dflt[1]["account_id"] == 0


def test_dedupe_log(spark):
    import datetime as dt
    rows = [(0, 1, "c", 1, "{}", "{}", dt.datetime(2024, 1, 1))] * 3 + \
           [(1, 1, "c", 1, "{}", "{}", dt.datetime(2024, 1, 1))]
    landed = spark.createDataFrame(rows, "kafka_partition int, kafka_offset long, op string, "
                                         "card_id long, payload_before string, "
                                         "payload_after string, src_ts timestamp_ntz")
    assert cdc.dedupe_log(landed).count() == 2


def test_raw_transaction_cdc_types(spark):
    import datetime as dt
    payload = json.dumps({"txn_id": 1, "card_id": 2, "terminal_id": None,
                          "txn_ts": "2024-01-01T10:00:00.250000Z", "amount": 12.5,
                          "currency_code": "RUB", "txn_type": "atm_withdrawal",
                          "status": "approved"})
    landed = spark.createDataFrame([(0, 1, "c", 1, payload, dt.datetime(2024, 1, 1)),
                                    (0, 2, "r", 9, payload, dt.datetime(2024, 1, 1))],
                                   "kafka_partition int, kafka_offset long, op string, "
                                   "txn_id long, payload_after string, src_ts timestamp_ntz")
    r = cdc.raw_transaction_cdc(landed).collect()
    assert len(r) == 1
    assert r[0]["txn_ts"] == dt.datetime(2024, 1, 1, 10, 0, 0, 250000)
    assert str(r[0]["amount"]) == "12.50"
    assert r[0]["terminal_id"] is None
    assert cdc.raw_transaction_cdc(landed, ops=("r", "c")).count() == 2


def test_times_with_offsets_are_utc(spark):
    from vaultline.functions.columns import parse_ts_best_effort
    rows = ["2024-01-01T00:00:00+03:00", "2024-01-01 00:00:00-0230", "2024-01-01T05:06:07.5Z",
            "2024-01-01", "2024-01-01T00:00:00 Europe/Paris", "", "bad", None]
    d = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    got = [str(r.t) if r.t else None for r in d.select("i", parse_ts_best_effort("s").alias("t")).orderBy("i").collect()]
    assert got == ["2023-12-31 21:00:00", "2024-01-01 02:30:00", "2024-01-01 05:06:07.500000",
                   "2024-01-01 00:00:00", None, None, None, None]


def test_out_of_order_ids_all_reach_the_model(spark, scratch):
    from vaultline.plans import jobs
    from vaultline.sinks.tables import TableStore
    from vaultline.schemas import STG_CDC_CARD
    store = TableStore(spark, scratch)
    cards = spark.createDataFrame([], STG_CDC_CARD)

    def landed(ids, when="2024-01-01T00:00:00Z"):
        return spark.createDataFrame(
            [(i % 2, i, "c", i, '{"card_id": 1, "txn_ts": "%s"}' % when) for i in ids],
            "kafka_partition int, kafka_offset long, op string, txn_id long, payload_after string") \
            .withColumn("src_ts", F.localtimestamp()).withColumn("ingested_at", F.localtimestamp())

    jobs.run_cdc_models(store, cards, landed([100, 101, 102]))
    jobs.run_cdc_models(store, cards, landed([50, 51, 52]))
    jobs.run_cdc_models(store, cards, landed([7], when="bad"))
    assert sorted(r.txn_id for r in store.read("raw_transaction_cdc").collect()) == [50, 51, 52, 100, 101, 102]
    assert [r.txn_id for r in store.read("raw_transaction_cdc_rejects").collect()] == [7]
