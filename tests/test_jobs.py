"""Composed jobs: re-runs and a crash between the data write and the
watermark save leave the same tables."""

import pytest
from pyspark.sql import functions as F

from vaultline import bindings as B
from vaultline.functions.columns import ntz
from vaultline.plans import jobs
from vaultline.sinks.tables import TableStore

TS = "2025-01-01 00:00:00"
CUT = "2024-01-15 00:00:00"


def _dims(spark, sf_dir, store):
    for entity, src in (("customer", B.customer), ("account", B.account), ("card", B.card),
                        ("terminal", B.terminal)):
        jobs.run_dim_load(store, entity, src(spark, sf_dir), ts=TS)


def _fact_rows(store):
    return sorted(tuple(r) for r in store.read(jobs.FACT).drop("loaded_at").collect())


def test_rerun_and_crash_before_watermark(spark, sf_dir, scratch):
    txn = B.transaction(spark, sf_dir)
    clean = TableStore(spark, scratch + "/clean")
    _dims(spark, sf_dir, clean)
    jobs.run_txn_load(clean, txn.filter(F.col("txn_ts") < ntz(CUT)), ts=TS)
    jobs.run_txn_load(clean, txn, ts=TS)
    expected = _fact_rows(clean)
    assert len(expected) == txn.count()

    crashy = TableStore(spark, scratch + "/crashy")
    _dims(spark, sf_dir, crashy)
    jobs.run_txn_load(crashy, txn.filter(F.col("txn_ts") < ntz(CUT)), ts=TS)
    original_append = crashy.append

    def crash_on_ctl(name, df, *a, **k):
        if name == jobs.CTL_LOAD:
            raise RuntimeError("crash after the data, before the watermark")
        return original_append(name, df, *a, **k)

    crashy.append = crash_on_ctl
    with pytest.raises(RuntimeError):
        jobs.run_txn_load(crashy, txn, ts=TS)
    crashy.append = original_append
    jobs.run_txn_load(crashy, txn, ts=TS)       # re-extracts, the upsert absorbs it
    jobs.run_txn_load(crashy, txn, ts=TS)       # nothing new
    assert _fact_rows(crashy) == expected
    assert crashy.read("raw_transaction").count() == txn.count()
    assert jobs.last_loaded_id(crashy, "pg_to_dwh", "transaction") == \
        txn.agg(F.max("txn_id")).first()[0]


def test_dim_load_rerun_is_stable(spark, sf_dir, scratch):
    store = TableStore(spark, scratch)
    card = B.card(spark, sf_dir)
    jobs.run_dim_load(store, "card", card, ts=TS)
    first = sorted(tuple(r) for r in store.read("ods_dim_card").collect())
    jobs.run_dim_load(store, "card", card, ts=TS)
    assert sorted(tuple(r) for r in store.read("ods_dim_card").collect()) == first
    assert store.read("raw_card").count() == card.count()


def test_cdc_models_rerun(spark, sf_dir, scratch):
    from vaultline.operators import cdc
    d = cdc.decode_envelope(B.cdc_records(spark, sf_dir))
    cards, txns = cdc.land_cards(d, ts=TS), cdc.land_transactions(d, ts=TS)
    store = TableStore(spark, scratch)
    jobs.run_cdc_models(store, cards, txns, ts=TS)
    n1 = store.read("raw_transaction_cdc").count()
    # a replay of the whole log: dedupe + upsert keep the tables unchanged
    jobs.run_cdc_models(store, cards.unionByName(cards), txns.unionByName(txns), ts=TS)
    assert store.read("raw_transaction_cdc").count() == n1
    assert store.read("ods_dim_card_scd2").count() == cards.count()


def test_incremental_fact_refresh_equals_rebuild(spark, sf_dir, scratch):
    """Dimension changes (blocked/closed cards, a customer moving) and new
    transactions between two refreshes give the same fact as a rebuild."""
    t1, t2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"
    old_cards = (B.card(spark, sf_dir).withColumn("status", F.lit("active"))
                 .withColumn("closed_at", F.lit(None).cast("timestamp_ntz"))
                 .withColumn("is_deleted", F.lit(False))
                 .withColumn("updated_at", F.col("opened_at")))
    cust = B.customer(spark, sf_dir)
    moved = (cust.withColumn("city", F.when(F.col("customer_id") % 7 == 0, F.lit("Elsewhere"))
                             .otherwise(F.col("city")))
                 .withColumn("updated_at", F.when(F.col("customer_id") % 7 == 0,
                                                  ntz("2024-06-01 00:00:00"))
                             .otherwise(F.col("updated_at"))))
    txn = B.transaction(spark, sf_dir)
    store = TableStore(spark, scratch)
    for entity, src in (("customer", cust), ("account", B.account(spark, sf_dir)),
                        ("card", old_cards), ("terminal", B.terminal(spark, sf_dir))):
        jobs.run_dim_load(store, entity, src, ts=t1)
    jobs.run_txn_load(store, txn.filter(F.col("txn_ts") < ntz(CUT)), ts=t1)
    jobs.run_dim_load(store, "card", B.card(spark, sf_dir), ts=t2)
    jobs.run_dim_load(store, "customer", moved, ts=t2)
    jobs.run_txn_load(store, txn, ts=t2)                       # incremental refresh
    fact = store.read(jobs.FACT)
    # only rows touched at t2 were recomputed (they carry the new load time)
    n_new = fact.filter(F.col("loaded_at") == ntz(t2)).count()
    assert 0 < n_new < fact.count()
    inc_rows = sorted(tuple(r) for r in fact.drop("loaded_at").collect())
    jobs.rebuild_fact(store, ts=t2)
    full_rows = sorted(tuple(r) for r in store.read(jobs.FACT).drop("loaded_at").collect())
    assert inc_rows == full_rows
    assert any(r for r in full_rows if "Elsewhere" in r)


def test_read_fact_range_and_drain(spark, sf_dir, scratch):
    store = TableStore(spark, scratch)
    _dims(spark, sf_dir, store)
    jobs.run_txn_load(store, B.transaction(spark, sf_dir), ts=TS)
    part = jobs.read_fact(store, "2024-01-10 00:00:00", "2024-01-12 00:00:00")
    expect = B.transaction(spark, sf_dir).filter(
        (F.col("txn_ts") >= ntz("2024-01-10 00:00:00")) & (F.col("txn_ts") < ntz("2024-01-12 00:00:00")))
    assert part.count() == expect.count() > 0
    from vaultline.streaming import landing
    import os
    src = os.path.join(scratch, "src")
    B.cdc_records(spark, sf_dir).write.json(src)
    q = landing.start_landing(landing.read_cdc_stream(spark, fmt="json", path=src),
                              f"{scratch}/c", f"{scratch}/t", f"{scratch}/ck",
                              available_now=False, processing_time="1 second")
    landing.drain(q)
    assert not q.isActive
    assert landing.read_landing(spark, f"{scratch}/c").count() > 0


def test_empty_source_runs(spark, sf_dir, scratch):
    """A first run with no transactions and a later run with none new keep
    consistent (empty, then unchanged) tables and watermarks."""
    store = TableStore(spark, scratch)
    _dims(spark, sf_dir, store)
    txn = B.transaction(spark, sf_dir)
    assert jobs.run_txn_load(store, txn.filter(F.lit(False)), ts=TS) is None
    assert store.read(jobs.FACT).count() == 0
    last = jobs.run_txn_load(store, txn, ts="2025-01-02 00:00:00")
    n = store.read(jobs.FACT).count()
    assert n == txn.count()
    assert jobs.run_txn_load(store, txn.filter(F.lit(False)), ts="2025-01-03 00:00:00") == last
    assert store.read(jobs.FACT).count() == n


def test_refresh_without_injected_time_in_other_zone(spark, sf_dir, scratch):
    """With wall-clock load times in a non-UTC session zone, a later change
    still reaches the fact (the refresh mark uses the same clock as loaded_at)."""
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        store = TableStore(spark, scratch)
        cards = B.card(spark, sf_dir)
        jobs.run_dim_loads(store, {"customer": B.customer(spark, sf_dir),
                                   "account": B.account(spark, sf_dir),
                                   "card": cards.withColumn("status", F.lit("active")),
                                   "terminal": B.terminal(spark, sf_dir)})
        txn = B.transaction(spark, sf_dir)
        jobs.run_txn_load(store, txn)
        assert store.read(jobs.FACT).count() == txn.count()
        # cards are re-numbered later (card_number is a fact column)
        jobs.run_dim_load(store, "card", cards
                          .withColumn("card_number", F.concat(F.lit("X"), F.col("card_number")))
                          .withColumn("updated_at", ntz("2030-01-01 00:00:00")))
        jobs.run_txn_load(store, txn)
        got = store.read(jobs.FACT).drop("loaded_at", "txn_month")
        jobs.rebuild_fact(store)
        want = store.read(jobs.FACT).drop("loaded_at", "txn_month")
        assert got.filter(F.col("card_number").startswith("X")).count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)


def test_late_ids_reach_raw_and_fact(spark, sf_dir, scratch):
    """Ids below the watermark that commit after it are loaded by the next run."""
    store = TableStore(spark, scratch)
    _dims(spark, sf_dir, store)
    txn = B.transaction(spark, sf_dir)
    late = F.col("txn_id") % 10 == 3
    jobs.run_txn_load(store, txn.filter(~late), ts=TS)
    jobs.run_txn_load(store, txn, ts="2025-01-02 00:00:00")
    assert store.read("raw_transaction").count() == txn.count()
    assert store.read(jobs.FACT).count() == txn.count() > store.read(jobs.TOUCHED).count() > 0
