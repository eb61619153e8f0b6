"""Streaming landing equals the batch decode; re-running from the checkpoint
adds nothing; the streaming fraud detector runs offline."""

import os

from pyspark.sql import functions as F

from vaultline import bindings as B
from vaultline.operators import cdc
from vaultline.streaming import landing
from vaultline.streaming.fraud import rapid_withdrawal_sessions_stream


def _land(spark, src, root):
    stream = landing.read_cdc_stream(spark, fmt="json", path=src, max_per_trigger=1)
    q = landing.start_landing(stream, f"{root}/card", f"{root}/txn", f"{root}/_ckpt",
                              reject_path=f"{root}/rej", ts="2025-01-01 00:00:00")
    q.awaitTermination()


def test_stream_equals_batch_and_is_idempotent(spark, sf_dir, scratch):
    src = os.path.join(scratch, "source")
    B.cdc_records(spark, sf_dir).repartition(5).write.json(src)
    _land(spark, src, scratch)
    cards = landing.read_landing(spark, f"{scratch}/card")
    batch = cdc.land_cards(cdc.decode_envelope(B.cdc_records(spark, sf_dir)),
                           ts="2025-01-01 00:00:00")
    cols = ["kafka_partition", "kafka_offset", "op", "card_id", "payload_before",
            "payload_after", "src_ts"]
    assert cards.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(cards.select(cols)).count() == 0
    n_batches = spark.read.parquet(f"{scratch}/card").select("batch_id").distinct().count()
    assert n_batches >= 2
    # restart on the same checkpoint: nothing new to land
    _land(spark, src, scratch)
    assert landing.read_landing(spark, f"{scratch}/card").count() == cards.count()
    rej = spark.read.parquet(f"{scratch}/rej")
    assert rej.count() == spark.read.parquet(f"{sf_dir}/region.parquet").count()


def test_streaming_fraud_sessions_smoke(spark, sf_dir, scratch):
    src = os.path.join(scratch, "txn")
    B.transaction(spark, sf_dir).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = rapid_withdrawal_sessions_stream(stream, gap="6 hours", watermark="1 day")
    q = (out.writeStream.format("memory").queryName("rapid_sessions").outputMode("append")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("rapid_sessions")
    assert set(got.columns) == {"card_id", "session_start", "session_end", "n_ops", "n_terminals"}
    assert got.filter(F.col("n_ops") < 3).count() == 0


def test_dedupe_stream_drops_replays(spark, sf_dir, scratch):
    src = os.path.join(scratch, "dup")
    rec = B.card_change_records(spark, sf_dir)
    rec.unionByName(rec).write.json(src)                 # every record twice
    stream = landing.read_cdc_stream(spark, fmt="json", path=src, max_per_trigger=None)
    q = (landing.dedupe_stream(stream, "1 day").writeStream.format("memory")
         .queryName("deduped").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("deduped").count() == rec.count()


def test_compact_landing_keeps_rows(spark, sf_dir, scratch):
    src = os.path.join(scratch, "source")
    B.cdc_records(spark, sf_dir).repartition(6).write.json(src)
    _land(spark, src, scratch)
    path = f"{scratch}/card"
    before = sorted(tuple(r) for r in landing.read_landing(spark, path).collect())
    last = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    landing.compact_landing(spark, path, upto_batch=last - 1)
    after = sorted(tuple(r) for r in landing.read_landing(spark, path).collect())
    assert after == before
    files = [f for f in os.listdir(os.path.join(path, "batch_id=0")) if f.endswith(".parquet")]
    assert len(files) == 1


def test_stateful_rapid_withdrawals_equal_batch(spark, sf_dir, scratch):
    from vaultline.operators import fraud
    from vaultline.streaming.fraud import rapid_withdrawals_stream, write_in_time_order
    txn = B.transaction(spark, sf_dir)
    src = os.path.join(scratch, "txn_by_day")
    write_in_time_order(txn, src, unit="day")
    schema = txn.schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    out = rapid_withdrawals_stream(stream, window_s=6 * 3600, lateness_s=86400)
    q = (out.writeStream.format("memory").queryName("rapid_stream").outputMode("append")
            .option("checkpointLocation", os.path.join(scratch, "ckpt"))
            .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("rapid_stream")
    expect = fraud.rapid_withdrawals(txn, 6 * 3600)
    cols = ["txn_id", "card_id", "txn_ts", "n_ops", "n_terminals"]
    assert got.count() == expect.count()
    assert got.select(cols).exceptAll(expect.select(cols)).count() == 0


def test_stream_maintains_cdc_models(spark, sf_dir, scratch):
    from vaultline.operators import scd2
    from vaultline.plans import jobs
    from vaultline.sinks.tables import TableStore
    src = os.path.join(scratch, "source")
    B.cdc_records(spark, sf_dir).repartition(4).write.json(src)
    store = TableStore(spark, os.path.join(scratch, "wh"))
    stream = landing.read_cdc_stream(spark, fmt="json", path=src, max_per_trigger=1)
    q = landing.start_cdc_models(stream, store, os.path.join(scratch, "landing"),
                                 os.path.join(scratch, "_ckpt"), ts="2025-01-01 00:00:00")
    q.awaitTermination()
    landed = landing.read_landing(spark, os.path.join(scratch, "landing", "stg_cdc_card"))
    full = scd2.scd2_from_landing(landed, ts="2025-01-01 00:00:00")
    got = jobs.read_card_scd2(store)
    cols = [c for c in full.columns if c != "loaded_at"]
    assert got.select(cols).exceptAll(full.select(cols)).count() == 0
    assert full.select(cols).exceptAll(got.select(cols)).count() == 0
    assert store.read("raw_transaction_cdc").count() > 0


def test_stateful_rapid_withdrawals_late_rows(spark, sf_dir, scratch):
    """A day delivered late (within the lateness) is still judged on its full
    trailing window."""
    from vaultline.operators import fraud
    from vaultline.streaming.fraud import rapid_withdrawals_stream
    txn = B.transaction(spark, sf_dir)
    flagged = fraud.rapid_withdrawals(txn, 6 * 3600)
    day = (flagged.groupBy(F.to_date("txn_ts").alias("d")).count()
           .orderBy(F.desc("count"), "d").first()["d"])
    late_day = F.to_date("txn_ts") == F.lit(day)
    src = os.path.join(scratch, "src")
    txn.filter(~late_day).coalesce(1).write.parquet(f"{src}/p=0")
    txn.filter(late_day).coalesce(1).write.parquet(f"{src}/p=1")     # arrives afterwards
    stream = (spark.readStream.schema(txn.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    out = rapid_withdrawals_stream(stream, window_s=6 * 3600, lateness_s=40 * 86400)
    q = (out.writeStream.format("memory").queryName("rapid_late").outputMode("append")
            .option("checkpointLocation", os.path.join(scratch, "ckpt"))
            .trigger(availableNow=True).start())
    q.awaitTermination()
    cols = ["txn_id", "card_id", "txn_ts", "n_ops", "n_terminals"]
    got = spark.table("rapid_late").filter(late_day).select(cols)
    expect = flagged.filter(late_day).select(cols)
    assert expect.count() > 0
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def test_stateful_rapid_withdrawals_non_utc_short_lateness(spark, sf_dir, scratch):
    """Idle-card timeouts are set on the watermark's clock: in a non-UTC
    session with little lateness the stream still equals the batch rule."""
    from vaultline.operators import fraud
    from vaultline.streaming.fraud import rapid_withdrawals_stream, write_in_time_order
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        txn = B.transaction(spark, sf_dir)
        src = os.path.join(scratch, "by_day")
        write_in_time_order(txn, src, unit="day")
        stream = (spark.readStream.schema(txn.schema).option("maxFilesPerTrigger", 1)
                  .option("recursiveFileLookup", "true").parquet(src))
        out = rapid_withdrawals_stream(stream, window_s=6 * 3600, lateness_s=600)
        q = (out.writeStream.format("memory").queryName("rapid_ny").outputMode("append")
                .option("checkpointLocation", os.path.join(scratch, "ckpt"))
                .trigger(availableNow=True).start())
        q.awaitTermination()
        cols = ["txn_id", "card_id", "txn_ts", "n_ops", "n_terminals"]
        got = spark.table("rapid_ny").select(cols)
        expect = fraud.rapid_withdrawals(txn, 6 * 3600).select(cols)
        assert expect.count() > 0
        assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)


def test_replay_in_slices_and_groups_of_cards(spark, scratch):
    """A long period is replayed in files of bounded size, each later than the
    one before; peers of a time share a file, rows without a time are left
    out; cards that share a state do not mix."""
    import glob
    from vaultline.operators import fraud
    from vaultline.streaming.fraud import rapid_withdrawals_stream, write_in_time_order
    i = F.col("id")
    txn = spark.range(3000).select(
        i.alias("txn_id"), (i % 37).alias("card_id"), F.when(i % 11 != 0, i % 5).alias("terminal_id"),
        F.when(i != 7, F.timestamp_add("MINUTE", F.floor(i / 2) * 3, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
        .alias("txn_ts"), F.lit("atm_withdrawal").alias("txn_type"))
    src = os.path.join(scratch, "slices")
    write_in_time_order(txn, src, unit="week", rows_per_file=400)
    files = sorted(glob.glob(f"{src}/part=*/part-*.parquet"), key=os.path.getmtime)
    spans = [spark.read.parquet(f).agg(F.min("txn_ts"), F.max("txn_ts"), F.count("*")).first() for f in files]
    assert len(files) >= 7 and max(n for *_, n in spans) < 800 and sum(n for *_, n in spans) == 2999
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    stream = (spark.readStream.schema(txn.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    out = rapid_withdrawals_stream(stream, window_s=6 * 3600, lateness_s=600, groups=3)
    q = (out.writeStream.format("memory").queryName("rapid_slices").outputMode("append")
            .option("checkpointLocation", os.path.join(scratch, "ckpt_slices"))
            .trigger(availableNow=True).start())
    q.awaitTermination()
    cols = ["txn_id", "card_id", "txn_ts", "n_ops", "n_terminals"]
    got = spark.table("rapid_slices").select(cols)
    expect = fraud.rapid_withdrawals(txn.filter("txn_ts is not null"), 6 * 3600).select(cols)
    assert expect.count() > 1000
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
