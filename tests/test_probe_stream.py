"""The streaming amount-probe detector equals the batch one under disorder within its lateness."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest

from vaultline.operators import fraud
from vaultline.streaming.fraud import ROCKSDB, amount_probe_stream

SCHEMA = ("txn_id long, card_id long, terminal_id long, txn_ts timestamp_ntz, amount decimal(18,2), "
          "txn_type string, status string")
STORE = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture()
def rocksdb(spark):
    spark.conf.set(STORE, ROCKSDB)
    yield
    spark.conf.unset(STORE)


def test_stream_equals_batch(spark, scratch, rocksdb):
    rnd, t0, rows = random.Random(11), dt.datetime(2024, 1, 1), []
    for i in range(900):
        at = t0 + dt.timedelta(seconds=i * 5 + rnd.randrange(5))
        rows.append((i, rnd.choice([1, 1, 2, None]), rnd.choice([7, 7, 8, None]), at, Decimal(rnd.choice([10, 20, 30, 40])),
                     rnd.choice(["atm_withdrawal"] * 4 + ["atm_deposit"]), rnd.choice(["declined", "declined", "approved"])))
    rows.append((5000, 99, 99, t0 + dt.timedelta(days=9), Decimal(1), "atm_withdrawal", "approved"))   # moves the watermark
    # micro-batches of a hundred rows, swapped with rows up to some minutes away
    order = sorted(range(900), key=lambda i: i + rnd.randrange(40)) + [900]
    src = os.path.join(scratch, "src")
    for b in range(0, 901, 100):
        spark.createDataFrame([rows[i] for i in order[b:b + 100]], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    out = amount_probe_stream(stream, lateness_s=600)
    q = (out.writeStream.format("memory").queryName("probe_stream").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    want = fraud.amount_probe(spark.createDataFrame(rows, SCHEMA))
    got = spark.table("probe_stream")
    cols = want.columns
    assert want.count() > 20
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
