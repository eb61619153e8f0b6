"""The command line runs the scheduled jobs end to end."""

import os

import pytest
from pyspark.sql import functions as F

from vaultline import bindings as B
from vaultline.__main__ import main
from vaultline.plans import jobs
from vaultline.sinks.tables import TableStore


def test_load_models_cdc_monitor(spark, sf_dir, scratch):
    src = os.path.join(scratch, "src")
    frames = {"customer": B.customer, "account": B.account, "card": B.card,
              "terminal": B.terminal, "transaction": B.transaction}
    for name, fn in frames.items():
        fn(spark, sf_dir).write.parquet(os.path.join(src, name))
    wh = os.path.join(scratch, "wh")
    assert main(["load", "--source", src, "--warehouse", wh, "--ts", "2025-01-01 00:00:00"],
                spark=spark) == 0
    store = TableStore(spark, wh)
    assert store.read(jobs.FACT).count() == B.transaction(spark, sf_dir).count()

    wh2 = os.path.join(scratch, "wh2")
    assert main(["models", "--source", src, "--warehouse", wh2], spark=spark) == 0
    assert TableStore(spark, wh2).read(jobs.FACT).count() == B.transaction(spark, sf_dir).count()

    cdc_in = os.path.join(scratch, "cdc")
    B.cdc_records(spark, sf_dir).write.json(cdc_in)
    assert main(["cdc", "--input", cdc_in, "--warehouse", wh], spark=spark) == 0
    assert jobs.read_card_scd2(TableStore(spark, wh)).count() > 0
    marks = TableStore(spark, wh).read(jobs.CTL_LOAD).filter(
        (F.col("process_name") == jobs.FACT_STATE) & (F.col("src_table") == "raw_transaction"))
    assert marks.count() == 2                        # one by load, one by cdc

    end, committed = B.offsets(spark, sf_dir)
    end.write.parquet(os.path.join(scratch, "end"))
    committed.write.parquet(os.path.join(scratch, "committed"))
    args = ["monitor", "--end", os.path.join(scratch, "end"), "--committed",
            os.path.join(scratch, "committed"), "--warehouse", wh]
    total = end.join(committed, ["topic", "partition"], "left").select(
        (F.col("end_offset") - F.coalesce("committed_offset", F.lit(0))).alias("l")) \
        .agg(F.sum("l")).first()[0]
    if total > 5000:
        with pytest.raises(RuntimeError):
            main(args, spark=spark)
    else:
        assert main(args, spark=spark) == 0
    assert TableStore(spark, wh).read("ctl_monitoring").count() > 0


def test_load_from_jdbc(spark, sf_dir, scratch, monkeypatch):
    from vaultline.sources import extract
    frames = {"customer": B.customer, "account": B.account, "card": B.card,
              "terminal": B.terminal, "transaction": B.transaction}
    calls = []

    def read(spark, url, table, **options):
        calls.append((url, table, options))
        if table.startswith("("):                    # the bounds of a table's key
            key, name = table.split("min(")[1].split(")")[0], table.split("bank.")[1].split(")")[0]
            return frames[name](spark, sf_dir).agg(F.min(key).alias("low"), F.max(key).alias("high"))
        return frames[table.split(".")[1]](spark, sf_dir)

    monkeypatch.setattr(extract, "read_jdbc", read)
    os.makedirs(scratch, exist_ok=True)
    secret = os.path.join(scratch, "secret")
    with open(secret, "w") as fh:
        fh.write("word\n")
    wh = os.path.join(scratch, "wh")
    assert main(["load", "--jdbc", "jdbc:x://db", "--jdbc-user", "u", "--jdbc-password-file", secret,
                 "--jdbc-partitions", "3", "--warehouse", wh], spark=spark) == 0
    assert TableStore(spark, wh).read(jobs.FACT).count() == B.transaction(spark, sf_dir).count()
    url, _, options = next(c for c in calls if c[1] == "bank.transaction")
    assert url == "jdbc:x://db" and options["user"] == "u" and options["password"] == "word"
    assert options["partition_column"] == "txn_id" and options["num_partitions"] == 3
    assert options["lower_bound"] <= options["upper_bound"]


def test_source_and_jdbc_exclude_each_other(spark):
    for args in ([], ["--source", "a", "--jdbc", "b"]):
        with pytest.raises(SystemExit):
            main(["load", "--warehouse", "w", *args], spark=spark)
