"""The library example of the README runs as written (paths adapted)."""

import os

from vaultline import bindings as B


def test_readme_library_example(spark, sf_dir, scratch):
    d = scratch
    for e in ("customer", "account", "card", "terminal", "transaction"):
        getattr(B, e)(spark, sf_dir).write.parquet(os.path.join(d, "src", e))
    B.card_change_records(spark, sf_dir).write.json(os.path.join(d, "cdc"))

    from vaultline import TableStore, as_of, decode_envelope, land_cards
    from vaultline.operators.scd2 import scd2_from_landing
    from vaultline.plans import jobs
    from vaultline.schemas import CDC_RECORD

    store = TableStore(spark, os.path.join(d, "dwh"))
    for e in ("customer", "account", "terminal", "card"):
        jobs.run_dim_load(store, e, spark.read.parquet(os.path.join(d, "src", e)))
    jobs.run_txn_load(store, spark.read.parquet(os.path.join(d, "src", "transaction")))
    fact = jobs.read_fact(store, "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    cards = land_cards(decode_envelope(spark.read.schema(CDC_RECORD).json(os.path.join(d, "cdc"))))
    dim = scd2_from_landing(cards)
    out = as_of(fact.select("txn_id", "card_id", "txn_ts"), dim)
    assert out.count() == fact.count() > 0
    assert out.filter("status IS NOT NULL").count() > 0
