"""Command line for the scheduled warehouse jobs.

    python -m vaultline load    --source DIR --warehouse DIR [--ts TS]
    python -m vaultline models  --source DIR --warehouse DIR [--ts TS]
    python -m vaultline load    --jdbc URL [--jdbc-user U --jdbc-password-file F] --warehouse DIR
    python -m vaultline cdc     --input DIR  --warehouse DIR [--format json] [--ts TS]
    python -m vaultline monitor --end PATH [--committed PATH] --warehouse DIR [--group G]

``--source`` holds one parquet folder per source table (customer, account,
card, terminal, transaction) in the source schema; ``--jdbc`` reads the same
tables of ``--jdbc-schema`` from a database, in ``--jdbc-partitions`` ranges of
their keys. Each command runs once and
exits, so any scheduler can call it at the reference's cadence (15 / 20 / 10 /
5 minutes). The Spark session comes from the environment (spark-submit or
defaults); the warehouse folder should be on shared storage.
"""

from __future__ import annotations

import argparse
import os
import sys

ENTITIES = ("customer", "account", "card", "terminal", "transaction")


def _session():
    from pyspark.sql import SparkSession

    from vaultline.session import RECOMMENDED_CONF, ensure_checkpoint_dir
    builder = SparkSession.builder.appName("vaultline")
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _sources(spark, source: str) -> dict:
    """Every entity's folder; a missing one is an error, so no job runs on part of a source."""
    return {e: spark.read.parquet(os.path.join(source, e)) for e in ENTITIES}


def _jdbc_sources(spark, args) -> dict:
    """Every entity's table, read in parallel ranges between its smallest and largest key."""
    from vaultline.schemas import PRIMARY_KEYS
    from vaultline.sources import extract
    login = {}
    if args.jdbc_user:
        login["user"] = args.jdbc_user
    if args.jdbc_password_file:
        with open(args.jdbc_password_file) as fh:
            login["password"] = fh.read().strip()
    out = {}
    for e in ENTITIES:
        table, key = f"{args.jdbc_schema}.{e}", PRIMARY_KEYS[e]
        low, high = extract.read_jdbc(
            spark, args.jdbc, f"(SELECT min({key}) AS low, max({key}) AS high FROM {table}) b",
            **login).first()
        ranges = {} if low is None else {
            "partition_column": key, "lower_bound": low, "upper_bound": high,
            "num_partitions": args.jdbc_partitions}
        out[e] = extract.read_jdbc(spark, args.jdbc, table, **ranges, **login)
    return out


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="vaultline")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("load", "models"):
        s = sub.add_parser(name)
        where = s.add_mutually_exclusive_group(required=True)
        where.add_argument("--source")
        where.add_argument("--jdbc", help="JDBC URL of the source database")
        s.add_argument("--jdbc-schema", default="bank")
        s.add_argument("--jdbc-user")
        s.add_argument("--jdbc-password-file")
        s.add_argument("--jdbc-partitions", type=int, default=8)
        s.add_argument("--warehouse", required=True)
        s.add_argument("--ts")
    c = sub.add_parser("cdc")
    c.add_argument("--input", help="folder of a file source")
    c.add_argument("--topics", nargs="+", help="Kafka topics (with --format kafka)")
    c.add_argument("--bootstrap", help="Kafka bootstrap servers")
    c.add_argument("--max-per-trigger", type=int)
    c.add_argument("--trigger", help="run on, with this processing time; default: drain and stop")
    c.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="option of the stream source, such as kafka.security.protocol=SSL; may be repeated")
    c.add_argument("--warehouse", required=True)
    c.add_argument("--format", default="json")
    c.add_argument("--ts")
    m = sub.add_parser("monitor")
    m.add_argument("--end", required=True)
    m.add_argument("--committed", help="committed offsets; default: those of the landed batches")
    m.add_argument("--warehouse", required=True)
    m.add_argument("--group", default="dwh_cdc_v1")
    m.add_argument("--threshold", type=int, default=None)
    m.add_argument("--ts")
    args = p.parse_args(argv)

    spark = spark or _session()
    from vaultline.plans import jobs
    from vaultline.sinks.tables import TableStore
    store = TableStore(spark, args.warehouse)
    if args.cmd in ("load", "models"):
        src = _jdbc_sources(spark, args) if args.jdbc else _sources(spark, args.source)

    if args.cmd == "load":
        jobs.run_dim_loads(store, {e: src[e] for e in ("customer", "account", "card", "terminal")},
                           ts=args.ts)
        jobs.run_txn_load(store, src["transaction"], ts=args.ts)
    elif args.cmd == "models":
        jobs.run_models(store, src, ts=args.ts)
    elif args.cmd == "cdc":
        from vaultline.streaming import landing
        if args.format == "kafka" and not (args.topics and args.bootstrap):
            p.error("--format kafka needs --topics and --bootstrap")
        if args.format != "kafka" and not args.input:
            p.error("a file source needs --input")
        stream = landing.read_cdc_stream(spark, fmt=args.format, path=args.input,
                                         topics=args.topics, bootstrap=args.bootstrap,
                                         max_per_trigger=args.max_per_trigger,
                                         **dict(o.split("=", 1) for o in args.option))
        root = os.path.join(args.warehouse, "landing")
        q = landing.start_cdc_models(stream, store, root, os.path.join(root, "_checkpoint"),
                                     available_now=args.trigger is None,
                                     processing_time=args.trigger or "10 minutes", ts=args.ts,
                                     fact=args.trigger is not None)
        q.awaitTermination()
        jobs.refresh_loaded_fact(store, args.ts)
    elif args.cmd == "monitor":
        from vaultline.operators import monitoring
        from vaultline.schemas import LAG_THRESHOLD
        ranges = None
        if args.committed is None:
            from vaultline.streaming.landing import CTL_OFFSETS
            ranges = spark.read.parquet(os.path.join(args.warehouse, "landing", CTL_OFFSETS))
        committed = spark.read.parquet(args.committed) if ranges is None else monitoring.committed_offsets(ranges)
        metrics = monitoring.lag_metrics(monitoring.kafka_lag(spark.read.parquet(args.end), committed), args.group, ts=args.ts)
        if ranges is not None:
            metrics = metrics.unionByName(monitoring.break_metrics(monitoring.offset_breaks(ranges), args.ts))
        monitoring.write_metrics(store, metrics)
        monitoring.assert_lag(metrics, LAG_THRESHOLD if args.threshold is None else args.threshold)
    return 0


if __name__ == "__main__":
    sys.exit(main())
