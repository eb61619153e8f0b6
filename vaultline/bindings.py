"""Binding of the bank model to the driver's TPC-H-ish test tables.

Only tests, the benchmark and the query registry import this module; the
library itself works on any frames with the bank schemas. Every expression
here has a twin in ``vaultline.plans.oracle`` so the DuckDB oracle derives the
same frames from the same parquet files.

Mapping (deterministic):
  customer    <- customer JOIN nation
  account     <- orders
  card        <- part (every 50th under a key that no transaction names)
  terminal    <- supplier JOIN nation
  transaction <- events (unique txn_id) or lineitem (volume, no unique key)
  change log  <- events, wrapped into change envelopes as Kafka-shaped records
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.columns import epoch_millis, ntz

TOPIC_CARD = "bankcdc.bank.card"
TOPIC_TXN = "bankcdc.bank.transaction"
TOPIC_TERMINAL = "bankcdc.bank.terminal"
TOPIC_HEARTBEAT = "__heartbeat.bankcdc"

ISO_MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad(key: Column, width: int) -> Column:
    """The key as text, with leading zeros up to ``width``; longer keys stay whole."""
    text = key.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _currency(col: Column) -> Column:
    m = col % 3
    return F.when(m == 0, "RUB").when(m == 1, "USD").otherwise("EUR")


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.alias("customer_id"),
        F.md5(key.cast("string")).alias("customer_uuid"),
        F.col("c_name").alias("full_name"),
        F.date_add(F.lit("1980-01-01").cast("date"), (key % 15000).cast("int")).alias("birth_date"),
        F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(key % 10 != 0, F.concat(F.lit("+1000000"), _pad(key, 4)))
        .alias("phone"),
        F.col("n_name").alias("city"),
        ntz("2020-01-01 00:00:00").alias("created_at"),
        F.timestamp_add("MINUTE", key, ntz("2024-01-01 00:00:00")).alias("updated_at"),
        (F.col("c_acctbal") < 0).alias("is_deleted"),
    )


def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    closed_at = F.when(st == "F", F.timestamp_add("DAY", F.lit(90), F.col("o_orderdate")))
    return o.select(
        F.col("o_orderkey").alias("account_id"),
        F.concat(F.lit("ACC"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))
        .alias("account_number"),
        F.col("o_custkey").alias("customer_id"),
        _currency(F.col("o_orderkey")).alias("currency_code"),
        F.col("o_orderdate").alias("opened_at"),
        closed_at.alias("closed_at"),
        F.when(st == "O", "active").when(st == "F", "closed").when(st == "P", "blocked")
        .alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("daily_transfer_limit"),
        F.col("o_orderdate").alias("created_at"),
        F.coalesce(closed_at, F.col("o_orderdate")).alias("updated_at"),
        (st == "F").alias("is_deleted"),
    )


def card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards from part; every 50th has a key that no transaction names."""
    p = table(spark, sf_dir, "part")
    m = F.col("p_size") % 10
    key = F.when(F.col("p_partkey") % 50 == 49, -F.col("p_partkey")).otherwise(F.col("p_partkey"))
    opened_at = F.timestamp_add("DAY", F.col("p_size"), ntz("2020-01-01 00:00:00"))
    return p.select(
        key.alias("card_id"),
        F.lpad(F.col("p_partkey").cast("string"), 16, "4").alias("card_number"),
        (F.col("p_partkey") * 3).alias("account_id"),
        F.when(m == 0, "closed").when(m == 1, "blocked").otherwise("active").alias("status"),
        opened_at.alias("opened_at"),
        F.when(m == 0, ntz("2024-01-15 00:00:00")).alias("closed_at"),
        opened_at.alias("created_at"),
        F.when(m.isin(0, 1), ntz("2024-01-15 00:00:00")).otherwise(opened_at).alias("updated_at"),
        (m == 0).alias("is_deleted"),
    )


def terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    working = F.col("s_acctbal") >= 0
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        key.alias("terminal_id"),
        F.concat(F.lit("ATM-"), _pad(key, 5)).alias("terminal_code"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country"),
        (F.lit(55.0) + key / 1000.0).alias("latitude"),
        (F.lit(37.0) + key / 1000.0).alias("longitude"),
        ntz("2020-01-01 00:00:00").alias("created_at"),
        F.timestamp_add("HOUR", key, ntz("2024-01-01 00:00:00")).alias("updated_at"),
        working.alias("is_working"),
        (~working).alias("is_deleted"),
    )


def _terminal_from_props() -> Column:
    return F.get_json_object(F.col("props"), "$.k").try_cast("bigint")


def _txn_columns() -> list[Column]:
    et = F.col("event_type")
    return [
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("card_id"),
        _terminal_from_props().alias("terminal_id"),
        F.col("ts").alias("txn_ts"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        _currency(F.col("event_id")).alias("currency_code"),
        F.when(F.col("event_id") % 4 == 0, "atm_deposit").otherwise("atm_withdrawal")
        .alias("txn_type"),
        F.when(et == "error", "declined").when(et == "signup", "reversed").otherwise("approved")
        .alias("status"),
    ]


def transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with a unique txn_id (from events)."""
    return table(spark, sf_dir, "events").select(*_txn_columns())


def transaction_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-volume transactions (from lineitem); txn_id is NOT unique here."""
    li = table(spark, sf_dir, "lineitem")
    rf = F.col("l_returnflag")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        F.col("l_partkey").alias("card_id"),
        F.col("l_suppkey").alias("terminal_id"),
        F.col("l_shipdate").alias("txn_ts"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        _currency(F.col("l_orderkey")).alias("currency_code"),
        F.when(F.col("l_linenumber") % 4 == 0, "atm_deposit").otherwise("atm_withdrawal")
        .alias("txn_type"),
        F.when(rf == "R", "reversed").when(rf == "A", "declined").otherwise("approved")
        .alias("status"),
    )


# ---------------------------------------------------------------------------
# Change stream: Kafka-shaped records carrying JSON change envelopes
# ---------------------------------------------------------------------------

def _card_op(et: Column) -> Column:
    return (F.when(et == "signup", "c").when(et == "error", "d").when(et == "purchase", "r")
            .otherwise("u"))


def _spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over the cores, by no key: a topic is read in many
    splits, while a small test table is one row group."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def card_change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change message per event on the card topic.

    op: signup->c, error->d, purchase->r, else u. Deletes carry a key-only
    ``before`` (default replica identity) and no ``after``. Even offsets are
    wrapped as ``{"payload": envelope}``, odd ones are bare envelopes.
    """
    e = _spread(table(spark, sf_dir, "events"))
    op = _card_op(F.col("event_type"))
    seven = F.col("event_id") % 7
    after = F.struct(
        F.col("user_id").alias("card_id"),
        F.lpad(F.col("user_id").cast("string"), 16, "4").alias("card_number"),
        (F.col("user_id") * 3).alias("account_id"),
        F.concat(F.lit("S"), seven.cast("string")).alias("status"),
        F.date_format(F.timestamp_add("DAY", F.col("user_id") % 365, ntz("2020-01-01 00:00:00")),
                      ISO_MICROS_Z).alias("opened_at"),
        F.when(seven == 0, F.date_format(F.col("ts"), ISO_MICROS_Z)).alias("closed_at"),
        (seven == 0).alias("is_deleted"),
    )
    before = F.struct(F.col("user_id").alias("card_id"))
    envelope = F.struct(
        F.when(op == "d", before).alias("before"),
        F.when(op != "d", after).alias("after"),
        op.alias("op"),
        epoch_millis(F.col("ts")).alias("ts_ms"),
    )
    value = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(envelope.alias("payload")))) \
        .otherwise(F.to_json(envelope))
    return e.select(
        F.lit(TOPIC_CARD).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        value.alias("value"),
    )


def txn_change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One insert (or snapshot read for purchases) per event on the transaction topic."""
    j = _spread(table(spark, sf_dir, "events").select(*_txn_columns(), "event_type", "value"))
    after = F.struct(
        F.col("txn_id"), F.col("card_id"), F.col("terminal_id"),
        F.date_format(F.col("txn_ts"), ISO_MICROS_Z).alias("txn_ts"),
        F.col("value").alias("amount"),  # decimals travel as JSON doubles
        F.col("currency_code"), F.col("txn_type"), F.col("status"),
    )
    envelope = F.struct(
        F.lit(None).cast("string").alias("before"),
        after.alias("after"),
        F.when(F.col("event_type") == "purchase", "r").otherwise("c").alias("op"),
        epoch_millis(F.col("txn_ts")).alias("ts_ms"),
    )
    return j.select(
        F.lit(TOPIC_TXN).alias("topic"),
        (F.col("txn_id") % 3).cast("int").alias("partition"),
        F.col("txn_id").alias("offset"),
        F.col("txn_ts").alias("timestamp"),
        F.to_json(envelope).alias("value"),
    )


def noise_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats and another entity's topic (from supplier) and malformed
    values (from region): everything the router must skip."""
    s = table(spark, sf_dir, "supplier")
    r = table(spark, sf_dir, "region")
    ts = F.timestamp_add("HOUR", F.col("s_suppkey"), ntz("2024-01-01 00:00:00"))
    heartbeat = s.select(
        F.lit(TOPIC_HEARTBEAT).alias("topic"), F.lit(0).alias("partition"),
        F.col("s_suppkey").alias("offset"), ts.alias("timestamp"),
        F.to_json(F.struct(epoch_millis(ts).alias("ts_ms"))).alias("value"))
    other = s.select(
        F.lit(TOPIC_TERMINAL).alias("topic"), F.lit(0).alias("partition"),
        F.col("s_suppkey").alias("offset"), ts.alias("timestamp"),
        F.to_json(F.struct(
            F.lit(None).cast("string").alias("before"),
            F.struct(F.col("s_suppkey").alias("terminal_id")).alias("after"),
            F.lit("c").alias("op"), epoch_millis(ts).alias("ts_ms"))).alias("value"))
    malformed = r.select(
        F.lit(TOPIC_CARD).alias("topic"), F.lit(3).alias("partition"),
        F.col("r_regionkey").cast("long").alias("offset"),
        ntz("2024-01-01 00:00:00").alias("timestamp"),
        F.concat(F.lit("{not json "), F.col("r_name")).alias("value"))
    return heartbeat.unionByName(other).unionByName(malformed)


def cdc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole change stream as Kafka-shaped rows."""
    return (card_change_records(spark, sf_dir)
            .unionByName(txn_change_records(spark, sf_dir))
            .unionByName(noise_records(spark, sf_dir)))


def offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """End and committed offsets per (topic, partition) from events: end is
    max(event_id)+1 per (event_type, user_id % 3); committed is the same over
    events whose id does not end in 9 (a consumer that is a little behind)."""
    e = table(spark, sf_dir, "events").select(
        F.concat(F.lit("bankcdc.bank."), F.col("event_type")).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id"))
    end = e.groupBy("topic", "partition").agg((F.max("event_id") + 1).alias("end_offset"))
    committed = (e.filter(F.col("event_id") % 10 != 9).groupBy("topic", "partition")
                 .agg((F.max("event_id") + 1).alias("committed_offset")))
    return end, committed
