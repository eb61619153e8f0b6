"""Registered queries: one per operator of the coverage checklist.

Each entry takes ``(spark, sf_dir)``, reads the driver's parquet tables
through ``vaultline.bindings`` and returns a DataFrame whose columns match
its DuckDB twin in ``vaultline.plans.oracle``. Outputs are made comparable
across engines at this boundary only: decimals leave as doubles and dates as
ISO text; timestamps stay TIMESTAMP_NTZ and load times are a fixed literal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline import bindings as B
from vaultline.functions.columns import ntz
from vaultline.operators import (cdc, facts, fraud, lifecycle, monitoring, quality, relational,
                                 scd2, staging)
from vaultline.operators import incremental as inc, intervals
from vaultline.plans import jobs
from vaultline.session import scratch_path
from vaultline.sinks import scd2_table
from vaultline.sinks.tables import TableStore, materialize, with_month
from vaultline.streaming import landing
from vaultline.schemas import (ACCOUNT_NUMBER_MAX_LEN, ACCOUNT_STATUSES, AMOUNT_PRECISION,
                               AMOUNT_SCALE, CARD_NUMBER_MAX_LEN, CARD_STATUSES, CURRENCIES,
                               CURRENCY_LEN, LAG_THRESHOLD, NOT_NULL, TXN_STATUSES, TXN_TYPES)
from vaultline.sources.extract import extract_incremental, extract_snapshot

LOAD_TS = "2025-01-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared inputs: source frames and their warehouse (raw) extracts
# ---------------------------------------------------------------------------

def raw(spark, sf_dir, entity):
    src = {"customer": B.customer, "account": B.account, "card": B.card,
           "terminal": B.terminal, "transaction": B.transaction}[entity](spark, sf_dir)
    return extract_snapshot(src, entity)


# ---------------------------------------------------------------------------
# JN1 star fact
# ---------------------------------------------------------------------------

@query("fact_atm_transaction")
def q_fact(spark, sf_dir):
    """JN1: the denormalised ATM-transaction fact (flagship query)."""
    return facts.fact_atm_transaction(
        raw(spark, sf_dir, "transaction"), raw(spark, sf_dir, "card"),
        raw(spark, sf_dir, "account"), raw(spark, sf_dir, "customer"),
        raw(spark, sf_dir, "terminal"), ts=LOAD_TS)


@query("fact_unmatched_defaults")
def q_fact_defaults(spark, sf_dir):
    """T10: unmatched dimension columns filled with ''/0."""
    return facts.fact_atm_transaction(
        raw(spark, sf_dir, "transaction"), raw(spark, sf_dir, "card"),
        raw(spark, sf_dir, "account"), raw(spark, sf_dir, "customer"),
        raw(spark, sf_dir, "terminal"), unmatched="default", ts=LOAD_TS)


@query("fact_atm_transaction_volume")
def q_fact_volume(spark, sf_dir):
    """JN1 over the high-volume (lineitem) transactions."""
    txn = extract_snapshot(B.transaction_volume(spark, sf_dir), "transaction")
    return facts.fact_atm_transaction(
        txn, raw(spark, sf_dir, "card"), raw(spark, sf_dir, "account"),
        raw(spark, sf_dir, "customer"), raw(spark, sf_dir, "terminal"), ts=LOAD_TS)


# ---------------------------------------------------------------------------
# PRJ1 staging views, PRJ2 dimensions, SRC1 extracts
# ---------------------------------------------------------------------------

def _register_projections():
    for entity in ("customer", "account", "card", "terminal", "transaction"):
        def stg(spark, sf_dir, entity=entity):
            return staging.stage(raw(spark, sf_dir, entity), entity)
        stg.__doc__ = f"PRJ1: staging projection of {entity}."
        query(f"stg_{entity}")(stg)
    for entity in ("customer", "account", "card", "terminal"):
        def dim(spark, sf_dir, entity=entity):
            return staging.dimension(raw(spark, sf_dir, entity), entity, ts=LOAD_TS)
        dim.__doc__ = f"PRJ2: ods dimension of {entity}."
        query(f"dim_{entity}")(dim)


_register_projections()


@query("extract_snapshot_flags")
def q_extract_flags(spark, sf_dir):
    """SRC1: terminal snapshot, booleans to 0/1."""
    return extract_snapshot(B.terminal(spark, sf_dir), "terminal")


@query("active_cards")
def q_active_cards(spark, sf_dir):
    """JN2 + FLT1 on the source frames."""
    return facts.active_cards(B.card(spark, sf_dir), B.account(spark, sf_dir),
                              B.customer(spark, sf_dir))


@query("active_terminals")
def q_active_terminals(spark, sf_dir):
    """FLT1 on terminals."""
    return staging.active(B.terminal(spark, sf_dir), "terminal").select(
        "terminal_id", "terminal_code", "city")


@query("customers_without_active_accounts")
def q_no_active(spark, sf_dir):
    """JN3 (anti-join form)."""
    return facts.customers_without_active_accounts(B.customer(spark, sf_dir),
                                                   B.account(spark, sf_dir))


@query("customers_without_active_accounts_having")
def q_no_active_having(spark, sf_dir):
    """JN3 + AG2 (LEFT JOIN ... GROUP BY ... HAVING count = 0 form)."""
    return facts.customers_without_active_accounts(B.customer(spark, sf_dir),
                                                   B.account(spark, sf_dir), literal=True)


# ---------------------------------------------------------------------------
# Incremental core
# ---------------------------------------------------------------------------

# earlier load: everything before this instant was loaded by a previous run
PREVIOUS_RUN = "2024-01-15 00:00:00"


@query("high_watermark")
def q_high_watermark(spark, sf_dir):
    """AG1: max(txn_id) with default 0."""
    return inc.high_watermark(raw(spark, sf_dir, "transaction"), "txn_id", 0, alias="last_id")


@query("high_watermark_empty")
def q_high_watermark_empty(spark, sf_dir):
    """AG1 / T1: an empty target yields the default, not NULL."""
    empty = raw(spark, sf_dir, "transaction").filter(F.col("txn_id") < 0)
    return inc.high_watermark(empty, "txn_id", 0, alias="last_id")


@query("extract_incremental_txn")
def q_extract_incremental(spark, sf_dir):
    """SRC3: transactions above the watermark of the previous run's target."""
    src = raw(spark, sf_dir, "transaction")
    target = src.filter(F.col("txn_ts") < ntz(PREVIOUS_RUN))
    last = inc.read_high_watermark(target, "txn_id", 0)
    return extract_incremental(src, "txn_id", last)


@query("delta_by_updated_at")
def q_delta(spark, sf_dir):
    """INC1: customers changed after the target's max(updated_at)."""
    src = raw(spark, sf_dir, "customer")
    target = src.filter(F.col("updated_at") < ntz("2024-01-01 12:00:00"))
    return inc.delta(src, target, "updated_at")


def _accounts_before(spark, sf_dir, cut):
    """Target state of the account table as loaded at ``cut``: rows opened
    before ``cut`` in their original (open) state."""
    acc = raw(spark, sf_dir, "account")
    return (acc.filter(F.col("opened_at") < ntz(cut))
               .withColumn("status", F.lit("active"))
               .withColumn("closed_at", F.lit(None).cast("timestamp_ntz"))
               .withColumn("is_deleted", F.lit(0))
               .withColumn("updated_at", F.col("opened_at")))


ACCOUNT_CUT = "1998-01-01 00:00:00"


@query("upsert_by_key")
def q_upsert(spark, sf_dir):
    """INC2: replace changed accounts, keep the rest, add new ones."""
    target = _accounts_before(spark, sf_dir, ACCOUNT_CUT)
    src = raw(spark, sf_dir, "account")
    batch = src.filter(F.col("updated_at") >= ntz(ACCOUNT_CUT))
    return inc.upsert(target, batch, "account_id", order=["updated_at"])


@query("latest_per_key")
def q_latest(spark, sf_dir):
    """AG3: latest change per card from the change log (ties by offset)."""
    landed = cdc.land_cards(cdc.decode_envelope(B.card_change_records(spark, sf_dir)), ts=LOAD_TS)
    return inc.latest_per_key(landed.select("card_id", "op", "src_ts", "kafka_partition",
                                            "kafka_offset"),
                              "card_id", ["src_ts", "kafka_partition", "kafka_offset"])


def _ctl_rows(spark, sf_dir):
    """Control rows a daily loader would have written: one per day of
    transactions with that day's max id, stamped at the end of the day. The
    names are carried by the days' rows, so a filter on them reads the rows."""
    t = raw(spark, sf_dir, "transaction")
    day = F.to_date("txn_ts")
    return (t.groupBy(day.alias("d")).agg(F.max("txn_id").alias("last_id"))
             # strings are sorted to be aggregated: of the few days only
             .groupBy("d").agg(F.max("last_id").alias("last_id"), F.max(F.lit("pg_to_dwh")).alias("process_name"),
                               F.max(F.lit("transaction")).alias("src_table"))
             .select("process_name", "src_table", "last_id",
                     F.timestamp_add("DAY", F.lit(1), F.col("d").cast("timestamp_ntz"))
                     .alias("updated_at")))


@query("read_watermark")
def q_read_watermark(spark, sf_dir):
    """ST2: latest control row for (process, table), default 0."""
    return inc.read_watermark(_ctl_rows(spark, sf_dir), "pg_to_dwh", "transaction")


@query("read_watermark_missing")
def q_read_watermark_missing(spark, sf_dir):
    """ST2: no control row for the table yields the default."""
    return inc.read_watermark(_ctl_rows(spark, sf_dir), "pg_to_dwh", "card", default=0)


# ---------------------------------------------------------------------------
# CDC decode, landing, SCD2
# ---------------------------------------------------------------------------

@query("cdc_decode")
def q_cdc_decode(spark, sf_dir):
    """CDC1/CDC6: envelope unwrap over the whole stream (incl. noise)."""
    d = cdc.decode_envelope(B.cdc_records(spark, sf_dir))
    return d.select("topic", "partition", "offset", "op", "src_ts", "decoded")


@query("cdc_route_ops")
def q_cdc_route(spark, sf_dir):
    """CDC2-CDC5, FLT2/FLT4: accepted rows per routed entity and op."""
    d = cdc.decode_envelope(B.cdc_records(spark, sf_dir))
    cards = cdc.land_cards(d, ts=LOAD_TS).select(F.lit("card").alias("kind"), "op")
    txns = cdc.land_transactions(d, ts=LOAD_TS).select(F.lit("transaction").alias("kind"), "op")
    return cards.unionByName(txns).groupBy("kind", "op").agg(F.count("*").alias("n"))


def landed_cards(spark, sf_dir):
    return cdc.land_cards(cdc.decode_envelope(B.cdc_records(spark, sf_dir)), ts=LOAD_TS)


def landed_txns(spark, sf_dir):
    return cdc.land_transactions(cdc.decode_envelope(B.cdc_records(spark, sf_dir)), ts=LOAD_TS)


@query("cdc_landing_card")
def q_landing_card(spark, sf_dir):
    """SNK5 rows of the card landing table."""
    return landed_cards(spark, sf_dir).select("kafka_partition", "kafka_offset", "op",
                                              "card_id", "src_ts")


@query("cdc_dedupe")
def q_cdc_dedupe(spark, sf_dir):
    """STR2: a replay of the last day of the log is collapsed by log position."""
    landed = landed_cards(spark, sf_dir)
    replay = landed.filter(F.col("src_ts") >= ntz("2024-01-29 00:00:00"))
    return cdc.dedupe_log(landed.unionByName(replay)).select(
        "kafka_partition", "kafka_offset", "op", "card_id", "src_ts")


@query("raw_transaction_cdc")
def q_raw_txn_cdc(spark, sf_dir):
    """CDC7 + INC2: typed inserts from the stored landing table; a first run,
    then the rows that were landed after it, whatever their ids."""
    store = _store(spark, "raw-txn-cdc")
    store.overwrite("stg_cdc_transaction", landed_txns(spark, sf_dir))
    landed = store.read("stg_cdc_transaction")
    first = cdc.raw_transaction_cdc(landed.filter(F.col("src_ts") < ntz(PREVIOUS_RUN)),
                                    ts=LOAD_TS)
    later = F.coalesce(F.col("src_ts") >= ntz(PREVIOUS_RUN), F.lit(True))
    batch = cdc.raw_transaction_cdc(landed.filter(later), ts=LOAD_TS)
    return inc.upsert(first, batch, "txn_id")


def stored_cards(spark, sf_dir):
    """The landing table as a landing job leaves it: decoded once, then stored."""
    store = _store(spark, "landing")
    store.overwrite("stg_cdc_card", landed_cards(spark, sf_dir))
    return store.read("stg_cdc_card")


def scd2_card(spark, sf_dir):
    return scd2.scd2_from_landing(stored_cards(spark, sf_dir), ts=LOAD_TS)


def render_valid_to(df: DataFrame) -> DataFrame:
    """The open end 2999-12-31 is outside pandas' nanosecond range, so the
    registered SCD2 outputs carry ``valid_to`` as millisecond ISO text."""
    return df.withColumn("valid_to", F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss.SSS"))


@query("scd2_card")
def q_scd2(spark, sf_dir):
    """S2 (WN1/WN2, CDC8/CDC9) over the card change log."""
    return render_valid_to(scd2_card(spark, sf_dir))


@query("scd2_current")
def q_scd2_current(spark, sf_dir):
    """S3."""
    return render_valid_to(scd2.scd2_current(scd2_card(spark, sf_dir)))


@query("scd2_as_of")
def q_scd2_as_of(spark, sf_dir):
    """S4: the card version valid at each transaction's time."""
    txn = raw(spark, sf_dir, "transaction").select("txn_id", "card_id", "txn_ts")
    out = scd2.as_of(txn, scd2_card(spark, sf_dir), cols=("card_sk", "status", "is_deleted"),
                     prefix="card_")
    return out.withColumnRenamed("card_card_sk", "card_sk")


@query("scd2_version_number")
def q_scd2_rn(spark, sf_dir):
    """WN1: version number per card."""
    v = cdc.card_versions(stored_cards(spark, sf_dir))
    return scd2.version_number(v).select("card_id", "kafka_offset", "rn")


# ---------------------------------------------------------------------------
# Q1-Q5 quality
# ---------------------------------------------------------------------------

@query("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    """Q1: txn_id is not unique in the volume transactions."""
    t = B.transaction_volume(spark, sf_dir)
    return quality.duplicate_keys(t, "txn_id")


@query("unique_violations")
def q_unique_violations(spark, sf_dir):
    """Q1 over the UNIQUE columns of the source schema."""
    return quality.unique_violations([
        ("customer", B.customer(spark, sf_dir), "customer_uuid"),
        ("account", B.account(spark, sf_dir), "account_number"),
        ("card", B.card(spark, sf_dir), "card_number"),
        ("terminal", B.terminal(spark, sf_dir), "terminal_code"),
    ])


@query("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    """Q2: foreign keys without a parent row."""
    txn, card = B.transaction(spark, sf_dir), B.card(spark, sf_dir)
    acc, cust, term = B.account(spark, sf_dir), B.customer(spark, sf_dir), B.terminal(spark, sf_dir)
    return (quality.orphans_many(txn, "txn_id", [
                ("transaction.card_id", "card_id", card, "card_id"),
                ("transaction.terminal_id", "terminal_id", term, "terminal_id")])
            .unionByName(quality.orphans(card, acc, "account_id", "account_id", "card_id",
                                         "card.account_id"))
            .unionByName(quality.orphans(acc, cust, "customer_id", "customer_id", "account_id",
                                         "account.customer_id")))


@query("null_counts")
def q_null_counts(spark, sf_dir):
    """Q3: NULL profile and NOT NULL violations of customer and transaction."""
    return (quality.null_counts(B.customer(spark, sf_dir), "customer",
                                not_null=NOT_NULL["customer"])
            .unionByName(quality.null_counts(B.transaction(spark, sf_dir), "transaction",
                                             not_null=NOT_NULL["transaction"])))


@query("domain_violations")
def q_domain(spark, sf_dir):
    """Q4: enum domains of transactions, accounts, cards and the landed card states."""
    txn, acc, card = B.transaction(spark, sf_dir), B.account(spark, sf_dir), B.card(spark, sf_dir)
    versions = cdc.card_versions(landed_cards(spark, sf_dir))
    return (quality.domain_violations(txn, "transaction",
                                      {"txn_type": TXN_TYPES, "status": TXN_STATUSES})
            .unionByName(quality.domain_violations(acc, "account",
                                                   {"status": ACCOUNT_STATUSES,
                                                    "currency_code": CURRENCIES}))
            .unionByName(quality.domain_violations(card, "card", "status", CARD_STATUSES))
            .unionByName(quality.domain_violations(versions, "card_scd2", "status",
                                                   CARD_STATUSES)))


@query("length_violations")
def q_length(spark, sf_dir):
    """Q5: CHAR(3), VARCHAR(34/16) and NUMERIC(18,2) limits."""
    acc, card = B.account(spark, sf_dir), B.card(spark, sf_dir)
    vol = B.transaction_volume(spark, sf_dir)
    return (quality.length_violations(acc, "account", {
                "currency_code": ("eq", CURRENCY_LEN),
                "account_number": ("max", ACCOUNT_NUMBER_MAX_LEN),
                "daily_transfer_limit": ("int_digits", AMOUNT_PRECISION - AMOUNT_SCALE)})
            .unionByName(quality.length_violations(card, "card", {
                "card_number": ("max", CARD_NUMBER_MAX_LEN)}))
            .unionByName(quality.length_violations(vol, "transaction", {
                "currency_code": ("eq", CURRENCY_LEN),
                "amount": ("int_digits", AMOUNT_PRECISION - AMOUNT_SCALE)})))


# ---------------------------------------------------------------------------
# AG4, M1, M2 monitoring
# ---------------------------------------------------------------------------

GROUP_ID = "dwh_cdc_v1"


@query("kafka_lag")
def q_kafka_lag(spark, sf_dir):
    """AG4: lag per (topic, partition)."""
    end, committed = B.offsets(spark, sf_dir)
    return monitoring.kafka_lag(end, committed)


@query("lag_metrics")
def q_lag_metrics(spark, sf_dir):
    """M1: metric rows with JSON labels."""
    end, committed = B.offsets(spark, sf_dir)
    return monitoring.lag_metrics(monitoring.kafka_lag(end, committed), GROUP_ID, ts=LOAD_TS)


@query("lag_alert")
def q_lag_alert(spark, sf_dir):
    """M2: threshold check on the total lag."""
    end, committed = B.offsets(spark, sf_dir)
    m = monitoring.lag_metrics(monitoring.kafka_lag(end, committed), GROUP_ID, ts=LOAD_TS)
    return monitoring.lag_alert(m, LAG_THRESHOLD)


# ---------------------------------------------------------------------------
# FRD1-FRD3 fraud
# ---------------------------------------------------------------------------

RAPID_WINDOW_S = 6 * 3600      # testdata transactions are hours apart per card
PROBE_GAP_S = 24 * 3600


@query("rapid_withdrawals")
def q_rapid(spark, sf_dir):
    """FRD1: >= 3 withdrawals on >= 2 terminals within 6 h on one card."""
    return fraud.rapid_withdrawals(raw(spark, sf_dir, "transaction"), RAPID_WINDOW_S)


@query("rapid_withdrawal_sessions")
def q_rapid_sessions(spark, sf_dir):
    """FRD1 session form (batch twin of the streaming detector), 6 h gap."""
    return fraud.rapid_withdrawal_sessions(raw(spark, sf_dir, "transaction"), RAPID_WINDOW_S)


@query("used_after_block")
def q_used_after_block(spark, sf_dir):
    """FRD2: transactions after the card was blocked/closed."""
    return fraud.used_after_block(raw(spark, sf_dir, "transaction"), B.card(spark, sf_dir))


@query("used_after_block_versions")
def q_used_after_block_versions(spark, sf_dir):
    """FRD2 on the card's versions; S0 is the closed state in the change log."""
    return fraud.used_after_block_versions(raw(spark, sf_dir, "transaction"),
                                           scd2_card(spark, sf_dir), statuses=("S0",))


@query("amount_probe")
def q_amount_probe(spark, sf_dir):
    """FRD3 keyed by card (testdata has no same-terminal runs), gaps <= 24 h."""
    return fraud.amount_probe(raw(spark, sf_dir, "transaction"), keys=("card_id",),
                              max_gap_s=PROBE_GAP_S)


@query("amount_probe_card_terminal")
def q_amount_probe_ct(spark, sf_dir):
    """FRD3 with the reference's key (card, terminal); on this data with gaps of 30 days."""
    return fraud.amount_probe(raw(spark, sf_dir, "transaction"), max_gap_s=30 * 86_400)


# ---------------------------------------------------------------------------
# LC1-LC5 lifecycle
# ---------------------------------------------------------------------------

CLOSE_TS = "2024-02-01 00:00:00"
CARD_STATE = ["card_id", "status", "is_deleted", "closed_at", "updated_at"]


@query("close_cards")
def q_close_cards(spark, sf_dir):
    """LC1: close every card that has a declined transaction."""
    keys = B.transaction(spark, sf_dir).filter(F.col("status") == "declined").select("card_id")
    return lifecycle.close_cards(B.card(spark, sf_dir), keys, ts=CLOSE_TS).select(*CARD_STATE)


@query("close_accounts_cascade")
def q_close_accounts(spark, sf_dir):
    """LC2 + JN6: close blocked accounts and cascade to their active cards."""
    acc, card = B.account(spark, sf_dir), B.card(spark, sf_dir)
    keys = acc.filter(F.col("status") == "blocked").select("account_id")
    a, c = lifecycle.close_accounts(acc, card, keys, ts=CLOSE_TS)
    cols = ["status", "is_deleted", "closed_at", "updated_at"]
    return (a.select(F.lit("account").alias("entity"), F.col("account_id").alias("id"), *cols)
            .unionByName(c.select(F.lit("card").alias("entity"), F.col("card_id").alias("id"),
                                  *cols)))


@query("close_customers")
def q_close_customers(spark, sf_dir):
    """LC3: close live customers without active accounts."""
    return lifecycle.close_customers(B.customer(spark, sf_dir), B.account(spark, sf_dir),
                                     ts=CLOSE_TS).select("customer_id", "is_deleted", "updated_at")


@query("close_terminals")
def q_close_terminals(spark, sf_dir):
    """LC4: retire terminals that never served a transaction."""
    term = B.terminal(spark, sf_dir)
    used = B.transaction(spark, sf_dir).select("terminal_id")
    idle = term.join(used, "terminal_id", "left_anti").select("terminal_id")
    return lifecycle.close_terminals(term, idle, ts=CLOSE_TS).select(
        "terminal_id", "is_working", "is_deleted", "updated_at")


@query("block_cards")
def q_block_cards(spark, sf_dir):
    """LC5: block the cards flagged by the rapid-withdrawal detector."""
    flagged = fraud.rapid_withdrawals(raw(spark, sf_dir, "transaction"), RAPID_WINDOW_S)
    return lifecycle.block_cards(B.card(spark, sf_dir), flagged, ts=CLOSE_TS).select(*CARD_STATE)


# ---------------------------------------------------------------------------
# JN4, JN5, WN3, ST1-ST4
# ---------------------------------------------------------------------------

@query("fan_out")
def q_fan_out(spark, sf_dir):
    """JN4: 1-2 cards per account (1 + account_id % 2)."""
    acc = B.account(spark, sf_dir).select("account_id")
    return relational.fan_out(acc, 1 + F.col("account_id") % 2).select("account_id", "seq")


@query("lateral_top1")
def q_lateral_top1(spark, sf_dir):
    """JN5: latest transaction of every card (NULLs when none)."""
    card = B.card(spark, sf_dir).select("card_id")
    txn = raw(spark, sf_dir, "transaction")
    return relational.latest_child_per_parent(card, txn, "card_id", ["txn_ts", "txn_id"],
                                      ["txn_id", "txn_ts", "terminal_id"], prefix="last_")


@query("global_row_id")
def q_global_row_id(spark, sf_dir):
    """WN3: row_number() OVER (ORDER BY txn_ts, txn_id) over all transactions."""
    t = raw(spark, sf_dir, "transaction").select("txn_id", "txn_ts")
    return relational.global_row_id(t, ["txn_ts", "txn_id"]).select("txn_id", "row_id")


@query("sample_k")
def q_sample_k(spark, sf_dir):
    """ST3: reproducible sample of 25 transactions (seed 42)."""
    t = raw(spark, sf_dir, "transaction").select("txn_id", "card_id", "amount")
    return relational.sample_k(t, 25, 42, "txn_id")


@query("first_n_by_id")
def q_first_n(spark, sf_dir):
    """ST1 + ST4: ORDER BY txn_id LIMIT 500."""
    t = raw(spark, sf_dir, "transaction").select("txn_id", "card_id", "txn_ts")
    return relational.first_n(t, 500, ["txn_id"])


# ---------------------------------------------------------------------------
# SNK1-SNK4, SNK7 writers and INC4-INC6 jobs (write to the shared warehouse
# folder named by the session, then read back)
# ---------------------------------------------------------------------------

def _store(spark, name):
    return TableStore(spark, scratch_path(spark, name))


@query("full_refresh_roundtrip")
def q_full_refresh(spark, sf_dir):
    """SNK1: two full refreshes of the customer dimension; readers get the last."""
    store = _store(spark, "full-refresh")
    cust = raw(spark, sf_dir, "customer")
    store.overwrite("ods_dim_customer", staging.dim_customer(
        cust.filter(F.col("updated_at") < ntz("2024-01-01 12:00:00")), ts=LOAD_TS))
    store.overwrite("ods_dim_customer", staging.dim_customer(cust, ts=LOAD_TS))
    return store.read("ods_dim_customer")


@query("append_roundtrip")
def q_append(spark, sf_dir):
    """SNK2: two appends of staged transactions."""
    store = _store(spark, "append")
    t = staging.stg_transaction(raw(spark, sf_dir, "transaction"))
    store.append("raw_transaction", t.filter(F.col("txn_ts") < ntz(PREVIOUS_RUN)))
    store.append("raw_transaction", t.filter(F.col("txn_ts") >= ntz(PREVIOUS_RUN)))
    return store.read("raw_transaction")


def _volume_fact_store(spark, sf_dir):
    store = _store(spark, "monthly")
    t = extract_snapshot(B.transaction_volume(spark, sf_dir), "transaction")
    store.overwrite("raw_transaction", with_month(t), partition_by="txn_month", sort_by="txn_id")
    return store


@query("partition_month_counts")
def q_month_counts(spark, sf_dir):
    """SNK3/SNK4: month-partitioned, key-ordered write; per-month totals read back."""
    store = _volume_fact_store(spark, sf_dir)
    return (store.read("raw_transaction").groupBy("txn_month")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount_total")))


@query("partition_range_read")
def q_range_read(spark, sf_dir):
    """Partition-pruned range read of the month-partitioned table."""
    store = _volume_fact_store(spark, sf_dir)
    return store.read_between("raw_transaction", "txn_ts", "1995-01-01 00:00:00",
                              "1995-07-01 00:00:00").select("txn_id", "card_id", "txn_ts",
                                                            "amount", "txn_month")


@query("partitioned_upsert")
def q_partitioned_upsert(spark, sf_dir):
    """INC2 on a month-partitioned table: only touched months are rewritten."""
    store = _store(spark, "partitioned-upsert")
    target = _accounts_before(spark, sf_dir, ACCOUNT_CUT)
    store.overwrite("raw_account", with_month(target, "opened_at", "open_month"),
                    partition_by="open_month")
    batch = raw(spark, sf_dir, "account").filter(F.col("updated_at") >= ntz(ACCOUNT_CUT))
    store.upsert("raw_account", with_month(batch, "opened_at", "open_month"), "account_id",
                 order=["updated_at"], partition_by="open_month")
    return store.read("raw_account")


@query("materialize_incremental")
def q_materialize(spark, sf_dir):
    """SNK7 + INC3: first run builds the table, the next run is incremental."""
    store = _store(spark, "materialize")
    card = raw(spark, sf_dir, "card")
    first = card.filter(F.col("updated_at") < ntz("2024-01-01 00:00:00"))
    materialize(first, "raw_card", "incremental", store, keys="card_id", order=["updated_at"])
    target = store.read("raw_card")
    return materialize(inc.delta(card, target, "updated_at"), "raw_card", "incremental", store,
                       keys="card_id", order=["updated_at"])


def _old_cards(spark, sf_dir):
    """The card source as it was before the 2024-01-15 closes and blocks."""
    c = B.card(spark, sf_dir)
    return (c.withColumn("status", F.lit("active"))
             .withColumn("closed_at", F.lit(None).cast("timestamp_ntz"))
             .withColumn("is_deleted", F.lit(False))
             .withColumn("updated_at", F.col("opened_at")))


@query("dim_load_run")
def q_dim_load(spark, sf_dir):
    """INC6: stg -> raw (delta + upsert) -> ods for cards, an old then the current source."""
    store = _store(spark, "dim-load")
    jobs.run_dim_load(store, "card", _old_cards(spark, sf_dir), ts=LOAD_TS)
    jobs.run_dim_load(store, "card", B.card(spark, sf_dir), ts=LOAD_TS)
    return store.read("ods_dim_card")


def _load_dims(store, spark, sf_dir):
    jobs.run_dim_loads(store, {"customer": B.customer(spark, sf_dir),
                               "account": B.account(spark, sf_dir),
                               "card": B.card(spark, sf_dir),
                               "terminal": B.terminal(spark, sf_dir)}, ts=LOAD_TS)


@query("incremental_fact_run")
def q_txn_load(spark, sf_dir):
    """INC4/INC5: dims, then two incremental transaction loads and an idempotent
    re-run; the month-partitioned fact read back."""
    store = _store(spark, "txn-load")
    _load_dims(store, spark, sf_dir)
    txn = B.transaction(spark, sf_dir)
    jobs.run_txn_load(store, txn.filter(F.col("txn_ts") < ntz(PREVIOUS_RUN)), ts=LOAD_TS)
    jobs.run_txn_load(store, txn, ts=LOAD_TS)
    jobs.run_txn_load(store, txn, ts=LOAD_TS)
    return store.read(jobs.FACT)


# ---------------------------------------------------------------------------
# STR1-STR5 streaming landing and the CDC model run
# ---------------------------------------------------------------------------

def _land_stream(spark, sf_dir):
    root = scratch_path(spark, "cdc-stream")
    src = f"{root}/source"
    B.cdc_records(spark, sf_dir).write.json(src)
    stream = landing.read_cdc_stream(spark, fmt="json", path=src, max_per_trigger=8)
    q = landing.start_landing(stream, f"{root}/stg_cdc_card", f"{root}/stg_cdc_transaction",
                              f"{root}/_checkpoint", reject_path=f"{root}/cdc_rejects",
                              ts=LOAD_TS)
    q.awaitTermination()
    return (root, landing.read_landing(spark, f"{root}/stg_cdc_card"),
            landing.read_landing(spark, f"{root}/stg_cdc_transaction"))


@query("cdc_stream_landing")
def q_stream_landing(spark, sf_dir):
    """STR1-STR4: availableNow file stream -> foreachBatch fan-out -> landing."""
    _, cards, _ = _land_stream(spark, sf_dir)
    return cards.select("kafka_partition", "kafka_offset", "op", "card_id", "src_ts")


@query("cdc_models_run")
def q_cdc_models(spark, sf_dir):
    """CDC10/STR5: stream-landed log -> raw_transaction_cdc, card SCD2 and the
    fact over the loaded raw layer; one row per row of each model."""
    root, cards, txns = _land_stream(spark, sf_dir)
    store = TableStore(spark, f"{root}/warehouse")
    _load_dims(store, spark, sf_dir)
    jobs.run_txn_load(store, B.transaction(spark, sf_dir), ts=LOAD_TS)
    jobs.run_cdc_models(store, cards, txns, ts=LOAD_TS)
    cols = ["txn_id", "card_id", "terminal_id", "txn_ts", "amount", "currency_code", "txn_type",
            "status", "loaded_at"]
    out = None
    for name in ("raw_transaction_cdc", jobs.FACT, "ods_dim_card_scd2"):
        df = jobs.read_card_scd2(store) if name == "ods_dim_card_scd2" else store.read(name)
        df = df.select("card_id", F.col("valid_from").alias("txn_ts"), "status", "loaded_at",
                       "is_current") if name == "ods_dim_card_scd2" else df.select(cols)
        df = df.withColumn("model", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


@query("metrics_sink_roundtrip")
def q_metrics_sink(spark, sf_dir):
    """SNK6: lag metrics appended to the metrics table by two monitoring runs."""
    store = _store(spark, "metrics")
    end, committed = B.offsets(spark, sf_dir)
    lag = monitoring.kafka_lag(end, committed)
    monitoring.write_metrics(store, monitoring.lag_metrics(lag, GROUP_ID, ts=LOAD_TS))
    monitoring.write_metrics(store, monitoring.lag_metrics(lag, GROUP_ID, ts=CLOSE_TS))
    return store.read("ctl_monitoring")


@query("scd2_invariants")
def q_scd2_invariants(spark, sf_dir):
    """S2 invariants over a dimension with planted faults: closed versions of
    every fifth card end a second late, every seventh card lost its current one."""
    late = (F.col("card_id") % 5 == 0) & (F.col("is_current") == 0)
    dim = scd2_card(spark, sf_dir)
    dim = dim.withColumn("valid_to", F.when(late, F.timestamp_add("SECOND", F.lit(1), "valid_to"))
                         .otherwise(F.col("valid_to"))) \
        .withColumn("is_current", F.when(F.col("card_id") % 7 == 0, 0).otherwise(F.col("is_current")))
    return scd2.check_invariants(dim)


@query("raw_transaction_cdc_rejects")
def q_txn_rejects(spark, sf_dir):
    """T15: landed inserts whose txn_ts does not parse (planted in one of 97)."""
    bad = F.concat(F.lit('{"txn_ts":"'), F.col("txn_id").cast("string"), F.lit(' is no time"}'))
    landed = landed_txns(spark, sf_dir)
    return cdc.raw_transaction_cdc_rejects(landed.withColumn(
        "payload_after", F.when(F.col("txn_id") % 97 == 0, bad).otherwise(F.col("payload_after"))))


@query("scd2_incremental")
def q_scd2_incremental(spark, sf_dir):
    """S2 kept batch by batch in a stored dimension: the log before the cut,
    then the later rows; equals the full build."""
    versions = cdc.card_versions(stored_cards(spark, sf_dir))
    store = _store(spark, "scd2-incremental")
    for batch, late in enumerate((F.col("src_ts") < ntz(PREVIOUS_RUN), F.col("src_ts") >= ntz(PREVIOUS_RUN))):
        scd2_table.apply_batch(store, "ods_dim_card_scd2", versions.filter(late), batch, ts=LOAD_TS)
    return render_valid_to(scd2_table.read_dimension(store, "ods_dim_card_scd2"))


@query("model_run")
def q_model_run(spark, sf_dir):
    """Model-driven path: stg reload -> raw by each table's own watermark ->
    ods + fact; a first run on the older transactions, then the full source."""
    store = _store(spark, "model-run")
    sources = {"customer": B.customer(spark, sf_dir), "account": B.account(spark, sf_dir),
               "card": B.card(spark, sf_dir), "terminal": B.terminal(spark, sf_dir)}
    txn = B.transaction(spark, sf_dir)
    jobs.run_models(store, {**sources, "transaction": txn.filter(F.col("txn_ts") <
                                                                ntz(PREVIOUS_RUN))}, ts=LOAD_TS)
    jobs.run_models(store, {**sources, "transaction": txn}, ts=LOAD_TS)
    return store.read(jobs.FACT)


@query("fact_incremental_refresh")
def q_fact_incremental(spark, sf_dir):
    """Incremental fact maintenance: a first load with the cards before their
    closes and the older transactions, then a later load where the card
    changes and the new transactions are re-joined and upserted into their
    months only; equals the fact over the current state (load time dropped,
    since untouched rows keep the first run's)."""
    store = _store(spark, "fact-refresh")
    t1, t2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"
    for entity, src in (("customer", B.customer), ("account", B.account),
                        ("terminal", B.terminal)):
        jobs.run_dim_load(store, entity, src(spark, sf_dir), ts=t1)
    jobs.run_dim_load(store, "card", _old_cards(spark, sf_dir), ts=t1)
    txn = B.transaction(spark, sf_dir)
    jobs.run_txn_load(store, txn.filter(F.col("txn_ts") < ntz(PREVIOUS_RUN)), ts=t1)
    jobs.run_dim_load(store, "card", B.card(spark, sf_dir), ts=t2)
    jobs.run_txn_load(store, txn, ts=t2)
    return store.read(jobs.FACT).drop("loaded_at")


@query("rapid_withdrawals_stream")
def q_rapid_stream(spark, sf_dir):
    """FRD1 as a stateful stream (applyInPandasWithState): transactions
    replayed week by week (long weeks in slices) in event-time order; equals the batch detector."""
    from vaultline.streaming.fraud import rapid_withdrawals_stream, state_tasks, write_in_time_order
    root = scratch_path(spark, "rapid-stream")
    txn = raw(spark, sf_dir, "transaction")
    write_in_time_order(txn, f"{root}/source", unit="week")
    stream = (spark.readStream.schema(txn.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{root}/source"))
    out = rapid_withdrawals_stream(stream, window_s=RAPID_WINDOW_S, lateness_s=86400)
    with state_tasks(spark):
        q = (out.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", f"{root}/_checkpoint")
                .trigger(availableNow=True).start(f"{root}/flags"))
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/flags")


@query("rapid_withdrawals_events")
def q_rapid_events(spark, sf_dir):
    """FRD1 in linear time (interval start/end events and running sums),
    same rule and result as the range-frame form."""
    return fraud.rapid_withdrawals(raw(spark, sf_dir, "transaction"), RAPID_WINDOW_S,
                                   method="events")


# ---------------------------------------------------------------------------
# Offsets from the landing stream, footers, large k
# ---------------------------------------------------------------------------

@query("cdc_offset_breaks")
def q_offset_breaks(spark, sf_dir):
    """AG4/M1: gaps and replays of the drained card topic by its batches' offset
    ranges; the source lacks offsets of some stretches and repeats others."""
    root = scratch_path(spark, "offsets")
    e = B.card_change_records(spark, sf_dir)
    e = e.filter(F.col("offset") % 500 >= 20)
    e.unionByName(e.filter(F.col("offset") % 700 < 9)).write.json(f"{root}/source")
    stream = landing.read_cdc_stream(spark, fmt="json", path=f"{root}/source", max_per_trigger=8)
    landing.start_landing(stream, f"{root}/stg_cdc_card", f"{root}/stg_cdc_transaction", f"{root}/_checkpoint",
                          offsets_path=f"{root}/{landing.CTL_OFFSETS}", ts=LOAD_TS).awaitTermination()
    return monitoring.offset_breaks(spark.read.parquet(f"{root}/{landing.CTL_OFFSETS}")).select(
        "topic", "partition", "kind", "from_offset", "to_offset", "records")


@query("loaded_id_runs")
def q_loaded_runs(spark, sf_dir):
    """INC5: runs of consecutive ids of the transactions loaded before the cut."""
    t = raw(spark, sf_dir, "transaction").filter(F.col("txn_ts") < ntz(PREVIOUS_RUN))
    return intervals.merge(t.select("txn_id"), "txn_id")


@query("footer_watermark")
def q_footer_watermark(spark, sf_dir):
    """AG1 from parquet footers: the highest event id."""
    return inc.footer_watermark(spark, f"{sf_dir}/events.parquet", "event_id", 0, "last_id")


@query("sample_many")
def q_sample_many(spark, sf_dir):
    """ST3 for a large k: two of five transactions, by radix selection."""
    t = raw(spark, sf_dir, "transaction").select("txn_id", "card_id")
    k = t.count() * 2 // 5
    return relational.sample_k(t, k, 42, "txn_id")


@query("clustered_point_read")
def q_clustered(spark, sf_dir):
    """SNK4: the high-volume transactions of the cards of one key range, read
    from files clustered by card and time."""
    store = _store(spark, "clustered")
    t = B.transaction_volume(spark, sf_dir)
    store.overwrite("raw_transaction", t, cluster_by=["card_id", "txn_ts"], rows_per_file=max(1000, t.count() // 32))
    return store.read("raw_transaction").filter("card_id between 100 and 110").groupBy("card_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount_total"))
