"""Composed warehouse jobs (INC4-INC6, CDC10, STR5).

Each job is a handful of Spark jobs over a ``TableStore``; the driver only
handles scalar watermarks and bounded partition-value lists. Every job can
be re-run after a crash at any point with the same result:

* staging is a full refresh into a new version (readers never see it empty);
* raw tables are key upserts, so re-extracting rows already loaded is harmless;
* the watermark is saved after the data, so a crash in between only causes
  a re-extract of rows the upsert absorbs;
* ods tables and the fact are rebuilt as new versions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import month_of, ntz, with_load_ts
from vaultline.operators import cdc, facts, incremental as inc, intervals, scd2, staging
from vaultline.schemas import CURSORS, PRIMARY_KEYS
from vaultline.sinks import scd2_table
from vaultline.sinks.tables import TableStore
from vaultline.sources.extract import extract_snapshot

_EPOCH = dt.datetime(1970, 1, 1)
CTL_LOAD = "ctl_pg_load"
FACT = "ods_fact_atm_transaction"
CTL_RUNS = "ctl_loaded_runs"
CARD_SCD2 = "ods_dim_card_scd2"
FACT_REFRESH, FACT_STATE = "fact_refresh", "fact_refresh_state"
TOUCHED = "stg_fact_touched"


def run_dim_load(store: TableStore, entity: str, source: DataFrame, ts=None) -> None:
    """INC6: snapshot -> stg (full refresh) -> raw (delta + upsert on the
    key) -> ods dimension (rebuild)."""
    stg_name, raw_name = f"stg_{entity}", f"raw_{entity}"
    store.overwrite(stg_name, with_load_ts(extract_snapshot(source, entity), "extracted_at", ts))
    stg = staging.stage(store.read(stg_name), entity)
    target = store.read(raw_name) if store.exists(raw_name) else None
    # rows that share the watermark are taken again; the upsert absorbs them
    batch = inc.delta(stg, target, CURSORS[entity], inclusive=True)
    store.upsert(raw_name, with_load_ts(batch, "loaded_at", ts), PRIMARY_KEYS[entity],
                 order=[CURSORS[entity]])
    store.overwrite(f"ods_dim_{entity}", staging.dimension(store.read(raw_name), entity, ts))


def run_dim_loads(store: TableStore, sources: dict[str, DataFrame], ts=None,
                  parallel: bool = True) -> None:
    """INC6 for several dimensions. They touch disjoint tables, so with
    ``parallel`` their Spark jobs are submitted concurrently from driver
    threads (the 4-way fan-out before the fact load) and share the cluster."""
    if not parallel or len(sources) < 2:
        for entity, src in sources.items():
            run_dim_load(store, entity, src, ts)
        return
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(sources)) as pool:
        futures = [pool.submit(run_dim_load, store, e, src, ts) for e, src in sources.items()]
        for f in futures:
            f.result()          # re-raise the first failure


def last_loaded_id(store: TableStore, process: str, table: str) -> int | None:
    """ST2 on the control table; None before the first run, so the first
    extract takes everything (a default of 0 would silently skip id 0)."""
    if not store.exists(CTL_LOAD):
        return None
    return inc.read_watermark_value(store.read(CTL_LOAD), process, table, None)


def loaded_runs(store: TableStore, process: str, table: str, key: str) -> DataFrame | None:
    """The ids of ``table`` that a process has loaded, as runs (lo, hi); of a
    raw table older than its control table, from its ids. None before the
    first run, so the first extract takes everything."""
    if store.exists(f"{CTL_RUNS}_{process}_{table}"):
        return store.read(f"{CTL_RUNS}_{process}_{table}")
    if store.exists(f"raw_{table}"):
        return intervals.merge(store.read(f"raw_{table}"), key)
    return None


def save_runs(store: TableStore, process: str, table: str, key: str, batch: DataFrame, runs: DataFrame | None) -> None:
    store.overwrite(f"{CTL_RUNS}_{process}_{table}", intervals.merge(batch, key, runs))


def run_txn_load(store: TableStore, source_txn: DataFrame, process: str = "pg_to_dwh",
                 ts=None, lookback: int | None = None, incremental_fact: bool = True) -> int:
    """INC5: loaded id runs -> extract of the ids outside them -> stg -> raw
    upsert (month-partitioned, only touched months rewritten) -> save runs and
    watermark -> refresh the fact (always, even without new rows). Returns the
    new watermark. The source is asked by pushed id ranges, so ids committed
    late, below the watermark, come with the next load; ``lookback`` bounds how
    far below it looks, 0 not at all."""
    runs = loaded_runs(store, process, "transaction", "txn_id")
    extract = extract_snapshot(source_txn, "transaction")
    if runs is not None:
        extract = intervals.unloaded(extract, runs, "txn_id", store.read("raw_transaction"), lookback=lookback)
    store.overwrite("stg_transaction", with_load_ts(extract, "extracted_at", ts))
    stg = staging.stage(store.read("stg_transaction"), "transaction")
    batch = with_load_ts(stg, "loaded_at", ts).withColumn("txn_month", month_of("txn_ts"))
    # transactions are insert-only: a txn_id never changes month
    store.upsert("raw_transaction", batch, "txn_id", partition_by="txn_month",
                 stable_partitions=True)
    save_runs(store, process, "transaction", "txn_id", stg, runs)
    new_last = inc.read_high_watermark(store.read(f"{CTL_RUNS}_{process}_transaction"), "hi")
    if new_last is not None:
        store.append(CTL_LOAD, inc.watermark_row(store.spark, process, "transaction", new_last,
                                                 ts))
    refresh_fact(store, ts, incremental=incremental_fact)
    return new_last


def run_models(store: TableStore, sources: dict[str, DataFrame], ts=None,
               incremental_fact: bool = True) -> None:
    """The model-driven path: full reload of every staging table, then each
    raw table takes the rows from its *own* high-watermark on (updated_at for
    dimensions, txn_id for transactions and the ids below it that raw lacks;
    everything when empty) and upserts them by key, then the ods dimensions and the fact are rebuilt."""
    for entity, source in sources.items():
        stg_name, raw_name = f"stg_{entity}", f"raw_{entity}"
        store.overwrite(stg_name, with_load_ts(extract_snapshot(source, entity), "extracted_at",
                                               ts))
        stg = staging.stage(store.read(stg_name), entity)
        target = store.read(raw_name) if store.exists(raw_name) else None
        runs = loaded_runs(store, "models", entity, "txn_id") if entity == "transaction" else None
        if runs is not None:
            batch = intervals.unloaded(stg, runs, "txn_id", target)
        else:
            batch = inc.delta(stg, target, CURSORS[entity], inclusive=True)
        batch = with_load_ts(batch, "loaded_at", ts)
        if entity == "transaction":
            store.upsert(raw_name, batch.withColumn("txn_month", month_of("txn_ts")), "txn_id",
                         partition_by="txn_month", stable_partitions=True)
            save_runs(store, "models", entity, "txn_id", batch, runs)
        else:
            store.upsert(raw_name, batch, PRIMARY_KEYS[entity], order=[CURSORS[entity]])
            store.overwrite(f"ods_dim_{entity}",
                            staging.dimension(store.read(raw_name), entity, ts))
    refresh_fact(store, ts, incremental=incremental_fact)


def rebuild_fact(store: TableStore, ts=None, cluster_by=None) -> None:
    """JN1 over the raw layer, written month-partitioned and key-ordered; with
    ``cluster_by`` (such as card and time) each month's files are ranges of
    these keys, for reads by card."""
    fact = facts.fact_atm_transaction(
        store.read("raw_transaction"), store.read("raw_card"), store.read("raw_account"),
        store.read("raw_customer"), store.read("raw_terminal"), ts=ts)
    store.overwrite(FACT, fact.withColumn("txn_month", month_of("txn_ts")),
                    partition_by="txn_month", sort_by="txn_id", cluster_by=cluster_by)


def _changes(store: TableStore, marks: dict[str, int], states: dict[str, int]) -> tuple[dict, dict, dict]:
    """What each raw table has that the last refresh did not read: the rows'
    predicate (None if the table has not changed), and the new marks and states.

    A mark is the latest load time among the rows *read*, not a clock: rows
    stamped before a refresh but written after it are above the mark. A table
    written again under the load time of its mark is taken from that time on.
    """
    since, tops, now = {}, {}, {}
    for e in PRIMARY_KEYS:
        table = f"raw_{e}"
        now[table] = store.state(table)
        tops[table] = marks.get(table)
        if states.get(table) == now[table]:
            since[e] = None
            continue
        df, mark = store.read(table), None
        if tops[table] is not None:
            mark = ntz(_EPOCH + dt.timedelta(microseconds=tops[table]))
        newer = df if mark is None else df.filter(F.col("loaded_at") > mark)
        top = inc.read_high_watermark(newer, "loaded_at")
        if top is not None:
            tops[table] = (top - _EPOCH) // dt.timedelta(microseconds=1)
        since[e] = F.lit(True) if mark is None else \
            F.col("loaded_at") > mark if top is not None else F.col("loaded_at") >= mark
    return since, tops, now


def refresh_fact(store: TableStore, ts=None, incremental: bool = True) -> None:
    """Keep the fact equal to JN1 over the raw layer.

    The first refresh (or ``incremental=False``) rebuilds it. Afterwards only
    fact rows that can have changed are recomputed: transactions written since
    the last refresh, and transactions of cards whose card, account or
    customer row -- or of terminals whose row -- was written since then (see
    ``_changes``; a raw table without a change is not read for it). They
    are re-joined and upserted by txn_id into their month partitions, so
    untouched months are not rewritten. The marks are kept in the control
    table; load times of one raw table must not go backwards between runs.
    """
    ctl = store.read(CTL_LOAD) if store.exists(CTL_LOAD) else None
    known = incremental and store.exists(FACT) and ctl is not None
    marks, states = ((inc.read_watermarks(ctl, p) for p in (FACT_REFRESH, FACT_STATE)) if known else ({}, {}))
    since, tops, now = _changes(store, marks, states)
    if not marks:
        rebuild_fact(store, ts)
    elif any(s is not None for s in since.values()):
        none = F.lit(False)
        card, acc = store.read("raw_card"), store.read("raw_account")
        cust, term = store.read("raw_customer"), store.read("raw_terminal")
        txn = store.read("raw_transaction")
        own = none if since["transaction"] is None else since["transaction"]
        since = {e: none if s is None else s for e, s in since.items()}
        acc_hit = (acc.filter(since["account"]).select("account_id")
                   .unionByName(acc.join(cust.filter(since["customer"]).select("customer_id"),
                                         "customer_id", "left_semi").select("account_id")))
        card_hit = (card.filter(since["card"]).select("card_id")
                    .unionByName(card.join(acc_hit, "account_id", "left_semi").select("card_id"))
                    .distinct().withColumn("__card_hit", F.lit(True)))
        term_hit = (term.filter(since["terminal"]).select("terminal_id").distinct()
                    .withColumn("__term_hit", F.lit(True)))
        # one pass over the transactions; the hit sets are broadcast when AQE
        # measures them small (the usual case between two refreshes). Without a
        # changed dimension row only the load time decides, a pushed-down filter.
        if card_hit.isEmpty() and term_hit.isEmpty():
            touched = txn.filter(own)
        else:
            touched = (txn.join(card_hit, "card_id", "left").join(term_hit, "terminal_id", "left")
                          .filter(own | F.col("__card_hit").isNotNull()
                                  | F.col("__term_hit").isNotNull())
                          .select(*txn.columns))
        # used for the key sets, the partition list and the join: written once
        store.overwrite(TOUCHED, touched)
        touched = store.read(TOUCHED)
        # narrow each dimension to the keys the touched rows can reach (small
        # key sets, broadcast by AQE), so the snowflake is joined for the
        # change set only; left-join results are unchanged
        card_n = card.join(touched.select("card_id").distinct(), "card_id", "left_semi")
        acc_n = acc.join(card_n.select("account_id").distinct(), "account_id", "left_semi")
        cust_n = cust.join(acc_n.select("customer_id").distinct(), "customer_id", "left_semi")
        term_n = term.join(touched.select("terminal_id").distinct(), "terminal_id", "left_semi")
        rows = facts.fact_atm_transaction(touched, card_n, acc_n, cust_n, term_n, ts=ts) \
            .withColumn("txn_month", month_of("txn_ts"))
        store.upsert(FACT, rows, "txn_id", partition_by="txn_month", sort_by="txn_id",
                     stable_partitions=True)
    for process, values in ((FACT_REFRESH, tops), (FACT_STATE, now)):
        store.append(CTL_LOAD, inc.watermark_rows(
            store.spark, process, {t: v for t, v in values.items() if v is not None}, ts))


def refresh_loaded_fact(store: TableStore, ts=None) -> None:
    """``refresh_fact`` where every raw table has been loaded."""
    if all(store.exists(f"raw_{e}") for e in PRIMARY_KEYS):
        refresh_fact(store, ts)


def run_cdc_models(store: TableStore, card_landing: DataFrame, txn_landing: DataFrame,
                   ts=None, dedupe: bool = True, batch_id: int | None = None,
                   fact: bool = True) -> None:
    """CDC10 / STR5: bring the CDC models up to date with landed rows:
    raw_transaction_cdc (upsert on txn_id) and the card SCD2.

    Without a ``batch_id`` the frames are the whole log, and the SCD2 is built
    anew; with one they are the rows landed by that batch, and the SCD2 takes
    only these (``sinks.scd2_table``). Both place late rows correctly: ids of
    another Kafka partition may arrive in any order, so no watermark cuts them.
    The transactions are partitioned by month, and a run rewrites the months it
    touches. The third model, the fact over the raw layer, is refreshed last,
    unless ``fact`` is off or the raw tables have not been loaded yet."""
    landed = cdc.dedupe_log(txn_landing) if dedupe else txn_landing
    typed = cdc.raw_transaction_cdc(landed, ts=ts).withColumn("txn_month", month_of("txn_ts"))
    store.upsert("raw_transaction_cdc", typed, "txn_id", order=["txn_ts"], partition_by="txn_month")
    store.upsert("raw_transaction_cdc_rejects", cdc.raw_transaction_cdc_rejects(landed),
                 ["kafka_partition", "kafka_offset"])
    if batch_id is None:
        store.overwrite(CARD_SCD2, scd2.scd2_from_landing(card_landing, dedupe=dedupe, ts=ts),
                        sort_by=["card_id", "valid_from"])
    else:
        scd2_table.apply_batch(store, CARD_SCD2, cdc.card_versions(card_landing), batch_id, ts=ts)
    if fact:
        refresh_loaded_fact(store, ts)


def read_card_scd2(store: TableStore) -> DataFrame:
    """The card SCD2, kept batch by batch or built as a whole."""
    return scd2_table.read_dimension(store, CARD_SCD2) if scd2_table.exists(store, CARD_SCD2) else store.read(CARD_SCD2)


def read_fact(store: TableStore, start=None, end=None) -> DataFrame:
    """Fact rows in [start, end): month partitions pruned, timestamps pushed."""
    return store.read_between(FACT, "txn_ts", start, end, "txn_month")

