"""Detectors for the three card-fraud shapes (FRD1-FRD3).

All per-card ordered work goes through ``vaultline.functions.windows`` so a
card with a huge history is split by time bucket, never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions import windows as W
from vaultline.functions.columns import epoch_micros
from vaultline.operators import scd2

US = 1_000_000


def _bucket(bucket):
    return bucket if bucket is not None else F.to_date("txn_ts")


def _withdrawals(txn: DataFrame, *keys: str) -> DataFrame:
    """Withdrawals that have all ``keys``: rows without a card are no card's."""
    d = txn.filter(F.col("txn_type") == "atm_withdrawal")
    return d.dropna(subset=list(keys))


def rapid_withdrawals(txn: DataFrame, window_s: int = 15 * 60, min_ops: int = 3,
                      min_terminals: int = 2, key: str = "card_id",
                      method: str = "events", bucket_s: int = 86_400) -> DataFrame:
    """FRD1: withdrawals ending a burst on one card: within the trailing
    ``window_s`` seconds (inclusive range frame, ties included) there are at
    least ``min_ops`` withdrawals on at least ``min_terminals`` distinct
    terminals. Output: txn_id, card_id, txn_ts, n_ops, n_terminals.

    Withdrawals without a card are no card's and never flagged. One shuffle,
    by (card, bucket of ``bucket_s`` seconds); the last window of each bucket
    is copied into the next one, so every count is complete inside a task.

    ``method='events'`` first keeps what can matter: a time is a candidate only
    if the withdrawal ``min_ops - 1`` places before it lies in its window (one
    lag), and only rows within a window before a candidate are counted, as
    running sums of interval start and end events: linear work whatever the
    density of a card's withdrawals. ``method='frame'`` aggregates a sliding
    range frame per row, whose cost is the number of the card's withdrawals
    inside the window.
    """
    bucket_s = max(bucket_s, window_s)
    if method == "events":
        return _rapid_by_events(txn, window_s, min_ops, min_terminals, key, bucket_s)
    if method != "frame":
        raise ValueError(f"unknown method {method!r}")
    w = _withdrawals(txn, key).withColumn("__t", epoch_micros("txn_ts"))
    width = window_s * US
    out = W.range_window(
        w, key, "__t", width, bucket_s * US, {
            "n_ops": lambda s: F.count(F.lit(1)).over(s),
            "n_terminals": lambda s: F.size(F.collect_set("terminal_id").over(s)),
        })
    return (out.filter((F.col("n_ops") >= min_ops) & (F.col("n_terminals") >= min_terminals))
               .select("txn_id", key, "txn_ts", "n_ops", "n_terminals"))


def _rapid_by_events(txn: DataFrame, window_s: int, min_ops: int, min_terminals: int,
                     key: str, bucket_s: int) -> DataFrame:
    """FRD1 counts in linear time, on the candidates' neighbourhood.

    A withdrawal at t lies in the trailing window of every later point up to
    t + W, so it covers [t, t + W]; the window count at t_j is the number of
    covering intervals. For distinct terminals, an occurrence of a terminal
    covers only until that terminal's next occurrence (which takes over), so
    the intervals of one terminal are disjoint and the same running sum counts
    terminals. Events of one time are ordered starts, queries, ends.
    """
    width = window_s * US
    rows = (_withdrawals(txn, key).select("txn_id", key, "txn_ts", "terminal_id")
            .withColumn("__t", epoch_micros("txn_ts")).filter(F.col("__t").isNotNull()))
    d = W.with_halo(rows, "__t", width, bucket_s * US)
    near = Window.partitionBy(key, "__b").orderBy("__t")
    t = F.col("__t")
    # the last row of a time sees all rows up to it
    last = F.coalesce(F.lead("__t").over(near) != t, F.lit(True))
    kth = F.lag("__t", min_ops - 1).over(near) if min_ops > 1 else t
    d = d.withColumn("__c", F.when(last & (t - kth <= width), t))
    back = Window.partitionBy(key, "__b").orderBy(t.desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    # the nearest candidate time from the row on; a row of a candidate time has its own
    d = d.withColumn("__next", F.min("__c").over(back)).filter(F.col("__next") - t <= width)
    same = Window.partitionBy(key, "__b", "terminal_id").orderBy("__t", "txn_id")
    d = d.withColumn("__again", F.lead("__t").over(same))
    has, taken = F.col("terminal_id").isNotNull().cast("int"), F.col("__again") <= t + width
    no_row = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("txn_id", "txn_ts")]
    ev = lambda at, kind, ops, term: F.struct(                                    # noqa: E731
        at.alias("t"), F.lit(kind).alias("kind"), F.lit(ops).alias("ops"), term.alias("term"), *no_row)
    query = F.struct(t.alias("t"), F.lit(1).alias("kind"), F.lit(0).alias("ops"), F.lit(0).alias("term"),
                     "txn_id", "txn_ts")
    asked = F.col("__native") & (F.col("__next") == t)
    events = F.array(
        ev(t, 0, 1, has), ev(t + width, 2, -1, F.lit(0)),
        F.when(has == 1, F.when(taken, ev(F.col("__again"), 0, 0, F.lit(-1)))
               .otherwise(ev(t + width, 2, 0, F.lit(-1)))),
        F.when(asked, query))
    e = d.select(key, "__b", F.explode(events).alias("e")).filter(F.col("e").isNotNull()).select(key, "__b", "e.*")
    run = Window.partitionBy(key, "__b").orderBy("t", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("n_ops", F.sum("ops").over(run)).withColumn("n_terminals", F.sum("term").over(run))
    return (e.filter((F.col("kind") == 1) & (F.col("n_ops") >= min_ops) & (F.col("n_terminals") >= min_terminals))
             .select("txn_id", key, "txn_ts", "n_ops", F.col("n_terminals").cast("int").alias("n_terminals")))


def used_after_block(txn: DataFrame, card: DataFrame,
                     statuses=("blocked", "closed")) -> DataFrame:
    """FRD2: transactions on a card after it was blocked or closed.

    The block time is the card's ``updated_at`` (a block leaves
    ``closed_at`` NULL), so a later change of the card moves it; with the
    card's versions at hand use ``used_after_block_versions``. The card side has one row per key, so the equi join
    emits no pairs beyond the transactions themselves; AQE splits a hot card's
    shuffle partition on the transaction side.
    """
    blocked = (card.filter(F.col("status").isin(list(statuses)))
                   .select(F.col("card_id").alias("__card"), F.col("status").alias("card_status"),
                           F.col("updated_at").alias("blocked_at")))
    j = txn.join(blocked, txn["card_id"] == blocked["__card"])
    return (j.filter(F.col("txn_ts") > F.col("blocked_at"))
             .select("txn_id", "card_id", "txn_ts", "status", "card_status", "blocked_at"))


def used_after_block_versions(txn: DataFrame, dim: DataFrame,
                              statuses=("blocked", "closed")) -> DataFrame:
    """FRD2 from the card's history: transactions made while the card version
    in effect (SCD2 ``dim``: valid_from <= txn_ts < valid_to) was blocked or
    closed. Later changes of the card do not hide them, and a card that was
    unblocked again is not reported. ``blocked_at`` is the start of that
    version. An as-of lookup, so no pairs; transactions without a card, or
    before its first version, are not reported.
    """
    t = txn.select("txn_id", "card_id", "txn_ts", "status")
    j = scd2.as_of(t, dim, cols=("status", "valid_from"), prefix="card_")
    return (j.filter(F.col("card_status").isin(list(statuses)))
             .withColumnRenamed("card_valid_from", "blocked_at"))


def amount_probe(txn: DataFrame, keys=("card_id", "terminal_id"), max_gap_s: int = 120,
                 min_len: int = 3, bucket=None) -> DataFrame:
    """FRD3: runs of withdrawals on the same key with non-increasing amounts
    (repeats allowed: the amount may stay at its floor) and gaps of at most
    ``max_gap_s`` seconds.

    Gaps-and-islands: previous row (lag) -> break flag -> running sum of
    breaks = run id -> one aggregate per run. Output per run of at least
    ``min_len``: keys, run_start, run_end, n_attempts, n_declined,
    first_amount, last_amount, last_status, probing (every attempt but the
    last declined). ``bucket`` (default: day of txn_ts) is the unit one task
    handles for one key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = ["txn_ts", "txn_id"]
    w = _withdrawals(txn, *keys).select("txn_id", *keys, "txn_ts", "amount", "status")

    def breaks(p: str):
        gap = F.timestamp_diff("MICROSECOND", F.col(p + "txn_ts"), F.col("txn_ts"))
        return (F.col(p + "txn_ts").isNull() | (gap > F.lit(max_gap_s * US))
                | (F.col("amount") > F.col(p + "amount")))

    w = W.with_islands(w, keys, order, ["txn_ts", "amount"], _bucket(bucket), breaks, "__run")
    ordv = F.struct("txn_ts", "txn_id")
    runs = w.groupBy(*keys, "__run").agg(
        F.min("txn_ts").alias("run_start"),
        F.max("txn_ts").alias("run_end"),
        F.count(F.lit(1)).alias("n_attempts"),
        F.sum(F.when(F.col("status") == "declined", 1).otherwise(0)).cast("long")
        .alias("n_declined"),
        F.min_by("amount", ordv).alias("first_amount"),
        F.max_by("amount", ordv).alias("last_amount"),
        F.max_by("status", ordv).alias("last_status"))
    last_declined = F.when(F.col("last_status") == "declined", 1).otherwise(0)
    return (runs.filter(F.col("n_attempts") >= min_len)
                .withColumn("probing",
                            (F.col("n_declined") - last_declined) == (F.col("n_attempts") - 1))
                .drop("__run"))


def rapid_withdrawal_sessions(txn: DataFrame, gap_s: int = 15 * 60, min_ops: int = 3,
                              min_terminals: int = 2, key: str = "card_id",
                              bucket=None) -> DataFrame:
    """FRD1, session form (the batch twin of the streaming detector): a
    session closes after ``gap_s`` seconds without a withdrawal on the card;
    report sessions with enough withdrawals on enough terminals.
    session_end = last withdrawal + gap, as a session window reports it.
    ``bucket`` as in ``amount_probe``."""
    order = ["txn_ts", "txn_id"]
    w = _withdrawals(txn, key).select("txn_id", key, "txn_ts", "terminal_id")

    def breaks(p: str):
        gap = F.timestamp_diff("MICROSECOND", F.col(p + "txn_ts"), F.col("txn_ts"))
        return F.col(p + "txn_ts").isNull() | (gap >= F.lit(gap_s * US))

    w = W.with_islands(w, key, order, ["txn_ts"], _bucket(bucket), breaks, "__s")
    s = w.groupBy(key, "__s").agg(
        F.min("txn_ts").alias("session_start"),
        F.timestamp_add("SECOND", F.lit(gap_s), F.max("txn_ts")).alias("session_end"),
        F.count(F.lit(1)).alias("n_ops"),
        F.countDistinct("terminal_id").alias("n_terminals"))
    return (s.filter((F.col("n_ops") >= min_ops) & (F.col("n_terminals") >= min_terminals))
             .drop("__s"))
