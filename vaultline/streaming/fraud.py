"""Streaming variant of the rapid-withdrawal detector (FRD1).

Session windows per card with an event-time watermark: a session closes
after ``gap`` without a withdrawal and is emitted once the watermark passes
its end (append mode), so late rows within the watermark still count and
state is dropped afterwards. The batch twin is
``vaultline.operators.fraud.rapid_withdrawal_sessions``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.columns import EPOCH, epoch_micros


def rapid_withdrawal_sessions_stream(txn: DataFrame, gap: str = "15 minutes",
                                     watermark: str = "1 hour", min_ops: int = 3,
                                     min_terminals: int = 2) -> DataFrame:
    # watermarks need TIMESTAMP (not NTZ); the session zone is UTC
    t = (txn.filter((F.col("txn_type") == "atm_withdrawal") & F.col("card_id").isNotNull())
            .withColumn("event_time", F.col("txn_ts").cast("timestamp"))
            .withWatermark("event_time", watermark))
    s = (t.groupBy("card_id", F.session_window("event_time", gap).alias("session"))
          .agg(F.count(F.lit(1)).alias("n_ops"),
               F.size(F.collect_set("terminal_id")).alias("n_terminals")))
    return (s.filter((F.col("n_ops") >= min_ops) & (F.col("n_terminals") >= min_terminals))
             .select("card_id",
                     F.col("session.start").cast("timestamp_ntz").alias("session_start"),
                     F.col("session.end").cast("timestamp_ntz").alias("session_end"),
                     "n_ops", "n_terminals"))


_RAPID_OUT = ("txn_id long, card_id long, txn_ts timestamp_ntz, n_ops long, n_terminals int")
_RAPID_STATE = "card array<long>, ts array<long>, term array<long>, has_term array<boolean>, last_ms array<long>"
CARD_GROUPS = 1024           # groups of cards that share a state and a call
ROWS_PER_BATCH = 2_000_000   # rows of a replayed file


@contextmanager
def state_tasks(spark: SparkSession):
    """A stream started inside keeps its state in two tasks a core at most: each
    batch pays for every task (a Python worker, a state commit), and a batch of
    a bounded file needs no more of them as the input grows."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _rows_before(card, t, of_card, at, equal: bool):
    """How many of the rows (card, t) lie before each (of_card, at); rows at
    that very place count if ``equal``."""
    import numpy as np

    kind = np.concatenate([np.ones(len(t), "int8"), np.full(len(at), 2 if equal else 0, "int8")])
    order = np.lexsort((kind, np.concatenate([t, at]), np.concatenate([card, of_card])))
    out = np.empty(len(order), dtype="int64")
    out[order] = np.cumsum(kind[order] == 1)
    return out[len(t):]


def rapid_withdrawals_stream(txn: DataFrame, window_s: int = 15 * 60, min_ops: int = 3,
                             min_terminals: int = 2, lateness_s: int = 3600,
                             groups: int = CARD_GROUPS) -> DataFrame:
    """FRD1 on a stream with the batch detector's range-frame rule.

    A custom stateful operator (``applyInPandasWithState``, Arrow batches per
    group of cards, so a call judges the rows of many cards at once; ``groups``
    is their number and must not change for a checkpoint): the state of a card
    is its withdrawals of the last ``window_s`` + ``lateness_s`` seconds, so it
    stays bounded; each arriving withdrawal is flagged when its trailing window
    holds ``min_ops`` withdrawals on ``min_terminals`` terminals. A row up to
    ``lateness_s`` late is still evaluated against its full window (rows
    already emitted are not revised: append mode); later rows are dropped by
    the watermark. Idle cards are dropped once the watermark passes their last
    withdrawal plus the window. For rows arriving in event-time order the
    output equals ``operators.fraud.rapid_withdrawals``. Withdrawals without a
    card are no card's, as there; those without a time are left out.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    width_us, width_ms = window_s * 1_000_000, window_s * 1000
    keep_us = (window_s + lateness_s) * 1_000_000
    watermark = f"{lateness_s} seconds"
    w = (txn.filter((F.col("txn_type") == "atm_withdrawal") & F.col("card_id").isNotNull() & F.col("txn_ts").isNotNull())
            .select(F.pmod(F.xxhash64("card_id"), F.lit(groups)).alias("card_group"), "txn_id", "card_id", "txn_ts",
                    F.coalesce("terminal_id", F.lit(0)).cast("long").alias("term"),
                    F.col("terminal_id").isNotNull().alias("has_term"),
                    F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00")
                                     .cast("timestamp_ntz"), F.col("txn_ts")).alias("t_us"),
                    F.col("txn_ts").cast("timestamp").alias("event_time"))
            # the watermark's clock: epoch of event_time in the session zone
            .withColumn("e_ms", F.unix_millis("event_time"))
            .withWatermark("event_time", watermark))

    def flag(key, batches, state):
        import numpy as np
        import pandas as pd

        kinds = ("int64", "int64", "int64", "bool", "int64")
        old = [np.asarray(a, dtype=k) for a, k in zip(state.get if state.exists else [[]] * 5, kinds)]
        mark_ms = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            new, hist = None, old
        else:
            new = pd.concat(list(batches), ignore_index=True)
            new = new.iloc[np.lexsort((new["t_us"], new["card_id"]))]
            arrived = [new[c].to_numpy(dtype=k) for c, k in zip(("card_id", "t_us", "term", "has_term", "e_ms"), kinds)]
            hist = [np.concatenate(x) for x in zip(old, arrived)]
        order = np.lexsort((hist[1], hist[0]))
        card, t, term, has_term, last_ms = (a[order] for a in hist)
        # where the rows of each card begin, how many they are, and its last clock time
        begins = np.flatnonzero(np.concatenate([[True], card[1:] != card[:-1]]))
        sizes = np.diff(np.append(begins, len(card)))
        last_ms = np.repeat(np.maximum.reduceat(last_ms, begins), sizes)
        kept = t >= np.repeat(t[begins + sizes - 1], sizes) - keep_us
        # idle cards go once the watermark passes their last withdrawal + W
        idle = last_ms + width_ms + 1 < mark_ms
        if new is not None:
            idle &= ~np.isin(card, arrived[0])
            lo = _rows_before(card, t, arrived[0], arrived[1] - width_us, False)
            hi = _rows_before(card, t, arrived[0], arrived[1], True)          # peers included
            # row j is the last one of its card and terminal in the windows with lo <= j < hi <= nxt;
            # lo and hi never fall from one new row to the next, so these are a range
            j = np.flatnonzero(has_term)
            by = j[np.lexsort((j, term[j], card[j]))]
            again = (term[by][1:] == term[by][:-1]) & (card[by][1:] == card[by][:-1])
            nxt = np.full(len(card), len(card))
            nxt[by[:-1][again]] = by[1:][again]
            first = np.searchsorted(hi, j, side="right")
            last = np.minimum(np.searchsorted(hi, nxt[j], side="right"),
                              np.searchsorted(lo, j, side="right"))
            first, last = first[last > first], last[last > first]
            steps = (np.bincount(first, minlength=len(lo) + 1)
                     - np.bincount(last, minlength=len(lo) + 1))
            out = new[["txn_id", "card_id", "txn_ts"]].assign(
                n_ops=hi - lo, n_terminals=np.cumsum(steps)[:len(lo)].astype("int32"))
            out = out[(out.n_ops >= min_ops) & (out.n_terminals >= min_terminals)]
            if len(out):
                yield out
        kept &= ~idle
        if kept.any():
            state.update(tuple(a[kept].tolist() for a in (card, t, term, has_term, last_ms)))
            state.setTimeoutTimestamp(max(int(last_ms[kept].min()) + width_ms, mark_ms) + 1)
        else:
            state.remove()

    return w.groupBy("card_group").applyInPandasWithState(
        flag, _RAPID_OUT, _RAPID_STATE, "append", GroupStateTimeout.EventTimeTimeout)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROBE_ROW = "t_us long, txn_id long, amount decimal(18,2), status string"
_PROBE_RUN = ("start_us long, last_us long, n long, declined long, first_amount decimal(18,2), "
              "last_amount decimal(18,2), last_status string")
_PROBE_OUT = ("card_id long, terminal_id long, start_us long, end_us long, n_attempts long, n_declined long, "
              "first_amount decimal(18,2), last_amount decimal(18,2), last_status string")


def amount_probe_stream(txn: DataFrame, max_gap_s: int = 120, min_len: int = 3, lateness_s: int = 3600) -> DataFrame:
    """FRD3 on a stream, by (card, terminal), with the rule of
    ``operators.fraud.amount_probe``: one output row per run of at least
    ``min_len`` withdrawals with amounts that do not rise and gaps of at most
    ``max_gap_s`` seconds, emitted when the run breaks or times out.

    A state machine with event-time timers. A row waits until the watermark
    (``lateness_s`` behind the latest time) has passed it, so rows in any order
    within the lateness are judged in the order of (time, id); later ones are
    dropped by the watermark. The state of a key is the summary of its open
    run, whatever its length, and its waiting rows. Rows without a card or a
    terminal are no key's. Needs the RocksDB state store (``ROCKSDB``).
    """
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    width_us = max_gap_s * 1_000_000

    class Probe(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.run = handle.getValueState("run", _PROBE_RUN)
            self.waiting = handle.getListState("waiting", _PROBE_ROW)

        def handleInputRows(self, key, rows, timerValues):
            self.waiting.appendList([(r.t_us, r.txn_id, r.amount, r.status) for r in rows])
            yield from self._advance(key, timerValues)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            yield from self._advance(key, timerValues)

        def _advance(self, key, timers):
            """Judge the rows that the watermark has passed, then wait for the next ones."""
            mark_us = timers.getCurrentWatermarkInMs() * 1000
            rows = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: r[:2])
            run = tuple(self.run.get()) if self.run.exists() else None
            done = 0
            while done < len(rows) and rows[done][0] < mark_us:
                t, _, amount, status = rows[done]
                declined = int(status == "declined")
                if run and t - run[1] <= width_us and amount <= run[5]:
                    run = (run[0], t, run[2] + 1, run[3] + declined, run[4], amount, status)
                else:
                    yield from self._told(key, run)
                    run = (t, t, 1, declined, amount, amount, status)
                done += 1
            if run and run[1] + width_us < mark_us and not (done < len(rows) and rows[done][0] <= run[1] + width_us):
                yield from self._told(key, run)
                run = None
            if run:
                self.run.update(run)
            else:
                self.run.clear()
            if done:
                self.waiting.clear()
                if rows[done:]:
                    self.waiting.put(rows[done:])
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            ends = [r[0] for r in rows[done:done + 1]] + ([run[1] + width_us] if run else [])
            if ends:
                self.handle.registerTimer(max(min(ends) // 1000, mark_us // 1000) + 1)

        @staticmethod
        def _told(key, run):
            if run and run[2] >= min_len:
                yield Row(card_id=key[0], terminal_id=key[1], start_us=run[0], end_us=run[1], n_attempts=run[2],
                          n_declined=run[3], first_amount=run[4], last_amount=run[5], last_status=run[6])

        def close(self):
            pass

    w = (txn.filter((F.col("txn_type") == "atm_withdrawal") & F.col("card_id").isNotNull() & F.col("terminal_id").isNotNull())
            .select("txn_id", "card_id", "terminal_id", epoch_micros("txn_ts").alias("t_us"),
                    F.col("amount").cast("decimal(18,2)").alias("amount"), "status",
                    F.timestamp_micros(epoch_micros("txn_ts")).alias("event_time"))
            .withWatermark("event_time", f"{lateness_s} seconds"))
    out = w.groupBy("card_id", "terminal_id").transformWithState(Probe(), _PROBE_OUT, "Append", "EventTime")
    at = lambda c: F.timestamp_add("MICROSECOND", F.col(c), F.expr(EPOCH))           # noqa: E731
    last_declined = F.when(F.col("last_status") == "declined", 1).otherwise(0)
    return out.select("card_id", "terminal_id", at("start_us").alias("run_start"), at("end_us").alias("run_end"), "n_attempts",
                      "n_declined", "first_amount", "last_amount", "last_status",
                      ((F.col("n_declined") - last_declined) == (F.col("n_attempts") - 1)).alias("probing"))


def write_in_time_order(df: DataFrame, path: str, ts_col: str = "txn_ts", unit: str = "week",
                        rows_per_file: int = ROWS_PER_BATCH) -> None:
    """Write ``df`` as one folder per ``unit`` of event time, so that a file
    stream (which orders files by modification time) replays it in event-time
    order, a file at a time. Rows without a time are left out.

    All files are written by one job, each a range of times of about
    ``rows_per_file`` rows inside a unit; rows of the same time share a file.
    Then the files get modification times in the order of their rows. Only the
    list of files reaches the driver."""
    spark = df.sparkSession
    at = F.col(ts_col)
    timed = df.filter(at.isNotNull())
    tasks = max(1, -(-timed.count() // rows_per_file))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def files() -> list:
        """(folder, name, status) of the data files, in the order of their rows."""
        parts = [p for p in fs.listStatus(folder) if p.isDirectory()] if fs.exists(folder) else []
        found = [(p.getPath().getName(), f.getPath().getName(), f) for p in parts for f in fs.listStatus(p.getPath())]
        return sorted((x for x in found if x[1].startswith("part-")), key=lambda x: x[:2])

    before = {x[:2] for x in files()}
    part = F.date_format(F.date_trunc(unit, at), "yyyyMMddHHmmss")
    (timed.withColumn("part", part).repartitionByRange(tasks, ts_col).sortWithinPartitions("part", ts_col)
          .write.mode("append").partitionBy("part").parquet(path))
    new = [x for x in files() if x[:2] not in before]
    start = max((f.getModificationTime() for *_, f in new), default=0)
    for i, (_, _, f) in enumerate(new):
        fs.setTimes(f.getPath(), start + i, -1)
    if any(f.getModificationTime() != start + i for i, (*_, f) in enumerate(x for x in files() if x[:2] not in before)):
        # a store that does not keep such times: the files are written anew, one after the other
        for name, _, f in new:
            again = spark.read.schema(df.schema).parquet(f.getPath().toString()).coalesce(1)
            again.write.mode("append").parquet(f"{path}/part={name.partition('=')[2]}")
            fs.delete(f.getPath(), False)
