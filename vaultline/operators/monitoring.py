"""Consumer-lag monitoring (AG4, M1, M2).

Offsets arrive as frames (from the broker's admin API, a Kafka source's
progress, or a table of offsets); lag is computed and turned into metric rows
on Spark. Only the single total is ever brought to the driver (for the alert).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.columns import load_ts
from vaultline.operators import intervals
from vaultline.schemas import LAG_THRESHOLD


def kafka_lag(end_offsets: DataFrame, committed: DataFrame,
              keys=("topic", "partition")) -> DataFrame:
    """AG4: lag per (topic, partition) = max(0, end - committed); a partition
    with no committed offset counts as committed at 0."""
    keys = list(keys)
    j = end_offsets.join(committed, keys, "left")
    lag = F.greatest(F.lit(0).cast("long"),
                     F.col("end_offset") - F.coalesce(F.col("committed_offset"),
                                                      F.lit(0).cast("long")))
    return j.select(*keys, "end_offset",
                    F.coalesce(F.col("committed_offset"), F.lit(0).cast("long"))
                    .alias("committed_offset"),
                    lag.alias("lag"))


def last_offsets(ranges: DataFrame) -> DataFrame:
    """``ctl_cdc_offsets``: (topic, partition, last_offset, updated_at) of the
    offset ranges that the landing stream keeps per batch."""
    return ranges.groupBy("topic", "partition").agg(
        F.max("to_offset").alias("last_offset"), F.max("updated_at").alias("updated_at"))


def committed_offsets(ranges: DataFrame) -> DataFrame:
    """(topic, partition, committed_offset) of the same: one past the last."""
    return last_offsets(ranges).select("topic", "partition", (F.col("last_offset") + 1).alias("committed_offset"))


def end_offsets(spark: SparkSession, progress: dict) -> DataFrame:
    """(topic, partition, end_offset) from a stream's progress report: the
    latest offsets of its Kafka sources (a few numbers per topic partition)."""
    rows = [(t, int(p), int(o)) for s in progress["sources"]
            for t, parts in _json(s.get("latestOffset") or s.get("endOffset")).items() for p, o in parts.items()]
    return spark.createDataFrame(rows, "topic string, partition int, end_offset long")


def _json(x) -> dict:
    x = json.loads(x) if isinstance(x, str) else x or {}
    return {t: p for t, p in x.items() if isinstance(p, dict)}


def offset_breaks(ranges: DataFrame) -> DataFrame:
    """(topic, partition, kind, from_offset, to_offset, records) over the
    offset ranges of all batches, whatever their order: a ``gap`` is an
    interval between landed offsets that no batch holds, a ``replay`` one that
    was landed more than once (``records``: the surplus ones)."""
    by = ["topic", "partition"]
    spans = ranges.select(*by, F.col("from_offset").alias("lo"), F.col("to_offset").alias("hi"), "times")
    size = F.col("hi") - F.col("lo") + 1
    gaps = intervals.holes(intervals.merge(None, "", spans, by), by).select(
        *by, F.lit("gap").alias("kind"), "lo", "hi", size.alias("records"))
    again = intervals.coverage(spans, by).filter("times > 1").select(
        *by, F.lit("replay").alias("kind"), "lo", "hi", (size * (F.col("times") - 1)).alias("records"))
    return gaps.unionByName(again).withColumnsRenamed({"lo": "from_offset", "hi": "to_offset"})


def break_metrics(breaks: DataFrame, ts=None) -> DataFrame:
    """M1: metric rows ``cdc_offset_gap`` and ``cdc_offset_replay`` per topic partition."""
    return breaks.groupBy("topic", "partition", "kind").agg(F.sum("records").cast("double").alias("value")).select(
        load_ts(ts).alias("ts"), F.concat(F.lit("cdc_offset_"), "kind").alias("metric"), "value",
        F.to_json(F.struct("topic", "partition")).alias("labels"))


def lag_metrics(lag: DataFrame, group_id: str, ts=None) -> DataFrame:
    """M1: metric rows (ts, metric, value, labels JSON): one
    ``kafka_partition_lag`` per partition and one ``kafka_total_lag``."""
    per_part = lag.select(
        load_ts(ts).alias("ts"), F.lit("kafka_partition_lag").alias("metric"),
        F.col("lag").cast("double").alias("value"),
        F.to_json(F.struct("topic", "partition")).alias("labels"))
    total = lag.agg(F.coalesce(F.sum("lag"), F.lit(0)).cast("double").alias("value")).select(
        load_ts(ts).alias("ts"), F.lit("kafka_total_lag").alias("metric"), "value",
        F.to_json(F.struct(F.lit(group_id).alias("group"))).alias("labels"))
    return per_part.unionByName(total)


def connector_metrics(status: DataFrame, ts=None,
                      metric: str = "cdc_connector_running") -> DataFrame:
    """Connector gauge rows from a (connector, state) status frame (as polled
    from a connector service): value 1.0 when the state is RUNNING, else 0.0,
    labels {"connector": name}."""
    return status.select(
        load_ts(ts).alias("ts"), F.lit(metric).alias("metric"),
        F.when(F.upper(F.col("state")) == "RUNNING", 1.0).otherwise(0.0).alias("value"),
        F.to_json(F.struct(F.col("connector"))).alias("labels"))


def assert_connectors(metrics: DataFrame, metric: str = "cdc_connector_running") -> None:
    """Raise when a connector gauge is below 1 (after the rows were written).
    Only the names of failing connectors reach the driver."""
    down = [r["labels"] for r in metrics.filter((F.col("metric") == metric)
                                                & (F.col("value") < 1.0)).select("labels")
            .collect()]
    if down:
        raise RuntimeError(f"connector not RUNNING: {', '.join(down)}")


def write_metrics(store, metrics: DataFrame, table: str = "ctl_monitoring") -> None:
    """SNK6: append metric rows (ts, metric, value, labels) to the metrics table."""
    store.append(table, metrics.select("ts", "metric", "value", "labels"))


def lag_alert(metrics: DataFrame, threshold: int = LAG_THRESHOLD) -> DataFrame:
    """M2 as a frame: (total_lag, threshold, breached)."""
    return (metrics.filter(F.col("metric") == "kafka_total_lag")
                   .agg(F.coalesce(F.max("value"), F.lit(0.0)).alias("total_lag"))
                   .select("total_lag", F.lit(threshold).alias("threshold"),
                           (F.col("total_lag") > threshold).alias("breached")))


def assert_lag(metrics: DataFrame, threshold: int = LAG_THRESHOLD) -> float:
    """M2: raise when total lag exceeds ``threshold``. Call after the metric
    rows were written, so the alert never loses the measurement."""
    row = lag_alert(metrics, threshold).first()
    if row["breached"]:
        raise RuntimeError(f"CDC lag too high: {row['total_lag']:.0f} > {threshold}")
    return row["total_lag"]
