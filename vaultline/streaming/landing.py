"""Structured Streaming landing of the change stream (SRC4, SRC5, SNK5,
STR1-STR4).

``read_cdc_stream`` gives Kafka-shaped rows (from Kafka, or from files with
the same columns); ``start_landing`` decodes and routes each micro-batch and
appends it to one landing table per entity.

Delivery: each micro-batch is written into its own ``batch_id=<n>``
partition with dynamic partition overwrite. A batch re-run after a failure
(same id, same offsets from the checkpoint) replaces its own partition, so
the landing tables are exactly-once even though the sink is a plain parquet
folder. Offsets advance through the checkpoint even when every record of a
batch was filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vaultline.functions.columns import load_ts
from vaultline.operators import intervals
from vaultline.operators.cdc import decode_envelope, land_cards, land_transactions, rejects
from vaultline.schemas import CDC_BATCH_SIZE, CDC_RECORD, STG_CDC_CARD, STG_CDC_TRANSACTION


CTL_OFFSETS = "ctl_cdc_offsets"


def read_cdc_stream(spark: SparkSession, fmt: str = "kafka", topics=None, path: str | None = None,
                    bootstrap: str | None = None, starting_offsets: str = "earliest",
                    max_per_trigger: int | None = None, fail_on_data_loss: bool = True,
                    **options) -> DataFrame:
    """SRC4/SRC5: multi-topic change stream from the earliest offset. A batch
    takes at most ``max_per_trigger`` records of Kafka (CDC_BATCH_SIZE by
    default) or files of a file source (no limit by default). Expired offsets
    stop the query unless ``fail_on_data_loss`` is off.

    Kafka output is normalised to (topic, partition, offset, timestamp NTZ,
    value text); file sources must already have these columns.
    """
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", ",".join(topics))
             .option("startingOffsets", starting_offsets)
             .option("failOnDataLoss", str(fail_on_data_loss).lower())
             .option("maxOffsetsPerTrigger", str(max_per_trigger or CDC_BATCH_SIZE)))
        df = r.options(**options).load()
        return df.select("topic", "partition", "offset",
                         F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                         F.col("value").cast("string").alias("value"))
    r = spark.readStream.format(fmt).schema(CDC_RECORD)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.options(**options).load(path)


def write_batch(batch: DataFrame, batch_id: int, card_path: str, txn_path: str,
                reject_path: str | None = None, ts=None, offsets_path: str | None = None) -> None:
    """STR3: decode once, fan out to the landing tables (and rejects, and the
    offset ranges of the batch)."""
    decoded = decode_envelope(batch).persist()
    try:
        outputs = [(land_cards(decoded, ts), card_path), (land_transactions(decoded, ts), txn_path)]
        if reject_path:
            outputs.append((rejects(decoded).select("topic", "partition", "offset", "value"),
                            reject_path))
        if offsets_path:
            outputs.append((offset_ranges(decoded, ts), offsets_path))
        for df, path in outputs:
            (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch_id").parquet(path))
    finally:
        decoded.unpersist()


def offset_ranges(records: DataFrame, ts=None) -> DataFrame:
    """What a batch took of each topic partition, as intervals of offsets that
    came the same number of ``times``: one row where they are consecutive, as a
    broker gives them."""
    p = records.select("topic", F.col("partition").cast("int").alias("partition"), "offset")
    return intervals.id_coverage(p, "offset", ["topic", "partition"]).withColumnsRenamed(
        {"lo": "from_offset", "hi": "to_offset"}).withColumn("updated_at", load_ts(ts))


def start_landing(stream: DataFrame, card_path: str, txn_path: str, checkpoint: str,
                  reject_path: str | None = None, available_now: bool = True,
                  processing_time: str | None = None, ts=None,
                  after_batch=None, offsets_path: str | None = None) -> StreamingQuery:
    """STR1: the micro-batch loop poll -> decode -> route -> write -> commit.
    ``available_now`` drains what is there and stops (STR4); otherwise a
    ``processing_time`` trigger keeps the query running. ``after_batch(spark,
    batch_id)`` runs after each landed batch, e.g. the periodic recompute of
    the CDC models (STR5) with a ``processing_time`` of "10 minutes".
    ``offsets_path`` keeps the offset ranges of each batch (``ctl_cdc_offsets``);
    a batch that is run again replaces its own."""
    def run(df: DataFrame, bid: int) -> None:
        write_batch(df, bid, card_path, txn_path, reject_path, ts, offsets_path)
        if after_batch is not None:
            after_batch(df.sparkSession, bid)

    w = (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def drain(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """STR4: process everything available, then stop (graceful flush)."""
    if timeout_s is None:
        query.processAllAvailable()
    else:
        query.awaitTermination(timeout_s)
    query.stop()


def read_landing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Landing table without the bookkeeping partition column."""
    return _landed(spark, path, schema).drop("batch_id")


def _landed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The landed rows with their ``batch_id``; with a ``schema``, a folder
    without rows yet is an empty table."""
    if schema is None:
        return spark.read.parquet(path)
    schema = T.StructType([*(f for f in schema.fields if f.name != "batch_id"),
                           T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(path)


def dedupe_stream(stream: DataFrame, delay: str = "1 hour",
                  keys=("topic", "partition", "offset"), time_col: str = "timestamp") -> DataFrame:
    """STR2 on the stream itself: drop records replayed within ``delay`` of
    event time (at-least-once producers), keeping only bounded state."""
    t = stream.withColumn("__et", F.col(time_col).cast("timestamp")).withWatermark("__et", delay)
    return t.dropDuplicatesWithinWatermark(list(keys)).drop("__et")


def compact_landing(spark: SparkSession, path: str, upto_batch: int,
                    from_batch: int | None = None) -> None:
    """Rewrite landed micro-batch partitions ``from_batch..upto_batch`` into
    one file each (dynamic partition overwrite: only those ``batch_id``
    partitions are replaced, at job commit). Batches above ``upto_batch`` --
    the ones a running stream may still write -- are not touched. Each batch
    is bounded by the stream's per-trigger limit, so one task per batch is
    bounded too."""
    df = spark.read.parquet(path).filter(F.col("batch_id") <= upto_batch)
    if from_batch is not None:
        df = df.filter(F.col("batch_id") >= from_batch)
    (df.repartition("batch_id").write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def start_cdc_models(stream: DataFrame, store, root: str, checkpoint: str,
                     available_now: bool = True, processing_time: str = "10 minutes",
                     ts=None, fact: bool = False) -> StreamingQuery:
    """STR1 + STR5 wired together: land each micro-batch under ``root`` and
    then bring the CDC models in ``store`` up to date with the rows of that
    batch (its ``batch_id`` partition), whatever their ids; the landed log is
    not read again. With ``fact`` the fact is refreshed after each batch."""
    from vaultline.plans.jobs import run_cdc_models

    card_path, txn_path = f"{root}/stg_cdc_card", f"{root}/stg_cdc_transaction"

    def models(spark: SparkSession, batch_id: int) -> None:
        cards, txns = (_landed(spark, path, schema).filter(F.col("batch_id") == batch_id).drop("batch_id")
                       for path, schema in ((card_path, STG_CDC_CARD), (txn_path, STG_CDC_TRANSACTION)))
        run_cdc_models(store, cards, txns, ts=ts, batch_id=batch_id, fact=fact)

    return start_landing(stream, card_path, txn_path, checkpoint,
                         reject_path=f"{root}/cdc_rejects", offsets_path=f"{root}/{CTL_OFFSETS}",
                         available_now=available_now,
                         processing_time=None if available_now else processing_time, ts=ts,
                         after_batch=models)
