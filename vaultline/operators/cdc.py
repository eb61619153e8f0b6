"""Change-data-capture decoding and landing (CDC1-CDC9, FLT2, FLT4, STR2).

Input: Kafka-shaped rows (topic, partition, offset, [timestamp], value) where
``value`` is a JSON change envelope ``{before, after, op, ts_ms}``, either bare
or wrapped as ``{"payload": envelope}``. The same functions serve batch
frames and streaming frames (all stateless column expressions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.functions.columns import (from_epoch_millis, load_ts, parse_ts_best_effort,
                                         trunc_millis)
from vaultline.schemas import (ALLOWED_OPS_CARD, ALLOWED_OPS_TXN, CARD_PAYLOAD, CDC_OPS,
                               TOPIC_SUFFIX_CARD, TOPIC_SUFFIX_TXN, TXN_MODEL_OPS, TXN_PAYLOAD)

_PAYLOAD = T.StructType([
    T.StructField("before", T.StringType()),
    T.StructField("after", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])
# bare envelope fields plus an optional ``payload`` wrapper; objects under
# before/after are kept as their raw JSON text (string leaves)
_ENVELOPE = T.StructType([T.StructField("payload", _PAYLOAD), *_PAYLOAD.fields,
                          T.StructField("_corrupt", T.StringType())])
# malformed JSON (or a non-object payload) lands in ``_corrupt`` instead of
# failing the job
_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def parse_once(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Add ``expr`` as column ``name`` behind a one-row ``inline``: filters on
    fields of the result cannot be pushed below the generator, so Catalyst
    never copies an expensive parse into pushed-down predicates."""
    return df.select("*", F.inline(F.array(F.struct(expr.alias(name)))))


def decode_envelope(records: DataFrame, fallback_ts: str | Column | None = "timestamp"
                    ) -> DataFrame:
    """CDC1 + CDC6: unwrap the envelope with one JSON parse per record.

    Adds ``op``, ``before`` / ``after`` (raw JSON text of the objects or NULL),
    ``src_ts`` (from ``ts_ms``; when absent the record ``timestamp``, else the
    load time) and ``decoded`` (false for values that are not JSON objects, so
    callers can route them to a reject table instead of failing).
    """
    if fallback_ts is None:
        fb = load_ts()
    elif isinstance(fallback_ts, str):
        fb = (trunc_millis(F.col(fallback_ts)) if fallback_ts in records.columns
              else load_ts())
    else:
        fb = fallback_ts
    d = parse_once(records, F.from_json(F.col("value").cast("string"), _ENVELOPE, _JSON_OPTS),
                   "__env")
    env = F.col("__env")
    wrapped = env["payload"].isNotNull()
    decoded = F.coalesce(env.isNotNull() & env["_corrupt"].isNull(), F.lit(False))

    def field(n: str) -> Column:
        return F.when(decoded, F.when(wrapped, env["payload"][n]).otherwise(env[n]))

    src_ts = F.coalesce(from_epoch_millis(field("ts_ms")), fb)
    return d.select(
        *[F.col(f"`{c}`") for c in records.columns],
        field("op").alias("op"),
        field("before").alias("before"),
        field("after").alias("after"),
        src_ts.alias("src_ts"),
        decoded.alias("decoded"),
    )


def topic_kind(topic: Column | str = "topic") -> Column:
    """CDC3: route by topic suffix."""
    t = F.col(topic) if isinstance(topic, str) else topic
    return (F.when(t.endswith(TOPIC_SUFFIX_TXN), "transaction")
             .when(t.endswith(TOPIC_SUFFIX_CARD), "card").otherwise("other"))


def filter_ops(df: DataFrame, ops, col: str = "op") -> DataFrame:
    """FLT2: ``op IN (...)``."""
    return df.filter(F.col(col).isin(list(ops)))


def _key(before: str, after: str, name: str) -> Column:
    """CDC2: key from ``after``, else ``before``; a NULL test, so key 0 is valid."""
    return F.coalesce(F.get_json_object(F.col(after), f"$.{name}").try_cast("long"),
                      F.get_json_object(F.col(before), f"$.{name}").try_cast("long"))


def rejects(decoded: DataFrame) -> DataFrame:
    """Values that are not JSON objects (T16): kept aside with their raw text."""
    return decoded.filter(~F.col("decoded"))


def land_transactions(decoded: DataFrame, ts=None) -> DataFrame:
    """CDC2-CDC5 for the transaction topic: heartbeats and other ops dropped,
    key NULL dropped, ``payload_after`` = after, else before, else '{}'."""
    d = decoded.filter(F.col("decoded") & (topic_kind() == "transaction")
                       & F.col("op").isNotNull() & F.col("op").isin(list(ALLOWED_OPS_TXN)))
    d = parse_once(d, _key("before", "after", "txn_id"), "txn_id").filter(
        F.col("txn_id").isNotNull())
    return d.select(
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        "op", "txn_id",
        F.coalesce(_filled("after"), _filled("before"), F.lit("{}")).alias("payload_after"),
        "src_ts", load_ts(ts).alias("ingested_at"))


def _filled(col: str) -> Column:
    """The object text, or NULL for an object without fields."""
    return F.when(~F.col(col).rlike(r"^\s*\{\s*\}\s*$"), F.col(col))


def land_cards(decoded: DataFrame, ts=None) -> DataFrame:
    """CDC2-CDC5 for the card topic (full r/c/u/d change set)."""
    d = decoded.filter(F.col("decoded") & (topic_kind() == "card")
                       & F.col("op").isNotNull() & F.col("op").isin(list(ALLOWED_OPS_CARD)))
    d = parse_once(d, _key("before", "after", "card_id"), "card_id").filter(
        F.col("card_id").isNotNull())
    return d.select(
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        "op", "card_id",
        F.coalesce(F.col("before"), F.lit("{}")).alias("payload_before"),
        F.coalesce(F.col("after"), F.lit("{}")).alias("payload_after"),
        "src_ts", load_ts(ts).alias("ingested_at"))


def dedupe_log(landed: DataFrame, keys=("kafka_partition", "kafka_offset")) -> DataFrame:
    """STR2: drop replayed rows (at-least-once delivery) by their log position.
    ``dropDuplicates`` aggregates map-side, so a replayed hot partition is
    collapsed before the shuffle."""
    return landed.dropDuplicates(list(keys))


def raw_transaction_cdc(landed: DataFrame, ops=TXN_MODEL_OPS, ts=None) -> DataFrame:
    """CDC7: typed transaction rows from the landing table (inserts only by
    default; snapshot reads are landed but not modelled)."""
    d = _typed_transactions(landed, ops)
    # rows whose time does not parse are rejects, not transactions at no time
    return d.filter(F.col("__ts").isNotNull()).select(
        "txn_id",
        F.col("__p.card_id").alias("card_id"),
        F.col("__p.terminal_id").alias("terminal_id"),
        F.col("__ts").alias("txn_ts"),
        F.col("__p.amount").alias("amount"),
        F.col("__p.currency_code").alias("currency_code"),
        F.col("__p.txn_type").alias("txn_type"),
        F.col("__p.status").alias("status"),
        load_ts(ts).alias("loaded_at"))


def _typed_transactions(landed: DataFrame, ops) -> DataFrame:
    """The rows of ``ops`` with their payload (``__p``) and time (``__ts``), each parsed once."""
    d = landed.filter(F.col("op").isin(list(ops)))
    d = parse_once(d, F.from_json(F.col("payload_after"), TXN_PAYLOAD), "__p")
    return parse_once(d, parse_ts_best_effort(F.col("__p.txn_ts")), "__ts")


def raw_transaction_cdc_rejects(landed: DataFrame, ops=TXN_MODEL_OPS) -> DataFrame:
    """T15: modelled transaction rows whose payload or ``txn_ts`` does not
    parse; they are kept aside (with the raw payload) instead of failing the
    load or silently carrying a NULL time."""
    return (_typed_transactions(landed, ops).filter(F.col("__ts").isNull())
            .select("kafka_partition", "kafka_offset", "txn_id", "payload_after"))


def card_versions(landed: DataFrame, ops=CDC_OPS, defaults: bool = False) -> DataFrame:
    """CDC8 + CDC9: one typed card state per change.

    The state is ``before`` for deletes and ``after`` otherwise; the delete
    flag is ``greatest(payload.is_deleted, op = 'd')``. Text timestamps are
    parsed best-effort (unparseable or '' -> NULL). Missing attributes stay
    NULL; ``defaults=True`` turns them into ''/0 like a non-nullable store.
    """
    d = landed.filter(F.col("op").isin(list(ops)))
    deleted_by_op = (F.col("op") == "d").cast("int")
    payload = F.when(F.col("op") == "d", F.col("payload_before")).otherwise(F.col("payload_after"))
    d = parse_once(d, F.from_json(payload, CARD_PAYLOAD), "__p")
    p = F.col("__p")
    card_number, account_id, status = p["card_number"], p["account_id"], p["status"]
    flag = p["is_deleted"].cast("int")
    if defaults:
        card_number = F.coalesce(card_number, F.lit(""))
        account_id = F.coalesce(account_id, F.lit(0).cast("long"))
        status = F.coalesce(status, F.lit(""))
        flag = F.coalesce(flag, F.lit(0))
    return d.select(
        "card_id",
        card_number.alias("card_number"),
        account_id.alias("account_id"),
        status.alias("status"),
        parse_ts_best_effort(p["opened_at"]).alias("opened_at"),
        parse_ts_best_effort(p["closed_at"]).alias("closed_at"),
        F.greatest(flag, deleted_by_op).alias("is_deleted"),
        "src_ts", "kafka_partition", "kafka_offset")
