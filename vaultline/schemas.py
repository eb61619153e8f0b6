"""Logical schemas of the bank model and the fixed values its operators use.

Source (OLTP) frames keep booleans; warehouse frames (stg/raw/ods) carry 0/1
integers, as the warehouse stores flags as small unsigned ints.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the modelled system's for identical results)
# ---------------------------------------------------------------------------
# change-event operation codes: r = snapshot read, c = create, u = update, d = delete
CDC_OPS = ("r", "c", "u", "d")
# operations accepted per landed entity
ALLOWED_OPS_TXN = ("r", "c")
ALLOWED_OPS_CARD = ("r", "c", "u", "d")
# operations the transaction model keeps from its landing table
TXN_MODEL_OPS = ("c",)
# topic routing by suffix
TOPIC_SUFFIX_TXN = ".transaction"
TOPIC_SUFFIX_CARD = ".card"
# enum domains
TXN_TYPES = ("atm_withdrawal", "atm_deposit")
TXN_STATUSES = ("approved", "declined", "reversed")
ACCOUNT_STATUSES = ("active", "closed", "blocked")
CARD_STATUSES = ("active", "blocked", "closed")
CURRENCIES = ("RUB", "USD", "EUR")
# open-ended end of a current SCD2 version
OPEN_END = "2999-12-31 00:00:00"
# consumer poll size and lag alert threshold
CDC_BATCH_SIZE = 500
LAG_THRESHOLD = 5000
# column length limits: CHAR(3), VARCHAR(34), VARCHAR(16); NUMERIC(18,2)
CURRENCY_LEN = 3
ACCOUNT_NUMBER_MAX_LEN = 34
CARD_NUMBER_MAX_LEN = 16
AMOUNT_PRECISION, AMOUNT_SCALE = 18, 2

# column defaults of the source schema applied on insert ("now" = load time)
SOURCE_DEFAULTS = {
    "customer": {"created_at": "now", "updated_at": "now", "is_deleted": False},
    "account": {"opened_at": "now", "status": "active", "daily_transfer_limit": 100000,
                "created_at": "now", "updated_at": "now", "is_deleted": False},
    "card": {"status": "active", "opened_at": "now", "created_at": "now", "updated_at": "now",
             "is_deleted": False},
    "terminal": {"created_at": "now", "updated_at": "now", "is_working": True,
                 "is_deleted": False},
    "transaction": {"txn_ts": "now"},
}

# ---------------------------------------------------------------------------
# Column lists of the layers
# ---------------------------------------------------------------------------
SOURCE_COLUMNS = {
    "customer": ["customer_id", "customer_uuid", "full_name", "birth_date", "email", "phone",
                 "city", "created_at", "updated_at", "is_deleted"],
    "account": ["account_id", "account_number", "customer_id", "currency_code", "opened_at",
                "closed_at", "status", "daily_transfer_limit", "created_at", "updated_at",
                "is_deleted"],
    "card": ["card_id", "card_number", "account_id", "status", "opened_at", "closed_at",
             "created_at", "updated_at", "is_deleted"],
    "terminal": ["terminal_id", "terminal_code", "city", "country", "latitude", "longitude",
                 "created_at", "updated_at", "is_working", "is_deleted"],
    "transaction": ["txn_id", "card_id", "terminal_id", "txn_ts", "amount", "currency_code",
                    "txn_type", "status"],
}

# boolean source columns stored as 0/1 in the warehouse
FLAG_COLUMNS = {
    "customer": ["is_deleted"],
    "account": ["is_deleted"],
    "card": ["is_deleted"],
    "terminal": ["is_working", "is_deleted"],
    "transaction": [],
}

# audit columns dropped by the ods dimensions
AUDIT_COLUMNS = ("created_at", "updated_at")

PRIMARY_KEYS = {
    "customer": "customer_id",
    "account": "account_id",
    "card": "card_id",
    "terminal": "terminal_id",
    "transaction": "txn_id",
}

# incremental cursor per entity
CURSORS = {
    "customer": "updated_at",
    "account": "updated_at",
    "card": "updated_at",
    "terminal": "updated_at",
    "transaction": "txn_id",
}

# NOT NULL columns of the source schema
NOT_NULL = {
    "customer": ["customer_id", "customer_uuid", "full_name", "created_at", "updated_at",
                 "is_deleted"],
    "account": ["account_id", "account_number", "customer_id", "currency_code", "opened_at",
                "status", "daily_transfer_limit", "created_at", "updated_at", "is_deleted"],
    "card": ["card_id", "card_number", "account_id", "status", "opened_at", "created_at",
             "updated_at", "is_deleted"],
    "terminal": ["terminal_id", "terminal_code", "city", "country", "created_at", "updated_at",
                 "is_working", "is_deleted"],
    "transaction": ["txn_id", "card_id", "txn_ts", "amount", "currency_code", "txn_type",
                    "status"],
}

# ---------------------------------------------------------------------------
# Struct types
# ---------------------------------------------------------------------------
TS = T.TimestampNTZType()

CARD_PAYLOAD = T.StructType([
    T.StructField("card_id", T.LongType()),
    T.StructField("card_number", T.StringType()),
    T.StructField("account_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("opened_at", T.StringType()),
    T.StructField("closed_at", T.StringType()),
    T.StructField("is_deleted", T.BooleanType()),
])

TXN_PAYLOAD = T.StructType([
    T.StructField("txn_id", T.LongType()),
    T.StructField("card_id", T.LongType()),
    T.StructField("terminal_id", T.LongType()),
    T.StructField("txn_ts", T.StringType()),
    T.StructField("amount", T.DecimalType(AMOUNT_PRECISION, AMOUNT_SCALE)),
    T.StructField("currency_code", T.StringType()),
    T.StructField("txn_type", T.StringType()),
    T.StructField("status", T.StringType()),
])

# Kafka-shaped record (the columns a Kafka source produces, value as text)
CDC_RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", TS),
    T.StructField("value", T.StringType()),
])

# landing tables of the change stream
STG_CDC_CARD = T.StructType([
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("card_id", T.LongType()),
    T.StructField("payload_before", T.StringType()),
    T.StructField("payload_after", T.StringType()),
    T.StructField("src_ts", TS),
])

STG_CDC_TRANSACTION = T.StructType([
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("txn_id", T.LongType()),
    T.StructField("payload_after", T.StringType()),
    T.StructField("src_ts", TS),
])

CTL_LOAD = T.StructType([
    T.StructField("process_name", T.StringType()),
    T.StructField("src_table", T.StringType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("updated_at", TS),
])

METRICS = T.StructType([
    T.StructField("ts", TS),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("labels", T.StringType()),
])
