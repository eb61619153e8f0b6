"""DuckDB twins of the registered queries.

The ``bk_*`` common table expressions restate ``vaultline.bindings`` in SQL
over the pre-registered parquet views, so each twin derives the bank model
from the same files and computes the operator independently.
"""

from __future__ import annotations

LOAD_TS = "TIMESTAMP '2025-01-01 00:00:00'"

_CUR = "CASE {k} % 3 WHEN 0 THEN 'RUB' WHEN 1 THEN 'USD' ELSE 'EUR' END"

BINDINGS: dict[str, str] = {
    "bk_customer": """
  SELECT c.c_custkey AS customer_id,
         md5(CAST(c.c_custkey AS VARCHAR)) AS customer_uuid,
         c.c_name AS full_name,
         CAST(DATE '1980-01-01' + CAST(c.c_custkey % 15000 AS INTEGER) AS DATE) AS birth_date,
         'customer' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email,
         CASE WHEN c.c_custkey % 10 <> 0
              THEN '+1000000' || lpad(CAST(c.c_custkey AS VARCHAR), greatest(4, length(CAST(c.c_custkey AS VARCHAR)))::INTEGER, '0') END AS phone,
         n.n_name AS city,
         TIMESTAMP '2020-01-01 00:00:00' AS created_at,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c.c_custkey) AS updated_at,
         c.c_acctbal < 0 AS is_deleted
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "bk_account": f"""
  SELECT o_orderkey AS account_id,
         'ACC' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS account_number,
         o_custkey AS customer_id,
         {_CUR.format(k='o_orderkey')} AS currency_code,
         o_orderdate AS opened_at,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 90 DAY END AS closed_at,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'closed'
                            WHEN 'P' THEN 'blocked' END AS status,
         CAST(o_totalprice AS DECIMAL(18,2)) AS daily_transfer_limit,
         o_orderdate AS created_at,
         coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 90 DAY END,
                  o_orderdate) AS updated_at,
         o_orderstatus = 'F' AS is_deleted
  FROM orders""",
    "bk_card": """
  SELECT CASE WHEN p_partkey % 50 = 49 THEN -p_partkey ELSE p_partkey END AS card_id,
         lpad(CAST(p_partkey AS VARCHAR), 16, '4') AS card_number,
         p_partkey * 3 AS account_id,
         CASE WHEN p_size % 10 = 0 THEN 'closed' WHEN p_size % 10 = 1 THEN 'blocked'
              ELSE 'active' END AS status,
         TIMESTAMP '2020-01-01 00:00:00' + to_days(p_size) AS opened_at,
         CASE WHEN p_size % 10 = 0 THEN TIMESTAMP '2024-01-15 00:00:00' END AS closed_at,
         TIMESTAMP '2020-01-01 00:00:00' + to_days(p_size) AS created_at,
         CASE WHEN p_size % 10 IN (0, 1) THEN TIMESTAMP '2024-01-15 00:00:00'
              ELSE TIMESTAMP '2020-01-01 00:00:00' + to_days(p_size) END AS updated_at,
         p_size % 10 = 0 AS is_deleted
  FROM part""",
    "bk_terminal": """
  SELECT s.s_suppkey AS terminal_id,
         'ATM-' || lpad(CAST(s.s_suppkey AS VARCHAR), greatest(5, length(CAST(s.s_suppkey AS VARCHAR)))::INTEGER, '0') AS terminal_code,
         n.n_name AS city,
         'R' || CAST(n.n_regionkey AS VARCHAR) AS country,
         CAST(55 AS DOUBLE) + CAST(s.s_suppkey AS DOUBLE) / 1000.0 AS latitude,
         CAST(37 AS DOUBLE) + CAST(s.s_suppkey AS DOUBLE) / 1000.0 AS longitude,
         TIMESTAMP '2020-01-01 00:00:00' AS created_at,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(s.s_suppkey) AS updated_at,
         s.s_acctbal >= 0 AS is_working,
         NOT (s.s_acctbal >= 0) AS is_deleted
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "bk_txn": f"""
  SELECT event_id AS txn_id,
         user_id AS card_id,
         TRY_CAST((props->>'$.k') AS BIGINT) AS terminal_id,
         ts AS txn_ts,
         CAST(value AS DECIMAL(18,2)) AS amount,
         {_CUR.format(k='event_id')} AS currency_code,
         CASE WHEN event_id % 4 = 0 THEN 'atm_deposit' ELSE 'atm_withdrawal' END AS txn_type,
         CASE event_type WHEN 'error' THEN 'declined' WHEN 'signup' THEN 'reversed'
                         ELSE 'approved' END AS status
  FROM events""",
    "bk_txn_volume": f"""
  SELECT l_orderkey * 10 + l_linenumber AS txn_id,
         l_partkey AS card_id,
         l_suppkey AS terminal_id,
         l_shipdate AS txn_ts,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         {_CUR.format(k='l_orderkey')} AS currency_code,
         CASE WHEN l_linenumber % 4 = 0 THEN 'atm_deposit' ELSE 'atm_withdrawal' END AS txn_type,
         CASE l_returnflag WHEN 'R' THEN 'reversed' WHEN 'A' THEN 'declined'
                           ELSE 'approved' END AS status
  FROM lineitem""",
}

_CARD_OP = ("CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' "
            "WHEN 'purchase' THEN 'r' ELSE 'u' END")

# the card change log as landed (one row per event with a card key)
BINDINGS["bk_card_log"] = f"""
  SELECT user_id AS card_id,
         CAST(user_id % 3 AS INTEGER) AS kafka_partition,
         event_id AS kafka_offset,
         {_CARD_OP} AS op,
         date_trunc('millisecond', ts) AS src_ts,
         event_id, ts
  FROM events WHERE user_id IS NOT NULL"""

# transactions with the event type that decides their change op
BINDINGS["bk_txn_ev"] = BINDINGS["bk_txn"].replace(
    "  FROM events", "  , event_type, date_trunc('millisecond', ts) AS src_ts\n  FROM events")

# warehouse (0/1 flag) versions of the source frames
BINDINGS["raw_customer"] = """
  SELECT * REPLACE (CAST(is_deleted AS INTEGER) AS is_deleted) FROM bk_customer"""
BINDINGS["raw_account"] = """
  SELECT * REPLACE (CAST(is_deleted AS INTEGER) AS is_deleted) FROM bk_account"""
BINDINGS["raw_card"] = """
  SELECT * REPLACE (CAST(is_deleted AS INTEGER) AS is_deleted) FROM bk_card"""
BINDINGS["raw_terminal"] = """
  SELECT * REPLACE (CAST(is_working AS INTEGER) AS is_working,
                    CAST(is_deleted AS INTEGER) AS is_deleted) FROM bk_terminal"""
BINDINGS["raw_txn"] = "SELECT * FROM bk_txn"

_ORDER = list(BINDINGS)

SQL: dict[str, str] = {}


def with_(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the binding CTEs it needs (dependencies included)."""
    deps = {
        "raw_customer": ["bk_customer"], "raw_account": ["bk_account"],
        "raw_card": ["bk_card"], "raw_terminal": ["bk_terminal"], "raw_txn": ["bk_txn"],
    }
    need: list[str] = []

    def add(n):
        for d in deps.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    need.sort(key=_ORDER.index)
    ctes = [f"{n} AS ({BINDINGS[n]}\n)" for n in need]
    for n, q in (extra or {}).items():
        ctes.append(f"{n} AS ({q}\n)")
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


FACT_SELECT = f"""
SELECT t.txn_id, t.txn_ts, CAST(t.amount AS DOUBLE) AS amount, t.currency_code,
       cd.card_id, cd.card_number, ac.account_id, ac.account_number,
       cu.customer_id, cu.city AS customer_city, te.terminal_id, te.city AS terminal_city,
       t.txn_type, t.status, {LOAD_TS} AS loaded_at
FROM {{txn}} t
LEFT JOIN raw_card cd ON cd.card_id = t.card_id
LEFT JOIN raw_account ac ON ac.account_id = cd.account_id
LEFT JOIN raw_customer cu ON cu.customer_id = ac.customer_id
LEFT JOIN raw_terminal te ON te.terminal_id = t.terminal_id"""

SQL["fact_atm_transaction"] = with_(
    FACT_SELECT.format(txn="raw_txn"),
    "raw_txn", "raw_card", "raw_account", "raw_customer", "raw_terminal")

SQL["fact_unmatched_defaults"] = with_(f"""
SELECT t.txn_id, t.txn_ts, CAST(t.amount AS DOUBLE) AS amount, t.currency_code,
       coalesce(cd.card_id, 0) AS card_id, coalesce(cd.card_number, '') AS card_number,
       coalesce(ac.account_id, 0) AS account_id, coalesce(ac.account_number, '') AS account_number,
       coalesce(cu.customer_id, 0) AS customer_id, coalesce(cu.city, '') AS customer_city,
       coalesce(te.terminal_id, 0) AS terminal_id, coalesce(te.city, '') AS terminal_city,
       t.txn_type, t.status, {LOAD_TS} AS loaded_at
FROM raw_txn t
LEFT JOIN raw_card cd ON cd.card_id = t.card_id
LEFT JOIN raw_account ac ON ac.account_id = cd.account_id
LEFT JOIN raw_customer cu ON cu.customer_id = ac.customer_id
LEFT JOIN raw_terminal te ON te.terminal_id = t.terminal_id""",
    "raw_txn", "raw_card", "raw_account", "raw_customer", "raw_terminal")

SQL["fact_atm_transaction_volume"] = with_(
    FACT_SELECT.format(txn="bk_txn_volume"),
    "bk_txn_volume", "raw_card", "raw_account", "raw_customer", "raw_terminal")

# ---------------------------------------------------------------------------
# projections
# ---------------------------------------------------------------------------
from vaultline.schemas import AUDIT_COLUMNS, SOURCE_COLUMNS  # noqa: E402

_SQL_CAST = {"birth_date": "strftime(birth_date, '%Y-%m-%d') AS birth_date",
             "daily_transfer_limit": "CAST(daily_transfer_limit AS DOUBLE) AS daily_transfer_limit",
             "amount": "CAST(amount AS DOUBLE) AS amount"}


def cols_sql(entity: str, drop=(), prefix: str = "") -> str:
    out = []
    for c in SOURCE_COLUMNS[entity]:
        if c in drop:
            continue
        out.append(_SQL_CAST.get(c, c).replace(c, prefix + c, 1) if prefix else _SQL_CAST.get(c, c))
    return ", ".join(out)


_RAW = {"customer": "raw_customer", "account": "raw_account", "card": "raw_card",
        "terminal": "raw_terminal", "transaction": "raw_txn"}
for _e, _t in _RAW.items():
    SQL[f"stg_{_e}"] = with_(f"SELECT {cols_sql(_e)} FROM {_t}", _t)
    if _e != "transaction":
        SQL[f"dim_{_e}"] = with_(
            f"SELECT {cols_sql(_e, drop=AUDIT_COLUMNS)}, {LOAD_TS} AS loaded_at FROM {_t}", _t)

SQL["extract_snapshot_flags"] = with_(f"SELECT {cols_sql('terminal')} FROM raw_terminal",
                                      "raw_terminal")

SQL["active_cards"] = with_("""
SELECT cd.card_id, cd.account_id, ac.customer_id
FROM bk_card cd
JOIN bk_account ac ON cd.account_id = ac.account_id
JOIN bk_customer cu ON ac.customer_id = cu.customer_id
WHERE cd.status = 'active' AND coalesce(cd.is_deleted, FALSE) = FALSE
  AND ac.status = 'active' AND coalesce(ac.is_deleted, FALSE) = FALSE
  AND coalesce(cu.is_deleted, FALSE) = FALSE""", "bk_card", "bk_account", "bk_customer")

SQL["active_terminals"] = with_("""
SELECT terminal_id, terminal_code, city FROM bk_terminal
WHERE coalesce(is_working, FALSE) AND coalesce(is_deleted, FALSE) = FALSE""", "bk_terminal")

_NO_ACTIVE = with_("""
SELECT cu.customer_id
FROM bk_customer cu
LEFT JOIN bk_account a
  ON a.customer_id = cu.customer_id AND a.status = 'active'
 AND coalesce(a.is_deleted, FALSE) = FALSE
WHERE coalesce(cu.is_deleted, FALSE) = FALSE
GROUP BY cu.customer_id
HAVING COUNT(a.account_id) = 0""", "bk_customer", "bk_account")
SQL["customers_without_active_accounts"] = _NO_ACTIVE
SQL["customers_without_active_accounts_having"] = _NO_ACTIVE

# ---------------------------------------------------------------------------
# incremental
# ---------------------------------------------------------------------------
PREVIOUS_RUN = "TIMESTAMP '2024-01-15 00:00:00'"

SQL["high_watermark"] = with_("SELECT coalesce(max(txn_id), 0) AS last_id FROM raw_txn", "raw_txn")
SQL["high_watermark_empty"] = with_(
    "SELECT coalesce(max(txn_id), 0) AS last_id FROM raw_txn WHERE txn_id < 0", "raw_txn")

SQL["extract_incremental_txn"] = with_(f"""
SELECT {cols_sql('transaction')} FROM raw_txn
WHERE txn_id > (SELECT coalesce(max(txn_id), 0) FROM raw_txn WHERE txn_ts < {PREVIOUS_RUN})""",
    "raw_txn")

SQL["delta_by_updated_at"] = with_(f"""
SELECT {cols_sql('customer')} FROM raw_customer
WHERE updated_at > (SELECT max(updated_at) FROM raw_customer
                    WHERE updated_at < TIMESTAMP '2024-01-01 12:00:00')
   OR updated_at IS NULL""", "raw_customer")

SQL["upsert_by_key"] = with_(f"""
SELECT {cols_sql('account')} FROM (
  SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.account_id = t.account_id)
  UNION ALL
  SELECT * FROM batch)""", "raw_account", extra={
    "target": """SELECT * REPLACE ('active' AS status, CAST(NULL AS TIMESTAMP) AS closed_at,
                        0 AS is_deleted, opened_at AS updated_at)
                 FROM raw_account WHERE opened_at < TIMESTAMP '1998-01-01 00:00:00'""",
    "batch": "SELECT * FROM raw_account WHERE updated_at >= TIMESTAMP '1998-01-01 00:00:00'"})

SQL["latest_per_key"] = with_("""
SELECT card_id, op, src_ts, kafka_partition, kafka_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY card_id
                               ORDER BY src_ts DESC, kafka_partition DESC, kafka_offset DESC) AS rn
  FROM bk_card_log) WHERE rn = 1""", "bk_card_log")

_CTL = """SELECT 'pg_to_dwh' AS process_name, 'transaction' AS src_table, max(txn_id) AS last_id,
       CAST(CAST(txn_ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS updated_at
  FROM raw_txn GROUP BY CAST(txn_ts AS DATE)"""
for _name, _tbl in (("read_watermark", "transaction"), ("read_watermark_missing", "card")):
    SQL[_name] = with_(f"""
SELECT coalesce((SELECT last_id FROM ctl WHERE process_name = 'pg_to_dwh'
                 AND src_table = '{_tbl}' ORDER BY updated_at DESC, last_id DESC LIMIT 1),
                0) AS last_id""", "raw_txn", extra={"ctl": _CTL})

# ---------------------------------------------------------------------------
# CDC
# ---------------------------------------------------------------------------
SQL["cdc_decode"] = with_(f"""
SELECT 'bankcdc.bank.card' AS topic, kafka_partition AS partition, kafka_offset AS "offset",
       op, src_ts, TRUE AS decoded FROM bk_card_log
UNION ALL
SELECT 'bankcdc.bank.transaction', CAST(txn_id % 3 AS INTEGER), txn_id,
       CASE WHEN event_type = 'purchase' THEN 'r' ELSE 'c' END, src_ts, TRUE FROM bk_txn_ev
UNION ALL
SELECT '__heartbeat.bankcdc', 0, s_suppkey, NULL,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(s_suppkey), TRUE FROM supplier
UNION ALL
SELECT 'bankcdc.bank.terminal', 0, s_suppkey, 'c',
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(s_suppkey), TRUE FROM supplier
UNION ALL
SELECT 'bankcdc.bank.card', 3, CAST(r_regionkey AS BIGINT), NULL,
       TIMESTAMP '2024-01-01 00:00:00', FALSE FROM region""", "bk_card_log", "bk_txn_ev")

SQL["cdc_route_ops"] = with_("""
SELECT 'card' AS kind, op, count(*) AS n FROM bk_card_log GROUP BY op
UNION ALL
SELECT 'transaction' AS kind, CASE WHEN event_type = 'purchase' THEN 'r' ELSE 'c' END AS op,
       count(*) AS n
FROM bk_txn_ev WHERE txn_id IS NOT NULL GROUP BY 2""", "bk_card_log", "bk_txn_ev")

_LANDED = "SELECT kafka_partition, kafka_offset, op, card_id, src_ts FROM bk_card_log"
SQL["cdc_landing_card"] = with_(_LANDED, "bk_card_log")
SQL["cdc_dedupe"] = with_(_LANDED, "bk_card_log")

SQL["raw_transaction_cdc"] = with_(f"""
SELECT txn_id, card_id, terminal_id, txn_ts, CAST(amount AS DOUBLE) AS amount, currency_code,
       txn_type, status, {LOAD_TS} AS loaded_at
FROM bk_txn_ev WHERE event_type <> 'purchase' AND txn_id IS NOT NULL""", "bk_txn_ev")

_SCD2_VERSIONS = """
  SELECT card_id,
         CASE WHEN op <> 'd' THEN lpad(CAST(card_id AS VARCHAR), 16, '4') END AS card_number,
         CASE WHEN op <> 'd' THEN card_id * 3 END AS account_id,
         CASE WHEN op <> 'd' THEN 'S' || CAST(event_id % 7 AS VARCHAR) END AS status,
         CASE WHEN op <> 'd' THEN TIMESTAMP '2020-01-01 00:00:00'
                                  + to_days(CAST(card_id % 365 AS INTEGER)) END AS opened_at,
         CASE WHEN op <> 'd' AND event_id % 7 = 0 THEN ts END AS closed_at,
         CASE WHEN op = 'd' OR event_id % 7 = 0 THEN 1 ELSE 0 END AS is_deleted,
         src_ts, kafka_partition, kafka_offset
  FROM bk_card_log"""

_SCD2 = f"""
  SELECT md5(CAST(card_id AS VARCHAR) || '|' || CAST(epoch_ms(src_ts) AS VARCHAR) || '|'
             || CAST(kafka_partition AS VARCHAR) || '|' || CAST(kafka_offset AS VARCHAR)) AS card_sk,
         card_id, card_number, account_id, status, opened_at, closed_at, is_deleted,
         src_ts AS valid_from,
         coalesce(lead(src_ts) OVER w, TIMESTAMP '2999-12-31 00:00:00') AS valid_to,
         CASE WHEN lead(src_ts) OVER w IS NULL THEN 1 ELSE 0 END AS is_current,
         src_ts, {LOAD_TS} AS loaded_at
  FROM versions
  WINDOW w AS (PARTITION BY card_id ORDER BY src_ts, kafka_partition, kafka_offset)"""

_SCD2_CTES = {"versions": _SCD2_VERSIONS, "scd": _SCD2}
_VALID_TO_TEXT = "strftime(valid_to, '%Y-%m-%d %H:%M:%S.%g') AS valid_to"
SQL["scd2_card"] = with_(f"SELECT * REPLACE ({_VALID_TO_TEXT}) FROM scd", "bk_card_log",
                         extra=_SCD2_CTES)
SQL["scd2_current"] = with_(f"SELECT * REPLACE ({_VALID_TO_TEXT}) FROM scd WHERE is_current = 1",
                            "bk_card_log", extra=_SCD2_CTES)
SQL["scd2_as_of"] = with_("""
SELECT t.txn_id, t.card_id, t.txn_ts, s.card_sk, s.status AS card_status,
       s.is_deleted AS card_is_deleted
FROM raw_txn t
LEFT JOIN scd s ON s.card_id = t.card_id AND s.valid_from <= t.txn_ts AND t.txn_ts < s.valid_to""",
    "raw_txn", "bk_card_log", extra=_SCD2_CTES)
SQL["scd2_version_number"] = with_("""
SELECT card_id, kafka_offset,
       CAST(row_number() OVER (PARTITION BY card_id
                               ORDER BY src_ts, kafka_partition, kafka_offset) AS INTEGER) AS rn
FROM bk_card_log""", "bk_card_log")

# ---------------------------------------------------------------------------
# quality
# ---------------------------------------------------------------------------
SQL["duplicate_keys"] = with_("""
SELECT txn_id, count(*) AS n FROM bk_txn_volume GROUP BY txn_id HAVING count(*) > 1""",
                              "bk_txn_volume")

SQL["unique_violations"] = with_("\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value,
       count(*) AS n FROM {v} GROUP BY {c} HAVING count(*) > 1"""
    for t, v, c in (("customer", "bk_customer", "customer_uuid"),
                    ("account", "bk_account", "account_number"),
                    ("card", "bk_card", "card_number"),
                    ("terminal", "bk_terminal", "terminal_code"))),
    "bk_customer", "bk_account", "bk_card", "bk_terminal")


def _orphan(rel, child, child_key, fk, parent, pk):
    return f"""SELECT '{rel}' AS relation, CAST(x.{child_key} AS BIGINT) AS child_id,
       CAST(x.{fk} AS BIGINT) AS fk_value
FROM {child} x WHERE x.{fk} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = x.{fk})"""


SQL["fk_orphans"] = with_("\nUNION ALL\n".join([
    _orphan("transaction.card_id", "bk_txn", "txn_id", "card_id", "bk_card", "card_id"),
    _orphan("transaction.terminal_id", "bk_txn", "txn_id", "terminal_id", "bk_terminal",
            "terminal_id"),
    _orphan("card.account_id", "bk_card", "card_id", "account_id", "bk_account", "account_id"),
    _orphan("account.customer_id", "bk_account", "account_id", "customer_id", "bk_customer",
            "customer_id")]), "bk_txn", "bk_card", "bk_terminal", "bk_account", "bk_customer")

from vaultline.schemas import NOT_NULL  # noqa: E402


def _nulls(table, view):
    parts = []
    for c in SOURCE_COLUMNS[table]:
        nn = "TRUE" if c in NOT_NULL[table] else "FALSE"
        parts.append(f"""SELECT '{table}' AS table_name, '{c}' AS column_name,
       CAST(count(*) - count({c}) AS BIGINT) AS null_count,
       ({nn} AND count(*) - count({c}) > 0) AS violation FROM {view}""")
    return "\nUNION ALL\n".join(parts)


SQL["null_counts"] = with_(_nulls("customer", "bk_customer") + "\nUNION ALL\n"
                           + _nulls("transaction", "bk_txn"), "bk_customer", "bk_txn")


def _domain(table, view, col, allowed):
    vals = ", ".join(f"'{a}'" for a in allowed)
    return f"""SELECT '{table}' AS table_name, '{col}' AS column_name, CAST({col} AS VARCHAR) AS value,
       count(*) AS n FROM {view} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}) GROUP BY {col}"""


from vaultline.schemas import (ACCOUNT_STATUSES, CARD_STATUSES, CURRENCIES,  # noqa: E402
                               TXN_STATUSES, TXN_TYPES)

SQL["domain_violations"] = with_("\nUNION ALL\n".join([
    _domain("transaction", "bk_txn", "txn_type", TXN_TYPES),
    _domain("transaction", "bk_txn", "status", TXN_STATUSES),
    _domain("account", "bk_account", "status", ACCOUNT_STATUSES),
    _domain("account", "bk_account", "currency_code", CURRENCIES),
    _domain("card", "bk_card", "status", CARD_STATUSES),
    _domain("card_scd2", "versions", "status", CARD_STATUSES)]),
    "bk_txn", "bk_account", "bk_card", "bk_card_log", extra={"versions": _SCD2_VERSIONS})


def _length(table, view, col, rule, n):
    bad = {"eq": f"length({col}) <> {n}", "max": f"length({col}) > {n}",
           "int_digits": f"abs(CAST({col} AS DOUBLE)) >= 1e{n}"}[rule]
    return f"""SELECT '{table}' AS table_name, '{col}' AS column_name, '{rule}:{n}' AS rule,
       CAST(coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_violations
FROM {view}"""


SQL["length_violations"] = with_("\nUNION ALL\n".join([
    _length("account", "bk_account", "currency_code", "eq", 3),
    _length("account", "bk_account", "account_number", "max", 34),
    _length("account", "bk_account", "daily_transfer_limit", "int_digits", 16),
    _length("card", "bk_card", "card_number", "max", 16),
    _length("transaction", "bk_txn_volume", "currency_code", "eq", 3),
    _length("transaction", "bk_txn_volume", "amount", "int_digits", 16)]),
    "bk_account", "bk_card", "bk_txn_volume")

# ---------------------------------------------------------------------------
# monitoring
# ---------------------------------------------------------------------------
_LAG_CTES = {
    "e": """SELECT 'bankcdc.bank.' || event_type AS topic,
                   CAST(user_id % 3 AS INTEGER) AS "partition", event_id FROM events""",
    "endo": """SELECT topic, "partition", max(event_id) + 1 AS end_offset FROM e GROUP BY 1, 2""",
    "com": """SELECT topic, "partition", max(event_id) + 1 AS committed_offset FROM e
              WHERE event_id % 10 <> 9 GROUP BY 1, 2""",
    "lag": """SELECT endo.topic, endo."partition", end_offset,
                     coalesce(committed_offset, 0) AS committed_offset,
                     greatest(0, end_offset - coalesce(committed_offset, 0)) AS lag
              FROM endo LEFT JOIN com ON com.topic = endo.topic
                                     AND com."partition" = endo."partition\"""",
}
_METRICS = f"""
  SELECT {LOAD_TS} AS ts, 'kafka_partition_lag' AS metric, CAST(lag AS DOUBLE) AS value,
         CAST(json_object('topic', topic, 'partition', "partition") AS VARCHAR) AS labels
  FROM lag
  UNION ALL
  SELECT {LOAD_TS}, 'kafka_total_lag', CAST(coalesce(sum(lag), 0) AS DOUBLE),
         CAST(json_object('group', 'dwh_cdc_v1') AS VARCHAR) FROM lag"""
SQL["kafka_lag"] = with_("SELECT * FROM lag", extra=_LAG_CTES)
SQL["lag_metrics"] = with_(_METRICS, extra=_LAG_CTES)
SQL["lag_alert"] = with_("""
SELECT total_lag, 5000 AS threshold, total_lag > 5000 AS breached
FROM (SELECT coalesce(max(value), 0.0) AS total_lag FROM metrics
      WHERE metric = 'kafka_total_lag')""", extra={**_LAG_CTES, "metrics": _METRICS})

# ---------------------------------------------------------------------------
# fraud
# ---------------------------------------------------------------------------
_RAPID = """
  SELECT * FROM (
    SELECT txn_id, card_id, txn_ts, count(*) OVER win AS n_ops,
           CAST(count(DISTINCT terminal_id) OVER win AS INTEGER) AS n_terminals
    FROM raw_txn WHERE txn_type = 'atm_withdrawal'
    WINDOW win AS (PARTITION BY card_id ORDER BY txn_ts
                   RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW))
  WHERE n_ops >= 3 AND n_terminals >= 2"""
SQL["rapid_withdrawals"] = with_("SELECT * FROM rapid", "raw_txn", extra={"rapid": _RAPID})

SQL["rapid_withdrawal_sessions"] = with_("""
SELECT card_id, min(txn_ts) AS session_start, max(txn_ts) + INTERVAL 21600 SECOND AS session_end,
       count(*) AS n_ops, count(DISTINCT terminal_id) AS n_terminals
FROM s GROUP BY card_id, sid
HAVING count(*) >= 3 AND count(DISTINCT terminal_id) >= 2""", "raw_txn", extra={
    "l": """SELECT txn_id, card_id, txn_ts, terminal_id,
                   lag(txn_ts) OVER (PARTITION BY card_id ORDER BY txn_ts, txn_id) AS prev_ts
            FROM raw_txn WHERE txn_type = 'atm_withdrawal'""",
    "b": """SELECT *, CASE WHEN prev_ts IS NULL
                            OR epoch_us(txn_ts) - epoch_us(prev_ts) >= 21600000000
                       THEN 1 ELSE 0 END AS brk FROM l""",
    "s": """SELECT *, sum(brk) OVER (PARTITION BY card_id ORDER BY txn_ts, txn_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
            FROM b"""})

SQL["used_after_block"] = with_("""
SELECT t.txn_id, t.card_id, t.txn_ts, t.status, c.status AS card_status, c.updated_at AS blocked_at
FROM raw_txn t JOIN bk_card c ON c.card_id = t.card_id
WHERE c.status IN ('blocked', 'closed') AND t.txn_ts > c.updated_at""", "raw_txn", "bk_card")


SQL["used_after_block_versions"] = with_("""
SELECT t.txn_id, t.card_id, t.txn_ts, t.status, s.status AS card_status, s.valid_from AS blocked_at
FROM raw_txn t
JOIN scd s ON s.card_id = t.card_id AND s.valid_from <= t.txn_ts AND t.txn_ts < s.valid_to
WHERE s.status = 'S0'""", "raw_txn", "bk_card_log", extra=_SCD2_CTES)


def _probe(keys, gap_us):
    part = ", ".join(keys)
    return with_(f"""
SELECT {part}, run_start, run_end, n_attempts, n_declined, first_amount, last_amount, last_status,
       (n_declined - CASE WHEN last_status = 'declined' THEN 1 ELSE 0 END) = n_attempts - 1
       AS probing
FROM g WHERE n_attempts >= 3""", "raw_txn", extra={
        "l": f"""SELECT txn_id, {part}, txn_ts, amount, status,
                        lag(txn_ts) OVER o AS prev_ts, lag(amount) OVER o AS prev_amount
                 FROM raw_txn WHERE txn_type = 'atm_withdrawal'
                 WINDOW o AS (PARTITION BY {part} ORDER BY txn_ts, txn_id)""",
        "b": f"""SELECT *, CASE WHEN prev_ts IS NULL
                                 OR epoch_us(txn_ts) - epoch_us(prev_ts) > {gap_us}
                                 OR amount > prev_amount THEN 1 ELSE 0 END AS brk FROM l""",
        "r": f"""SELECT *, sum(brk) OVER (PARTITION BY {part} ORDER BY txn_ts, txn_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_id
                 FROM b""",
        "g": f"""SELECT {part}, run_id, min(txn_ts) AS run_start, max(txn_ts) AS run_end,
                        count(*) AS n_attempts,
                        CAST(sum(CASE WHEN status = 'declined' THEN 1 ELSE 0 END) AS BIGINT)
                        AS n_declined,
                        CAST(first(amount ORDER BY txn_ts, txn_id) AS DOUBLE) AS first_amount,
                        CAST(last(amount ORDER BY txn_ts, txn_id) AS DOUBLE) AS last_amount,
                        last(status ORDER BY txn_ts, txn_id) AS last_status
                 FROM r GROUP BY {part}, run_id"""})


SQL["amount_probe"] = _probe(["card_id"], 24 * 3600 * 1_000_000)
SQL["amount_probe_card_terminal"] = _probe(["card_id", "terminal_id"], 30 * 86_400 * 1_000_000)

# ---------------------------------------------------------------------------
# lifecycle
# ---------------------------------------------------------------------------
CLOSE_TS = "TIMESTAMP '2024-02-01 00:00:00'"


def _close_card_sql(keys_sql: str, status: str, closing: bool) -> str:
    hit = "k.card_id IS NOT NULL"
    deleted = f"CASE WHEN {hit} THEN TRUE ELSE c.is_deleted END" if closing else "c.is_deleted"
    closed = f"CASE WHEN {hit} THEN {CLOSE_TS} ELSE c.closed_at END" if closing else "c.closed_at"
    return f"""
SELECT c.card_id, CASE WHEN {hit} THEN '{status}' ELSE c.status END AS status,
       {deleted} AS is_deleted, {closed} AS closed_at,
       CASE WHEN {hit} THEN {CLOSE_TS} ELSE c.updated_at END AS updated_at
FROM bk_card c LEFT JOIN (SELECT DISTINCT card_id FROM ({keys_sql})) k ON k.card_id = c.card_id"""


SQL["close_cards"] = with_(
    _close_card_sql("SELECT card_id FROM bk_txn WHERE status = 'declined'", "closed", True),
    "bk_card", "bk_txn")
SQL["block_cards"] = with_(_close_card_sql("SELECT card_id FROM rapid", "blocked", False),
                           "bk_card", "raw_txn", extra={"rapid": _RAPID})

SQL["close_accounts_cascade"] = with_(f"""
SELECT 'account' AS entity, a.account_id AS id,
       CASE WHEN k.account_id IS NOT NULL THEN 'closed' ELSE a.status END AS status,
       CASE WHEN k.account_id IS NOT NULL THEN TRUE ELSE a.is_deleted END AS is_deleted,
       CASE WHEN k.account_id IS NOT NULL THEN {CLOSE_TS} ELSE a.closed_at END AS closed_at,
       CASE WHEN k.account_id IS NOT NULL THEN {CLOSE_TS} ELSE a.updated_at END AS updated_at
FROM bk_account a LEFT JOIN k ON k.account_id = a.account_id
UNION ALL
SELECT 'card', c.card_id,
       CASE WHEN hit THEN 'closed' ELSE c.status END,
       CASE WHEN hit THEN TRUE ELSE c.is_deleted END,
       CASE WHEN hit THEN {CLOSE_TS} ELSE c.closed_at END,
       CASE WHEN hit THEN {CLOSE_TS} ELSE c.updated_at END
FROM (SELECT c.*, (k.account_id IS NOT NULL AND c.status = 'active'
                   AND coalesce(c.is_deleted, FALSE) = FALSE) AS hit
      FROM bk_card c LEFT JOIN k ON k.account_id = c.account_id) c""",
    "bk_account", "bk_card",
    extra={"k": "SELECT DISTINCT account_id FROM bk_account WHERE status = 'blocked'"})

SQL["close_customers"] = with_(f"""
SELECT c.customer_id, CASE WHEN e.customer_id IS NOT NULL THEN TRUE ELSE c.is_deleted END
       AS is_deleted,
       CASE WHEN e.customer_id IS NOT NULL THEN {CLOSE_TS} ELSE c.updated_at END AS updated_at
FROM bk_customer c LEFT JOIN eligible e ON e.customer_id = c.customer_id""",
    "bk_customer", "bk_account", extra={"eligible": """
  SELECT cu.customer_id FROM bk_customer cu
  LEFT JOIN bk_account a ON a.customer_id = cu.customer_id AND a.status = 'active'
   AND coalesce(a.is_deleted, FALSE) = FALSE
  WHERE coalesce(cu.is_deleted, FALSE) = FALSE
  GROUP BY cu.customer_id HAVING COUNT(a.account_id) = 0"""})

SQL["close_terminals"] = with_(f"""
SELECT t.terminal_id,
       CASE WHEN hit THEN FALSE ELSE t.is_working END AS is_working,
       CASE WHEN hit THEN TRUE ELSE t.is_deleted END AS is_deleted,
       CASE WHEN hit THEN {CLOSE_TS} ELSE t.updated_at END AS updated_at
FROM (SELECT t.*, NOT EXISTS (SELECT 1 FROM bk_txn x WHERE x.terminal_id = t.terminal_id) AS hit
      FROM bk_terminal t) t""", "bk_terminal", "bk_txn")

# ---------------------------------------------------------------------------
# relational
# ---------------------------------------------------------------------------
SQL["fan_out"] = with_("""
SELECT account_id, CAST(s AS INTEGER) AS seq
FROM (SELECT account_id, unnest(generate_series(1, 1 + account_id % 2)) AS s FROM bk_account)""",
                       "bk_account")

SQL["lateral_top1"] = with_("""
SELECT c.card_id, t.txn_id AS last_txn_id, t.txn_ts AS last_txn_ts,
       t.terminal_id AS last_terminal_id
FROM bk_card c
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY card_id
                                        ORDER BY txn_ts DESC, txn_id DESC) AS rn
           FROM raw_txn) t ON t.card_id = c.card_id AND t.rn = 1""", "bk_card", "raw_txn")

SQL["global_row_id"] = with_(
    "SELECT txn_id, row_number() OVER (ORDER BY txn_ts, txn_id) AS row_id FROM raw_txn", "raw_txn")

SQL["sample_k"] = with_("""
SELECT txn_id, card_id, CAST(amount AS DOUBLE) AS amount FROM raw_txn
ORDER BY md5(CAST(txn_id AS VARCHAR) || '|' || '42') LIMIT 25""", "raw_txn")

SQL["first_n_by_id"] = with_(
    "SELECT txn_id, card_id, txn_ts FROM raw_txn ORDER BY txn_id LIMIT 500", "raw_txn")

# ---------------------------------------------------------------------------
# writers and jobs (read back equals the plain computation)
# ---------------------------------------------------------------------------
SQL["full_refresh_roundtrip"] = SQL["dim_customer"]
SQL["append_roundtrip"] = SQL["stg_transaction"]
SQL["partition_month_counts"] = with_("""
SELECT CAST(year(txn_ts) * 100 + month(txn_ts) AS INTEGER) AS txn_month, count(*) AS n,
       CAST(sum(amount) AS DOUBLE) AS amount_total
FROM bk_txn_volume GROUP BY 1""", "bk_txn_volume")
SQL["partition_range_read"] = with_("""
SELECT txn_id, card_id, txn_ts, CAST(amount AS DOUBLE) AS amount,
       CAST(year(txn_ts) * 100 + month(txn_ts) AS INTEGER) AS txn_month
FROM bk_txn_volume
WHERE txn_ts >= TIMESTAMP '1995-01-01 00:00:00' AND txn_ts < TIMESTAMP '1995-07-01 00:00:00'""",
                                    "bk_txn_volume")
SQL["partitioned_upsert"] = SQL["upsert_by_key"].replace(
    f"SELECT {cols_sql('account')} FROM (",
    f"SELECT {cols_sql('account')}, "
    "CAST(year(opened_at) * 100 + month(opened_at) AS INTEGER) AS open_month FROM (")
SQL["materialize_incremental"] = with_(f"""
SELECT {cols_sql('card')} FROM raw_card""", "raw_card")
SQL["dim_load_run"] = SQL["dim_card"]
# first run loads transactions before the cut; the second run takes all others,
# whether their ids are above or below the first run's watermark
SQL["incremental_fact_run"] = with_(
    f"SELECT *, CAST(year(txn_ts) * 100 + month(txn_ts) AS INTEGER) AS txn_month FROM ("
    + FACT_SELECT.format(txn="loaded") + ")",
    "raw_txn", "raw_card", "raw_account", "raw_customer", "raw_terminal", extra={
        "loaded": "SELECT * FROM raw_txn"})
SQL["cdc_stream_landing"] = SQL["cdc_landing_card"]
SQL["cdc_models_run"] = with_(f"""
SELECT 'raw_transaction_cdc' AS model, txn_id, card_id, terminal_id, txn_ts,
       CAST(amount AS DOUBLE) AS amount, currency_code, txn_type, status, {LOAD_TS} AS loaded_at,
       CAST(NULL AS INTEGER) AS is_current
FROM bk_txn_ev WHERE event_type <> 'purchase' AND txn_id IS NOT NULL
UNION ALL
SELECT 'ods_fact_atm_transaction', txn_id, card_id, terminal_id, txn_ts, amount, currency_code,
       txn_type, status, loaded_at, NULL FROM fact
UNION ALL
SELECT 'ods_dim_card_scd2', NULL, card_id, NULL, valid_from, NULL, NULL, NULL, status, loaded_at,
       is_current FROM scd""",
    "bk_txn_ev", "bk_card_log", "raw_txn", "raw_card", "raw_account", "raw_customer",
    "raw_terminal", extra={**_SCD2_CTES, "fact": FACT_SELECT.format(txn="raw_txn")})
SQL["metrics_sink_roundtrip"] = with_(
    _METRICS + "\nUNION ALL\n" + _METRICS.replace(LOAD_TS, "TIMESTAMP '2024-02-01 00:00:00'"),
    extra=_LAG_CTES)
SQL["scd2_invariants"] = with_("""
SELECT card_id, 'gap_or_overlap' AS violation FROM linked WHERE valid_to <> next_from
UNION ALL
SELECT card_id, 'current_count' FROM faulty GROUP BY card_id
HAVING sum(is_current) <> 1
    OR sum(CASE WHEN is_current = 1 AND valid_to <> TIMESTAMP '2999-12-31 00:00:00'
                THEN 1 ELSE 0 END) > 0""", "bk_card_log", extra={
    **_SCD2_CTES,
    "faulty": """SELECT card_id, card_sk, valid_from,
                        CASE WHEN card_id % 5 = 0 AND is_current = 0
                             THEN valid_to + INTERVAL 1 SECOND ELSE valid_to END AS valid_to,
                        CASE WHEN card_id % 7 = 0 THEN 0 ELSE is_current END AS is_current
                 FROM scd""",
    "linked": """SELECT *, lead(valid_from) OVER (PARTITION BY card_id
                                                 ORDER BY valid_from, card_sk) AS next_from
                 FROM faulty"""})
SQL["raw_transaction_cdc_rejects"] = with_("""
SELECT CAST(txn_id % 3 AS INTEGER) AS kafka_partition, txn_id AS kafka_offset, txn_id,
       '{"txn_ts":"' || CAST(txn_id AS VARCHAR) || ' is no time"}' AS payload_after
FROM bk_txn_ev WHERE event_type <> 'purchase' AND txn_id % 97 = 0""", "bk_txn_ev")
SQL["scd2_incremental"] = SQL["scd2_card"]
SQL["model_run"] = SQL["incremental_fact_run"]
SQL["fact_incremental_refresh"] = with_("""
SELECT t.txn_id, t.txn_ts, CAST(t.amount AS DOUBLE) AS amount, t.currency_code,
       cd.card_id, cd.card_number, ac.account_id, ac.account_number,
       cu.customer_id, cu.city AS customer_city, te.terminal_id, te.city AS terminal_city,
       t.txn_type, t.status,
       CAST(year(t.txn_ts) * 100 + month(t.txn_ts) AS INTEGER) AS txn_month
FROM loaded t
LEFT JOIN raw_card cd ON cd.card_id = t.card_id
LEFT JOIN raw_account ac ON ac.account_id = cd.account_id
LEFT JOIN raw_customer cu ON cu.customer_id = ac.customer_id
LEFT JOIN raw_terminal te ON te.terminal_id = t.terminal_id""",
    "raw_txn", "raw_card", "raw_account", "raw_customer", "raw_terminal", extra={
        "loaded": "SELECT * FROM raw_txn"})
SQL["rapid_withdrawals_stream"] = SQL["rapid_withdrawals"]
SQL["rapid_withdrawals_events"] = SQL["rapid_withdrawals"]

# ---------------------------------------------------------------------------
# offsets, id runs, footers, large k
# ---------------------------------------------------------------------------
SQL["cdc_offset_breaks"] = """
WITH src AS (SELECT 'bankcdc.bank.card' AS topic, CAST(user_id % 3 AS INTEGER) AS partition, event_id AS o FROM events
             WHERE event_id % 500 >= 20),
taken AS (SELECT * FROM src UNION ALL SELECT * FROM src WHERE o % 700 < 9),
per AS (SELECT topic, partition, o, count(*) AS times FROM taken GROUP BY ALL),
nb AS (SELECT *, lead(o) OVER (PARTITION BY topic, partition ORDER BY o) AS nxt,
              lag(o) OVER (PARTITION BY topic, partition ORDER BY o) AS prv,
              lag(times) OVER (PARTITION BY topic, partition ORDER BY o) AS ptimes FROM per),
isl AS (SELECT *, sum(CASE WHEN prv = o - 1 AND ptimes = times THEN 0 ELSE 1 END)
                  OVER (PARTITION BY topic, partition ORDER BY o) AS g FROM nb)
SELECT topic, partition, 'gap' AS kind, o + 1 AS from_offset, nxt - 1 AS to_offset, nxt - o - 1 AS records
FROM nb WHERE nxt > o + 1
UNION ALL
SELECT topic, partition, 'replay', min(o), max(o), CAST(sum(times - 1) AS BIGINT)
FROM isl WHERE times > 1 GROUP BY topic, partition, g"""

SQL["loaded_id_runs"] = with_(f"""
SELECT min(txn_id) AS lo, max(txn_id) AS hi
FROM (SELECT txn_id, txn_id - row_number() OVER (ORDER BY txn_id) AS g FROM raw_txn
      WHERE txn_ts < {PREVIOUS_RUN}) t GROUP BY g""", "raw_txn")

SQL["footer_watermark"] = "SELECT max(event_id) AS last_id FROM events"

SQL["sample_many"] = with_("""
SELECT txn_id, card_id FROM (SELECT *, row_number() OVER (ORDER BY md5(CAST(txn_id AS VARCHAR) || '|' || '42')) AS rn,
       count(*) OVER () AS n FROM raw_txn) t WHERE rn <= n * 2 // 5""", "raw_txn")

SQL["clustered_point_read"] = with_("""
SELECT card_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount_total
FROM bk_txn_volume WHERE card_id BETWEEN 100 AND 110 GROUP BY card_id""", "bk_txn_volume")
