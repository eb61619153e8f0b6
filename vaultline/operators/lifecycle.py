"""Soft-close and block rules applied to source-shaped tables (LC1-LC5, JN6).

Each function takes the table plus a *frame* of keys (never a driver-side
list) and returns the whole updated table. Keys are de-duplicated and joined
(left join + flag), so a key set of any size works; AQE broadcasts it only
when its measured size is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import load_ts
from vaultline.operators.facts import customers_without_active_accounts
from vaultline.operators.staging import is_active


def _flag(df: DataFrame, keys: DataFrame, key: str, key_col: str | None = None) -> DataFrame:
    k = keys.select(F.col(key_col or key).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    out = df.join(k, df[key] == k["__k"], "left").drop("__k")
    return out.withColumn("__hit", F.coalesce(F.col("__hit"), F.lit(False)))


def _set(df: DataFrame, cond, values: dict) -> DataFrame:
    cols = []
    for c in df.columns:
        if c == "__hit":
            continue
        if c in values:
            v = values[c]
            cols.append(F.when(cond, v).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def close_cards(card: DataFrame, keys: DataFrame, ts=None, key_col: str = "card_id") -> DataFrame:
    """LC1: status 'closed', deleted, closed_at and updated_at = ts."""
    now = load_ts(ts)
    d = _flag(card, keys, "card_id", key_col)
    return _set(d, F.col("__hit"), {"status": F.lit("closed"), "is_deleted": F.lit(True),
                                    "closed_at": now, "updated_at": now})


def close_accounts(account: DataFrame, card: DataFrame, keys: DataFrame, ts=None,
                   key_col: str = "account_id") -> tuple[DataFrame, DataFrame]:
    """LC2 + JN6: close the accounts and cascade to their *active* cards only
    (cards already blocked or closed keep their state)."""
    now = load_ts(ts)
    a = _flag(account, keys, "account_id", key_col)
    accounts = _set(a, F.col("__hit"), {"status": F.lit("closed"), "is_deleted": F.lit(True),
                                        "closed_at": now, "updated_at": now})
    c = _flag(card, keys, "account_id", key_col)
    cond = F.col("__hit") & is_active("card")
    cards = _set(c, cond, {"status": F.lit("closed"), "is_deleted": F.lit(True),
                           "closed_at": now, "updated_at": now})
    return accounts, cards


def close_customers(customer: DataFrame, account: DataFrame, ts=None,
                    keys: DataFrame | None = None) -> DataFrame:
    """LC3: close live customers that have no active account (optionally only
    among ``keys``)."""
    eligible = customers_without_active_accounts(customer, account)
    if keys is not None:
        eligible = eligible.join(keys.select("customer_id").distinct(), "customer_id")
    now = load_ts(ts)
    d = _flag(customer, eligible, "customer_id")
    return _set(d, F.col("__hit"), {"is_deleted": F.lit(True), "updated_at": now})


def close_terminals(terminal: DataFrame, keys: DataFrame, ts=None,
                    key_col: str = "terminal_id") -> DataFrame:
    """LC4: retire terminals (not working, deleted)."""
    now = load_ts(ts)
    d = _flag(terminal, keys, "terminal_id", key_col)
    return _set(d, F.col("__hit"), {"is_working": F.lit(False), "is_deleted": F.lit(True),
                                    "updated_at": now})


def block_cards(card: DataFrame, keys: DataFrame, ts=None, key_col: str = "card_id") -> DataFrame:
    """LC5: status 'blocked' and updated_at = ts; closed_at stays as it was."""
    now = load_ts(ts)
    d = _flag(card, keys, "card_id", key_col)
    return _set(d, F.col("__hit"), {"status": F.lit("blocked"), "updated_at": now})
