"""Staging and dimension projections (PRJ1, PRJ2) and active-row predicates (FLT1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import load_ts, with_load_ts
from vaultline.schemas import AUDIT_COLUMNS, SOURCE_COLUMNS, SOURCE_DEFAULTS


def stage(df: DataFrame, entity: str) -> DataFrame:
    """PRJ1: the 1:1 staging projection of ``entity`` (explicit column list,
    so a wider source never leaks columns into the warehouse)."""
    return df.select(*SOURCE_COLUMNS[entity])


def stg_customer(df: DataFrame) -> DataFrame:
    return stage(df, "customer")


def stg_account(df: DataFrame) -> DataFrame:
    return stage(df, "account")


def stg_card(df: DataFrame) -> DataFrame:
    return stage(df, "card")


def stg_terminal(df: DataFrame) -> DataFrame:
    return stage(df, "terminal")


def stg_transaction(df: DataFrame) -> DataFrame:
    return stage(df, "transaction")


def apply_defaults(df: DataFrame, entity: str, ts=None) -> DataFrame:
    """Insert-time column defaults of the source schema: NULL (or missing)
    columns with a declared default get it; ``now`` is the load time."""
    out = df
    for col, value in SOURCE_DEFAULTS[entity].items():
        v = load_ts(ts) if value == "now" else F.lit(value)
        if col in out.columns:
            v = F.coalesce(F.col(col), v.cast(out.schema[col].dataType))
        out = out.withColumn(col, v)
    return out


def dimension(df: DataFrame, entity: str, ts=None) -> DataFrame:
    """PRJ2: ods dimension = raw columns minus audit columns, plus ``loaded_at``."""
    cols = [c for c in SOURCE_COLUMNS[entity] if c not in AUDIT_COLUMNS]
    return with_load_ts(df.select(*cols), "loaded_at", ts)


def dim_customer(df: DataFrame, ts=None) -> DataFrame:
    return dimension(df, "customer", ts)


def dim_account(df: DataFrame, ts=None) -> DataFrame:
    return dimension(df, "account", ts)


def dim_card(df: DataFrame, ts=None) -> DataFrame:
    return dimension(df, "card", ts)


def dim_terminal(df: DataFrame, ts=None) -> DataFrame:
    return dimension(df, "terminal", ts)


# ---------------------------------------------------------------------------
# FLT1 active-row predicates; they accept boolean (source) or 0/1 (warehouse) flags
# ---------------------------------------------------------------------------

def _not_set(flag: str, prefix: str = "") -> Column:
    c = F.col(prefix + flag)
    return F.coalesce(c.cast("boolean"), F.lit(False)) == F.lit(False)


def is_active(entity: str, prefix: str = "") -> Column:
    """Predicate for a live row of ``entity``.

    card/account: status = 'active' and not deleted; customer: not deleted;
    terminal: working and not deleted.
    """
    if entity in ("card", "account"):
        return (F.col(prefix + "status") == "active") & _not_set("is_deleted", prefix)
    if entity == "customer":
        return _not_set("is_deleted", prefix)
    if entity == "terminal":
        return (F.coalesce(F.col(prefix + "is_working").cast("boolean"), F.lit(False))
                & _not_set("is_deleted", prefix))
    raise ValueError(f"no active predicate for {entity!r}")


def active(df: DataFrame, entity: str) -> DataFrame:
    """FLT1: keep live rows of ``entity``."""
    return df.filter(is_active(entity))
