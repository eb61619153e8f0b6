"""Star/snowflake fact build (JN1) and the relational lookups of the
lifecycle rules (JN2 active cards, JN3 customers without active accounts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import load_ts
from vaultline.operators.staging import is_active

FACT_COLUMNS = ["txn_id", "txn_ts", "amount", "currency_code", "card_id", "card_number",
                "account_id", "account_number", "customer_id", "customer_city", "terminal_id",
                "terminal_city", "txn_type", "status", "loaded_at"]


def card_profile(card: DataFrame, account: DataFrame, customer: DataFrame) -> DataFrame:
    """card LEFT JOIN account LEFT JOIN customer, sized like the card dimension.

    Built once so the (much larger) transaction side is joined on card_id
    only: one shuffle of the fact instead of one per snowflake level. Outer
    joins are not reordered by Catalyst, so the grouping is stated here; it is
    equivalent because the account/customer predicates only reference the
    card side and reject its NULLs.
    """
    cd = card.select(F.col("card_id").alias("p_card_id"), "card_number",
                     F.col("account_id").alias("p_card_account_id"))
    ac = account.select(F.col("account_id").alias("p_account_id"), "account_number",
                        F.col("customer_id").alias("p_account_customer_id"))
    cu = customer.select(F.col("customer_id").alias("p_customer_id"),
                         F.col("city").alias("customer_city"))
    return (cd.join(ac, F.col("p_card_account_id") == F.col("p_account_id"), "left")
              .join(cu, F.col("p_account_customer_id") == F.col("p_customer_id"), "left"))


def fact_atm_transaction(txn: DataFrame, card: DataFrame, account: DataFrame,
                         customer: DataFrame, terminal: DataFrame,
                         unmatched: str = "null", ts=None) -> DataFrame:
    """JN1: denormalised ATM-transaction fact.

    Every transaction is kept (left joins); card/account/customer/terminal ids
    are taken from the dimension side, so an unmatched transaction loses its
    own card_id/terminal_id. ``unmatched='default'`` fills misses with ''/0
    like a warehouse with non-null columns; ``'null'`` keeps NULLs.
    Broadcast vs shuffle is decided by AQE from measured sizes.
    """
    if unmatched not in ("null", "default"):
        raise ValueError("unmatched must be 'null' or 'default'")
    tx = txn.select("txn_id", "txn_ts", "amount", "currency_code",
                    F.col("card_id").alias("t_card_id"),
                    F.col("terminal_id").alias("t_terminal_id"), "txn_type", "status")
    prof = card_profile(card, account, customer)
    term = terminal.select(F.col("terminal_id").alias("p_terminal_id"),
                           F.col("city").alias("terminal_city"))
    j = (tx.join(prof, F.col("t_card_id") == F.col("p_card_id"), "left")
           .join(term, F.col("t_terminal_id") == F.col("p_terminal_id"), "left"))

    def dim(col, alias, default):
        c = F.col(col)
        if unmatched == "default":
            c = F.coalesce(c, F.lit(default))
        return c.alias(alias)

    return j.select(
        "txn_id", "txn_ts", F.col("amount").cast("double").alias("amount"), "currency_code",
        dim("p_card_id", "card_id", 0), dim("card_number", "card_number", ""),
        dim("p_account_id", "account_id", 0), dim("account_number", "account_number", ""),
        dim("p_customer_id", "customer_id", 0), dim("customer_city", "customer_city", ""),
        dim("p_terminal_id", "terminal_id", 0), dim("terminal_city", "terminal_city", ""),
        "txn_type", "status", load_ts(ts).alias("loaded_at"),
    )


def active_cards(card: DataFrame, account: DataFrame, customer: DataFrame) -> DataFrame:
    """JN2: active card of an active account of a live customer (inner joins;
    each side is filtered before the join so the predicates reach the scans)."""
    cd = card.filter(is_active("card")).select("card_id", "account_id")
    ac = account.filter(is_active("account")).select(
        F.col("account_id").alias("a_account_id"), "customer_id")
    cu = customer.filter(is_active("customer")).select(F.col("customer_id").alias("c_customer_id"))
    return (cd.join(ac, cd.account_id == ac.a_account_id)
              .join(cu, ac.customer_id == cu.c_customer_id)
              .select("card_id", "account_id", "customer_id"))


def customers_without_active_accounts(customer: DataFrame, account: DataFrame,
                                      literal: bool = False) -> DataFrame:
    """JN3: live customers with no active account.

    Default form is a left-anti join (one shuffle, no per-customer state).
    ``literal=True`` states it as LEFT JOIN ... GROUP BY ... HAVING
    count(account_id) = 0, which Catalyst does not rewrite into an anti join.
    """
    cu = customer.filter(is_active("customer")).select("customer_id")
    ac = account.filter(is_active("account")).select(
        F.col("customer_id").alias("a_customer_id"), "account_id")
    if not literal:
        return cu.join(ac, cu.customer_id == ac.a_customer_id, "left_anti")
    return (cu.join(ac, cu.customer_id == ac.a_customer_id, "left")
              .groupBy("customer_id").agg(F.count("account_id").alias("n"))
              .filter(F.col("n") == 0).select("customer_id"))
