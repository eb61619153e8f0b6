"""Plan properties: pushed filters, no Python UDFs, no cartesian products,
and the fact shuffles the transaction side at most for two joins."""

import pytest

from vaultline import bindings as B
from vaultline.plans.catalog import QUERIES
from vaultline.sources.extract import extract_incremental

# queries that write and read back (plans of the read only) are still checked
BAD_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_or_cartesian(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for bad in BAD_NODES:
        assert bad not in plan, f"{name}: {bad}"


def test_missing_watermark_reads_the_table(spark, sf_dir):
    plan = QUERIES["read_watermark_missing"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "LocalRelation" not in plan


def test_incremental_extract_pushes_filter(spark, sf_dir):
    df = extract_incremental(B.transaction(spark, sf_dir), "txn_id", 100)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,100)]" in plan


def test_fact_builds_profile_once(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["fact_atm_transaction"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the transaction side is shuffled twice (card_id, terminal_id), never by
    # account_id or customer_id: the snowflake is resolved on the card side
    txn_side = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(t_" in ln]
    assert len(txn_side) == 2


@pytest.mark.parametrize("name", ["rapid_withdrawals", "rapid_withdrawals_events"])
def test_rapid_withdrawals_shuffle_once(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_as_of_reads_the_facts_once(spark, sf_dir):
    from vaultline.operators import scd2
    from vaultline.plans.catalog import stored_cards
    dim = scd2.scd2_from_landing(stored_cards(spark, sf_dir))
    own = _plan(dim).count("Exchange hashpartitioning")
    fact = B.transaction(spark, sf_dir).select("txn_id", "card_id", "txn_ts")
    plan = _plan(scd2.as_of(fact, dim))
    assert plan.count("events.parquet") == _plan(fact).count("events.parquet") == 1
    assert plan.count("Exchange hashpartitioning") == own + 1
