"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.tables import materialize


def _state(e: DataFrame) -> tuple:
    """Number of edges and an order-free sum of their hashes."""
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is the
    smallest node that can be reached.

    ``edges`` has two bigint columns, ``a`` and ``b``, in either order; loops
    and repeated edges do no harm, an empty table gives an empty result. Each
    round joins the edges with one minimum per node (aggregated before the
    shuffle), so a node with very many edges is split by the skew join and
    never gathered in one task. Only a count and a hash sum reach the driver.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("n"), F.least("a", "low").alias("low"))
        large = (both.filter("b > a").join(low, F.col("a") == F.col("n"))
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        large = materialize(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), "low")
        small = (large.join(least, F.col("a") == F.col("n"))
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
                 .union(least).distinct())
        e = materialize(small, "edges")
        before, state = state, _state(e)
        if state == before:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select("b", "b").distinct())
