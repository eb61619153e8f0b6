"""Relational building blocks: fan-out (JN4), top-1 per parent (JN5),
global row numbering (WN3), reproducible sampling (ST3), ordered top-n (ST1/ST4)
for any n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.session import cut_lineage


def fan_out(df: DataFrame, n: str | Column, name: str = "seq") -> DataFrame:
    """JN4: repeat each row ``n`` times with a 1-based sequence number
    (LATERAL generate_series). Rows with n < 1 or NULL produce nothing."""
    n = F.col(n) if isinstance(n, str) else n
    return (df.filter(n >= 1)
              .withColumn(name, F.explode(F.sequence(F.lit(1), n.cast("int")))))


def latest_child_per_parent(parent: DataFrame, child: DataFrame, key: str,
                    order: Sequence[str], cols: Sequence[str], prefix: str = "top_") -> DataFrame:
    """JN5: for each parent row, the child row of the same key that is last in
    ``order`` (LATERAL (... ORDER BY order DESC LIMIT 1)); parents without
    children get NULLs. A ``max_by`` aggregate combines map-side, so a parent
    with a huge number of children never sorts them in one task."""
    best = (child.groupBy(F.col(key).alias("__k"))
                 .agg(F.max_by(F.struct(*[F.col(c) for c in cols]),
                               F.struct(*[F.col(c) for c in order])).alias("__top")))
    j = parent.join(best, parent[key] == best["__k"], "left")
    return j.select(*[parent[c] for c in parent.columns],
                    *[F.col(f"__top.{c}").alias(prefix + c) for c in cols])


def global_row_id(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """WN3: dense 1-based row number over the whole frame in ``order``
    (``row_number() OVER (ORDER BY ...)``) without a single-partition window.

    The frame is range-partitioned and sorted, then checkpointed to the shared
    checkpoint folder so the partitioning is fixed (range bounds come from
    sampling). Per-partition counts (one row per partition: a proven size
    bound) give each partition its starting offset, which is broadcast.
    """
    sorted_df = cut_lineage(df.orderBy(*order))
    with_pos = (sorted_df.withColumn("__pid", F.spark_partition_id())
                         .withColumn("__mid", F.monotonically_increasing_id()))
    counts = with_pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    out = with_pos.join(F.broadcast(offsets), "__pid")
    return out.withColumn(name, F.col("__off") + local + 1).drop("__pid", "__mid", "__off")


SMALL_K, FAN, LEAF = 1000, 4096, 10_000


def smallest(df: DataFrame, k: int, value: Column, order: Sequence[str | Column]) -> DataFrame:
    """The ``k`` rows that are first by ``order``, for any ``k``, by radix
    selection on the whole number ``value``, which must not fall along that
    order. Rows are counted in ``FAN`` equal ranges of the value, then inside
    the range that the k-th row lies in, down to a range of ``LEAF`` rows or
    one value; a filter by the cut value gives the result. Only counts and one
    leaf of values reach the driver, and no rows are merged in one task but
    those that share the cut value, where ``order`` decides."""
    d = df.withColumn("__v", value.cast("long"))
    low, high, valued, n = d.agg(F.min("__v"), F.max("__v"), F.count("__v"), F.count(F.lit(1))).first()
    if n <= k or k <= 0:
        return df.limit(max(k, 0)) if k <= 0 else df
    if valued < n:
        return df.orderBy(*order).limit(k)                  # rows without a value come first
    high, below, inside = high + 1, 0, n
    while high - low > 1 and inside > LEAF:
        width = -(-(high - low) // FAN)
        counts = d.filter(F.col("__v").between(low, high - 1)).groupBy(
            F.expr(f"(__v - {low}) div {width}").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        for b, inside in sorted((r["b"], r["n"]) for r in counts):
            if below + inside >= k:
                break
            below += inside
        low, high = low + b * width, min(high, low + (b + 1) * width)
    if high - low > 1:
        leaf = sorted(r[0] for r in d.filter(F.col("__v").between(low, high - 1)).select("__v").collect())
        low = leaf[k - below - 1]
        below += sum(v < low for v in leaf)
        inside = sum(v == low for v in leaf)
    if below + inside == k:
        return d.filter(F.col("__v") <= low).drop("__v")
    ties = d.filter(F.col("__v") == low).orderBy(*order).limit(k - below)
    return d.filter(F.col("__v") < low).unionByName(ties).drop("__v")


def sample_k(df: DataFrame, k: int, seed: int | str, key: str) -> DataFrame:
    """ST3: reproducible random sample of ``k`` rows: the first ``k`` by
    md5(key | seed). A small ``k`` is a per-partition top-k; a large one is
    selected by the leading 60 bits of the hash (``smallest``)."""
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    d = df.withColumn("__h", h)
    if k <= SMALL_K:
        return d.orderBy("__h").limit(k).drop("__h")
    return smallest(d, k, F.conv(F.substring("__h", 1, 15), 16, 10), ["__h"]).drop("__h")


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """ST1 + ST4: ORDER BY ... LIMIT n (deterministic with a unique order). A
    large ``n`` under a leading whole-number column is selected by its values."""
    if n > SMALL_K and df.schema[order[0]].dataType.typeName() in ("long", "integer", "short", "byte"):
        return smallest(df, n, F.col(order[0]), order)
    return df.orderBy(*order).limit(n)
