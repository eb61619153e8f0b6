"""Loaded ids as intervals (INC5): what a source may still hold that has not
been loaded is asked of it by ranges, not by comparing keys.

A loaded set is a table of maximal runs of consecutive ids (``lo``, ``hi``).
Sequences commit late and out of order, so a run has gaps for a while; a load
asks for the ids above the last run and inside the gaps, and merges what it
got into the runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions import windows as W

WIDEST = 16              # runs that a load names in its predicate; Java leaves the code of much longer ones uncompiled
BLOCK_BITS = 16          # ids are looked up among the runs of their block of 2 ** 16
MOST_BLOCKS = 200_000    # blocks of runs that are broadcast
BUCKET = 1 << 20         # ids whose ends one task orders


def _ends(spans: DataFrame, by: list[str]) -> DataFrame:
    """Where the number of ``spans`` (lo, hi, times) over a position changes:
    (by, at, step, covered from there on).

    A span is +times at its start and -times behind its end. Summed per
    position (map-side first) the steps between consecutive ids cancel, so only
    the ends of runs are shuffled; a running sum in buckets tells the cover.
    """
    steps = spans.filter("lo is not null").select(*by, F.explode(F.array(
        F.struct(F.col("lo").alias("at"), F.col("times").alias("step")),
        F.struct((F.col("hi") + 1).alias("at"), (-F.col("times")).alias("step")))).alias("s")).select(*by, "s.*")
    ends = steps.groupBy(*by, "at").agg(F.sum("step").alias("step")).filter("step != 0").withColumn("__one", F.lit(0))
    return W.with_running_sum(ends, [*by, "__one"], ["at"], "step", F.floor(F.col("at") / BUCKET), "covered")


def _to_next(ends: DataFrame, by: list[str]) -> DataFrame:
    return W.with_next(ends, [*by, "__one"], ["at"], ["at"], F.floor(F.col("at") / BUCKET), prefix="next_")


def _spans(ids: DataFrame, key: str, by: list[str]) -> DataFrame:
    i = F.col(key).cast("long")
    return ids.select(*by, i.alias("lo"), i.alias("hi"), F.lit(1).cast("long").alias("times"))


def coverage(spans: DataFrame, by=()) -> DataFrame:
    """(by, lo, hi, times): maximal segments that the same number of ``spans``
    (lo, hi, times) covers; positions that none covers are left out."""
    by = list(by)
    return _to_next(_ends(spans, by), by).filter("covered > 0").select(
        *by, F.col("at").alias("lo"), (F.col("next_at") - 1).alias("hi"), F.col("covered").alias("times"))


def id_coverage(ids: DataFrame, key: str, by=()) -> DataFrame:
    """``coverage`` of single ids; NULL ids are left out."""
    return coverage(_spans(ids, key, list(by)), by)


def merge(ids: DataFrame | None, key: str, runs: DataFrame | None = None, by=()) -> DataFrame:
    """(by, lo, hi) of the maximal runs of consecutive ids of ``ids`` and
    ``runs``. Repeated and overlapping ids are harmless, NULL ids are left out."""
    by = list(by)
    spans = None if ids is None else _spans(ids, key, by)
    if runs is not None:
        more = runs.select(*by, "lo", "hi", F.lit(1).cast("long").alias("times"))
        spans = more if spans is None else spans.unionByName(more)
    ends = _ends(spans, by).filter("covered = 0 or covered = step")      # begins and ends alternate
    return _to_next(ends, by).filter("covered > 0").select(
        *by, F.col("at").alias("lo"), (F.col("next_at") - 1).alias("hi"))


def holes(runs: DataFrame, by=()) -> DataFrame:
    """(by, lo, hi) of the intervals between the maximal runs (lo, hi)."""
    by = list(by)
    d = runs.withColumnRenamed("lo", "at").withColumn("__one", F.lit(0))
    return _to_next(d, by).filter("next_at is not null").select(
        *by, (F.col("hi") + 1).alias("lo"), (F.col("next_at") - 1).alias("hi"))


def outside(runs: DataFrame, key: str, widest: int = WIDEST) -> tuple[Column, bool]:
    """A predicate of literal ranges: ids outside the ``widest`` longest runs,
    and whether that is exactly the ids outside all of them. At most ``widest``
    rows are collected."""
    rows = runs.orderBy((F.col("hi") - F.col("lo")).desc(), "lo").limit(widest + 1).collect()
    named = sorted((r["lo"], r["hi"]) for r in rows[:widest])
    if not named:
        return F.col(key).isNotNull(), True
    k = F.col(key)
    gaps = [k < F.lit(named[0][0])]
    gaps += [(k > F.lit(a[1])) & (k < F.lit(b[0])) for a, b in zip(named, named[1:])]
    gaps.append(k > F.lit(named[-1][1]))
    return reduce(lambda a, b: a | b, gaps), len(rows) <= widest


def unloaded(src: DataFrame, runs: DataFrame, key: str, loaded: DataFrame, widest: int = WIDEST,
             lookback: int | None = None) -> DataFrame:
    """INC5: rows of ``src`` whose id is in no run, whatever their order.

    The ranges outside the ``widest`` longest runs are pushed to the source.
    If there are more runs than that, ids inside the shorter ones are taken
    off by looking them up among the broadcast runs of their block of ids;
    only if these blocks are too many, by an anti join with ``loaded``, read by
    the same ranges. A row without an id is never selected. ``lookback`` asks
    for ids above the last run less so many only; 0 is the plain watermark,
    which loses late ids.
    """
    where, exact = outside(runs, key, widest)
    if lookback is not None:
        last = runs.agg(F.max("hi")).first()[0]
        where = where & (F.col(key) > F.lit(last - lookback)) if last is not None else where
    new = src.filter(where)
    if exact:
        return new
    block = lambda c: F.shiftright(F.col(c).cast("long"), BLOCK_BITS)                # noqa: E731
    if runs.agg(F.sum(block("hi") - block("lo") + 1)).first()[0] > MOST_BLOCKS:
        return new.join(loaded.filter(where).select(key), key, "left_anti")
    spans = runs.select(F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
                        F.explode(F.sequence(block("lo"), block("hi"))).alias("__block"))
    return new.join(F.broadcast(spans), (block(key) == F.col("__block"))
                    & F.col(key).between(F.col("__lo"), F.col("__hi")), "left_anti")
