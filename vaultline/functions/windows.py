"""Skew-safe ordered windows.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task;
if one card or terminal holds a third of all rows, that task sorts a third of
the data. The helpers below partition by ``(key, bucket)`` instead, where
``bucket`` is a coarse, non-decreasing function of the leading order column
(e.g. the day of the timestamp). Only one summary row per ``(key, bucket)``
crosses bucket borders, through a small window over those summaries, so the
per-task work is bounded by one bucket of one key.

Plan shape: the large side is shuffled once by (key, bucket). The summary
branch (one row per group: a partial aggregate, or a first-row filter that
Catalyst turns into a per-partition top-1, before its own small shuffle)
re-reads the input, and is joined back on non-NULL surrogate columns of
(key, bucket), so the join needs no second shuffle of the large side, only
of the small summary. Gaps-and-islands is the exception: its summary needs
the lag, so that branch shuffles the pruned key/order columns.

Results equal the unbucketed window functions exactly (NULL keys form one
group, as in a plain window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.functions.columns import ntz


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _fill(dt: T.DataType) -> Column:
    if isinstance(dt, T.NumericType):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dt, T.TimestampNTZType):
        return ntz("1970-01-01 00:00:00")
    if isinstance(dt, T.TimestampType):
        return F.lit(0).cast("timestamp")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    raise TypeError(f"unsupported key type {dt}")


def _groups(df: DataFrame, keys: list[str], bucket: Column
            ) -> tuple[DataFrame, list[str], list[str]]:
    """Add non-NULL surrogates (value, is-null) for each key and the bucket.
    Returns the frame, the key surrogate names and the bucket surrogate names."""
    d = df.withColumn("__bucket", bucket)
    gk: list[str] = []
    for i, k in enumerate(keys + ["__bucket"]):
        dt = d.schema[k].dataType
        d = (d.withColumn(f"__g{i}", F.coalesce(F.col(k), _fill(dt)))
              .withColumn(f"__z{i}", F.col(k).isNull()))
        gk += [f"__g{i}", f"__z{i}"]
    return d.drop("__bucket"), gk[:-2], gk[-2:]


def _bucket_order(gb: list[str]) -> list[Column]:
    # NULL buckets first, as NULLs sort first in an ascending window order
    return [F.col(gb[1]).desc(), F.col(gb[0]).asc()]


def _drop(d: DataFrame, gk: list[str], gb: list[str], *extra: str) -> DataFrame:
    return d.drop(*gk, *gb, *extra)


def day_bucket(ts_col: str) -> Column:
    return F.to_date(F.col(ts_col))


def with_prev(df: DataFrame, keys, order: Sequence[str], cols: Sequence[str],
              bucket: Column, prefix: str = "prev_") -> DataFrame:
    """``lag(c, 1)`` over (partition by keys order by order) for each c in ``cols``."""
    keys, order, cols = _as_list(keys), list(order), list(cols)
    d, gk, gb = _groups(df, keys, bucket)
    g = gk + gb
    w = Window.partitionBy(*g).orderBy(*order)
    # last row per group as a partial aggregate of the input (small shuffle)
    last = d.groupBy(*g).agg(F.max_by(F.struct(*[F.col(c) for c in cols]),
                                      F.struct(*[F.col(c) for c in order])).alias("__last"))
    d = d.withColumn("__rn", F.row_number().over(w))
    for c in cols:
        d = d.withColumn(prefix + c, F.lag(c).over(w))
    wb = Window.partitionBy(*gk).orderBy(*_bucket_order(gb))
    carry = last.select(*g, F.lag("__last").over(wb).alias("__carry"))
    d = d.join(carry, on=g, how="left")
    for c in cols:
        d = d.withColumn(prefix + c, F.when(F.col("__rn") == 1, F.col(f"__carry.{c}"))
                         .otherwise(F.col(prefix + c)))
    return _drop(d, gk, gb, "__rn", "__carry")


def with_next(df: DataFrame, keys, order: Sequence[str], cols: Sequence[str],
              bucket: Column, prefix: str = "next_", dedupe_by: Sequence[str] | None = None
              ) -> DataFrame:
    """``lead(c, 1)`` over (partition by keys order by order) for each c in ``cols``.

    ``dedupe_by`` drops rows repeating the previous row's values of those
    columns (replayed log rows, which sort next to each other) inside the same
    shuffle, before the lead is taken.
    """
    keys, order, cols = _as_list(keys), list(order), list(cols)
    d, gk, gb = _groups(df, keys, bucket)
    g = gk + gb
    w = Window.partitionBy(*g).orderBy(*order)
    # first row per group, from the input itself: Catalyst turns this into a
    # per-partition top-1 before a small shuffle (replays are identical rows,
    # so dropping them below does not change any group's first row)
    first = (d.withColumn("__rn0", F.row_number().over(w)).filter(F.col("__rn0") == 1)
              .select(*g, F.struct(*[F.col(c) for c in cols]).alias("__first")))
    if dedupe_by:
        ident = F.struct(*[F.col(c) for c in dedupe_by])
        d = (d.withColumn("__dup", F.coalesce(F.lag(ident).over(w) == ident, F.lit(False)))
              .filter(~F.col("__dup")).drop("__dup"))
    d = (d.withColumn("__rn", F.row_number().over(w))
          .withColumn("__cnt", F.count(F.lit(1)).over(Window.partitionBy(*g))))
    for c in cols:
        d = d.withColumn(prefix + c, F.lead(c).over(w))
    wb = Window.partitionBy(*gk).orderBy(*_bucket_order(gb))
    carry = first.select(*g, F.lead("__first").over(wb).alias("__carry"))
    d = d.join(carry, on=g, how="left")
    for c in cols:
        d = d.withColumn(prefix + c, F.when(F.col("__rn") == F.col("__cnt"),
                                            F.col(f"__carry.{c}"))
                         .otherwise(F.col(prefix + c)))
    return _drop(d, gk, gb, "__rn", "__cnt", "__carry")


def with_running_sum(df: DataFrame, keys, order: Sequence[str], col, bucket: Column,
                     name) -> DataFrame:
    """Running ``sum(col)`` (rows unbounded preceding .. current row). ``col``
    and ``name`` may be lists to compute several sums in the same pass."""
    keys, order = _as_list(keys), list(order)
    cols = col if isinstance(col, (list, tuple)) else [col]
    names = _as_list(name)
    vals = [F.col(c) if isinstance(c, str) else c for c in cols]
    d = df
    for i, v in enumerate(vals):
        d = d.withColumn(f"__v{i}", v)
    d, gk, gb = _groups(d, keys, bucket)
    g = gk + gb
    w = Window.partitionBy(*g).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # group totals as a partial aggregate of the input (small shuffle)
    tot = d.groupBy(*g).agg(*[F.sum(f"__v{i}").alias(f"__tot{i}") for i in range(len(names))])
    for i, n in enumerate(names):
        d = d.withColumn(n, F.sum(f"__v{i}").over(run))
    wb = (Window.partitionBy(*gk).orderBy(*_bucket_order(gb))
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = tot.select(*g, *[F.sum(f"__tot{i}").over(wb).alias(f"__carry{i}")
                             for i in range(len(names))])
    d = d.join(carry, on=g, how="left")
    for i, n in enumerate(names):
        # like a plain window: NULL only until the first value of the key
        d = d.withColumn(n, F.coalesce(F.col(n) + F.col(f"__carry{i}"), n, f"__carry{i}"))
    extra = [f"__{p}{i}" for i in range(len(names)) for p in ("v", "carry")]
    return _drop(d, gk, gb, *extra)


def with_row_number(df: DataFrame, keys, order: Sequence[str], bucket: Column,
                    name: str = "rn") -> DataFrame:
    """``row_number()`` over (partition by keys order by order)."""
    out = with_running_sum(df, keys, order, F.lit(1), bucket, name)
    return out.withColumn(name, F.col(name).cast("int"))


def with_halo(df: DataFrame, t_col: str, width: int, bucket_width: int) -> DataFrame:
    """Rows dealt into time buckets (``__b``) of ``bucket_width >= width``; a
    row is also copied into the next bucket (``__native`` false) when it lies
    within ``width`` of that bucket's start, so every frame ``[t - width, t]``
    is complete inside one bucket. ``t_col`` is an integer time."""
    if bucket_width < width:
        raise ValueError("bucket_width must be >= width")
    t = F.col(t_col)
    b = F.floor(t / F.lit(bucket_width)).cast("long")
    near_next = t >= (b + 1) * F.lit(bucket_width) - F.lit(width)
    copies = F.array(
        F.struct(b.alias("b"), F.lit(True).alias("native")),
        F.when(near_next, F.struct((b + 1).alias("b"), F.lit(False).alias("native"))),
    )
    return (df.withColumn("__copy", F.explode(copies)).filter(F.col("__copy").isNotNull())
              .withColumn("__b", F.col("__copy.b")).withColumn("__native", F.col("__copy.native"))
              .drop("__copy"))


def range_window(df: DataFrame, keys, t_col: str, width: int, bucket_width: int,
                 aggs: dict[str, callable]) -> DataFrame:
    """Range-frame aggregates over ``[t - width, t]`` per key, where ``t_col``
    is an integer time (e.g. epoch microseconds), inside the buckets of
    ``with_halo``. ``aggs`` maps output names to functions of a window spec.
    """
    keys = _as_list(keys)
    d = with_halo(df, t_col, width, bucket_width)
    w = Window.partitionBy(*keys, "__b").orderBy(t_col).rangeBetween(-width, 0)
    for name, fn in aggs.items():
        d = d.withColumn(name, fn(w))
    return d.filter(F.col("__native")).drop("__native", "__b")


def as_of(left: DataFrame, right: DataFrame, keys, left_ts: str, right_ts: str,
          right_order: Sequence[str], right_cols: Sequence[str], bucket_fn,
          prefix: str = "") -> DataFrame:
    """As-of join: for each left row, the right row of the same key with the
    greatest ``right_order`` such that ``right_ts <= left_ts``.

    Both sides are unioned and ordered by time per (key, bucket); the last
    right row seen is carried forward. Right rows from earlier buckets reach
    a bucket through one summary row per (key, bucket). No pairs are formed,
    so a hot key costs linear work spread over its buckets. NULL keys and
    NULL times match nothing (``right_ts <= left_ts`` semantics).
    ``bucket_fn`` maps a timestamp column to a non-decreasing bucket.
    """
    keys, right_order, right_cols = _as_list(keys), list(right_order), list(right_cols)
    r = right.select(*keys, F.col(right_ts).alias("__t"), F.lit(0).alias("__side"),
                     F.struct(*[F.col(c) for c in right_order]).alias("__ord"),
                     F.struct(*[F.col(c) for c in right_cols]).alias("__r"))
    for k in keys:
        r = r.filter(F.col(k).isNotNull())
    # a right row without a time is never "at or before" anything (and a left
    # row without a time sorts before every right row of its key)
    r = r.filter(F.col("__t").isNotNull())
    lcols = [c for c in left.columns if c not in keys]
    l_ = left.select(*keys, F.col(left_ts).alias("__t"), F.lit(1).alias("__side"),
                     F.struct(*[F.col(c) for c in lcols]).alias("__l"))
    u = r.unionByName(l_, allowMissingColumns=True)
    d, gk, gb = _groups(u, keys, bucket_fn(F.col("__t")))
    g = gk + gb
    # one row per (key, bucket): its last right row and whether it has left
    # rows; a partial aggregate, so only one row per group and map task moves
    summ = d.groupBy(*g).agg(
        F.max_by("__r", F.when(F.col("__side") == 0, F.struct("__t", "__ord"))).alias("__rl"),
        F.max("__side").alias("__has_left"))
    w = Window.partitionBy(*g).orderBy("__t", "__side", "__ord")
    d = d.withColumn("__cand", F.last("__r", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    wb = (Window.partitionBy(*gk).orderBy(*_bucket_order(gb))
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = (summ.withColumn("__carry", F.last("__rl", ignorenulls=True).over(wb))
                 .filter(F.col("__has_left") == 1).select(*g, "__carry"))
    lefts = d.filter(F.col("__side") == 1)
    out = lefts.join(carry, on=g, how="left")
    match = F.coalesce(F.col("__cand"), F.col("__carry"))
    return out.select(*keys, *[F.col(f"__l.{c}").alias(c) for c in lcols],
                      *[match[c].alias(prefix + c) for c in right_cols])


def with_islands(df: DataFrame, keys, order: Sequence[str], cols: Sequence[str],
                 bucket: Column, breaks, island: str = "island", prefix: str = "prev_"
                 ) -> DataFrame:
    """Gaps-and-islands in one shuffle: ``prev_<c>`` (lag 1 of each c in
    ``cols``) and ``island`` = running count of rows where
    ``breaks(prefix)`` is true, over (partition by keys order by order).

    ``breaks(prefix)`` builds the break condition from the current columns
    and the ``prefix``-ed previous ones; it must treat a missing previous row
    (NULLs) as a break. Equivalent to ``with_prev`` followed by
    ``with_running_sum`` of the break flag, but the large side is shuffled
    and windowed once: each (key, bucket) contributes one summary row (its
    first row, last row and local break count), a small per-key window
    resolves the first row's break and the island offset, and one
    co-partitioned join brings them back.
    """
    keys, order, cols = _as_list(keys), list(order), list(cols)
    d, gk, gb = _groups(df, keys, bucket)
    g = gk + gb
    w = Window.partitionBy(*g).orderBy(*order)
    whole = Window.partitionBy(*g)
    d = (d.withColumn("__rn", F.row_number().over(w))
          .withColumn("__cnt", F.count(F.lit(1)).over(whole)))
    for c in cols:
        d = d.withColumn(prefix + c, F.lag(c).over(w))
    # the first row's break needs the previous bucket: counted later
    d = d.withColumn("__bl", F.when((F.col("__rn") > 1) & breaks(prefix), 1).otherwise(0))
    d = (d.withColumn("__cs", F.sum("__bl").over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
          .withColumn("__tot", F.sum("__bl").over(whole))
          .withColumn("__last", F.last(F.struct(*[F.col(c) for c in cols])).over(
              w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    summ = d.filter(F.col("__rn") == 1).select(*g, *cols, "__last", "__tot")
    wb = Window.partitionBy(*gk).orderBy(*_bucket_order(gb))
    summ = summ.withColumn("__pl", F.lag("__last").over(wb))
    for c in cols:
        summ = summ.withColumn(prefix + c, F.col(f"__pl.{c}"))
    summ = summ.withColumn("__fb", F.when(breaks(prefix), 1).otherwise(0))
    summ = summ.withColumn("__off", F.coalesce(F.sum(F.col("__fb") + F.col("__tot")).over(
        wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    carry = summ.select(*g, F.col("__pl").alias("__carry"), "__fb", "__off")
    d = d.join(carry, on=g, how="left")
    for c in cols:
        d = d.withColumn(prefix + c, F.when(F.col("__rn") == 1, F.col(f"__carry.{c}"))
                         .otherwise(F.col(prefix + c)))
    d = d.withColumn(island, (F.col("__off") + F.col("__fb") + F.col("__cs")).cast("long"))
    return _drop(d, gk, gb, "__rn", "__cnt", "__bl", "__cs", "__tot", "__last", "__carry",
                 "__fb", "__off")
