"""Incremental loading: watermarks (AG1, INC4, ST2), latest-wins collapse
(AG3), delta select (INC1) and key upsert (INC2).

The only values brought to the driver are scalar watermarks, which are then
used as literal bounds so the delta predicate is pushed into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.columns import load_ts
from vaultline.sources.extract import bound_literal


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def high_watermark(df: DataFrame, col: str, default=None, alias: str | None = None) -> DataFrame:
    """AG1: one-row frame with ``coalesce(max(col), default)``.

    An empty target yields ``default`` instead of NULL, so a first incremental
    run over a pre-created empty table selects everything rather than nothing.
    """
    agg = F.max(col)
    if default is not None:
        agg = F.coalesce(agg, F.lit(default).cast(df.schema[col].dataType))
    return df.agg(agg.alias(alias or f"max_{col}"))


def read_high_watermark(df: DataFrame, col: str, default=None):
    """AG1 as a scalar (one small aggregate job; only the scalar is collected)."""
    return high_watermark(df, col, default, alias="wm").first()["wm"]


def footer_watermark(spark: SparkSession, path: str, col: str, default=None, alias: str | None = None,
                     where: Column | None = None) -> DataFrame:
    """AG1 over a parquet folder from the statistics in its file footers: no
    column data is read. The aggregate is pushed into Spark's parquet source
    (whole numbers, dates, booleans and floats, without a filter or with one on
    partition columns); where it cannot be pushed, Spark aggregates the rows,
    with the same result. The settings hold in a session of their own."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(path)
    return high_watermark(df if where is None else df.filter(where), col, default, alias)


def latest_per_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """AG3: keep the latest row per key; ``order`` lists the version columns
    by precedence (e.g. ``["updated_at", "last_id"]``), the last one breaking
    ties.

    Uses a ``max_by`` aggregate instead of a row_number window: it combines
    map-side, so a key holding a large share of the rows never has to be
    sorted inside one task.
    """
    keys = _as_list(keys)
    others = [c for c in df.columns if c not in keys]
    version = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in others]), version).alias("_latest"))
              .select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in others]))


def delta(src: DataFrame, target: DataFrame | None, cursor: str, inclusive: bool = False,
          lookback=None, keep_null_cursor: bool = True) -> DataFrame:
    """INC1: source rows above the target's high-watermark of ``cursor``.

    No target or an empty one selects everything. Rows whose cursor is NULL
    are kept (they can never be ordered against a watermark) when
    ``keep_null_cursor``; a quality check counts them.
    """
    wm = None if target is None else read_high_watermark(target, cursor)
    if wm is None:
        return src
    if lookback is not None:
        wm = wm - lookback
    c = F.col(cursor)
    bound = bound_literal(wm)
    cond = (c >= bound) if inclusive else (c > bound)
    if keep_null_cursor:
        cond = cond | c.isNull()
    return src.filter(cond)


def with_keys(rows: DataFrame, held: DataFrame, keys, how: str, tasks: int | None = None) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of ``rows`` with the key rows ``held``.

    Without ``tasks`` the plan is Spark's. With it the keys are dealt to so
    many tasks: keys are narrow and pack well, so tasks made up by shuffled
    bytes hold millions of them. 0: ``held`` is few and broadcast.
    """
    keys = _as_list(keys)
    held = held.select(*keys)
    if tasks:
        rows, held = rows.repartition(tasks, *keys), held.repartition(tasks, *keys)
    elif tasks == 0:
        held = F.broadcast(held)
    return rows.join(held, keys, how)


def upsert(target: DataFrame, batch: DataFrame, keys, order: Sequence[str] | None = None,
           tasks: int | None = None) -> DataFrame:
    """INC2: replace target rows whose key appears in ``batch``, keep the rest,
    add the new keys. With ``order`` the batch is first collapsed to its latest
    row per key (AG3), so replays and duplicates in one batch are harmless.

    Plan: one anti join (AQE splits skewed keys) plus a union; no MERGE needed.
    ``tasks``: see ``with_keys``.
    """
    keys = _as_list(keys)
    if order:
        batch = latest_per_key(batch, keys, order)
    batch = batch.select(*target.columns)
    return with_keys(target, batch, keys, "left_anti", tasks).unionByName(batch)


def read_watermark(ctl: DataFrame, process: str, table: str, default: int | None = 0
                   ) -> DataFrame:
    """ST2: last loaded id for (process, table): the row with the latest
    ``updated_at`` (ties: highest ``last_id``), or ``default`` when none.
    An aggregate (one row, always) rather than ORDER BY ... LIMIT 1."""
    return (ctl.filter((F.col("process_name") == process) & (F.col("src_table") == table))
               .agg(F.coalesce(F.max_by("last_id", F.struct("updated_at", "last_id")),
                               F.lit(default).cast("long")).alias("last_id")))


def read_watermark_value(ctl: DataFrame, process: str, table: str, default: int | None = 0
                         ) -> int | None:
    return read_watermark(ctl, process, table, default).first()["last_id"]


def watermark_row(spark, process: str, table: str, last_id: int, ts=None) -> DataFrame:
    """INC4: the control row to append after a load."""
    return watermark_rows(spark, process, {table: last_id}, ts)


def watermark_rows(spark, process: str, last_ids: dict[str, int], ts=None) -> DataFrame:
    """INC4 for several tables of one process: a row each."""
    rows = F.array(*[F.struct(F.lit(t).alias("src_table"), F.lit(i).cast("long").alias("last_id"))
                     for t, i in last_ids.items()])
    return spark.range(1).select(F.lit(process).alias("process_name"), F.inline(rows),
                                 load_ts(ts).alias("updated_at"))


def read_watermarks(ctl: DataFrame, process: str) -> dict[str, int]:
    """ST2 for every table of a process (one row per table is collected)."""
    rows = ctl.filter(F.col("process_name") == process).groupBy("src_table").agg(
        F.max_by("last_id", F.struct("updated_at", "last_id")).alias("last_id")).collect()
    return {r["src_table"]: r["last_id"] for r in rows}
