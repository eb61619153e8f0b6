"""Type-2 slowly changing dimension from a change log (WN1, WN2, S2-S4).

Version order per key is (src_ts, kafka_partition, kafka_offset). The
window work is partitioned by (key, day of src_ts) with a small carry across
days (``vaultline.functions.windows``), so a key with a huge history is
spread over many tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions import windows as W
from vaultline.functions.columns import epoch_millis, hash_key, load_ts, ntz
from vaultline.operators.cdc import card_versions, dedupe_log
from vaultline.schemas import OPEN_END

VERSION_ORDER = ["src_ts", "kafka_partition", "kafka_offset"]


def _bucket(bucket, col: str):
    return bucket if bucket is not None else W.day_bucket(col)


def version_number(log: DataFrame, key: str = "card_id", order=VERSION_ORDER,
                   name: str = "rn", bucket=None) -> DataFrame:
    """WN1: ``row_number() OVER (PARTITION BY key ORDER BY order)``. ``bucket``
    as in ``scd2``."""
    return W.with_row_number(log, key, order, _bucket(bucket, order[0]), name)


def scd2(versions: DataFrame, key: str = "card_id", order=VERSION_ORDER,
         attrs=("card_number", "account_id", "status", "opened_at", "closed_at", "is_deleted"),
         sk_name: str = "card_sk", ts=None, carry_forward: bool = False,
         bucket=None, dedupe_by=None) -> DataFrame:
    """S2: versioned dimension.

    valid_from = src_ts; valid_to = next version's src_ts (WN2 ``lead``) or
    2999-12-31; is_current = 1 for the last version. The surrogate key is
    md5(key | epoch-ms of src_ts | partition | offset), the same in any engine.
    ``carry_forward`` fills attributes a delete does not carry (key-only
    ``before``) from the previous version. ``bucket`` (default: day of
    src_ts) is the unit one task handles for one key; use an hour bucket when
    single keys burst within a day. ``dedupe_by`` (e.g. the log position)
    drops replayed rows inside the same shuffle.
    """
    attrs = list(attrs)
    bucket = _bucket(bucket, order[0])
    v = versions
    if carry_forward:
        v = W.with_prev(v, key, order, attrs, bucket, prefix="__pv_")
        for a in attrs:
            if a != "is_deleted":
                v = v.withColumn(a, F.coalesce(F.col(a), F.col(f"__pv_{a}")))
        v = v.drop(*[f"__pv_{a}" for a in attrs])
    v = W.with_next(v, key, order, ["src_ts"], bucket, prefix="__next_", dedupe_by=dedupe_by)
    nxt = F.col("__next_src_ts")
    return v.select(
        hash_key(F.col(key), epoch_millis("src_ts"), "kafka_partition", "kafka_offset")
        .alias(sk_name),
        key, *attrs,
        F.col("src_ts").alias("valid_from"),
        F.coalesce(nxt, ntz(OPEN_END)).alias("valid_to"),
        F.when(nxt.isNull(), 1).otherwise(0).alias("is_current"),
        "src_ts",
        load_ts(ts).alias("loaded_at"))


def scd2_from_landing(landed: DataFrame, dedupe: bool = True, ts=None, **kw) -> DataFrame:
    """S2 over the card landing table (CDC8/CDC9 parse). Replayed log rows are
    dropped first (STR2) so a crash-replay cannot create zero-length
    versions; ``dedupe=False`` keeps them, as a plain append-only log would."""
    if dedupe and kw.get("carry_forward"):
        landed = dedupe_log(landed)
    elif dedupe:
        # replays share (card, src_ts, partition, offset): dropped in the SCD2 shuffle
        kw["dedupe_by"] = ["kafka_partition", "kafka_offset"]
    return scd2(card_versions(landed), ts=ts, **kw)


def scd2_current(dim: DataFrame) -> DataFrame:
    """S3: current state (is_current = 1)."""
    return dim.filter(F.col("is_current") == 1)


def as_of(fact: DataFrame, dim: DataFrame, key: str = "card_id", ts_col: str = "txn_ts",
          cols=("card_sk", "status", "is_deleted"), prefix: str = "",
          unit: str = "month", horizon=None) -> DataFrame:
    """S4: point-in-time lookup, the version with valid_from <= ts < valid_to.

    An interval index: a version stands in the month it starts in and, as it
    was, at the beginning of every later month that it covers. Facts meet the
    versions of their key and month in one shuffle of both, each read once, and
    take the last one at or before their time; no pairs are made, so a month of
    many versions and many facts of one key is linear work. Among versions that
    start at the same instant the zero-length ones end there, so the order
    (valid_from, valid_to) picks the one that is valid.

    ``unit`` is what one task handles of one key ('day' for keys that burst
    within a month). Months from ``horizon`` on (default: now) are one bucket,
    so an open version is not repeated without end; facts after it are right
    too. Facts before the first version, and facts without a key or a time,
    get NULLs.
    """
    last = F.date_trunc(unit, F.coalesce(F.lit(horizon).cast("timestamp_ntz"), F.localtimestamp())).cast("timestamp_ntz")
    of = lambda c: F.least(F.date_trunc(unit, c).cast("timestamp_ntz"), last)        # noqa: E731
    step = F.expr(f"interval 1 {unit}")
    v = dim.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        key, "valid_from", "valid_to", F.struct(*cols).alias("__v"))
    first, until = of(F.col("valid_from")), of(F.col("valid_to") - F.expr("interval 1 microsecond"))
    later = F.when(first + step <= until, F.sequence(first + step, until, step))
    v = v.select(key, "__v", F.lit(0).alias("__side"), "valid_to", F.inline(F.concat(
        F.array(F.struct(first.alias("__m"), F.col("valid_from").alias("__t"))),
        F.coalesce(F.transform(later, lambda m: F.struct(m.alias("__m"), m.alias("__t"))),
                   F.array().cast("array<struct<__m:timestamp_ntz,__t:timestamp_ntz>>")))))
    rest = [c for c in fact.columns if c != key]
    f = fact.select(key, F.lit(1).alias("__side"), of(F.col(ts_col)).alias("__m"), F.col(ts_col).alias("__t"),
                    F.struct(*rest).alias("__f"))
    both = v.unionByName(f, allowMissingColumns=True)
    # facts without a key have no versions to meet: they are spread by their time
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64("__t"), F.lit(1024))).otherwise(F.lit(0))
    # a version carried into a month precedes one that starts with the month
    w = Window.partitionBy(key, "__m", spread).orderBy("__t", "__side", "valid_to").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn("__hit", F.last("__v", ignorenulls=True).over(w)).filter("__side = 1")
    found = F.when(F.col("__t").isNotNull(), F.col("__hit"))
    return out.select(key, *[F.col(f"__f.`{c}`").alias(c) for c in rest], *[found[c].alias(prefix + c) for c in cols])


def check_invariants(dim: DataFrame, key: str = "card_id", bucket=None) -> DataFrame:
    """Per-key SCD2 invariant violations: overlaps/gaps between consecutive
    versions, not exactly one current version, or a current version that does
    not end at the open end. Empty frame = healthy."""
    nxt = W.with_next(dim, key, ["valid_from", "card_sk"], ["valid_from"],
                      _bucket(bucket, "valid_from"), prefix="__n_")
    bad_link = nxt.filter(F.col("__n_valid_from").isNotNull()
                          & (F.col("valid_to") != F.col("__n_valid_from")))
    per_key = dim.groupBy(key).agg(
        F.sum("is_current").alias("n_current"),
        F.sum(F.when((F.col("is_current") == 1) & (F.col("valid_to") != ntz(OPEN_END)), 1)
              .otherwise(0)).alias("bad_open"))
    bad_key = per_key.filter((F.col("n_current") != 1) | (F.col("bad_open") > 0))
    return (bad_link.select(key, F.lit("gap_or_overlap").alias("violation"))
            .unionByName(bad_key.select(key, F.lit("current_count").alias("violation"))))


def scd2_incremental(dim: DataFrame, log: DataFrame, new_rows: DataFrame, key: str = "card_id",
                     ts=None, **kw) -> DataFrame:
    """S2 maintained incrementally: only keys touched by ``new_rows`` are
    rebuilt, from their whole history in ``log`` (the landing table, which
    already includes ``new_rows``), so a late change splits the right
    interval. Untouched keys keep their versions; the result equals a full
    recompute over ``log``.

    Work scales with the touched keys: the key set is a distinct aggregate,
    the log is semi-joined to it (Spark can prune the scan with a runtime
    filter), and the dimension is anti-joined -- no per-key state on the
    driver.
    """
    touched = new_rows.select(key).distinct()
    history = log.join(touched, key, "left_semi")
    rebuilt = scd2_from_landing(history, ts=ts, **kw)
    kept = dim.join(touched, key, "left_anti")
    return kept.unionByName(rebuilt.select(*dim.columns))
