"""A type-2 dimension that is kept up to date batch by batch (S2, STR5).

Two tables hold it: ``<name>_open`` has the current version of each key,
partitioned by a hash bucket of the key; ``<name>_closed`` has the ended
versions, partitioned by the batch that ended them. A batch reads and rewrites
the open buckets of its own keys and writes one new closed partition, so its
work does not grow with the history. Only keys with a late row, one that sorts
before their current version, have their ended versions looked up, and only
the closed partitions that hold a split interval are rewritten.

The closed partitions are replaced first, then the open buckets, each at once
and each marked with the batch. A batch that is run again after a failure
anywhere gives the same rows: if the open buckets know it, it is done; if not,
its closed partition is replaced by the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions import windows as W
from vaultline.functions.columns import epoch_millis, hash_key, load_ts, ntz
from vaultline.operators.scd2 import VERSION_ORDER
from vaultline.schemas import OPEN_END
from vaultline.sinks.tables import TableStore

ATTRIBUTES = ("card_number", "account_id", "status", "opened_at", "closed_at", "is_deleted")
BUCKETS = 64
LITERAL_KEYS = 1000        # keys of late rows that are pushed to the files as values


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_dimension(store: TableStore, name: str) -> DataFrame:
    """All versions, in the columns of the dimension."""
    closed = store.read(f"{name}_closed").drop("kafka_partition", "kafka_offset", "batch_id")
    return store.read(f"{name}_open").select(closed.columns).unionByName(closed)


def read_current(store: TableStore, name: str) -> DataFrame:
    """S3: the current versions; the ended ones are not read."""
    return store.read(f"{name}_open").drop("kafka_partition", "kafka_offset", "batch_id", "key_bucket")


def exists(store: TableStore, name: str) -> bool:
    return store.exists(f"{name}_open")


def _ended(rows: DataFrame, key: str) -> DataFrame:
    """Versions with their ends, told by the next one of the key."""
    nxt = W.with_next(rows, key, VERSION_ORDER, ["src_ts"], W.day_bucket("src_ts"), prefix="__next_")
    end = F.col("__next_src_ts")
    return nxt.withColumn("valid_to", F.coalesce(end, ntz(OPEN_END))) \
        .withColumn("is_current", F.when(end.isNull(), 1).otherwise(0)).drop("__next_src_ts")


def apply_batch(store: TableStore, name: str, versions: DataFrame, batch_id: int, key: str = "card_id",
                attrs=ATTRIBUTES, buckets: int = BUCKETS, ts=None) -> None:
    """Bring ``<name>`` up to date with the change rows ``versions`` (as
    ``operators.cdc.card_versions`` makes them) of a batch. The result equals
    ``operators.scd2.scd2`` over all rows so far, whatever their order and
    however often a row or a batch comes. ``batch_id`` names the batch: the
    same one may be applied again, and no other."""
    opened, closed, sk = f"{name}_open", f"{name}_closed", f"{key.removesuffix('_id')}_sk"
    base = [sk, key, *attrs, "valid_from", "src_ts", "loaded_at", "kafka_partition", "kafka_offset"]
    columns = [sk, key, *attrs, "valid_from", "valid_to", "is_current", "src_ts", "loaded_at",
               "kafka_partition", "kafka_offset", "batch_id"]
    made = versions.select(
        hash_key(F.col(key), epoch_millis("src_ts"), "kafka_partition", "kafka_offset").alias(sk), key, *attrs,
        F.col("src_ts").alias("valid_from"), "src_ts", load_ts(ts).alias("loaded_at"),
        "kafka_partition", "kafka_offset").dropDuplicates([sk])
    this = F.lit(batch_id).cast("long").alias("batch_id")
    if not exists(store, name):
        rows = _ended(made, key).select(*columns[:-1], this)
        store.overwrite(closed, rows.filter("is_current = 0"), partition_by="batch_id", sort_by=key)
        store.overwrite(opened, rows.filter("is_current = 1").withColumn("key_bucket", _bucket(key, buckets)),
                        partition_by="key_bucket", sort_by=key)
        return
    # written once: read for its keys, for the late rows and for the merge
    store.overwrite(f"{name}_batch", made)
    new = store.read(f"{name}_batch")
    touched = [r[0] for r in new.select(_bucket(key, buckets).alias("b")).distinct().collect()]
    current = store.read(opened).filter(F.col("key_bucket").isin(touched))
    if not touched or not current.filter(F.col("batch_id") == batch_id).isEmpty():
        return                                                  # nothing, or applied before
    keys = new.select(key).distinct()
    old = current.join(keys, key, "left_semi")
    history = _history(store.read(closed), _late_keys(new, old, key), key)
    # of a row that came before, the stored one: it keeps its load time
    rows = old.select(base).unionByName(history.select(base)).withColumn("__new", F.lit(0)).unionByName(
        new.withColumn("__new", F.lit(1)))
    rows = rows.groupBy(sk).agg(F.min_by(F.struct(*base), "__new").alias("r")).select("r.*")
    before = history.select(sk, F.col("valid_to").alias("__to"), F.col("batch_id").alias("__batch"))
    store.overwrite(f"{name}_merged", _ended(rows, key).join(before, sk, "left"))
    merged = store.read(f"{name}_merged")
    # versions that end now or end earlier than they did; the latter leave the batch that held them
    ended = merged.filter("is_current = 0 and (__to is null or __to <> valid_to)")
    values = sorted({batch_id, *(r[0] for r in ended.select("__batch").distinct().collect() if r[0] is not None)})
    kept = store.read(closed).filter(F.col("batch_id").isin(values)).join(ended.select(sk), sk, "left_anti")
    store.replace(closed, kept.select(columns).unionByName(ended.select(*columns[:-1], this)), "batch_id", values, sort_by=key)
    now = merged.filter("is_current = 1").select(*columns[:-1], this).withColumn("key_bucket", _bucket(key, buckets))
    store.replace(opened, current.join(keys, key, "left_anti").unionByName(now), "key_bucket", touched, sort_by=key)


def _late_keys(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Keys with a row that sorts before their current version."""
    order = lambda p: F.struct(*[F.col(f"{p}.{c}") for c in VERSION_ORDER])          # noqa: E731
    return (new.alias("n").join(old.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"))
            .filter(order("n") < order("o")).select(F.col(f"n.{key}").alias(key)).distinct())


def _history(closed: DataFrame, late: DataFrame, key: str) -> DataFrame:
    """Ended versions of the keys of late rows; few keys are looked up by value."""
    some = [r[0] for r in late.limit(LITERAL_KEYS + 1).collect()]
    if not some:
        return closed.filter(F.lit(False))
    if len(some) <= LITERAL_KEYS:
        return closed.filter(F.col(key).isin(some))
    return closed.join(late, key, "left_semi")
