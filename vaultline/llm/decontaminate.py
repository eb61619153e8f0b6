"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by set size, (2^(i-1), 2^i] distinct shingles. An item's
sketch is the MinHash sketch of its k smallest hash values, k = min(2^i,
``SKETCH``): in the partitions up to ``SKETCH`` the sketch is the whole set, so
a short item cannot be hidden by a smaller hash of its neighbours; above, k
values stand for the item. A document is compared on those values, as its own
sketch has every hash of it below the item's largest one.

An item of n shingles that is contained by t = 75 % in a document of x has
Jaccard similarity t n / (x + n - t n) to it or more. On the sketches this
bound says that at least ``least_shared`` of the item's k values are values of
the document, whatever x is: t n of them for whole sets, and t k less five
standard deviations for samples (an item is missed with probability 3e-7).
Candidates are looked up by the k - least_shared + 1 values of the sketch that
are in fewest documents, one of which a match must have, so common shingles
pair nothing; then the sketches are compared, then the full sets, under a
second hash.

The shingles of all items fill a bitmap of fixed size, which goes to the tasks
that scan the documents. A document keeps the shingles that the bitmap has: all
that it shares with any item, and few others. So the bitmap's size affects
speed only, and the kept shingles are enough to count what is shared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.arrowtext import U, digest, distinct, mix, sets_of, word_groups
from vaultline.llm.tables import column_named, materialize, small

SHINGLE, PERCENT = 5, 75
SKETCH = 128                                      # values of a sketch at most
FILTER_BITS = 26                                  # the bitmap has 2**26 bits, 8 MB


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)])
    flat = np.concatenate([*sets, np.zeros(0, U)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    at, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return [flat[a:b] for a, b in zip(at, at[1:])]


def sketch(values: np.ndarray) -> np.ndarray:
    """The elements of a set that have the smallest min-wise hashes: as many as
    the upper size of its partition, ``SKETCH`` at most."""
    order = mix(values ^ U(0x452821E638D01377))
    return values[np.argsort(order, kind="stable")[:min(SKETCH, len(values))]]


def least_shared(n: int) -> int:
    """Values of the sketch of an item of ``n`` shingles that a document with
    PERCENT of the item has."""
    if n <= SKETCH:
        return -(-n * PERCENT // 100)
    t = PERCENT / 100
    return int(t * SKETCH - 5 * (SKETCH * t * (1 - t)) ** 0.5)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, words in word_groups(batch["text"], lower=True):
            sets, again = sets_of(words, SHINGLE), sets_of(words.in_lane(1), SHINGLE)
            yield pa.RecordBatch.from_pydict({
                "item_id": batch["item_id"].slice(a, len(sets)),
                "item": pa.array([digest(s, t) for s, t in zip(sets, again)], pa.binary()),
                "n_item": pa.array([len(t) for t in again], pa.int64()),
                "least": pa.array([least_shared(len(s)) for s in sets], pa.int64()),
                "item_set": _lists(sets), "item_again": _lists(again), "sketch": _lists([sketch(s) for s in sets])})


def _hits(bitmap):
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, m = bitmap.value, U((1 << FILTER_BITS) - 1)
        for batch in batches:
            for a, words in word_groups(batch["text"], lower=True):
                doc, h = words.shingles(SHINGLE)
                hit = np.arange(len(h))
                for shift in (0, 32):
                    at = ((h[hit] >> U(shift)) & m).astype(np.int64)
                    hit = hit[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
                docs, first = np.unique(doc[hit], return_index=True)
                if not len(docs):
                    continue
                second = words.in_lane(1).shingles(SHINGLE)[1][hit]
                sets = [distinct(x) for x in np.split(h[hit], first[1:])]
                again = [distinct(x) for x in np.split(second, first[1:])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch["doc_id"].slice(a, len(words.bounds) - 1).take(pa.array(docs)),
                    "fp": pa.array([digest(s, t) for s, t in zip(sets, again)], pa.binary()),
                    "set": _lists(sets), "again": _lists(again)})
    return hits


def _common(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = []
        for x, again, of_item, y, least in zip(*(_arrays(batch[c]) for c in ("set", "again", "sketch", "item_again")),
                                               batch["least"].to_pylist()):
            near = _common(x, of_item) >= least                # the sketches' bound
            shared.append(_common(again, y) if near else 0)    # the full sets
        yield pa.RecordBatch.from_pydict({**{k: batch[k] for k in ("fp", "item_id", "n_item")},
                                          "n_shared": pa.array(shared, pa.int64())})


def _bitmap(items: DataFrame) -> np.ndarray:
    """Two slots per shingle of the items in 2**FILTER_BITS bits (aggregated as bitmaps of 4 KB, at most 8 MB together)."""
    m = (1 << FILTER_BITS) - 1
    slots = F.array(F.col("key").bitwiseAND(m), F.shiftrightunsigned("key", 32).bitwiseAND(m))
    parts = (items.select(F.explode("item_set").alias("key")).select(F.explode(slots).alias("s")).groupBy(F.expr("bitmap_bucket_number(s + 1)").alias("b"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s + 1))").alias("bits")).collect())
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for p in parts:
        out[(p["b"] - 1) * 4096:p["b"] * 4096] = np.frombuffer(p["bits"], np.uint8)
    return out


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id") -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every pair in which
    a row of ``docs`` holds at least 75 in 100 of an item's distinct shingles.

    Shingles are five lower-cased (A-Z) words, whole sequences for texts of
    fewer; so an item of fewer than five words is found only where it is a
    whole document. Null and wordless texts, on either side, match nothing.
    Rows with equal ids give rows of their own, null ids stay null. Other
    columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    source = items.select(column_named(items, item_col).cast("bigint").alias("item_id"),
                          column_named(items, text_col).alias("text"))
    prepared = materialize(source.mapInArrow(
        _items, "item_id bigint, item binary, n_item bigint, least bigint, item_set array<bigint>, "
                "item_again array<bigint>, sketch array<bigint>").filter("n_item > 0"), "items")
    bitmap = spark.sparkContext.broadcast(_bitmap(prepared))
    texts = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                        column_named(docs, text_col).alias("text"))
    hits = materialize(texts.mapInArrow(_hits(bitmap), "doc_id bigint, fp binary, set array<bigint>, again array<bigint>"), "hits")
    # documents of equal hits are searched and verified once, items of equal shingles are searched once
    sets = hits.select("fp", "set", "again").dropDuplicates(["fp"])
    keys = sets.select("fp", F.explode("set").alias("key"))
    found = keys.groupBy("key").agg(F.count("*").alias("n"))
    searched = prepared.dropDuplicates(["item"]).select(
        "item", (F.size("sketch") - F.col("least") + 1).cast("int").alias("enough"), F.explode("sketch").alias("key"))
    by_rarity = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")))    # SKETCH at most
    rare = materialize(searched.join(found, "key", "left").groupBy("item", "enough").agg(by_rarity.alias("keys"))
                       .select("item", F.explode(F.slice("keys", F.lit(1), F.col("enough"))).alias("k"))
                       .filter("k.n > 0").select("item", "k.key"), "rare")
    pairs = keys.join(small(rare, rare.count()), "key").select("fp", "item").distinct()
    verified = (pairs.join(sets, "fp").join(prepared, "item")
                .select("fp", "item_id", "n_item", "least", "set", "again", "sketch", "item_again")
                .mapInArrow(_verify, "fp binary, item_id bigint, n_item bigint, n_shared bigint")
                .filter(F.col("n_shared") * 100 >= F.col("n_item") * PERCENT))
    return hits.select("doc_id", "fp").join(verified, "fp").select(
        "doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id holds an item; rows without an id stay."""
    bad = materialize(contained_items(docs, items).select(F.col("doc_id").alias("bad_id"))
                      .filter("bad_id is not null").distinct(), "contaminated")
    return docs.join(small(bad, bad.count()), column_named(docs, "doc_id") == bad["bad_id"], "left_anti")
