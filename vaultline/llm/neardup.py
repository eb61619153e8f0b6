"""MinHash near-duplicates by fast similarity sketching (Dahlgaard, Knudsen, Thorup 2017).

A sketch has ``COORDS`` coordinates. In round i < COORDS every element is
thrown into one pseudorandom bin with a value that starts with i; in round
COORDS + j every element goes to bin j. A bin keeps its least value and a text
stops when all its bins hold one, so every coordinate is filled, early rounds
win, and one round suffices for long texts. Equal coordinates are an unbiased,
concentrated estimate of the Jaccard similarity.

Steps: sketch every text; texts with equal shingle sets form classes;
``COORDS / ROWS`` bands put the classes into buckets. In each bucket the class
with the smallest id is compared with all others (``stars``) on full sets.
Where a bucket still holds more than one component, all its classes of
different components are compared (``rest``), in blocks of bounded size, so a
link never depends on which class was the centre.

Shingles have two independent hashes: one finds candidates, the other makes
up the full sets on which links are confirmed; classes must agree in both.

At a similarity of 0.75 a pair shares no band with probability
(1 - 0.75**4)**32 = 5e-6; higher similarities are missed more rarely.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.arrowtext import U, digest, mix, seeded, sets_of, shingle_sets, word_groups
from vaultline.llm.components import connected_components
from vaultline.llm.tables import column_named, materialize, small

SHINGLE, PERCENT = 5, 75
COORDS, ROWS = 128, 4
BLOCK_ROWS, BLOCK_SHINGLES = 1500, 3_000_000     # bounds of one block of a bucket
ROUND_SEEDS = seeded(23, COORDS)
NONE = U((1 << 64) - 1)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDS coordinates per non-empty set; every one is filled."""
    n = len(sets)
    x = np.concatenate(sets) if n else np.zeros(0, U)
    d = np.repeat(np.arange(n), [len(s) for s in sets])
    out = np.full(n * COORDS, NONE, U)
    for i in range(2 * COORDS):
        if not len(x):
            break
        if i < COORDS:
            h = mix(x ^ ROUND_SEEDS[i])
            place = d * COORDS + (h & U(COORDS - 1)).astype(np.int64)
        else:
            h = mix(x ^ ROUND_SEEDS[i - COORDS] ^ U(0x5BF03635))
            place = d * COORDS + (i - COORDS)
        np.minimum.at(out, place, (U(i) << U(56)) | (h >> U(8)))
        open_ = (out.reshape(n, COORDS) == NONE).any(axis=1)
        keep = open_[d]
        x, d = x[keep], d[keep]
    return out.reshape(n, COORDS)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ROWS coordinates."""
    parts = sketches.reshape(len(sketches), -1, ROWS)
    keys = np.broadcast_to(seeded(29, parts.shape[1]), parts.shape[:2]).copy()
    for j in range(ROWS):
        keys = mix(keys * U(0x9E3779B97F4A7C15) + parts[:, :, j])
    return keys.view(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, words in word_groups(batch["text"], lower=True):
            sets, again = sets_of(words, SHINGLE), sets_of(words.in_lane(1), SHINGLE)
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(sketch(full)).tolist() if full else [])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"].slice(a, len(sets)),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "fp": pa.array([digest(s, t) if len(s) else None for s, t in zip(sets, again)], pa.binary()),
                "bands": pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64())),
            })


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, sets in shingle_sets(batch["text"], SHINGLE, lane=1):
            yield pa.RecordBatch.from_pydict({
                "rep": batch["doc_id"].slice(a, len(sets)),
                "set": pa.array([s.tobytes() for s in sets], pa.binary()),
            })


def linked(shared, n_a, n_b, percent: int = PERCENT):
    """100 * intersection >= percent * union, in whole numbers."""
    return 100 * shared >= percent * (n_a + n_b - shared)


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, last, left = [], None, None
        for x, y in zip(batch["set_a"], batch["set_b"]):
            if last is None or x != last:
                last, left = x, np.frombuffer(x.as_buffer(), U)
            right = np.frombuffer(y.as_buffer(), U)
            both = np.concatenate([left, right])
            both.sort()
            keep.append(bool(linked(int((both[1:] == both[:-1]).sum()), len(left), len(right))))
        yield pa.RecordBatch.from_pydict({k: batch[k] for k in ("a", "b")}).filter(pa.array(keep, pa.bool_()))


def cross_links(rep: np.ndarray, comp: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join different components of one block, on full sets.

    Every row outside the most frequent component is compared with all rows
    that are in another component at that time; postings of the shared
    shingles give the intersection sizes. Found links merge components, and
    only such links are returned.
    """
    n = np.array([len(s) for s in sets])
    values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    names, comp = np.unique(comp, return_inverse=True)
    largest = np.bincount(comp).argmax()
    links = []
    for c in np.flatnonzero(comp != largest):
        other = comp != comp[c]
        if not other.any():
            continue
        a = np.searchsorted(values, sets[c], "left")
        b = np.searchsorted(values, sets[c], "right")
        long_ = b - a
        at = np.repeat(a - np.concatenate([[0], np.cumsum(long_)[:-1]]), long_) + np.arange(long_.sum())
        shared = np.bincount(row[at], minlength=len(sets))
        for x in np.flatnonzero(linked(shared, n[c], n) & other):
            if comp[x] != comp[c]:
                links.append((int(rep[c]), int(rep[x])))
                comp[comp == comp[x]] = comp[c]
    return links


def _rest_block(table: pa.Table) -> pa.Table:
    sets = [np.frombuffer(x.as_buffer(), U) for x in table["set"]]
    links = cross_links(table["rep"].to_numpy(), table["comp"].to_numpy(), sets)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                     "b": pa.array([y for _, y in links], pa.int64())})


def _pairs_within(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links between the smallest class of each bucket and the others."""
    fit = 100 * F.least("n", "c_n") >= PERCENT * F.greatest("n", "c_n")
    pairs = members.filter((F.col("rep") != F.col("c_rep")) & fit).select(
        F.col("c_rep").alias("a"), F.col("rep").alias("b")).distinct()
    left = sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(right, "b").join(left, "a").mapInArrow(_verify_batches, "a bigint, b bigint")


def _residual_links(members: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Verified links inside the buckets that still hold several components."""
    named = comps.select(F.col("node").alias("rep"), "component")
    m = members.join(named, "rep", "left").select(
        "band", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    buckets = (m.groupBy("band").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("rows"),
        F.sum("n").alias("shingles"), F.min("rep").alias("first"),
        F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("mark"),
        F.expr("bit_xor(xxhash64(rep, 7))").alias("mark2"))
        .filter("lo < hi")
        # buckets of the same classes need one comparison
        .groupBy("rows", "shingles", "first", "mark", "mark2").agg(F.min("band").alias("band"))
        .select("band", F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS),
                                   F.ceil(F.col("shingles") / BLOCK_SHINGLES)).alias("blocks")))
    buckets = materialize(buckets, "residual")
    if buckets.isEmpty():
        return None
    # a bucket of b blocks is compared as b * (b + 1) / 2 pairs of blocks, each of bounded size
    mine = F.pmod(F.xxhash64("rep", "band"), F.col("blocks"))
    with_ = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    blocks = (m.join(buckets, "band").select("band", "rep", "comp", mine.alias("mine"), with_.alias("other"))
              .select("band", "rep", "comp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))
    return (blocks.join(sets, "rep").groupBy("band", "i", "j")
            .applyInArrow(_rest_block, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Texts are lower-cased (A-Z), cut into words, and stand for their set of
    distinct 5-word shingles (the whole sequence if shorter); two sets with
    100 * intersection >= 75 * union are linked, and the component is the
    smallest id that links reach. Null or wordless texts have the empty set
    and are linked with nothing. Rows without an id are linked with nothing:
    their component is null and they are kept. Rows that share an id are one
    node: they share one component. Other columns are not read.
    """
    source = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                         column_named(docs, text_col).alias("text"))
    sk = materialize(source.mapInArrow(
        _sketch_batches, "doc_id bigint, n bigint, fp binary, bands array<bigint>"), "sketches")
    classes = materialize(sk.filter("n > 0 and doc_id is not null").groupBy("fp").agg(
        F.min("doc_id").alias("rep")), "classes")
    bands = (sk.join(classes, "fp").filter("doc_id = rep")
             .select("rep", "n", F.explode(F.array_distinct("bands")).alias("band")).distinct())
    bands = materialize(bands, "bands")
    shared = bands.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("c"), F.max("rep").alias("top")) \
        .filter("c.rep < top")
    members = materialize(bands.join(shared, "band").select(
        "band", "rep", "n", F.col("c.rep").alias("c_rep"), F.col("c.n").alias("c_n")), "members")
    wanted = materialize(members.select("rep").distinct(), "wanted")
    # a text may come in many copies: one of them gives its set
    chosen = source.join(small(wanted, wanted.count()), source["doc_id"] == wanted["rep"]).select("doc_id", "text")
    sets = materialize(chosen.mapInArrow(_set_batches, "rep bigint, set binary"), "sets")
    # an id with several texts joins their classes
    ids = sk.filter("n > 0").join(classes, "fp").select("doc_id", "rep")
    several = ids.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi")
    same_id = ids.join(several, "doc_id").select(F.col("rep").alias("a"), F.col("lo").alias("b"))
    links = materialize(_pairs_within(members, sets).union(same_id), "links")
    comps = connected_components(links)
    more = _residual_links(members, comps, sets)
    if more is not None:
        comps = connected_components(comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                     .union(materialize(more, "more")))
    named = classes.join(comps, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component"))
    out = sk.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("fp")).alias("fp")) \
        .join(named, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is not the smallest of its
    component; same columns. Rows without an id stay; rows that share the kept
    id are one document and all stay."""
    lost = materialize(near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("lost_id")).distinct(), "lost")
    return docs.join(small(lost, lost.count()), column_named(docs, "doc_id") == lost["lost_id"], "left_anti")
