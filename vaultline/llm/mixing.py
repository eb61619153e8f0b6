"""Mixing sources to target weights, with DataFrame functions only.

Each source is a stream of words in a fixed order of its documents, cut into
blocks of ``BLOCK`` words. The output is a row of slots, ``SHARD`` to a shard;
each slot draws its source from the target shares, so a shard's source counts
are multinomial. Draws beyond a source's quota of slots are dealt, in order, to
sources that are still short, so that totals meet the targets. The k-th slot of
a source takes the block that the source's pseudorandom permutation puts at k;
the permutation is swap-or-not (Hoang, Morris, Rogaway 2012), computed per index
with a keyed hash, and starts anew when all blocks were taken. The last slot is
cut where the target is met. Documents and slots meet by block index.

Ranks inside a source are prefix sums over buckets and shards, so a source with
a third of all rows is never ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.tables import column_named, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE_PERCENT, MOST = (5, 2, 1), 150, 2
BLOCK, SHARD, BUCKETS, CELLS, ROUNDS, SEED = 256, 4096, 512, 1 << 12, 20, 2025
SLOTS_PER_TASK = 1 << 21


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, sid, source_size, target, quota) of each source of ``sizes``
    (source, size); one row per source, so the order of sources is one small
    window. ``sid`` numbers the sources by code point, null last; weights
    repeat in that order. A target stops at MOST times its source's size, and
    what is over goes to the others by weight until none is above."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    s = s.withColumn("sid", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                                            (F.col("sid") % len(WEIGHTS) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * float(MOST))
    # sources reach their cap in the order of cap / weight; level = words per weight of those that do not
    order = every.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * (SHARE_PERCENT / 100.0)
    s = s.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # with too few sources counted as capped the level is too low, with too many again: the right one is the largest
    open_level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(every)
    target = F.least("cap", F.coalesce(open_level * F.col("weight"), F.col("cap")))
    return s.withColumn("target", target).select(
        "source", "sid", "source_size", "target", F.round("target").cast("bigint").alias("quota"))


def _blocks(size: Column) -> Column:
    return F.ceil(size / BLOCK)


def _unit(*cols) -> Column:
    """A pseudorandom number of [0, 1) from a keyed hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11) / float(1 << 53)


def permuted(index: Column, n: Column, key: Column) -> Column:
    """Swap-or-not: a pseudorandom permutation of 0 .. n - 1, for any n."""
    def round_(x, r):
        other = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), key, r), n) - x, n)
        flip = F.xxhash64(F.lit(SEED + 1), key, r, F.greatest(x, other)) % 2 == 0
        return F.when(flip, other).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("bigint"), round_)


def placed(docs: DataFrame) -> DataFrame:
    """Adds ``start``: the place of each row's first word in its source's stream
    (columns sid, size, doc_id, tie; buckets of a source are ordered by number,
    rows of a bucket by doc_id and tie)."""
    bucket = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(BUCKETS))
    d = docs.withColumn("bucket", bucket)
    sums = d.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("sid", "bucket").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return d.join(sums, ["sid", "bucket"]).withColumn("start", F.col("base") + F.col("inner")).drop("base", "inner", "bucket")


def _ranges(sources: DataFrame, width: Column) -> DataFrame:
    """``lo`` and ``hi`` of each source's interval when widths stand side by side in the order of sid."""
    upto = Window.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sources.withColumn("hi", F.sum(width).over(upto)).withColumn("lo", F.col("hi") - width)


def slots(targets: DataFrame) -> DataFrame:
    """(shard, sid, k, words): each shard's slots with their number within the
    source, and the words they take (BLOCK, or fewer for short blocks and the cut)."""
    spark = targets.sparkSession
    t = targets.filter("quota > 0").withColumn("per_round", _blocks(F.col("source_size")))
    t = t.withColumn("n_slots", F.expr("quota div source_size") * F.col("per_round")
                     + F.ceil(F.expr("quota % source_size") / BLOCK))
    t = materialize(_ranges(t, F.col("n_slots")), "targets")
    n = t.agg(F.sum("n_slots")).first()[0] or 0
    # a slot's draw is a whole number below n; cells make the interval lookup an equi-join
    width = n // CELLS + 1
    cells = t.select("sid", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    drawn = spark.range(n).select(F.expr(f"id div {SHARD}").alias("shard"),
                                  F.least(F.floor(_unit(F.col("id")) * n), F.lit(n - 1)).alias("draw"))
    counts = (drawn.withColumn("cell", F.floor(F.col("draw") / width)).join(cells, "cell")
              .filter("draw >= lo and draw < hi").groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("drawn")))
    counts = materialize(counts, "draws")
    upto = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed_ = (counts.withColumn("from_k", F.coalesce(F.sum("drawn").over(upto), F.lit(0)))
               .join(t.select("sid", "n_slots"), "sid")
               .withColumn("used", F.greatest(F.lit(0), F.least("drawn", F.col("n_slots") - F.col("from_k")))))
    # draws beyond the quota, in the order of shards, meet the gaps of the other sources, in the order of sid
    over = placed_.groupBy("shard").agg(F.sum(F.col("drawn") - F.col("used")).alias("extra")).filter("extra > 0")
    over = over.withColumn("o_hi", F.sum("extra").over(
        Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    short = t.join(counts.groupBy("sid").agg(F.sum("drawn").alias("got")), "sid", "left")
    short = short.withColumn("gap", F.greatest(F.lit(0), F.col("n_slots") - F.coalesce("got", F.lit(0)))).filter("gap > 0")
    short = _ranges(short.select("sid", "got", "gap"), F.col("gap"))
    gap_cells = short.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") / SHARD), F.floor((F.col("hi") - 1) / SHARD))))
    over_cells = over.withColumn("o_lo", F.col("o_hi") - F.col("extra")).withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("o_lo") / SHARD), F.floor((F.col("o_hi") - 1) / SHARD))))
    a = F.greatest("lo", "o_lo", F.col("cell") * SHARD)
    b = F.least("hi", "o_hi", (F.col("cell") + 1) * SHARD)
    dealt = (gap_cells.join(over_cells, "cell").filter(a < b)
             .select("shard", "sid", (F.coalesce("got", F.lit(0)) + a - F.col("lo")).alias("from_k"), (b - a).alias("used")))
    runs = placed_.filter("used > 0").select("shard", "sid", "from_k", "used").unionByName(dealt)
    # a run is one short row but up to SHARD slots, so tasks are dealt by slots and not by the bytes of the runs
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // SLOTS_PER_TASK + 1)
    runs = runs.repartition(tasks, "shard", "sid", "from_k")
    return runs.select("shard", "sid", F.explode(F.sequence("from_k", F.col("from_k") + F.col("used") - 1)).alias("k"))


def mixed_blocks(slot_rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(shard, sid, k, block, words): the block behind each slot and how many of
    its leading words are taken. A short last block comes last in each round."""
    size, quota = F.col("source_size"), F.col("quota")
    s = slot_rows.join(targets.select("sid", "source_size", "quota"), "sid")
    s = s.withColumn("per_round", _blocks(size)).withColumn("full", F.expr(f"source_size div {BLOCK}"))
    s = s.withColumn("j", F.expr("k % per_round")).withColumn(
        "before", F.expr("k div per_round") * size + F.col("j") * BLOCK)
    s = s.withColumn("block", F.when(F.col("j") < F.col("full"), permuted(F.col("j"), F.col("full"), F.col("sid")))
                     .otherwise(F.col("full")))
    length = F.when(F.col("j") < F.col("full"), F.lit(BLOCK)).otherwise(size - F.col("full") * BLOCK)
    return s.select("shard", "sid", "k", "block", F.least(length, quota - F.col("before")).alias("words"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
    """(documents, blocks) of the mixture.

    documents: doc_id, sid, size, source_size, target, start, tie and ``taken``, the
    words of the row that the mixture takes, repeats counted. blocks: shard,
    sid, k, block, words, which with the documents' places tell which words
    stand where. A null text has no words; a null source is a source, the last
    one. Rows with equal ids are rows of their own, and equal rows are
    interchangeable. With no words at all every target is 0 and no block is
    taken. Other columns are not read. The same rows give the same mixture in
    any order and partitioning.
    """
    text = F.coalesce(column_named(docs, text_col).cast("string"), F.lit(""))
    rows = materialize(docs.select(
        column_named(docs, id_col).cast("bigint").alias("doc_id"), column_named(docs, source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), F.xxhash64(text).alias("tie")), "sizes")
    targets = materialize(source_targets(rows), "targets")
    named = targets.select(F.col("source").alias("name"), "sid", "source_size", "target")
    d = placed(rows.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("source", "name"))
    d = materialize(d, "placed")
    blocks = mixed_blocks(slots(targets), targets)
    # a block is taken twice at most; each taking is a prefix of it
    takings = blocks.groupBy("sid", "block").agg(
        F.sum((F.col("words") >= 0).cast("bigint")).alias("n"), F.max("words").alias("w1"), F.min("words").alias("w2"))
    span = d.filter("size > 0").select("sid", "doc_id", "tie", "start", "size", F.explode(F.sequence(
        F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))).alias("block"))
    lo = F.greatest(F.col("start") - F.col("block") * BLOCK, F.lit(0))
    hi = F.least(F.col("start") + F.col("size") - F.col("block") * BLOCK, F.lit(BLOCK))
    got = F.greatest(F.lit(0), F.least(hi, F.col("w1")) - lo) + F.when(
        F.col("n") > 1, F.greatest(F.lit(0), F.least(hi, F.col("w2")) - lo)).otherwise(0)
    taken = (span.join(takings, ["sid", "block"]).groupBy("sid", F.col("start").alias("at"))
             .agg(F.sum(got).alias("words")))
    # rows with words have places of their own in a source's stream
    key = F.when(F.col("size") > 0, F.col("start"))
    out = d.withColumn("place", key).join(taken.withColumnRenamed("sid", "t_sid"),
                                          (F.col("sid") == F.col("t_sid")) & (F.col("place") == F.col("at")), "left")
    return out.select("doc_id", "sid", "size", "source_size", "target", "start", "tie",
                      F.coalesce("words", F.lit(0)).cast("bigint").alias("taken")), blocks


def document_shares(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    return mix(docs)[0].select("doc_id", "size", "source_size", "target", "taken")
