"""SimHash fingerprints and block tables, with DataFrame functions only.

Terms of a text are its pairs of neighbouring words (the last word stands
alone); a term weighs its length in characters, 30 at most. Each of 128 bits of
a term's hash votes with that weight for or against the same bit of the
fingerprint. Votes are sums per text of a row, combined before any shuffle: bits
i and i + 32 of a hash share one 64-bit sum, so 64 sums count all 128 bits. A
sum is over one text only, however many copies it has, and stays below 2^31
for any text that a row can hold (a term weighs 31 at most, and no more than
three per byte of a text below 0.7 GB).

Search: a fingerprint is cut into 8 blocks of 16 bits. Two fingerprints that
differ in at most 6 bits agree in two blocks or more, so with one table for
each pair of blocks, keyed by those blocks, every pair within 6 bits meets in
some table; candidates are checked on all bits.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.tables import column_named, materialize, small

BITS, RADIUS, BLOCKS = 128, 6, 8
SEPARATORS = r"[\x20\x09-\x0D]+"
LANES = 0x0000000100000001
BUCKET_CHARS, MOST_BUCKETS = 12_000_000, 4096


def terms(text: Column) -> Column:
    """Array of (h1, h2, w): two hashes and the weight of each term."""
    words = F.split(text, SEPARATORS)
    size = lambda x: F.least(F.coalesce(F.char_length(x), F.lit(0)), F.lit(15))
    return F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.struct(
        F.xxhash64(a, b).alias("h1"), F.xxhash64(F.lit(17), b, a).alias("h2"),
        (size(a) + size(b) + 1).cast("bigint").alias("w")))


def votes() -> list[Column]:
    """Sums over exploded terms (h1, h2, w), and the total weight."""
    out = [F.sum("w").alias("total")]
    for h in ("h1", "h2"):
        for i in range(32):
            out.append(F.sum(F.shiftright(h, i).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"{h}_{i}"))
    return out


def fingerprint(h: str) -> Column:
    """The 64 bits that the votes on one hash decide; a tie gives 0."""
    low = [(F.col(f"{h}_{i}").bitwiseAND(F.lit(0xFFFFFFFF)), i) for i in range(32)]
    high = [(F.shiftrightunsigned(f"{h}_{i}", 32), i + 32) for i in range(32)]
    bits = [F.when(2 * n > F.col("total"), F.shiftleft(F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))
            for n, i in low + high]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def fingerprints(rows: DataFrame, texts: dict[str, str], keys: list[str]) -> DataFrame:
    """``keys``, ``which``, fp1, fp2 of every text of every row; ``texts`` maps
    the values of ``which`` to columns, and ``keys`` name a row."""
    marked = lambda which: lambda t: F.struct(                                                # noqa: E731
        F.lit(which).alias("which"), t["h1"].alias("h1"), t["h2"].alias("h2"), t["w"].alias("w"))
    told = F.concat(*[F.transform(terms(F.col(c)), marked(which)) for which, c in texts.items()])
    return rows.select(*keys, F.inline(told)).groupBy(*keys, "which").agg(*votes()).select(
        *keys, "which", fingerprint("h1").alias("fp1"), fingerprint("h2").alias("fp2"))


def likeness(a1: str, a2: str, b1: str, b2: str) -> Column:
    """Share of equal bits."""
    differ = F.bit_count(F.col(a1).bitwiseXOR(F.col(b1))) + F.bit_count(F.col(a2).bitwiseXOR(F.col(b2)))
    return 1 - differ / float(BITS)


def as_text(a: str, b: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def table_keys(a: str, b: str) -> Column:
    """Keys of the fingerprint in each of the 28 tables."""
    block = [F.shiftrightunsigned(h, 48 - 16 * i).bitwiseAND(F.lit(0xFFFF)) for h in (a, b) for i in range(4)]
    return F.array(*[F.shiftleft(block[i], 16).bitwiseOR(block[j]).bitwiseOR(F.lit(t << 32))
                     for t, (i, j) in enumerate(combinations(range(BLOCKS), 2))])


def near_counts(fps: DataFrame, queries: DataFrame) -> DataFrame:
    """(q1, q2, rows) for each distinct fingerprint of ``queries`` (fp1, fp2):
    the number of rows of ``fps`` (fp1, fp2, n: rows that have it) within
    RADIUS bits, exact matches included. Equal fingerprints are one entry of
    the tables, so copies are never paired."""
    data = fps.groupBy("fp1", "fp2").agg(F.sum("n").alias("n"))
    q = materialize(queries.select(F.col("fp1").alias("q1"), F.col("fp2").alias("q2")).distinct(), "queries")
    wanted = small(q.select("q1", "q2", F.explode(table_keys("q1", "q2")).alias("key")), 28 * q.count())
    found = (data.select("fp1", "fp2", "n", F.explode(table_keys("fp1", "fp2")).alias("key"))
             .join(wanted, "key").select("q1", "q2", "fp1", "fp2", "n").distinct())
    differ = F.bit_count(F.col("fp1").bitwiseXOR(F.col("q1"))) + F.bit_count(F.col("fp2").bitwiseXOR(F.col("q2")))
    return found.filter(differ <= RADIUS).groupBy("q1", "q2").agg(F.sum("n").alias("rows"))


def _bucket(doc_id: Column, splits: list[int]) -> Column:
    """Number of splits not above the id, by binary search; -1 for a null id."""
    steps = 1 << len(splits).bit_length()
    every = F.array(*[F.lit(s).cast("bigint") for s in splits], *[F.lit(None).cast("bigint")] * (steps - len(splits)))
    halves = F.array(*[F.lit(steps >> i) for i in range(1, steps.bit_length())])
    place = F.aggregate(halves, F.lit(0), lambda lo, s: F.when(
        F.coalesce(F.get(every, lo + s - 1) <= doc_id, F.lit(False)), lo + s).otherwise(lo))
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(place)


def with_next(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, tie) with ``next_text`` and
    ``next_tie`` of the row after it, ids descending (null ids last, rows of
    one id by tie), the first row after the last one.

    Rows are dealt into ranges of ids by quantiles, so one shuffle of the
    texts serves; the first row of each range is added once more as the end
    of the range before it.
    """
    size, = docs.agg(F.sum(F.char_length("text"))).first()
    n = min(MOST_BUCKETS, (size or 0) // BUCKET_CHARS + 1)
    splits: list[int] = []
    if n > 1:
        splits = sorted(set(docs.agg(F.percentile_approx(
            "doc_id", [i / n for i in range(1, n)], 20 * n)).first()[0] or []))
    d = docs.withColumn("bucket", _bucket(F.col("doc_id"), splits))
    # a range's first row: the largest id, and of its rows the smallest tie
    heads = d.groupBy("bucket").agg(F.min(F.struct((-F.col("doc_id")).alias("minus"), "tie")).alias("h")).select(
        "bucket", F.col("h.minus").alias("minus"), F.col("h.tie").alias("tie")).orderBy(F.col("bucket").desc()).collect()
    if not heads:
        return d.withColumns({"next_text": F.lit(""), "next_tie": F.col("tie"), "place": F.lit(0)})
    before = [heads[-1], *heads[:-1]]
    ends = docs.sparkSession.createDataFrame(
        [(h["minus"], h["tie"], b["bucket"]) for h, b in zip(heads, before)], "minus bigint, h_tie struct<a:bigint,b:bigint>, end_of int")
    same = (F.col("doc_id").eqNullSafe(-F.col("minus"))) & (F.col("tie") == F.col("h_tie"))
    ghosts = docs.join(F.broadcast(ends), same).select(      # at most MOST_BUCKETS + 1 heads
        "doc_id", "text", "tie", F.col("end_of").alias("bucket")).dropDuplicates(["bucket"])
    both = d.select("doc_id", "text", "tie", "bucket", F.lit(0).alias("ghost")).unionByName(
        ghosts.withColumn("ghost", F.lit(1)))
    w = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "tie")
    return (both.withColumn("next_text", F.lead("text").over(w)).withColumn("next_tie", F.lead("tie").over(w))
            .withColumn("place", F.row_number().over(w)).filter("ghost = 0").drop("ghost"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_near) of every row of ``docs``.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next row's text; see ``with_next`` for the
    order, ties and null ids. A null text counts as empty; an empty text has
    one empty term. Equal texts have equal fingerprints. ``n_near`` is given
    for ids divisible by 100: the other rows within RADIUS bits. A single row
    is its own next. Other columns are not read.
    """
    text = F.coalesce(column_named(docs, text_col).cast("string"), F.lit(""))
    rows = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    # two hashes name a text: 128 bits
    rows = rows.withColumn("tie", F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(17), "text").alias("b")))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    e = with_next(rows)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    e = e.select("bucket", "place", "doc_id", "tie", "next_tie", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"))
    e = e.withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["bucket", "place", "doc_id", "tie", "next_tie", "n_chars", "edited_sha256"]
    both = materialize(fingerprints(e, {"own": "text", "edited": "edited"}, keys), "fingerprints")
    own = both.filter("which = 'own'").drop("which")
    edited = both.filter("which = 'edited'").select("bucket", "place", F.col("fp1").alias("e1"), F.col("fp2").alias("e2"))
    after = own.groupBy(F.col("tie").alias("next_tie")).agg(F.min("fp1").alias("n1"), F.min("fp2").alias("n2"))
    out = materialize(own.join(edited, ["bucket", "place"]).join(after, "next_tie"), "joined")
    asked = out.filter("doc_id % 100 = 0")
    near = near_counts(out.select("fp1", "fp2", F.lit(1).alias("n")), asked)
    is_asked = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    near = near.withColumnsRenamed({"q1": "fp1", "q2": "fp2"})
    # one row each: only asked rows look up their count
    counted = asked.join(near, ["fp1", "fp2"]).select("bucket", "place", (F.col("rows") - 1).alias("n_near"))
    return out.join(small(counted, asked.count()), ["bucket", "place"], "left").select(
        "doc_id", "n_chars", "edited_sha256", as_text("fp1", "fp2").alias("fingerprint"),
        as_text("e1", "e2").alias("edited_fingerprint"), likeness("fp1", "fp2", "e1", "e2").alias("near_edited"),
        likeness("fp1", "fp2", "n1", "n2").alias("near_next"), F.when(is_asked, F.col("n_near")).alias("n_near"))
