"""Alignment of two tokenizers over the bytes of each text, on Arrow tables.

Every text is encoded by A (byte-level BPE, of a space and the text) and by B
(a piece vocabulary, which adds the space itself). The ids are list columns.
Flattened with their parent indices, token lengths turn into end offsets by
one cumulative sum minus its value at the start of each list. An Acero outer
hash join on (document, end) puts the ends of A and B together: a row with
both cuts a group, and every row is the last piece of one overlap, so filling
ids backward gives the overlapping pair of each row, one row per link.

Links are counted per task with ``Table.group_by`` and the partial counts are
merged by Spark. To look the corpus-wide counts up again, a bounded number of
the most frequent pairs is broadcast; links of other pairs, few since counts
are far from even, are joined by a shuffle. Both ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.bpe import PATTERN, Bpe, loaded, slices, texts_of
from vaultline.llm.tables import column_named, materialize
from vaultline.llm.token_counts import encoded

VOCABULARY_A, MODEL_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 1 << 18                     # bytes of text whose links are held at once
PARTIAL_ROWS = 1 << 20              # pairs that a task counts before it sends them on
HOT_PAIRS = 1 << 19                 # most pairs that are broadcast (24 bytes each)


def piece_bytes(model) -> list[bytes]:
    """Bytes of each piece of a sentencepiece model."""
    return [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]


class Side:
    """Ids to bytes, byte lengths and texts of one vocabulary."""

    def __init__(self, strings: list[bytes]):
        self.strings = pa.array(strings, pa.binary())
        self.lengths = pa.array([len(s) for s in strings], pa.int64())
        self.dtype = np.dtype("<u2" if len(strings) <= 1 << 16 else "<u4")
        self.written = pa.array([f"{i}{c}".encode() for c in (",", "|", ";", "") for i in range(len(strings))], pa.binary())

    def __len__(self) -> int:
        return len(self.strings)


class Pair:
    """Both tokenizers, loaded once per Python process."""

    def __init__(self, vocabulary: str, model: str):
        import sentencepiece
        import tiktoken
        self.bpe: Bpe = loaded(vocabulary, special=False)
        # the faster library takes the vocabulary as ranks, where ids rise in the order of the merges
        made = [i for _, i in self.bpe.merges.values()]
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            self.bpe.strings[i]: i for i in [*self.bpe.first, *made]}) if made == sorted(made) else None
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.a = Side([self.bpe.strings.get(i, b"") for i in range(max(self.bpe.strings) + 1)])
        self.b = Side(piece_bytes(self.model))

    def ids_a(self, text: str) -> np.ndarray:
        if self.fast is not None and self.bpe.knows(text):
            return np.array(encoded(text, self.fast), np.int32)
        return np.frombuffer(self.bpe.encode(text), "<u4").astype(np.int32)

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Id lists of A and B; both empty where the text is, or where the
        joined bytes of one side are not the space and the text."""
        a = [self.ids_a(" " + t) if t else np.zeros(0, np.int32) for t in texts]
        b = [np.array(x, np.int32) for x in self.model.encode(texts, num_threads=1)]
        want = [b" " + t.encode() for t in texts]
        for side, lists in ((self.a, a), (self.b, b)):
            flat = np.concatenate(lists)
            joined, ends = side.strings.take(pa.array(flat)), np.cumsum([0, *map(len, lists)])
            at = np.frombuffer(joined.buffers()[1], np.int32)[:len(flat) + 1][ends] if len(flat) else ends * 0
            data = joined.buffers()[2].to_pybytes() if len(flat) else b""
            for i, w in enumerate(want):
                if not texts[i] or data[at[i]:at[i + 1]] != w:
                    want[i], a[i], b[i] = None, a[i][:0], b[i][:0]
        return tuple(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(np.concatenate(x)))
                     for x in (a, b))


_pairs: dict[tuple[str, str], Pair] = {}


def tokenizers(vocabulary: str, model: str) -> Pair:
    if (vocabulary, model) not in _pairs:
        _pairs[vocabulary, model] = Pair(vocabulary, model)
    return _pairs[vocabulary, model]


def ends(lists: pa.ListArray, lengths: pa.Array, name: str) -> pa.Table:
    """(doc, end, ``name``): list number, end offset in bytes and id of every token."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(lengths.take(ids))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total]).take(lists.offsets.slice(0, len(lists)))
    return pa.table({"doc": doc, "end": pc.subtract(total, before.take(doc)), name: ids})


def links(a: pa.ListArray, b: pa.ListArray, pair: Pair) -> pa.Table:
    """(doc, end, a, b, ends_a, ends_b): one row per overlapping token pair, in
    byte order; whether its last byte ends a token of A, and of B."""
    both = ends(a, pair.a.lengths, "a").join(ends(b, pair.b.lengths, "b"), ["doc", "end"], join_type="full outer",
                                             use_threads=False)
    both = both.take(pc.sort_indices(both, sort_keys=[("doc", "ascending"), ("end", "ascending")])).combine_chunks()
    return pa.table({"doc": both["doc"], "end": both["end"],
                     "a": pc.fill_null_backward(both["a"]), "b": pc.fill_null_backward(both["b"]),
                     "ends_a": pc.is_valid(both["a"]), "ends_b": pc.is_valid(both["b"])})


def keys(rows: pa.Table) -> pa.Array:
    """A pair of ids as one number."""
    return pc.add(pc.multiply(rows["a"].cast(pa.int64()), 1 << 32), rows["b"].cast(pa.int64())).combine_chunks()


def per_list(n: int, doc, mask=None) -> np.ndarray:
    """Rows of each list, those of ``mask`` only."""
    doc = doc.to_numpy()
    return np.bincount(doc if mask is None else doc[mask], minlength=n)


def written_groups(a: pa.ListArray, b: pa.ListArray, rows: pa.Table, pair: Pair) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of every document: ids of A, then of B, group by group."""
    on_a, on_b = rows["ends_a"].to_numpy(), rows["ends_b"].to_numpy()
    cut = on_a & on_b
    group = np.cumsum(cut) - cut
    group_a, group_b = group[on_a], group[on_b]
    n_a, n_b = np.diff(a.offsets.to_numpy()), np.diff(b.offsets.to_numpy())
    last_a = np.append(group_a[1:] != group_a[:-1], True)[:len(group_a)]
    last_b = np.append(group_b[1:] != group_b[:-1], True)[:len(group_b)].astype(np.int64) * 2
    stops = np.cumsum(n_b)[n_b > 0] - 1
    last_b[stops] = 3                                        # the last token of a document has no mark behind it
    out = np.empty(len(group_a) + len(group_b), np.int64)
    out[np.arange(len(group_a)) + np.searchsorted(group_b, group_a, "left")] = pc.list_flatten(a).to_numpy() + last_a * len(pair.a)
    out[np.arange(len(group_b)) + np.searchsorted(group_a, group_b, "right")] = \
        len(pair.a.written) + pc.list_flatten(b).to_numpy() + last_b * len(pair.b)
    text = pa.concat_arrays([pair.a.written, pair.b.written]).take(pa.array(out))
    at = np.frombuffer(text.buffers()[1], np.int32) if len(out) else np.zeros(1, np.int32)
    offsets = at[np.concatenate([[0], np.cumsum(n_a + n_b)])]
    return pa.Array.from_buffers(pa.string(), len(a), [None, pa.py_buffer(offsets.astype(np.int32)), text.buffers()[2]])


class Counts:
    """Partial counts of pairs, bounded in size."""

    def __init__(self):
        self.parts, self.rows = [], 0

    def add(self, keys_: pa.Array) -> None:
        self.parts.append(pa.table({"key": keys_}).group_by("key", use_threads=False).aggregate([([], "count_all")])
                          .rename_columns(["key", "n"]))
        self.rows += len(self.parts[-1])

    def merged(self) -> pa.Table:
        out = pa.concat_tables(self.parts).group_by("key", use_threads=False).aggregate([("n", "sum")]) \
            .rename_columns(["key", "n"])
        self.parts, self.rows = [out], len(out)
        return out

    def full(self) -> bool:
        """Whether more than PARTIAL_ROWS different pairs are held."""
        return self.rows > 2 * PARTIAL_ROWS and len(self.merged()) > PARTIAL_ROWS

    def take(self) -> pa.Table:
        out = self.merged()
        self.parts, self.rows = [], 0
        return out


ENCODED = "row bigint, doc_id bigint, a_ids binary, b_ids binary, key bigint, n bigint"


def _rows_of_pairs(counts: pa.Table) -> Iterator[pa.RecordBatch]:
    for b in counts.combine_chunks().to_batches(max_chunksize=1 << 17):
        none = pa.nulls(len(b))
        yield pa.RecordBatch.from_pydict({
            "row": none.cast(pa.int64()), "doc_id": none.cast(pa.int64()), "a_ids": none.cast(pa.binary()),
            "b_ids": none.cast(pa.binary()), "key": b["key"], "n": b["n"].cast(pa.int64())})


def packed(lists: pa.ListArray, side: Side) -> pa.Array:
    """Id lists as bytes, two to an id where the vocabulary allows."""
    width = side.dtype.itemsize
    ids = pc.list_flatten(lists).to_numpy().astype(side.dtype)
    offsets = (lists.offsets.to_numpy().astype(np.int64) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def unpacked(column, side: Side) -> pa.ListArray:
    sizes = pc.binary_length(column).to_numpy() // side.dtype.itemsize
    ids = np.frombuffer(b"".join(column.to_pylist()), side.dtype).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids))


def _encode(vocabulary: str, model: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, counts = tokenizers(vocabulary, model), Counts()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                a, b = pair.encode(list(texts_of(part["text"])))
                found = links(a, b, pair)
                if len(found):
                    counts.add(keys(found))
                none = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(np.arange(row, row + len(part))), "doc_id": part["doc_id"],
                    "a_ids": packed(a, pair.a), "b_ids": packed(b, pair.b), "key": none, "n": none})
                row += len(part)
                pa.default_memory_pool().release_unused()
                if counts.full():
                    yield from _rows_of_pairs(counts.take())
        if counts.parts:
            yield from _rows_of_pairs(counts.take())
    return encode


def _score(vocabulary: str, model: str, hot):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(vocabulary, model)
        known, counts, best = hot.value
        names = pa.array(known)
        for batch in batches:
            for part in slices(batch, "a_ids", SLICE):
                a, b = unpacked(part["a_ids"], pair.a), unpacked(part["b_ids"], pair.b)
                n, found = len(part), links(a, b, pair)
                doc, key = found["doc"].to_numpy(), keys(found)
                at = pc.fill_null(pc.index_in(key, names), -1).to_numpy()
                told = at >= 0
                at = at[told]
                sums = np.zeros(n, np.int64)
                np.add.at(sums, doc[told], counts[at])
                rest = pa.table({"doc": doc[~told], "key": key.filter(pa.array(~told))}).group_by(
                    ["doc", "key"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "key", "times"])
                rest = rest.sort_by([("doc", "ascending"), ("key", "ascending")]).combine_chunks()
                offsets = np.concatenate([[0], np.cumsum(per_list(n, rest["doc"]))])
                pairs = pa.StructArray.from_arrays([_one(rest["key"]), _one(rest["times"]).cast(pa.int64())], ["key", "times"])
                yield pa.RecordBatch.from_pydict({
                    "row": part["row"], "doc_id": part["doc_id"],
                    "n_a": pc.list_value_length(a).cast(pa.int64()), "n_b": pc.list_value_length(b).cast(pa.int64()),
                    "n_groups": pa.array(per_list(n, found["doc"], (found["ends_a"].to_numpy() & found["ends_b"].to_numpy())), pa.int64()),
                    "n_links": pa.array(per_list(n, found["doc"]), pa.int64()),
                    "known_best": pa.array(np.bincount(doc[told], best[at], n).astype(np.int64)), "known_sum": pa.array(sums),
                    "groups": written_groups(a, b, found, pair),
                    "rest": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)})
                pa.default_memory_pool().release_unused()
    return score


def _one(column) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, counts and whether best, of the pairs that come at least 2^k
    times, with the least k that leaves at most HOT_PAIRS of them."""
    levels = counts.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    least, pairs = None, 0
    for r in sorted(levels, reverse=True):
        pairs += r["pairs"]
        if pairs > HOT_PAIRS:
            break
        least = 1 << r["level"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    t = counts.filter(F.col("n") >= least).select("key", "n", "best").toArrow()
    return t["key"].to_numpy(), t["n"].to_numpy(), t["best"].to_numpy()


def align(docs: DataFrame, vocabulary: str = VOCABULARY_A, model: str = MODEL_B, id_col: str = "doc_id",
          text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum) of every row,
    and its groups: ``groups`` (``a1,a2|b1;a3|b2,b3``, decimal ids in order),
    or what the expression ``keep`` makes of that column.

    Offsets where tokens of A and of B end cut the text's bytes into groups.
    A link is a pair of tokens whose bytes overlap; the count of an id pair is
    its number of links in all rows. ``n_best`` counts the links whose pair has
    the highest count of its B id (ties included), ``count_sum`` adds up the
    counts of the row's links. Special tokens' strings are plain text.

    Texts that are null or empty, or that one of the tokenizers does not give
    back byte for byte, have no tokens: zeros and no groups. Repeated rows and
    ids, and null ids, count as rows of their own. Other columns are not read;
    an empty table gives an empty result. Both files must be at the same paths
    on every executor.
    """
    texts = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                        column_named(docs, text_col).cast("string").alias("text"))
    made = materialize(texts.mapInArrow(_encode(vocabulary, model), ENCODED), "encoded", "zstd")
    counts = made.filter("key is not null").groupBy("key").agg(F.sum("n").alias("n"))
    counts = materialize(counts.withColumn("b", F.col("key").bitwiseAND((1 << 32) - 1)), "pairs")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))       # a row per id of B at most
    counts = counts.join(F.broadcast(top), "b").select("key", "n", (F.col("n") == F.col("top")).alias("best"))
    hot = docs.sparkSession.sparkContext.broadcast(_most_frequent(counts))
    scored = made.filter("row is not null").select("row", "doc_id", "a_ids", "b_ids").mapInArrow(
        _score(vocabulary, model, hot),
        "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, known_best bigint, "
        "known_sum bigint, groups string, rest array<struct<key:bigint,times:bigint>>")
    kept = F.col("groups") if keep is None else keep
    scored = materialize(scored.select(*[c for c in scored.columns if c != "groups"], kept), "scored", "zstd")
    more = scored.select("row", F.inline("rest")).join(counts, "key").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best"), F.sum(F.col("times") * F.col("n")).alias("sum"))
    return scored.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("known_best") + F.coalesce("best", F.lit(0))).alias("n_best"),
        (F.col("known_sum") + F.coalesce("sum", F.lit(0))).alias("count_sum"), scored[scored.columns[-1]])
