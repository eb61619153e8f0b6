"""Removal of word windows that repeat anywhere in the corpus.

Every window of ``k`` consecutive words is named by a Rabin-Karp hash modulo
2^61 - 1. Counting takes one shuffle of the hashes: texts are dealt into chunks
of bounded size, each chunk sends its distinct window hashes, packed as 64-bit
values and dealt by a second, independent Rabin-Karp hash into buckets; a bucket finds the hashes that more than one chunk sent and
answers each of those chunks. Back at its texts, a chunk marks every window
that repeats inside the chunk or in the answers, and overlapping windows merge
into maximal intervals.

A passage that a third of all texts share is one value per chunk, so no key is
hot. Two windows are taken for equal only if they agree in the first hash and
in the bucket of the second: 67 bits or more, 61 + log2(input / 16 MB) for large
inputs, so the names grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.llm.arrowtext import U, Words, buffers, distinct, groups_of
from vaultline.llm.tables import column_named

CHUNK_BYTES, BUCKET_BYTES, LEAST_BUCKETS = 1 << 20, 16 << 20, 64


def _texts(table: pa.Table, field: int) -> pa.Array:
    """The texts inside ``row``, which is shuffled as the only copy of them."""
    rows = table["row"].combine_chunks()
    if isinstance(rows, pa.ChunkedArray):
        rows = pa.concat_arrays(rows.chunks)
    return pc.struct_field(rows, [field])


def pack(values: np.ndarray) -> bytes:
    """Sorted hashes as byte planes of their differences: the upper planes of
    dense lists are zeros, which the shuffle's compression removes."""
    return np.diff(values, prepend=U(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(packed: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(packed.as_buffer(), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).ravel(), dtype=U)


class Chunk:
    """The texts of a chunk in groups of about a megabyte, and all their
    windows in the order of (bucket, hash)."""

    def __init__(self, column, k: int, buckets: int):
        shift, self.groups, hashes, names = U(64 - buckets.bit_length() + 1), [], [np.zeros(0, U)], [np.zeros(0, U)]
        data, offsets = buffers(column)
        for a, b in groups_of(offsets):
            part, offs = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            words = Words(part, offs)
            at, h = words.windows(k)
            self.groups.append((words, part, offs, at))
            hashes.append(h)
            names.append(words.in_lane(1).windows(k)[1] >> shift)
        hashes, names = np.concatenate(hashes), np.concatenate(names).astype(np.int32)
        self.order = np.lexsort((hashes, names))
        self.hashes, self.names = hashes[self.order], names[self.order]
        self.new = np.ones(len(self.order), bool)
        self.new[1:] = (self.hashes[1:] != self.hashes[:-1]) | (self.names[1:] != self.names[:-1])

    def repeated(self, answers: pa.Table) -> list[np.ndarray]:
        """For every group: the starts of its windows that occur again, in the
        chunk or in the answers."""
        again = ~self.new
        again[:-1] |= ~self.new[1:]
        for bucket, packed in zip(answers["bucket"].to_pylist(), answers["repeated"]):
            a, b = np.searchsorted(self.names, [bucket, bucket + 1])
            told, mine = unpack(packed), self.hashes[a:b]
            again[a:b] |= told[np.minimum(np.searchsorted(told, mine), len(told) - 1)] == mine
        flags = np.empty(len(again), bool)
        flags[self.order] = again
        ends = np.cumsum([0, *(len(at) for *_, at in self.groups)])
        return [at[flags[x:y]] for (*_, at), x, y in zip(self.groups, ends[:-1], ends[1:])]


def covered(n_words: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Mask of the words that windows starting at ``starts`` cover."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + k, -1)
    return np.cumsum(steps[:-1]) > 0


def _send(k: int, buckets: int, field: int):
    def send(key, table):
        c = Chunk(_texts(table, field), k, buckets)
        h, names, at = c.hashes[c.new], *np.unique(c.names[c.new], return_index=True)
        ends = [*at[1:].tolist(), len(h)]
        return pa.table({
            "bucket": pa.array(names, pa.int64()),
            "chunk": pa.array([key[0].as_py()] * len(names), pa.int64()),
            "hashes": pa.array([pack(h[x:y]) for x, y in zip(at.tolist(), ends)], pa.binary()),
        })
    return send


def _answer(key, table):
    """The hashes of one bucket that several chunks sent, back to each of these."""
    lists = [unpack(x) for x in table["hashes"]]
    every = np.concatenate(lists)
    every.sort()
    again = distinct(every[1:][every[1:] == every[:-1]])
    chunks, out = [], []
    for c, h in zip(table["chunk"].to_pylist(), lists):
        hit = np.intersect1d(h, again, assume_unique=True) if len(again) else again
        if len(hit):
            chunks.append(c)
            out.append(pack(hit))
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(out), pa.int64()),
                     "repeated": pa.array(out, pa.binary())})


def _mark(k: int, buckets: int, field: int):
    def mark(texts, answers):
        chunk = Chunk(_texts(texts, field), k, buckets)
        n_words, n_removed, kept, spans = [], [], [], []
        for (words, part, offs, _), at in zip(chunk.groups, chunk.repeated(answers)):
            gone = covered(len(words.starts), at, k)
            for d in range(len(offs) - 1):
                a, b = words.bounds[d], words.bounds[d + 1]
                mask = gone[a:b]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                left = np.flatnonzero(~mask) + a
                raw = part[offs[d]:offs[d + 1]].tobytes()
                base = offs[d]
                n_words.append(int(b - a))
                n_removed.append(int(mask.sum()))
                kept.append(b" ".join([raw[s:e] for s, e in zip((words.starts[left] - base).tolist(),
                                                                  (words.ends[left] - base).tolist())]))
                spans.append([{"first": int(x), "last": int(y) - 1} for x, y in edge.reshape(-1, 2)])
        return pa.table({
            "row": texts["row"],
            "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            "removed": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        })
    return mark


def remove_repeated_windows(docs: DataFrame, k: int = 35, text_col: str = "text") -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``n_words``,
    ``n_removed``, ``kept_text`` (kept words joined by one space) and
    ``removed`` (maximal intervals of removed words, first and last index).

    A word goes if a window of ``k`` words that covers it starts anywhere else
    too, in the same row or another one. Windows are judged on the input. Null
    texts have no words; texts of fewer than ``k`` words lose none; equal rows
    count as different rows, so they lose all windows. Columns of ``docs`` may
    have any names: they travel inside ``row``.
    """
    text = column_named(docs, text_col)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = size // CHUNK_BYTES + 1
    buckets = 1 << max(LEAST_BUCKETS.bit_length() - 1, (size // BUCKET_BYTES).bit_length())
    every = F.struct(*[column_named(docs, c) for c in docs.columns])
    dealt = docs.select(F.pmod(F.xxhash64(*[column_named(docs, c) for c in docs.columns
                                            if docs.schema[c].dataType.typeName() not in ("map", "variant")]),
                               F.lit(chunks)).alias("chunk"), every.alias("row"))
    field = docs.columns.index(text_col)
    sent = dealt.groupBy("chunk").applyInArrow(_send(k, buckets, field), "bucket bigint, chunk bigint, hashes binary")
    answers = sent.groupBy("bucket").applyInArrow(_answer, "chunk bigint, bucket bigint, repeated binary")
    span = T.StructType().add("first", "long").add("last", "long")
    schema = (T.StructType().add("row", dealt.schema["row"].dataType).add("n_words", "long")
              .add("n_removed", "long").add("kept_text", "string").add("removed", T.ArrayType(span)))
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_mark(k, buckets, field), schema)


def without_repeats(docs: DataFrame, k: int = 35) -> DataFrame:
    """``docs`` with the repeated windows taken out of ``text``; same columns
    and rows. A text that loses words becomes its kept words joined by one
    space, and ``n_chars`` its new length; other texts stay as they are."""
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept_text")).otherwise(F.col("row.text")),
           "n_chars": F.when(cut, F.char_length("kept_text")).otherwise(F.col("row.n_chars"))}
    out = remove_repeated_windows(docs, k)
    return out.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"row.`{c}`").alias(c)
                        for c in docs.columns])
