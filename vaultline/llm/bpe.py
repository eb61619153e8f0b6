"""Byte-level BPE encoding and decoding with a published vocabulary.

A text is cut into pieces by the vocabulary's pattern. The bytes of a piece
are symbols of a doubly linked list, and every neighbouring pair with a merge
rank is in a priority queue. The least rank is taken (the leftmost of equal
ones), its two symbols become one, and the pairs with the new neighbours are
queued; queue entries whose symbols have changed since are stale and skipped.
Time is n log n for a piece of n bytes, however long it is. Pieces come back
often, so every task keeps the ids of recent short ones.

Decoding concatenates the vocabulary's strings, as bytes.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.tables import column_named

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# fixed value: the pattern that byte-level pre-tokenization cuts by
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT_PIECES, KEPT_LENGTH = 300_000, 32       # bounds of a task's table of pieces
SLICE_BYTES = 4 << 20                        # texts whose results are held at once


def alphabet() -> list[str]:
    """The character that stands for each byte: itself for visible Latin-1
    characters, else the next one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(rest)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file.

    ``special``: strings of added tokens inside a text become those tokens, as
    in the vocabulary's own library; without it they are plain text.
    """

    def __init__(self, path: str, special: bool = True):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec["normalizer"] \
                or model.get("dropout") or model.get("ignore_merges") or not before.get("use_regex", True):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        letters, ids = alphabet(), model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if special and any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"added tokens that look at their surroundings: {path}")
        self.added = added if special else {}
        self.first = [ids[c] for c in letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        byte = {c: b for b, c in enumerate(letters)}
        self.strings = {i: bytes(byte[c] for c in s) if all(c in byte for c in s) else s.encode()
                        for s, i in [*ids.items(), *added.items()]}
        self.pieces = regex.compile(PATTERN).findall
        self.split = re.compile(f"({'|'.join(re.escape(s) for s in sorted(self.added, key=len, reverse=True))})").split
        self.known, self.kept, self.library = set(), {}, None

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        symbols = [self.first[b] for b in piece]
        n, merges = len(symbols), self.merges
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, a, b, new = heappop(queue)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue                                     # stale: one of the two has been merged
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((new, symbols[k]))
                if found:
                    heappush(queue, (found[0], i, new, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbols[h], new))
                if found:
                    heappush(queue, (found[0], h, symbols[h], new, found[1]))
        return [s for s in symbols if s >= 0]

    def knows(self, text: str) -> bool:
        """Whether the running Unicode tables have all characters of a text.
        The pattern libraries may hold different tables than the vocabulary's
        own library; they differ only in code points that these leave unassigned."""
        if text.isascii():
            return True
        new = set(text) - self.known
        self.known.update(c for c in new if unicodedata.category(c) != "Cn")
        return new <= self.known

    def _cut(self, text: str) -> list[str]:
        """Pieces of a text; one with unassigned characters (rare) is cut by the
        vocabulary's own library."""
        if self.knows(text):
            return self.pieces(text)
        if self.library is None:
            from tokenizers.pre_tokenizers import ByteLevel
            self.library = ByteLevel(add_prefix_space=False)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def _plain(self, text: str) -> bytes:
        kept, out = self.kept, []
        for piece in self._cut(text):
            ids = kept.get(piece)
            if ids is None:
                ids = array("I", self.merged(piece.encode())).tobytes()
                if len(piece) <= KEPT_LENGTH:
                    if len(kept) >= KEPT_PIECES:
                        kept.clear()
                    kept[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        if not any(s in text for s in self.added):
            return self._plain(text)
        return b"".join(array("I", [self.added[part]]).tobytes() if k % 2 else self._plain(part)
                        for k, part in enumerate(self.split(text)))

    def decode(self, ids: bytes) -> str:
        """Text of such ids; bytes that are not UTF-8 become U+FFFD, ids
        without a string nothing."""
        found = np.frombuffer(ids, "<u4").tolist()
        try:
            joined = b"".join(map(self.strings.__getitem__, found))
        except KeyError:
            joined = b"".join(self.strings.get(i, b"") for i in found)
        return joined.decode("utf-8", "replace")


_loaded: dict[tuple[str, bool], Bpe] = {}


def loaded(path: str, special: bool = True) -> Bpe:
    """The vocabulary, read once per Python process."""
    if (path, special) not in _loaded:
        _loaded[path, special] = Bpe(path, special)
    return _loaded[path, special]


def texts_of(column) -> Iterator[str]:
    """The strings of a column; null gives '', bytes that are not UTF-8 give U+FFFD."""
    for t in column.cast(pa.binary()):
        yield (t.as_py() or b"").decode("utf-8", "replace")


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of ``column`` (a longer value stands alone)."""
    import pyarrow.compute as pc
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
        yield batch.slice(a, b - a)
        a = b


def _encode(path: str, special: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, special)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "ids": pa.array(
                    [bpe.encode(t) for t in texts_of(part["text"])], pa.binary())})
    return encode


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for part in slices(batch, "ids"):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part["doc_id"], "ids": part["ids"],
                    "text": pa.array([bpe.decode(i or b"") for i in part["ids"].to_pylist()], pa.string())})
    return decode


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
           special: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row: ``ids`` are the token ids as
    little-endian unsigned 32-bit integers, one after another.

    Strings of added tokens inside a text are those tokens, unless ``special``
    is false. Null and empty texts have no tokens. Repeated rows and ids, and
    null ids, give rows of their own. Other columns are not read. The
    vocabulary file must be at the same path on every executor. Runs as map
    tasks over slices of a few megabytes; nothing is shuffled.
    """
    rows = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                       column_named(docs, text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_encode(vocabulary, special), "doc_id bigint, ids binary")
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, text) of rows (doc_id, ids) as ``encode`` makes them; added
    tokens give their strings, null ids an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(vocabulary), "doc_id bigint, ids binary, text string")
