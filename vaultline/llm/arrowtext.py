"""Word arithmetic on Arrow text columns, vectorised over the UTF-8 bytes.

A word is a maximal run of bytes other than space and 0x09-0x0D. All
separators are ASCII, so cutting the UTF-8 bytes gives the same words as
cutting the code points. Hashes depend on the constants below only, so they
agree between tasks, executors and runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20          # bytes whose temporary arrays are held at once
LONG_WORD = 256            # longer words are hashed one by one
U = np.uint64
P61 = (1 << 61) - 1        # the prime of the Rabin-Karp hashes
STEP = U(0x9E3779B97F4A7C15)
# (seed of the words, base of the windows) of independent hashes
LANES = ((0x243F6A8885A308D3, 0x0B3F2C5D1E8A9765), (0x13198A2E03707344, 0x1D8C49A7F35B2E61))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, element by element."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudorandom 64-bit values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(seed << 20)) * STEP)


def times(a: np.ndarray, c: int) -> np.ndarray:
    """``a * c`` modulo 2^61 - 1, of values below it, by halves of 31 bits."""
    a1, a0, c1, c0 = a >> U(31), a & U((1 << 31) - 1), U(c >> 31), U(c & ((1 << 31) - 1))
    mid = a1 * c0 + a0 * c1
    t = U(2) * a1 * c1 + (mid >> U(30)) + ((mid & U((1 << 30) - 1)) << U(31)) + a0 * c0
    return reduced(t)


def reduced(t: np.ndarray) -> np.ndarray:
    """64-bit values modulo 2^61 - 1."""
    t = (t & U(P61)) + (t >> U(61))
    return np.where(t >= U(P61), t - U(P61), t)


def rabin_karp(values: np.ndarray, k: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes modulo 2^61 - 1 of every run of ``k`` values: those of
    1, 2, 4 ... values, put together by the binary digits of ``k``."""
    n = len(values) - k + 1
    out, size, m, power = None, 0, values, 1
    while True:
        if k & power:
            if out is None:
                out = m[:n]
            else:
                out = reduced(times(out, pow(base, power, P61)) + m[size:size + n])
            size += power
        if size == k:
            return out
        m = reduced(times(m[:-power], pow(base, power, P61)) + m[power:])
        power *= 2


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """One hash below 2^61 - 1 per word ``data[start:end]``: its length and its
    bytes, eight at a time, each mixed into what went before (not a sum of
    powers, which structured words would break)."""
    size = ends - starts
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    h = mix(size.astype(U) * STEP + U(seed))
    open_ = np.flatnonzero(size <= LONG_WORD)
    done = 0
    while len(open_):
        left = size[open_] - done
        block = eights[starts[open_] + done]
        short = left < 8
        block[short] &= (U(1) << (U(8) * left[short].astype(U))) - U(1)
        h[open_] = mix((h[open_] ^ block) * STEP + U(seed))
        done += 8
        open_ = open_[left > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8,
                                              salt=seed.to_bytes(8, "little")).digest(), "little")
    return reduced(h >> U(3))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def groups_of(offsets: np.ndarray, size: int = SEGMENT):
    """Ranges of texts of about ``size`` bytes together (a longer text stands alone)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes unchanged."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


class Words:
    """Words of consecutive texts: byte ranges, hashes, and each text's range of
    words. ``lane`` chooses one of two independent hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, lane: int = 0):
        n = len(data)
        is_word = ~((data == 32) | ((data >= 9) & (data <= 13)))
        first = np.ones(n + 1, bool)
        first[1:n] = ~is_word[:n - 1] if n else first[1:n]
        first[offsets] = True
        last = np.ones(n + 1, bool)
        last[:n - 1 if n else 0] = ~is_word[1:]
        cuts = offsets[offsets > 0] - 1
        last[cuts] = True
        self.starts = np.flatnonzero(is_word & first[:n])
        self.ends = np.flatnonzero(is_word & last[:n]) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))
        self.data = lowered(data) if lower else data
        self.hashes, self.base = self._hashes(lane), LANES[lane][1]

    def _hashes(self, lane: int) -> np.ndarray:
        out = np.empty(len(self.starts), U)
        a = 0
        while a < len(self.starts):
            low = self.starts[a]
            b = max(a + 1, int(np.searchsorted(self.ends, low + SEGMENT, "right")))
            out[a:b] = word_hashes(self.data[low:self.ends[b - 1]], self.starts[a:b] - low, self.ends[a:b] - low, LANES[lane][0])
            a = b
        return out

    def in_lane(self, lane: int) -> "Words":
        """The same words with the hashes of another lane."""
        other = object.__new__(Words)
        other.__dict__.update(self.__dict__)
        other.hashes, other.base = self._hashes(lane), LANES[lane][1]
        return other

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``k`` words that lies in one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        step, out = SEGMENT // 4, np.empty(len(at), U)
        for i in range(0, len(at), step):
            p = at[i:i + step]
            low = p[0]
            out[i:i + step] = self._named(rabin_karp(self.hashes[low:p[-1] + k], k, self.base)[p - low], k)
        return at, out

    @staticmethod
    def _named(h: np.ndarray, k: int) -> np.ndarray:
        """64 bits of a hash and its number of words."""
        return mix(h + U(k * int(STEP) % (1 << 64)))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every ``k``-word shingle in text order; a text of
        1 to ``k`` - 1 words has its whole sequence as the only one."""
        at, h = self.windows(k)
        counts = np.diff(self.bounds)
        short = np.flatnonzero((counts > 0) & (counts < k))
        if not len(short):
            return self.doc[at], h
        whole = np.empty(len(short), U)
        for n in range(1, k):
            mine = np.flatnonzero(counts[short] == n)
            total = self.hashes[self.bounds[short[mine]]]
            for j in range(1, n):
                total = reduced(times(total, self.base) + self.hashes[self.bounds[short[mine]] + j])
            whole[mine] = self._named(total, n)
        doc = np.concatenate([self.doc[at], short])
        order = np.argsort(doc, kind="stable")
        return doc[order], np.concatenate([h, whole])[order]


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) < 2:
        return values
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_sets(column, k: int, lower: bool = True, lane: int = 0):
    """For each text of the column: its sorted distinct shingle hashes, in
    groups of about a megabyte: (index of the first text, list of arrays)."""
    for a, w in word_groups(column, lower, lane):
        yield a, sets_of(w, k)


def word_groups(column, lower: bool, lane: int = 0) -> Iterator[tuple[int, Words]]:
    """(index of the first text, its words) for groups of texts of about a megabyte."""
    data, offsets = buffers(column)
    for a, b in groups_of(offsets):
        yield a, Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lower, lane)


def sets_of(words: Words, k: int) -> list[np.ndarray]:
    doc, h = words.shingles(k)
    at = np.searchsorted(doc, np.arange(len(words.bounds)))
    return [distinct(h[x:y]) for x, y in zip(at[:-1], at[1:])]


def digest(*values: np.ndarray) -> bytes:
    """16 bytes that name sorted sets."""
    return hashlib.blake2b(b"".join(v.tobytes() for v in values), digest_size=16).digest()
