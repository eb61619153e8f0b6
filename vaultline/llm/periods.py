"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, at least ``REPEATS`` times
as long as q, that no neighbouring word extends. At the scale B (a power of
two) with B <= q < 2 B the run holds aligned blocks of B words that occur once
more q words later. For every block the sums of squared differences to all B
places that follow at distances B to 2 B - 1 come from one convolution,
``sum x^2 + sum y^2 - 2 sum x y``, computed by number-theoretic transforms in
whole numbers: modulo as many primes as the largest possible sum needs, so a
sum is zero exactly where the block occurs.

A run of period q has ``((REPEATS - 1) q - B + 1) // B`` blocks in a row, or
more, that occur at the distance q. Only such chains of blocks seed an
extension, which goes less than B words beyond the chain on either side, so
the work stays near n log^2 n, also for a text that is one word repeated. A
seed inside a run of a smaller period that divides its distance has that
period itself and is dropped.

Blocks with a word that does not occur again within 2 B words cannot occur
there as a whole and are not convolved; in prose that leaves few blocks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.bpe import slices
from vaultline.llm.tables import column_named

REPEATS, LEAST_LENGTH = 4, 6
# fixed values: primes of the form odd * 2**k + 1, k at least 24, and a primitive root of each
PRIMES = ((2013265921, 31), (469762049, 3), (754974721, 11))
PASS_VALUES = 1 << 20                                         # values that are transformed at once
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
U = np.uint64

_roots: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(w: int, n: int, p: int) -> np.ndarray:
    """1, w, w^2 ... w^(n-1) modulo p, by doubling."""
    out = np.ones(n, U)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * U(pow(w, have, p)) % U(p)
        have += more
    return out


def roots(size: int, prime: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a primitive root of order ``size`` modulo the prime, and of its inverse."""
    p, g = prime
    if (size, p) not in _roots:
        w = pow(g, (p - 1) // size, p)
        _roots[size, p] = _powers(w, max(1, size // 2), p), _powers(pow(w, -1, p), max(1, size // 2), p)
    return _roots[size, p]


def transform(rows: np.ndarray, prime: tuple[int, int]) -> np.ndarray:
    """Number-theoretic transform of every row (length a power of two), in
    bit-reversed order."""
    p, (n, size) = U(prime[0]), rows.shape
    x = rows.copy()
    powers, half = roots(size, prime)[0], size // 2
    while half:
        v = x.reshape(n, -1, 2, half)
        a, b = v[:, :, 0].copy(), v[:, :, 1]
        v[:, :, 0] = (a + b) % p
        v[:, :, 1] = (a + p - b) % p * powers[::len(powers) // half][:half] % p
        half //= 2
    return x


def inverse(rows: np.ndarray, prime: tuple[int, int]) -> np.ndarray:
    """The rows whose ``transform`` (bit-reversed) is given."""
    p, (n, size) = U(prime[0]), rows.shape
    x = rows.copy()
    powers, half = roots(size, prime)[1], 1
    while half < size:
        v = x.reshape(n, -1, 2, half)
        a, b = v[:, :, 0].copy(), v[:, :, 1] * powers[::len(powers) // half][:half] % p
        v[:, :, 0] = (a + b) % p
        v[:, :, 1] = (a + p - b) % p
        half *= 2
    return x * U(pow(size, -1, prime[0])) % p


def mismatches(blocks: np.ndarray, windows: np.ndarray, prime: tuple[int, int]) -> np.ndarray:
    """Sums of squared differences, modulo the prime, of every block (B words)
    to the places 0 ... B - 1 of its window (2 B words)."""
    p, size = U(prime[0]), blocks.shape[1]
    blocks, windows = blocks % p, windows % p
    turned = np.zeros_like(windows)
    turned[:, :size] = blocks[:, ::-1]
    both = inverse(transform(turned, prime) * transform(windows, prime) % p, prime)[:, size - 1:2 * size - 1]
    squares = np.zeros((len(windows), 2 * size + 1), U)
    np.cumsum(windows * windows % p, axis=1, out=squares[:, 1:])      # below 2 B p, far from 2^64
    mine = (blocks * blocks % p).sum(axis=1, dtype=U) % p
    there = (squares[:, size:2 * size] - squares[:, :size]) % p
    return (mine[:, None] + there + U(2) * (p - both)) % p


def occurrences(ids: np.ndarray, size: int, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block number, distance) of every aligned block of ``size`` words that
    occurs again at a distance of ``size`` to 2 ``size`` - 1 words. ``after``
    is the distance from each word to its next occurrence."""
    n = len(ids) // size
    open_ = np.flatnonzero(after[:n * size].reshape(n, size).max(axis=1) < 2 * size)
    most, blocks, distances = int(ids.max()) + 2, [], []
    step = max(1, PASS_VALUES // (2 * size))
    for k in range(0, len(open_), step):
        part = open_[k:k + step]
        at = part[:, None] * size + np.arange(3 * size)
        # beyond the end stands a value that no word has
        x = np.where(at < len(ids), ids[np.minimum(at, len(ids) - 1)], most).astype(U)
        zero, bound = np.ones((len(part), size), bool), 1
        for prime in PRIMES:
            zero &= mismatches(x[:, :size], x[:, size:], prime) == 0
            bound *= prime[0]
            if bound > size * most * most:
                break
        b, d = np.nonzero(zero)
        blocks.append(part[b])
        distances.append(d + size)
    return (np.concatenate([*blocks, np.zeros(0, np.int64)]).astype(np.int64),
            np.concatenate([*distances, np.zeros(0, np.int64)]).astype(np.int64))


def chains(blocks: np.ndarray, distances: np.ndarray, size: int) -> np.ndarray:
    """Rows (first block, blocks, distance) of blocks in a row that occur at
    the same distance, as many as a run of that period has at least."""
    if not len(blocks):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((blocks, distances))
    b, d = blocks[order], distances[order]
    new = np.ones(len(b), bool)
    new[1:] = (d[1:] != d[:-1]) | (b[1:] != b[:-1] + 1)
    at = np.flatnonzero(new)
    long_ = np.diff(np.append(at, len(b)))
    out = np.stack([b[at], long_, d[at]], axis=1)
    return out[long_ >= ((REPEATS - 1) * out[:, 2] - size + 1) // size]


def runs(ids: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows (start, length, period) of all runs in a sequence of small whole
    numbers, ordered by start, then period. ``longest`` is the most words that
    a run can have (all, if not given)."""
    n = len(ids)
    longest = n if longest is None else longest
    order = np.argsort(ids, kind="stable")
    after = np.full(n, 1 << 62, np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    after[order[:-1][same]] = (order[1:] - order[:-1])[same]
    found: list[tuple[int, int, int]] = []
    by_end: list[np.ndarray] = []                     # runs of the smaller scales, by start
    size = 1
    while REPEATS * size <= longest and size <= n:
        seeds = chains(*occurrences(ids, size, after), size)
        new = set()
        for first, count, d in _not_inside(seeds, by_end, size).tolist():
            a, b = first * size, (first + count) * size         # words a to b - 1 recur d words later
            low, high = max(0, a - size), min(n - d, b + size)
            differ = np.flatnonzero(ids[low:a] != ids[low + d:a + d])
            a = low + int(differ[-1]) + 1 if len(differ) else low
            differ = np.flatnonzero(ids[b:high] != ids[b + d:high + d])
            b = b + int(differ[0]) if len(differ) else max(b, high)
            if b - a + d >= max(LEAST_LENGTH, REPEATS * d):
                new.add((a, b - a + d, d))
        if new:
            by_end.append(np.array(sorted(new), np.int64))
            found.extend(new)
        size *= 2
    out = np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)
    return out


def _not_inside(seeds: np.ndarray, known: list[np.ndarray], size: int) -> np.ndarray:
    """The seeds that do not lie in a known run whose period divides theirs."""
    for k in known:
        # two runs of one scale overlap by less than the sum of their periods, so
        # of these only the last that starts at the seed or before can hold it
        a, b = seeds[:, 0] * size, (seeds[:, 0] + seeds[:, 1]) * size + seeds[:, 2]
        at = np.searchsorted(k[:, 0], a, "right") - 1
        r = k[np.maximum(at, 0)]
        seeds = seeds[~((at >= 0) & (r[:, 0] + r[:, 1] >= b) & (seeds[:, 2] % r[:, 2] == 0))]
    return seeds


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = [WORD.findall(t or b"") for t in part["text"].cast(pa.binary()).to_pylist()]
            sizes = np.array([len(w) for w in texts], np.int64)
            names: dict[bytes, int] = {}
            ids = np.empty(int(sizes.sum()) + len(texts), np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
            for words, a in zip(texts, starts.tolist()):
                ids[a:a + len(words)] = [names.setdefault(w, len(names)) for w in words]
            # a value of its own after each text keeps runs inside texts
            ids[starts + sizes] = len(names) + np.arange(len(texts))
            found = runs(ids, int(sizes.max(initial=0)))
            cut = np.searchsorted(found[:, 0], np.append(starts, len(ids)))
            collapsed, lists = [], []
            for k, words in enumerate(texts):
                mine = found[cut[k]:cut[k + 1]] - [starts[k], 0, 0]
                if len(mine):
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, mine[:, 0] + mine[:, 2], 1)
                    np.add.at(steps, mine[:, 0] + mine[:, 1], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
                collapsed.append(b" ".join(words))
                lists.append([{"start": s, "length": n, "period": q} for s, n, q in mine.tolist()])
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc_id"], "n_words": pa.array(sizes), "runs": pa.array(lists, RUNS),
                "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string(), safe=False)})


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` is an array of (start, length, period) in words from 0, by start,
    then period: every stretch with smallest period q and a length of at least
    6 and 4 q that no neighbouring word extends keeping the period.
    ``collapsed`` is the text without the words that some run holds after its
    first q words, joined by one space.

    Words are runs of characters other than space and 0x09-0x0D, compared as
    they are. Null and wordless texts have no words and no runs; texts of any
    length are searched whole. Repeated rows and ids, and null ids, give rows
    of their own. Other columns are not read. Runs as map tasks over slices of
    a few megabytes; nothing is shuffled.
    """
    rows = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                       column_named(docs, text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan, "doc_id bigint, n_words bigint, "
                                  "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def longest(runs_col: str) -> Column:
    """The run of greatest length of an array of runs; of equal ones the one of
    smallest start, then period. Null for an empty array."""
    return F.aggregate(runs_col, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
                       lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
