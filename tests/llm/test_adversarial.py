"""Inputs made to break an operator: structured words, many copies, long runs, deep markup, hidden items."""

import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vaultline.llm import arrowtext, bpe, decontaminate, licenses, neardup, simhash, substrings, token_counts


def _thue_morse(n):
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_structured_words_are_told_apart(spark):
    a, b = _thue_morse(4096)
    docs = spark.createDataFrame([(1, a), (2, b), (3, " ".join(["q"] * 17 + [a] + ["q"] * 17)), (4, " ".join(["q"] * 17 + [b] + ["q"] * 17))],
                                 "doc_id long, text string")
    assert all(r.kept for r in neardup.near_duplicates(docs).collect())
    assert all(r.n_removed == 0 for r in substrings.remove_repeated_windows(docs).collect())
    items = spark.createDataFrame([(1, a), (2, b)], "item_id long, text string")
    got = decontaminate.contained_items(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 2)]


def test_sequences_of_structured_words_are_told_apart():
    a, b = _thue_morse(32)
    texts = [" ".join(x) for x in (a, b)]
    for lane in (0, 1):
        w = next(w for _, w in arrowtext.word_groups(__import__("pyarrow").array(texts), False, lane))
        h = w.windows(32)[1]
        assert len(h) == 2 and h[0] != h[1]


def test_rabin_karp_equals_whole_numbers():
    rng = np.random.default_rng(1)
    v = rng.integers(0, arrowtext.P61, 60, np.uint64)
    v[:3] = [0, arrowtext.P61 - 1, 1]
    for _, base in arrowtext.LANES:
        for k in (1, 2, 3, 5, 8, 35):
            want = [sum(int(v[i + j]) * pow(base, k - 1 - j, arrowtext.P61) for j in range(k)) % arrowtext.P61 for i in range(len(v) - k + 1)]
            assert arrowtext.rabin_karp(v, k, base).tolist() == want


def test_word_hashes_depend_on_bytes_and_length_only():
    words = [b"a", b"b", b"ab", b"a\0", b"\0", b"12345678", b"123456789", b"1234567\0", b"x" * 255, b"x" * 256, b"x" * 257, b"x" * 3000, b"x" * 3001]
    data = np.frombuffer(b" ".join(words + words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words + words]) - 1
    h = arrowtext.word_hashes(data, ends - [len(w) for w in words + words], ends, 5)
    assert h[:len(words)].tolist() == h[len(words):].tolist() and len(set(h.tolist())) == len(words)


SEPARATORS = re.compile(simhash.SEPARATORS)


def _fingerprint(text):
    words, votes, total = SEPARATORS.split(text), [0] * 128, 0
    seed = int.from_bytes(xxhash.xxh64((17).to_bytes(4, "little"), seed=42).digest(), "big")

    def chain(seed, *parts):
        for p in parts:
            seed = seed if p is None else xxhash.xxh64_intdigest(p.encode(), seed=seed)
        return seed

    for i, a in enumerate(words):
        b = words[i + 1] if i + 1 < len(words) else None
        w = min(len(a), 15) + min(len(b or ""), 15) + 1
        total += w
        for half, h in enumerate((chain(42, a, b), chain(seed, b, a))):
            for k in range(64):
                votes[half * 64 + k] += w * (h >> k & 1)
    return [sum((2 * votes[half * 64 + k] > total) << k for k in range(64)) for half in (0, 1)]


def test_fingerprints_equal_brute_force(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["alpha", "é", "日本語", "x" * 40, "to", "b1"]) for _ in range(n)) for n in (1, 2, 7, 300)]
    texts += ["", None, "  lead", "trail \t", texts[3].replace("to", "too", 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.edited_fingerprints(docs).collect()}
    texts = [t or "" for t in texts]
    bits = lambda f: f[0] << 64 | f[1]                                                        # noqa: E731
    for i, t in enumerate(texts):
        after, h = texts[i - 1], len(t) // 2
        own, edited, nxt = (bits(_fingerprint(x)) for x in (t, t[:len(t) - h] + after[:h], after))
        assert got[i].fingerprint == f"{own:032x}" and got[i].edited_fingerprint == f"{edited:032x}"
        assert got[i].near_edited == 1 - (own ^ edited).bit_count() / 128 and got[i].near_next == 1 - (own ^ nxt).bit_count() / 128


def test_votes_are_not_summed_over_copies(spark, monkeypatch):
    plain = simhash.terms
    one = simhash.edited_fingerprints(spark.createDataFrame([(1, "a few words of one text")], "doc_id long, text string")).first()
    # as heavy as texts of millions of words
    monkeypatch.setattr(simhash, "terms", lambda t: F.transform(plain(t), lambda x: F.struct(
        x["h1"].alias("h1"), x["h2"].alias("h2"), (x["w"] * (1 << 23)).alias("w"))))
    docs = spark.range(200).select(F.floor(F.col("id") / 4).alias("doc_id"), F.lit("a few words of one text").alias("text"))
    got = simhash.edited_fingerprints(docs).collect()
    assert len(got) == 200 and {r.fingerprint for r in got} == {one.fingerprint}


@pytest.mark.parametrize("text", ["\n" * 1_000_000 + "a", " " * 1_000_000 + "b", "\t" * 400_000, "x" + " " * 300_000 + "\n"])
def test_long_white_space_is_counted(text):
    assert token_counts.n_tokens(text) == len(bpe.loaded(bpe.VOCABULARY, False).encode(text)) // 4


def test_runs_of_white_space_are_cut_as_the_pattern_cuts(monkeypatch):
    monkeypatch.setattr(token_counts, "LONG_RUN", re.compile(token_counts.LONG_RUN.pattern.replace("5000", "2")))
    rnd, own = random.Random(1), token_counts.encoding(token_counts.RANKS)
    pool = [" ", "  ", "\n", "\t", "　", "\xa0", "\x85", "a", "b1", "!", "'s", "\x1c", "é"]
    for _ in range(5000):
        x = "".join(rnd.choice(pool) for _ in range(rnd.randrange(25)))
        assert token_counts.n_tokens(x) == len(own.encode_ordinary(x)), repr(x)


@pytest.mark.parametrize("page", ["<!--" * 400_000, "<script " * 200_000, "<" * 1_000_000, "<b " * 300_000, "<a " * 300_000 + ">",
                                  "<script></script" + " " * 1_000_000, "<style>" * 200_000 + "</style>"])
def test_pages_of_unclosed_marks_take_linear_time(page):
    began = time.process_time()
    licenses.lines(page)
    assert time.process_time() - began < 5


def test_hidden_parts_are_those_between_marks():
    whole = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->")
    pool, rnd = ["<script", "<SCRIPT>", "</script>", "</style >", "<style", "<!--", "-->", "x", "y ", "<b>", ">", "<", " \n", "</script"], random.Random(2)
    for _ in range(5000):
        x = "".join(rnd.choice(pool) for _ in range(rnd.randrange(14)))
        assert licenses.shown(x) == whole.sub("", x), repr(x)


@pytest.mark.parametrize("size", [1, 2, 4, 8, 16, 32, 64, 128, 256, 512])
def test_recall_by_size_partition(spark, size):
    """Items of each partition, whole or with a quarter of their shingles lost,
    at the start, middle and end of long texts, and scattered in pieces."""
    rnd, docs, items, want = random.Random(size), [], [], []
    for i in range(60):
        n = rnd.randint(size // 2 + 1, size)
        item = [f"i{i}x{j}" for j in range(n + 4)]
        filler = [f"t{rnd.randrange(10 ** 6)}" for _ in range(1500)]
        where = i % 5
        if where < 3:
            at = (0, 700, 1500)[where]
            docs.append((i, " ".join(filler[:at] + item + filler[at:])))
        elif where == 3:                                   # pieces far from each other, each cut costs four shingles
            cuts = sorted(rnd.sample(range(1, n + 4), min(n // 16, n + 3)))
            pieces = [item[a:b] for a, b in zip([0, *cuts], [*cuts, n + 4])]
            docs.append((i, " ".join(w for k, p in enumerate(pieces) for w in [*filler[k * 40:k * 40 + 40], *p])))
        else:                                              # the end is missing
            docs.append((i, " ".join(filler[:300] + item[:n + 4 - n // 4] + filler[300:])))
        items.append((i, " ".join(item)))
        w = docs[-1][1].split()
        held = {tuple(w[a:a + 5]) for a in range(len(w) - 4)}
        of_item = [tuple(item[a:a + 5]) for a in range(n)]
        if 100 * sum(x in held for x in of_item) >= 75 * n:
            want.append((i, i))
    got = decontaminate.contained_items(spark.createDataFrame(docs, "doc_id long, text string"),
                                        spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == want and len(want) >= 48


def test_sketches_and_their_bound():
    assert [decontaminate.least_shared(n) for n in (1, 4, 5, 128)] == [1, 3, 4, 96]
    rng = np.random.default_rng(2)
    lost = 0
    for _ in range(3000):
        n = int(rng.integers(129, 2000))
        item = rng.integers(0, 1 << 63, n, np.uint64)
        s = decontaminate.sketch(item)
        assert len(s) == decontaminate.SKETCH
        held = rng.permutation(item)[:-(-3 * n // 4)]
        lost += np.isin(s, held).sum() < decontaminate.least_shared(n)
    assert lost == 0
