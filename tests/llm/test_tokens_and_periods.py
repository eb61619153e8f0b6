"""Tokenizer alignment, BPE and periodic runs against the libraries and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vaultline.llm import alignment, bpe, catalog, periods

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPECIAL = "<|endoftext|>"


def _sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    import tokenizers
    a, plain = (tokenizers.Tokenizer.from_file(bpe.VOCABULARY) for _ in range(2))
    plain.encode_special_tokens = True
    return a, plain, sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL_B)


def _texts():
    rnd = random.Random(6)
    pool = ["the ", "of", " ", "  ", "\n", "été", "日本", "▁", SPECIAL, "<0x41>", "<s>", "x1", "'ll", "!?", "\t", "ﬁ", "\U00033000", "a" * 9]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 40))) for _ in range(60)]
    return [*texts, None, "", " ", "\n" * 50_000 + "a", "word " * 20_000, "z" * 30_000, texts[0], texts[0], "plain words here", "\x00\x01"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(_texts())] + [(None, "no id"), (3, "twice")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("n_a", F.lit(1)) \
        .withColumn("row", F.lit(2)).withColumn("runs", F.lit(0)).withColumn("a.b", F.lit(0)).repartition(3).cache()


def test_bpe_equals_the_library(docs, library):
    full, plain, _ = library
    for special, ref in ((True, full), (False, plain)):
        encoded = bpe.encode(docs, special=special)
        rows = encoded.collect()
        want = sorted((str(r.doc_id), np.array(ref.encode(r.text or "", add_special_tokens=False).ids, "<u4").tobytes())
                      for r in docs.select("doc_id", "text").collect())
        assert sorted((str(r.doc_id), bytes(r.ids)) for r in rows) == want
        assert all(r.n_tokens * 4 == len(r.ids) for r in rows)
        back = bpe.decode(encoded).collect()
        assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in docs.select("doc_id", "text").collect())
    assert bpe.encode(docs.limit(0)).count() == 0


def test_bpe_decodes_any_ids(library):
    own, rnd = bpe.loaded(bpe.VOCABULARY), random.Random(1)
    for _ in range(300):
        ids = [rnd.randrange(50_257) for _ in range(rnd.randrange(20))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == library[0].decode(ids, skip_special_tokens=False)
    assert own.decode(np.array([999_999, 50_256], "<u4").tobytes()) == SPECIAL


def test_bpe_pieces_of_any_length(library):
    own, rnd = bpe.loaded(bpe.VOCABULARY), random.Random(2)
    for n in (1, 2, 3, 50, 5000):
        for letters in ("a", "ab", "the of", "éa"):
            piece = "".join(rnd.choice(letters) for _ in range(n)).replace(" ", "")
            assert own.merged(piece.encode()) == library[1].encode(piece, add_special_tokens=False).ids


def _alignment(texts, library):
    """Rows as the contract states them, token pair by token pair."""
    _, plain, model = library
    letters = {c: b for b, c in enumerate(bpe.alphabet())}
    docs, counts = [], Counter()
    for t in texts:
        a, b = plain.encode(" " + (t or ""), add_special_tokens=False).ids, model.encode(t or "")
        bytes_a = [bytes(letters[c] for c in plain.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            docs.append(([], [], [], ""))
            continue
        at_a, at_b = np.cumsum([0, *map(len, bytes_a)]).tolist(), np.cumsum([0, *map(len, bytes_b)]).tolist()
        pairs, j = [], 0
        for i in range(len(a)):
            while at_b[j + 1] <= at_a[i]:
                j += 1
            k = j
            while k < len(b) and at_b[k] < at_a[i + 1]:
                pairs.append((a[i], b[k]))
                k += 1
        counts.update(pairs)
        cuts = sorted(set(at_a[1:]) & set(at_b[1:]))
        groups, low = [], 0
        where_a, where_b = {x: i for i, x in enumerate(at_a)}, {x: i for i, x in enumerate(at_b)}
        for c in cuts:
            groups.append(",".join(map(str, a[where_a[low]:where_a[c]])) + "|" + ",".join(map(str, b[where_b[low]:where_b[c]])))
            low = c
        docs.append((a, b, pairs, ";".join(groups)))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [(len(a), len(b), g.count("|"), len(p), sum(counts[x] == top[x[1]] for x in p), sum(counts[x] for x in p), g)
            for a, b, p, g in docs]


@pytest.mark.parametrize("hot", [1 << 19, 40, 0])
def test_alignment_equals_brute_force(docs, library, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT_PAIRS", hot)
    rows = docs.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), *w) for r, w in zip(rows, _alignment([r.text for r in rows], library)))
    got = alignment.align(docs).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == want
    assert sum(w[1] > 0 for w in want) > 30 and sum(w[1] == 0 for w in want) > 10
    assert alignment.align(docs.limit(0)).count() == 0


def test_partial_counts_are_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "PARTIAL_ROWS", 50)
    counts, sent, rnd, want = alignment.Counts(), [], random.Random(3), Counter()
    for _ in range(40):
        keys = [rnd.randrange(200) for _ in range(60)]
        want.update(keys)
        counts.add(pa.array(keys, pa.int64()))
        if counts.full():
            sent.append(counts.take())
        assert counts.rows <= 200
    sent.append(counts.take())
    got = Counter()
    for t in sent:
        for k, n in zip(t["key"].to_pylist(), t["n"].to_pylist()):
            got[k] += n
    assert got == want and len(sent) > 2


def _runs(x):
    """All runs, straight from the definition."""
    n, out = len(x), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(x[i:i + size - p] == x[i + p:i + size] for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rnd = random.Random(4)
    for _ in range(1500):
        x, kinds, n = [], rnd.choice([1, 2, 2, 3, 5]), rnd.randrange(90)
        while len(x) < n:
            if rnd.random() < .5:
                x += [rnd.randrange(kinds) for _ in range(rnd.randrange(1, 12))] * rnd.randrange(1, 7)
            else:
                x.append(rnd.randrange(kinds))
        assert [tuple(r) for r in periods.runs(np.array(x[:n], np.int64)).tolist()] == _runs(x[:n])


@pytest.mark.parametrize("prime", periods.PRIMES)
def test_transform_convolves(prime):
    rng = np.random.default_rng(5)
    for size in (1, 2, 8, 64):
        blocks, windows = rng.integers(0, 1 << 40, (3, size), np.uint64), rng.integers(0, 1 << 40, (3, 2 * size), np.uint64)
        want = [[sum((int(blocks[r, i]) - int(windows[r, t + i])) ** 2 for i in range(size)) % prime[0] for t in range(size)] for r in range(3)]
        assert periods.mismatches(blocks, windows, prime).tolist() == want
        rows = rng.integers(0, prime[0], (2, size), np.uint64)
        assert (periods.inverse(periods.transform(rows, prime), prime) == rows).all()


def test_long_periodic_texts_take_near_linear_work():
    for x in (np.zeros(100_000, np.int64), np.arange(100_000) % 7, np.arange(100_000) % 24_999):
        (start, length, period), = periods.runs(x).tolist()
        assert (start, length) == (0, 100_000) and period == len(set(x.tolist()))
    a, b = "a", "ab"
    while len(b) < 50_000:
        a, b = b, b + a                                     # no stretch of it comes four times in a row
    assert not len(periods.runs(np.frombuffer(b.encode(), np.uint8).astype(np.int64)))


def _collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs_of_texts(spark):
    rows = [(1, "a b " * 9 + "c"), (2, None), (3, ""), (4, " \n"), (5, "x x x x x"), (6, "x x x x x x"), (None, "y " * 40), (7, "p q r " * 5),
            (7, "one two"), (8, "x " * 5), (9, "é é " * 8), (10, "A a " * 8), (11, " ".join(f"w{i % 900}" for i in range(30_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("start", F.lit(1)) \
        .withColumn("a.b", F.lit(0))
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.periodic_runs(docs).collect())
    want = []
    for d, t in rows[:-1]:
        w = WORD.findall(t or "")
        want.append((str(d), len(w), _runs(w), _collapsed(w, _runs(w))))
    want.append(("11", 30_000, [(0, 30_000, 900)], " ".join(f"w{i}" for i in range(900))))
    assert got == sorted(want)
    assert periods.periodic_runs(docs.limit(0)).count() == 0


def test_query_runs_equal_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in catalog.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    docs, some = spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), 0
    assert len(got) == len(docs)
    for d in docs:
        w = WORD.findall(d.text or "")
        h = zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        names = {}
        x = [names.setdefault(v, len(names)) for v in w]
        if len(x) > 3000:
            runs = [tuple(r) for r in periods.runs(np.array(x, np.int64)).tolist()]
        else:
            runs = _runs(x)
        some += len(runs) > 0
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None,) * 3))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and r.collapsed_sha256 == _sha(_collapsed(w, runs))
    assert some >= 10


def test_token_queries_equal_the_libraries(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: r for r in catalog.QUERIES["op12_bpe"](spark, sf_dir).collect()}
    for d in docs:
        ids = library[0].encode(d.text or "", add_special_tokens=False).ids
        assert tuple(got[d.doc_id])[1:] == (len(ids), _sha(np.array(ids, "<u4").tobytes()), _sha(library[0].decode(ids, skip_special_tokens=False)))
    got = {r.doc_id: tuple(r) for r in catalog.QUERIES["op11_align_tokenizers"](spark, sf_dir).collect()}
    want = _alignment([d.text for d in docs], library)
    assert got == {d.doc_id: (d.doc_id, *w[:-1], _sha(w[-1]) if w[-1] else "") for d, w in zip(docs, want)}
