"""Each operator against brute force, exact round trips or held-out labels, on
small tables with nulls, empty, short, long and repeated rows."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from vaultline.llm import (components, decontaminate, licenses, mixing, neardup, quality, simhash,
                           substrings, token_counts, toxicity, warc)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _text(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}é" for _ in range(n))


def _rows(seed=3):
    rnd = random.Random(seed)
    passage = _text(rnd, 60)
    texts = [_text(rnd, rnd.randint(1, 200)) for _ in range(30)]
    base = _text(rnd, 120).split(" ")
    near = [" ".join(base[:i * 7] + ["edit"] + base[i * 7 + 1:]) for i in range(8)]
    texts += [passage, texts[0] + "\n" + passage, passage + " " + texts[1], texts[2], texts[2].upper(), *near,
              None, "", " \t\n", "one", "one two three four", "one two three four", _text(rnd, 20_000)]
    rows = [(i * 10, t, "en", None if i % 7 == 0 else f"s{i % 5}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[3], (None, texts[4], "en", "s1", 1), (50, texts[6], None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names clash with those that operators make
    return spark.createDataFrame(_rows(), SCHEMA).withColumn("n_words", F.lit("x")).withColumn("score", F.lit(1)) \
        .withColumn("a.b", F.lit(2)).withColumn("chunk", F.lit(None).cast("int")).repartition(3).cache()


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def _set(t):
    w = WORD.findall(_lower(t))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(5, 5)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == label
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_equal_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = [_set(t) for _, t in rows]
    comp = {d: d for d, _ in rows if d is not None}
    for _ in range(10):
        for (a, _), x in zip(rows, sets):
            for (b, _), y in zip(rows, sets):
                if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    want = sorted((str(d), len(s), comp.get(d), d is None or comp[d] == d) for (d, _), s in zip(rows, sets))
    got = neardup.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in got) == want
    assert len({c for c in comp.values()}) < len(comp) - 5


def test_sketch_fills_and_estimates():
    rnd = np.random.default_rng(4)
    one = rnd.integers(0, 1 << 62, 1000, dtype=np.uint64)
    two = np.concatenate([one[:800], rnd.integers(0, 1 << 62, 200, dtype=np.uint64)])
    s = neardup.sketch([one, two, one[:1], one[:3]])
    assert (s != neardup.NONE).all()
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.15


def test_bucket_rest_finds_links_that_the_centre_misses():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a + np.uint64(20), a + np.uint64(30)]         # 0-1 and 0-2 are not linked, 1-2 is
    assert neardup.cross_links(np.array([1, 2, 3]), np.array([1, 2, 3]), sets) == [(3, 2)] or \
        neardup.cross_links(np.array([1, 2, 3]), np.array([1, 2, 3]), sets) == [(2, 3)]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_packed_hashes_come_back(n):
    import pyarrow as pa
    values = np.sort(np.random.default_rng(n).integers(0, 1 << 64, n, np.uint64))
    values[-1:] = (1 << 64) - 1
    assert (substrings.unpack(pa.scalar(substrings.pack(values), pa.binary())) == values).all()


def test_substrings_equal_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    words = [WORD.findall(t or "") for _, t in rows]
    seen = {}
    for w in words:
        for i in range(len(w) - 34):
            seen[tuple(w[i:i + 35])] = seen.get(tuple(w[i:i + 35]), 0) + 1
    want = []
    for (d, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i:i + 35])] > 1 for j in range(i, i + 35)}
        want.append((str(d), len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = substrings.remove_repeated_windows(docs).select("row.doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    out = substrings.without_repeats(docs)
    assert out.schema.names == docs.schema.names and out.count() == docs.count()


def test_contained_items_equal_brute_force(spark, docs):
    rnd = random.Random(9)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    long_ = next(t for _, t in rows if t and len(t) > 50_000).split(" ")
    items = [(1, " ".join(long_[7000:7020])), (2, " ".join(long_[300:340]).upper()), (3, _text(rnd, 30)), (4, None), (5, ""),
             (6, "one two three four"), (7, " ".join(long_[15:21])), (8, " ".join(long_[900:906])), (1, " ".join(long_[50:90])),
             (9, " ".join(long_[100:400])), (10, " ".join(long_[4000:4030] + ["x"] * 5)), (None, " ".join(long_[60:80]))]
    want = sorted((str(d), str(i), len(_set(q)), len(_set(q) & _set(t))) for d, t in rows for i, q in items
                  if _set(q) and 100 * len(_set(q) & _set(t)) >= 75 * len(_set(q)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contained_items(docs, bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.n_item, r.n_shared) for r in got) == want and len(want) > 7
    assert decontaminate.contained_items(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs, bench).columns == docs.columns


def test_short_and_scattered_items_are_found(spark):
    rnd = random.Random(21)
    docs, items = [], []
    for i in range(600):
        n = 5 + i % 5
        item, text = [f"i{i}x{j}" for j in range(n)], [f"t{rnd.randrange(10 ** 6)}" for _ in range(120)]
        at = (0, 60, 120)[i // 5 % 3]
        lost = n >= 8 and i % 2                # 3 of 4, 4 of 5 shingles are left
        docs.append((i, " ".join(text[:at] + item[:n - lost] + text[at:])))
        items.append((i, " ".join(item)))
    long_ = [f"s{j}" for j in range(100)]      # 12 runs of 7 shingles are left of 96, far from each other
    docs.append((600, " ".join(w for k in range(12) for w in long_[k * 8:k * 8 + 11] + [f"f{k}x{j}" for j in range(150)])))
    items.append((600, " ".join(long_)))
    want = sorted((i, i) for i, _ in items)
    got = decontaminate.contained_items(spark.createDataFrame(docs, "doc_id long, text string"),
                                        spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == want


def test_mixing_meets_targets(docs):
    rows = {(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()}
    got = mixing.document_shares(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), [0, 0])
        by[r.source_size, r.target][0] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    names = sorted({s for _, s, _ in rows if s is not None}) + [None]
    sizes = {s: 0 for s in names}
    for r in docs.select("source", "text").collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 2 * sizes[s]}
        for s in over or free:
            target[s] = 2 * sizes[s] if over else unit * weight[s]
            left -= target[s] if over else 0
        free -= over or free
    assert sorted(round(t) for t in target.values()) == sorted(x for x, _ in by.values())
    again = mixing.document_shares(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.document_shares(docs.limit(0)).count() == 0


def test_permutation(spark):
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_simhash(spark, docs):
    rows = [r for r in docs.select("doc_id", "text").collect()]
    got = simhash.edited_fingerprints(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    single = spark.createDataFrame([(i, t) for i, t in enumerate(["abc def", "xyzé uvw", "", None, "q"])], "doc_id long, text string")
    by = {r.doc_id: r for r in simhash.edited_fingerprints(single).collect()}
    texts = ["abc def", "xyzé uvw", "", "", "q"]
    for i, t in enumerate(texts):
        after, h = texts[i - 1], len(t) // 2
        assert by[i].edited_sha256 == hashlib.sha256((t[:len(t) - h] + after[:h]).encode()).hexdigest()
        assert by[i].n_chars == len(t)
    assert by[2].fingerprint == by[3].fingerprint != by[0].fingerprint and len(by[0].fingerprint) == 32
    assert simhash.edited_fingerprints(single.limit(0)).count() == 0


def test_simhash_ranges_equal_one_range(spark, docs, monkeypatch):
    one = sorted(map(str, simhash.edited_fingerprints(docs).collect()))
    monkeypatch.setattr(simhash, "BUCKET_CHARS", 5000)
    assert sorted(map(str, simhash.edited_fingerprints(docs).collect())) == one


def test_block_tables_find_all_within_radius(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(128) for _ in range(20)]
    fps = base + [b ^ sum(1 << p for p in rnd.sample(range(128), k)) for b in base for k in (1, 5, 6, 7, 20)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    split = [(signed(f >> 64), signed(f & ((1 << 64) - 1)), 1) for f in fps]
    d = spark.createDataFrame(split, "fp1 long, fp2 long, n int")
    got = {(r.q1, r.q2): r.rows for r in simhash.near_counts(d, d.limit(20)).collect()}
    want = {split[i][:2]: sum(bin(fps[i] ^ g).count("1") <= 6 for g in fps) for i in range(20)}
    assert got == want


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    big, other = "<p>é" + "x y " * 60, "<p>" + "z " * 90
    rows = [(5, "http://a/\r\nWARC-Type: x", big), (3, None, big), (9, "u", big), (4, "u", other), (7, "u", None), (8, "u", "small"),
            (2, "u", "small"), (None, "u", big), (3, "u", big), (11, "u", ""), *[(100 + i, "u", f"page {i} " * 40) for i in range(60)]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = warc.round_trip(pages.repartition(2)).collect()
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min((p for p, _, h in rows if h == html and p is not None), default=None)
        revisit = len(data) >= 100 and page is not None and page != first
        want.append((str(page), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                     first if revisit else None, None))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want, key=str) or \
        sorted(((str(r[0]), *r[1:]) for r in got), key=str) == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_reader_refuses_bad_records(tmp_path):
    import pyarrow as pa
    good = warc.record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None, "2024-01-01T00:00:00Z", "x")
    bad = [good.replace(b"Content-Length: 5", b"Content-Length: 6"), good.replace(b"hello", b"hullo"), good[:-2],
           good.replace(b"WARC-Type: response\r\n", b""), b"junk", good.replace(b"response", b"request", 1)]
    plain = zstandard.ZstdCompressionDict(b"some words that records share " * 20)
    for lead, made in ((struct.pack("<II", warc.DICT_MAGIC, 0), None),
                       (struct.pack("<II", warc.DICT_MAGIC, len(plain.as_bytes())) + plain.as_bytes(), plain)):
        c = zstandard.ZstdCompressor(dict_data=made)
        body = b"".join(c.compress(x) for x in [good, *bad, good])
        path = str(tmp_path / "a.warc.zst")
        with open(path, "wb") as fh:
            fh.write(lead + body + c.compress(good)[:-3])
        rows = [r for b in warc._read(iter([pa.RecordBatch.from_pydict({"path": [path]})])) for r in b.to_pylist()]
        assert [r["error"] is None for r in rows] == [True, *[False] * len(bad), True, False]
        assert rows[0]["payload"] == b"hello" and rows[0]["page_id"] == 1


def _labelled(spark, bad, kind):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        t, y = _text(rnd, 40, 60), i % 4 == 0
        if y:
            t = bad(t)
        rows.append((i, t))
        labels.append((i, int(y) if kind == "toxic" else int(not y)))
    rows += [(1000, None), (1001, ""), (None, "w1é"), (1002, "w " * 30_000)]
    labels += [(2000, 1), (None, 1), (3, None)]
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("x")),
            spark.createDataFrame(labels, f"doc_id long, {kind} int"))


@pytest.mark.parametrize("op, kind, bad, folds, out", [
    (quality, "quality", lambda t: t.upper().replace(" ", "!! "), 5, 0),
    (toxicity, "toxic", lambda t: t + " you absolute idiots", 3, 1)])
def test_classifiers_on_held_out_rows(spark, op, kind, bad, folds, out):
    docs, labels = _labelled(spark, bad, kind)
    got = op.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    truth = {r.doc_id: r[kind] for r in labels.collect()}
    for r in got:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % folds == out)
        assert r.predicted == int(r.score >= op.THRESHOLD)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400 and truth.get(r.doc_id) is not None]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    none = op.classify(docs, labels.limit(0)).select("score").distinct().collect()
    assert len(none) == 1
    assert op.classify(docs.limit(0), labels).count() == 0


def test_token_limits_equal_brute_force(docs):
    lengths = [r.n_tokens for r in token_counts.token_lengths(docs).collect()]
    text = next(r.text for r in docs.select("text").collect() if r.text and len(r.text) > 50_000)
    assert token_counts.encoding(token_counts.RANKS).decode(
        token_counts.encoding(token_counts.RANKS).encode_ordinary(text)) == text
    answers = token_counts.limits(token_counts.histogram(token_counts.token_lengths(docs)))
    for r in answers.collect():
        assert r.docs_over == sum(x > r.n_tokens for x in lengths)
        assert r.truncated_tokens == sum(min(x, r.n_tokens) for x in lengths)
        assert r.tokens_within == sum(x for x in lengths if x <= r.n_tokens)
        assert r.total_tokens == sum(lengths) and abs(r.quantile - sum(x <= r.n_tokens for x in lengths) / len(lengths)) < 1e-12
    for limit in (0, 10, 333, 10**6):
        assert token_counts.truncated_total(answers, limit) == sum(min(x, limit) for x in lengths)
    assert token_counts.quantile(answers, 0.5) == sorted(lengths)[(len(lengths) + 1) // 2 - 1]


def test_licences_and_inheritance(spark):
    mit, gpl = "<p>Released under the MIT License.</p>", "<p>This work is licensed under the GNU General Public License, version 3."
    pages = spark.createDataFrame([
        (1, "https://h.org/a/LICENSE", mit), (2, "http://h.org/a/b/c/x.html?q=1#t", "<p>plain words only"), (3, "h.org/a/b/", gpl),
        (4, "https://h.org/a/y", "<script>Released under the MIT License.</script> nothing"), (5, "https://h.org/z", None),
        (6, None, "<b>Licensed under the Apache License, Version 2.0.</b>"), (7, "", "plain"), (8, "https://h.org/ab/q", "none"),
    ], "page_id long, url string, html string").withColumn("path", F.lit(0))
    got = {r.page_id: (r.own, r.license, r.inherited_from) for r in licenses.scan(pages).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "GPL-3.0", "h.org/a/b"), 3: ("GPL-3.0", "GPL-3.0", None),
                   4: (None, "MIT", "h.org/a"), 5: (None, None, None), 6: ("Apache-2.0", "Apache-2.0", None),
                   7: (None, None, None), 8: (None, None, None)}
    assert licenses.scan(pages.limit(0)).count() == 0


def test_licence_far_above_is_inherited(spark):
    mit, deep = "<p>Released under the MIT License.</p>", "/".join(f"d{i % 7}" for i in range(300))
    pages = spark.createDataFrame([
        (1, "h.org/a/LICENSE", mit), (2, f"h.org/a/{deep}/x.html", "plain"), (3, f"h.org/b/{deep}/x.html", "plain"),
        (4, f"h.org/b/{deep}/y/", "<p>Licensed under CC BY 4.0."), (5, f"h.org/b/{deep}/y/{deep}/z", "plain"),
    ], "page_id long, url string, html string")
    got = {r.page_id: (r.license, r.inherited_from) for r in licenses.scan(pages).collect()}
    assert got == {1: ("MIT", None), 2: ("MIT", "h.org/a"), 3: (None, None), 4: ("CC-BY-4.0", None),
                   5: ("CC-BY-4.0", f"h.org/b/{deep}/y")}
    plain = pages.withColumn("html", F.lit("plain"))
    assert licenses.scan(plain).filter("license is null").count() == 5


def _own(spark, texts):
    rows = [(i, f"h.org/{i}", t) for i, t in enumerate([*texts, *["<p>plain words of the page"] * 200])]
    got = licenses.scan(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.own for r in sorted(got, key=lambda r: r.page_id)][:len(texts)]


def test_licences_are_told_apart(spark):
    want = {
        "Licensed under the <b>Foo</b> License": None, "Licensed under the <b>MIT</b> <a href=x>License</a>.": "MIT",
        "Rel<b>eased</b> under the M<i>IT</i> License.": "MIT", "Released under the ISC License.": "ISC",
        "Released under the BSD License.": None, "Released under the BSD 2-Clause License.": "BSD-2-Clause",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "This work is licensed under the GNU General Public License.": None, "Licensed under the GPLv2.": "GPL-2.0",
        "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0", "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
        "Licensed under CC BY-NC-ND 3.0.": "CC-BY-NC-ND-3.0", "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License.": "CC-BY-NC-ND-3.0",
        "Licensed under the Apache License, Version 1.1.": None, "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "MPL-2.0",
        f"{licenses.BSD_2} {licenses.BSD_WARRANTY}": "BSD-2-Clause", licenses.BSD_2: None,
        f"{licenses.BSD_2} {licenses.BSD_3} {licenses.BSD_WARRANTY}": "BSD-3-Clause",
        f"{licenses.MIT_GRANT}. {licenses.WARRANTY}": "MIT-0",
    }
    assert dict(zip(want, _own(spark, want))) == want


def test_every_template_tells_its_licence():
    for name, text in licenses.TEMPLATES:
        assert set(licenses.told(licenses.terms(text))) == {name}, text


def test_licences_inside_paragraphs_and_over_lines(spark):
    filler = " ".join(f"word{i}" for i in range(40))
    want = {
        "(c) 2024 Example Corp. Licensed under the Apache License, Version 2.0. Contact us for more information.": "Apache-2.0",
        f"{filler} this page is licensed under CC BY 4.0. See terms of use. {filler}": "CC-BY-4.0",
        f"{filler}. Released under the MIT License. {filler}": "MIT",
        f"<p>{filler} this work is licensed<br>under the GNU General\n Public License,</p><div>version 3.</div> {filler}": "GPL-3.0",
        "".join(f"<tr><td>{i}</td></tr>" for i in filler.split()) + "<div>Licensed under the Apache</div><div>License, Version 2.0</div>": "Apache-2.0",
        f"<pre>{filler}\n" + licenses.MIT_GRANT.replace(" ", "\n") + f"\n</pre>{filler}": "MIT",
        f"{filler} we compare what the MIT License says with {filler}": None, f"{filler} Licensed under the GPL. {filler}": None,
    }
    assert dict(zip(want, _own(spark, want))) == want


def test_sliding_cosine_equals_each_window():
    rnd = random.Random(8)
    scorer = licenses.Scorer({t: rnd.randrange(300) for t in licenses.VOCABULARY}, 1000)
    words = [rnd.choice([*licenses.VOCABULARY[:60], "x", "y"]) for _ in range(90)]
    for size, template in [x for name in ("MIT", "GPL-3.0", "CC-BY-4.0") for x in scorer.templates[name]]:
        for a, b in ((0, 0), (3, 40), (0, max(0, 90 - size))):
            b = max(a, min(b, 90 - size)) if size < 90 else a
            want = max(sum(x * scorer.vector(words[i:i + size]).get(t, 0) for t, x in template.items()) for i in range(a, b + 1))
            assert abs(scorer.slide(words, template, size, a, b) - want) < 1e-9
    spans = [(4, 6), (5, 6), (30, 33), (88, 90)]
    for size in (1, 5, 20, 100):
        got = [i for a, b in licenses.starts_of(spans, size, 90) for i in range(a, b + 1)]
        want = {i for i in range(max(1, 91 - size)) for p, q in spans if i <= p and q <= i + size}
        assert want <= set(got) and len(got) == len(set(got))


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    from vaultline.llm.tables import materialize
    for name, stage in P.STAGES[:-1]:
        after = materialize(stage(spark, docs, sf_dir), "test")
        assert after.dtypes == docs.dtypes and 0.7 * docs.count() <= after.count() <= docs.count(), name
        docs = after
    last = P.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()


@pytest.mark.parametrize("name", ["op3_decontaminate", "op4_warc", "op6_substring_dedup", "op10_near_dedup"])
def test_queries_equal_sql(spark, sf_dir, name):
    from tests.harness import compare, duck
    assert compare(spark, name, sf_dir, duck(sf_dir), verbose=True)
