"""Licence scan: TF-IDF cosine to templates, then inheritance along directories.

A page's URL is its path: host, then segments; query and fragment do not count.
A page is a licence file if its name says so (LICENSE, COPYING, ...) or if it
is the index of a directory (its path ends in a slash). A text counts for a
licence if it holds one of its telling phrases (TELLING: name and version, or a
clause that only this licence has). Compared are, around each phrase in the
visible text, every window of a template's number of words, whatever the lines
and paragraphs, and the line of the phrase; licence files are compared whole as
well. Each is a sparse TF-IDF vector, and the best cosine of 0.6 or more to a
template of the licence names it. So another version or variant, and a name
without its version, is null and not its neighbour. Document frequencies count
all lines.

Files without a licence take that of the nearest directory above them that has
one: each path is joined with the directories by its own ancestors, and the
deepest match stays.
"""

from __future__ import annotations

import html as markup
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.tables import column_named, materialize, small

LEAST_COSINE = 0.6
PATH_ROWS = 8            # a row of two paths counts as so many narrow rows

# fixed values: titles by SPDX identifier, usual notices with a title, and texts
PHRASES = ["Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.",
           "Distributed under the terms of the {}."]
TITLES = [
    ("0BSD", "Zero-Clause BSD License"), ("Apache-2.0", "Apache License, Version 2.0"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("BSL-1.0", "Boost Software License, Version 1.0"), ("CC0-1.0", "CC0 1.0 Universal"),
    ("EPL-1.0", "Eclipse Public License 1.0"), ("EPL-2.0", "Eclipse Public License 2.0"), ("ISC", "ISC License"),
    ("MIT", "MIT License"), ("MPL-1.1", "Mozilla Public License 1.1"), ("MPL-2.0", "Mozilla Public License 2.0"),
    ("Unlicense", "Unlicense"), ("Zlib", "zlib License"),
    *[(f"{k}GPL-{v}", f"GNU {n}General Public License, version {v.removesuffix('.0')}") for k, n, vs in (
        ("", "", "1.0 2.0 3.0"), ("L", "Lesser ", "2.0 2.1 3.0"), ("A", "Affero ", "1.0 3.0")) for v in vs.split()],
    *[(f"{k}GPL-{v}", f"{k}GPLv{v.removesuffix('.0')}") for k, vs in (
        ("", "1.0 2.0 3.0"), ("L", "2.0 2.1 3.0"), ("A", "1.0 3.0")) for v in vs.split()],
]
CC_KINDS = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-SA": "Attribution-ShareAlike",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
BSD_2 = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
ISC_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
GPL_NOTICE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
TEMPLATES = [
    *[(i, p.format(t)) for i, t in TITLES for p in PHRASES],
    *[(f"CC-{k}-{v}", t) for v in ("1.0", "2.0", "2.5", "3.0", "4.0") for k, n in CC_KINDS.items() for t in (
        f"Licensed under CC {k} {v}.", f"This work is licensed under a Creative Commons {n} {v} International License.",
        f"Creative Commons {n} {v} International Public License")],
    *[(f"{k}GPL-{v}", GPL_NOTICE.format(n, v.removesuffix(".0"))) for k, n, vs in (
        ("", "", "1.0 2.0 3.0"), ("L", "Lesser ", "2.0 2.1 3.0"), ("A", "Affero ", "1.0 3.0")) for v in vs.split()],
    # heads of the long texts
    *[(f"{k}GPL-{v}", f"GNU {n}General Public License Version {v.removesuffix('.0')}, {date} Copyright (C) {year} Free Software Foundation, Inc.")
      for k, n, v, date, year in (("", "", "2.0", "June 1991", "1989, 1991"), ("", "", "3.0", "29 June 2007", "2007"),
                                  ("L", "Lesser ", "2.1", "February 1999", "1991, 1999"), ("L", "Lesser ", "3.0", "29 June 2007", "2007"),
                                  ("A", "Affero ", "3.0", "19 November 2007", "2007"))],
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    # whole texts
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + ISC_WARRANTY),
    ("BSD-2-Clause", f"{BSD_2} {BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{BSD_2} {BSD_3} {BSD_WARRANTY}"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + ISC_WARRANTY),
    ("MIT", f"{MIT_GRANT}, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {WARRANTY}"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MIT-0", f"{MIT_GRANT}. {WARRANTY}"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
]

# patterns over the terms of a text, each with a space on both sides; {v} is a version
_V, _END = r"(?:version |v )?v?(\d(?:\.\d+)?)", r"(?= )"
_GNU = r"(lesser |library |affero )?general public licen[cs]e "
_KIND = {"": "", "lesser": "L", "library": "L", "affero": "A", "l": "L", "a": "A"}


def _version(v: str) -> str:
    return v if "." in v else f"{v}.0"


def _gnu(kind: str | None, v: str) -> str:
    return f"{_KIND[(kind or '').strip()]}GPL-{_version(v)}"


def _cc(kind: str | None, other: str | None, v: str) -> str:
    parts = [{"non": "NC", "sha": "SA", "no": "ND", "nod": "ND"}.get(p[:3].strip(), p.upper())
             for p in (kind, other) if p]
    return "-".join(["CC-BY", *parts, _version(v)])


TELLING = [(re.compile(p + _END), name) for p, name in [
    (rf" apache (?:software |public )?licen[cs]e {_V}", lambda m: f"Apache-{_version(m[1])}"),
    (r" apache (?:version )?v?(\d(?:\.\d+)?) licen[cs]e", lambda m: f"Apache-{_version(m[1])}"),
    (rf" gnu {_GNU}(?:[al]?gpl )?(?:as published by the free software foundation )?(?:either )?{_V}", lambda m: _gnu(m[1], m[2])),
    (rf" (?<! gnu )(lesser |affero )general public licen[cs]e {_V}", lambda m: _gnu(m[1], m[2])),
    (rf" version (\d(?:\.\d+)?) of the gnu {_GNU[:-1]}", lambda m: _gnu(m[2], m[1])),
    (r" ([al]?)gpl(?: version)?(?: v)? ?v?(\d(?:\.\d+)?)", lambda m: _gnu(m[1], m[2])),
    (rf" mozilla public licen[cs]e (?:mpl )?{_V}", lambda m: f"MPL-{_version(m[1])}"),
    (rf" mpl {_V}", lambda m: f"MPL-{_version(m[1])}"),
    (rf" eclipse public licen[cs]e (?:epl )?{_V}", lambda m: f"EPL-{_version(m[1])}"),
    (rf" boost software licen[cs]e {_V}", lambda m: f"BSL-{_version(m[1])}"),
    (r" cc by(?: (nc|sa|nd))?(?: (sa|nd))? v?(\d(?:\.\d)?)", lambda m: _cc(m[1], m[2], m[3])),
    (r" creative commons attribution(?: (non ?commercial|share ?alike|no ?deriv[a-z]*))?(?: (share ?alike|no ?deriv[a-z]*))?"
     r"(?: works)?(?: (?:international|unported|generic|public|licen[cs]e|version))* v?(\d(?:\.\d)?)", lambda m: _cc(m[1], m[2], m[3])),
    (r" cc0(?: 1(?:\.0)?)?", lambda m: "CC0-1.0"),
    (r" (?:mit|expat) licen[cs]e", lambda m: "MIT"),
    (r" furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be "
     r"included in all copies or substantial portions of the software(?! the software shall)", lambda m: "MIT"),
    (r" furnished to do so(?= the software is provided as is)", lambda m: "MIT-0"),
    (r" to deal in the software without restriction(?! including .{0,400} (?:furnished to do so the software is|the software shall be used))",
     lambda m: "MIT"),
    (r" isc licen[cs]e", lambda m: "ISC"),
    (r" permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"
     r"( provided that the above copyright notice)?", lambda m: "ISC" if m[1] else "0BSD"),
    (r" (?:zero|0) clause bsd", lambda m: "0BSD"), (r" 0bsd", lambda m: "0BSD"),
    (r" (?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd licen[cs]e)", lambda m: "BSD-2-Clause"),
    (r" (?:bsd (?:3|three) clause(?! clear)|(?:3|three) clause bsd|(?:new|modified|revised) bsd licen[cs]e)", lambda m: "BSD-3-Clause"),
    (r" provided with the distribution this software is provided", lambda m: "BSD-2-Clause"),
    (r" provided with the distribution (?:[a-z0-9]+ )?neither the names? of", lambda m: "BSD-3-Clause"),
    (r" governed by a bsd style licen[cs]e that can be found in the licen[cs]e file", lambda m: "BSD-3-Clause"),
    (r" (?:the unlicense|this is free and unencumbered software released into the public domain)", lambda m: "Unlicense"),
    (r" (?:zlib licen[cs]e|this software is provided as is without any express or implied warranty in no event will the authors? be held liable)",
     lambda m: "Zlib"),
]]
# every telling phrase has one of these
ANCHORS = (" licen", "gpl", " mpl ", " cc", " creative ", " furnished ", " restriction ", " permission ", "bsd ", " distribution ",
           " unlicense ", " unencumbered ", " warranty ")
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice|copyright)([._-].*)?$"

TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
HIDDEN = re.compile(r"(?i)<(script|style)\b|<!--")
HIDDEN_ENDS = {None: re.compile("-->"), "script": re.compile(r"(?i)</script\s*>"), "style": re.compile(r"(?i)</style\s*>")}
# tags inside a line: those of letters leave a word whole, the others may stand between two words
LETTERS = re.compile(r"(?i)</?(?:b|big|em|font|i|mark|s|small|strong|tt|u|wbr)(?:[\s/][^>]*)?>")
INLINE = re.compile(r"(?i)</?(?:a|abbr|acronym|bdi|bdo|cite|code|data|del|dfn|img|ins|kbd|label|q|samp|span|strike|sub|sup|time|var)(?:[\s/][^>]*)?>")
TAG = re.compile(r"<[^>]*>")


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


def shown(html: str) -> str:
    """The page without scripts, styles and comments, in one scan forward; an
    opening mark that is never closed hides nothing."""
    out, at, ends = [], 0, dict(HIDDEN_ENDS)
    opening = HIDDEN.search(html)
    while opening and ends:
        kind = opening[1] and opening[1].lower()
        end = ends[kind].search(html, opening.end()) if kind in ends else None
        if end:
            out.append(html[at:opening.start()])
            at = end.end()
        else:
            ends.pop(kind, None)                      # none further on either
        opening = HIDDEN.search(html, end.end() if end else opening.end())
    return "".join([*out, html[at:]])


def lines(html: str) -> list[str]:
    """Visible lines of a page: tags end a line, but for those inside a line."""
    html = shown(html)
    cut = html.rfind(">") + 1                         # no tag ends behind it
    text = markup.unescape(TAG.sub("\n", INLINE.sub(" ", LETTERS.sub("", html[:cut]))) + html[cut:])
    return [x for x in (y.strip() for y in text.splitlines()) if x]


VOCABULARY = sorted({t for _, text in TEMPLATES for t in terms(text)})


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, found, n = set(VOCABULARY), Counter(), 0
    for batch in batches:
        for h in batch["html"].to_pylist():
            for line in lines(h or ""):
                n += 1
                found.update(known.intersection(terms(line)))
    yield pa.RecordBatch.from_pydict({"term": ["", *found], "n": pa.array([n, *found.values()], pa.int64())})


def told(words: list[str]) -> dict[str, list[tuple[int, int]]]:
    """Licences whose telling phrases stand in ``words``, with the word ranges of the phrases."""
    text = f" {' '.join(words)} "
    if not any(a in text for a in ANCHORS):
        return {}
    at = [0, *accumulate(len(w) + 1 for w in words)]      # of the space before each word
    out: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for p, name in TELLING:
        for m in p.finditer(text):
            out[name(m)].append((bisect_left(at, m.start()), bisect_left(at, m.end())))
    return out


def starts_of(spans: list[tuple[int, int]], size: int, n: int) -> list[tuple[int, int]]:
    """Ranges of the starts of all windows of ``size`` of ``n`` words that hold a span, without overlap."""
    out: list[tuple[int, int]] = []
    for p, q in sorted(spans):
        a, b = max(0, min(q - size, n - size)), max(0, min(p, n - size))
        if a > b:                                          # the phrase is longer than the window
            a = b
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


class Scorer:
    """Cosines to the templates under given document frequencies."""

    def __init__(self, frequencies: dict[str, int], n: int):
        self.idf = {t: math.log((1 + n) / (1 + frequencies.get(t, 0))) + 1 for t in VOCABULARY}
        self.other = math.log(1 + n) + 1
        self.templates: dict[str, list[tuple[int, dict[str, float]]]] = defaultdict(list)
        for name, text in TEMPLATES:
            words = terms(text)
            self.templates[name].append((len(words), self.vector(words)))

    def vector(self, words: list[str]) -> dict[str, float]:
        v = {t: c * self.idf.get(t, self.other) for t, c in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / norm for t, x in v.items()}

    def cosine(self, words: list[str], name: str) -> float:
        v = self.vector(words)
        return max(sum(x * v.get(t, 0.0) for t, x in template.items()) for _, template in self.templates[name])

    def slide(self, words: list[str], template: dict[str, float], size: int, first: int, last: int) -> float:
        """Best cosine of the windows that start at ``first`` to ``last``, in constant time per window."""
        counts: Counter[str] = Counter()
        dot = squares = best = 0.0

        def put(word: str, by: int) -> None:
            nonlocal dot, squares
            x, c = self.idf.get(word, self.other), counts[word]
            counts[word] = c + by
            squares += (2 * c * by + 1) * x * x
            dot += by * x * template.get(word, 0.0)

        for i in range(first, min(last + size, len(words))):
            put(words[i], 1)
            if i - first >= size:
                put(words[i - size], -1)
            if i - first >= size - 1 or i == len(words) - 1:
                best = max(best, dot / math.sqrt(max(squares, 1e-12)))
        return best

    def best(self, rows: list[str], whole: bool) -> tuple[float, str | None]:
        """Best licence of a page of these lines; ``whole``: compared whole as well."""
        split = [terms(r) for r in rows]
        words = [t for r in split for t in r]
        ends = list(accumulate(map(len, split)))
        top: tuple[float, str | None] = (0.0, None)
        for name, spans in told(words).items():
            if name not in self.templates:
                continue
            found = [self.slide(words, template, size, a, b) for size, template in self.templates[name]
                     for a, b in starts_of(spans, size, len(words))]
            in_lines = {i for i, q in ((bisect_right(ends, p), q) for p, q in spans) if q <= ends[i]}
            found += [self.cosine(split[i], name) for i in in_lines]
            if whole:
                found.append(self.cosine(words, name))
            top = max(top, (round(max(found), 9), name), key=lambda x: (x[0], x[1] or ""))
        return top


def _matches(scorer):
    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scorer.value
        for batch in batches:
            cosine, name = [], []
            for h, is_file in zip(batch["html"].to_pylist(), batch["is_licence_file"].to_pylist()):
                top, who = s.best(lines(h or ""), is_file)
                cosine.append(top)
                name.append(who if top >= LEAST_COSINE else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("page_id", "path", "dir", "is_licence_file")), pa.array(name, pa.string()),
                 pa.array(cosine, pa.float64())], ["page_id", "path", "dir", "is_licence_file", "own", "cosine"])
    return matches


def url_path(url: Column) -> Column:
    """host/segment/...; a path that names a directory keeps its last slash."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.regexp_replace(bare, "/+", "/")


def scan(pages: DataFrame) -> DataFrame:
    """(page_id, path, own, cosine, license, inherited_from) of every row of
    ``pages`` (page_id, url, html).

    ``own`` is the page's best template, null below the threshold; ``cosine``
    is its cosine, 0 for a page without a telling phrase; ``license``
    is ``own``, or that of the nearest directory above. A directory's licence
    is the best match among its licence files, then the smallest path and
    licence. Null html has no lines; a null or empty url has no directory, so
    it neither gives nor takes. Paths of any depth look at all directories above
    them. Repeated rows get equal results. Other columns are not read.
    """
    spark = pages.sparkSession
    p = pages.select(column_named(pages, "page_id").cast("bigint").alias("page_id"),
                     url_path(column_named(pages, "url").cast("string")).alias("path"),
                     column_named(pages, "html").cast("string").alias("html"))
    p = p.withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    p = p.withColumn("dir", F.when(F.col("dir") != "", F.col("dir")))
    p = p.withColumn("is_licence_file", F.coalesce(F.col("path").endswith("/") | F.regexp_extract(
        "path", r"([^/]*)$", 1).rlike(FILE_NAMES), F.lit(False)))
    counts = p.select("html").mapInArrow(_frequencies, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counts.collect()}          # the templates' vocabulary at most
    scorer = spark.sparkContext.broadcast(Scorer(found, found.get("", 0)))
    m = materialize(p.mapInArrow(_matches(scorer), "page_id bigint, path string, dir string, is_licence_file boolean, "
                                                   "own string, cosine double"), "licences")
    dirs = materialize(m.filter("is_licence_file and own is not null and dir is not null")
            .groupBy(F.col("dir").alias("at"))
            .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "path", "own")).alias("best"))
            .select("at", F.col("best.own").alias("dir_license")), "licensed")
    # only depths at which a directory has a licence, at most as many as the deepest path has parts
    depths = [r[0] for r in dirs.select(F.size(F.split("at", "/"))).distinct().collect()]
    # one lookup per directory, not per file
    need = m.filter("own is null and dir is not null").select("dir").distinct()
    at_most = F.size(F.split("dir", "/"))
    above = (need.select("dir", F.explode(F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda k: k <= at_most))
                         .alias("depth"))
             .withColumn("at", F.expr("substring_index(dir, '/', depth)")))
    nearest = (above.join(dirs, "at").groupBy("dir")
               .agg(F.max_by(F.struct("at", "dir_license"), "depth").alias("near"))
               .select(F.col("dir").alias("d"), F.col("near.at").alias("at"), F.col("near.dir_license").alias("dir_license")))
    # written first: a directory of very many pages then meets a counted broadcast, or a join that can split it
    nearest = materialize(nearest, "nearest")
    out = m.join(small(nearest, PATH_ROWS * nearest.count()), F.col("own").isNull() & (F.col("dir") == F.col("d")), "left")
    return out.select("page_id", "path", "own", "cosine", F.coalesce("own", "dir_license").alias("license"),
                      F.when(F.col("own").isNull(), F.col("at")).alias("inherited_from"))
