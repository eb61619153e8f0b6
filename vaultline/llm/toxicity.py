"""Toxicity: linear classifier over character n-grams scaled by log-count ratios.

Features of a text, as indicators: the runs of three to five characters of its
lower-cased text (A-Z), where white space may only stand at either end, so a
gram lies in one word and knows whether it starts or ends it. Training and
scoring: ``nblinear``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm import nblinear
from vaultline.llm.arrowtext import U, buffers, groups_of, lowered, mix, seeded
from vaultline.llm.tables import column_named

SALT = seeded(43, 8)
SIZES = (3, 4, 5)
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the offsets counted in them."""
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    text = data.tobytes().decode("utf-8", "replace")
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), leads[offsets]


def extract(column) -> Iterator[tuple[int, list[np.ndarray]]]:
    data, offsets = buffers(column)
    distinct = nblinear.Distinct()
    for a, b in groups_of(offsets):
        points, offs = code_points(lowered(data[offsets[a]:offsets[b]]), offsets[a:b + 1] - offsets[a])
        space = (points == 32) | ((points >= 9) & (points <= 13))
        # each text stands between two spaces, so grams never join texts
        n_docs = b - a
        shift = np.repeat(np.arange(n_docs), np.diff(offs)) + 1
        padded = np.full(len(points) + n_docs + 1, 32, np.uint32)
        padded[np.arange(len(points)) + shift] = np.where(space, 32, points)
        bounds = offs + np.arange(n_docs + 1)
        value, blank = mix(padded.astype(U) ^ SALT[0]), padded == 32
        run, inner = value.copy(), np.zeros(len(padded), bool)
        kinds, places = [], []
        for k in range(1, max(SIZES)):
            n = len(padded) - k
            if n <= 0:
                break
            run = run[:n] * U(0x9E3779B97F4A7C15) + value[k:]
            inner = inner[:n] | (blank[k - 1:n + k - 1] if k > 1 else np.zeros(n, bool))
            if k + 1 in SIZES:
                at = np.flatnonzero(~inner)
                kinds.append(nblinear.features_of(mix(run[at] ^ SALT[k])))
                places.append(np.searchsorted(at, bounds))
        yield a, [distinct(np.concatenate([f[p[d]:p[d + 1]] for f, p in zip(kinds, places)])
                           if kinds else np.zeros(0, np.int32)) for d in range(n_docs)]


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text leaves remainder HELD_OUT; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """The model learnt from the labels of ``docs`` that are not held out."""
    source = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                         column_named(docs, text_col).alias("text"))
    known = labels.select("doc_id", F.col("toxic").alias("label")).filter(~held_out(F.col("doc_id")))
    return nblinear.train(source, known, extract)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    ``labels`` has doc_id and ``toxic`` (0, 1 or null); held-out ids teach
    nothing. Null and empty texts get the score of a text without features.
    Repeated rows get equal scores. Other columns are not read.
    """
    source = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                         column_named(docs, text_col).alias("text"))
    model = fitted(docs, labels, id_col, text_col)
    return nblinear.score(source, model, extract, carry=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that are predicted toxic; same columns."""
    return nblinear.score(docs, fitted(docs, labels), extract).filter(F.col("score") < THRESHOLD).select("row.*")
