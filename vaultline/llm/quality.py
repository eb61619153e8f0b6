"""Quality classifier: naive Bayes support vectors over word and shape n-grams.

Features of a text, as indicators: its lower-cased words, and the runs of one
to three word shapes. A shape holds whether the word repeats the one before,
has upper case only, has a digit, its first and last byte where these are
punctuation, and a class of its length. Training and scoring: ``nblinear``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm import nblinear
from vaultline.llm.arrowtext import U, Words, buffers, groups_of, mix, seeded
from vaultline.llm.tables import column_named

SALT = seeded(41, 8)
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3


def _inside(mask: np.ndarray, w: Words) -> np.ndarray:
    """Whether each word has a byte of the mask."""
    sums = np.concatenate([[0], np.cumsum(mask)])
    return sums[w.ends] > sums[w.starts]


def shapes(data: np.ndarray, w: Words) -> np.ndarray:
    lower = _inside(((data >= 97) & (data <= 122)) | (data >= 128), w)
    upper = _inside((data >= 65) & (data <= 90), w)
    digit = _inside((data >= 48) & (data <= 57), w)
    mark = ((data < 48) | ((data > 57) & (data < 65)) | ((data > 90) & (data < 97)) | ((data > 122) & (data < 128)))
    first, last = data[w.starts], data[w.ends - 1]
    again = np.zeros(len(w.starts), bool)
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    size = np.minimum(np.log2(w.ends - w.starts).astype(np.int64), 7)
    return (again + 2 * (upper & ~lower) + 4 * digit + 8 * size
            + 64 * np.where(mark[w.starts], first, 0).astype(np.int64)
            + (64 << 8) * np.where(mark[w.ends - 1], last, 0).astype(np.int64)).astype(U)


def extract(column) -> Iterator[tuple[int, list[np.ndarray]]]:
    data, offsets = buffers(column)
    distinct = nblinear.Distinct()
    for a, b in groups_of(offsets):
        part, offs = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        w = Words(part, offs, lower=True)
        n = len(w.starts)
        kinds = [nblinear.features_of(mix(w.hashes ^ SALT[0]))]
        run = np.zeros(n, U)
        if n:
            shape = mix(shapes(part, w) ^ SALT[1])
            for k in range(3):
                ahead = np.zeros(n, U)
                ahead[:n - k] = np.where(w.doc[k:] == w.doc[:n - k], shape[k:], 0)
                run = mix(run * U(0x9E3779B97F4A7C15) + ahead)
                kinds.append(nblinear.features_of(mix(run ^ SALT[2 + k])))
        every = np.stack(kinds, 1) if n else np.zeros((0, 1), np.int32)
        yield a, [distinct(every[w.bounds[d]:w.bounds[d + 1]].ravel()) for d in range(b - a)]


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text leaves remainder HELD_OUT; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    ``labels`` has doc_id and ``quality`` (0, 1 or null); held-out ids teach
    nothing. Null and empty texts get the score of a text without features.
    Repeated rows get equal scores. Other columns are not read.
    """
    source = docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                         column_named(docs, text_col).alias("text"))
    known = labels.select("doc_id", F.col("quality").alias("label")).filter(~held_out(F.col("doc_id")))
    model = nblinear.train(source, known, extract)
    return nblinear.score(source, model, extract, carry=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
