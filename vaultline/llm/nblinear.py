"""Linear hinge-loss models over indicators scaled by naive Bayes log-count ratios.

Shared by the quality and toxicity classifiers. ``extract(column)`` yields, for
groups of texts, the distinct hashed features of each text. Training:

1. class counts of every feature over all labelled training rows (summed per
   task, then per slice of the feature space);
2. log-count ratio r of each feature, smoothed towards the class sizes, so a
   feature without evidence gets 0; features in fewer than ``MIN_DOCS``
   training rows get 0;
3. a linear hinge-loss fit by dual coordinate descent on indicators times r,
   over a sample of about ``FIT_ROWS`` training rows of each class (the only
   sampled step, bounded so that it runs in one task);
4. a logistic curve through the margins of the quarter of that sample that
   the fit did not see, weighted back to the class sizes.

Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.llm.arrowtext import U
from vaultline.llm.tables import column_named, materialize, small

BITS, SLICE_BITS = 20, 14
FIT_ROWS, MIN_DOCS, SMOOTHING = 3000, 3, 1.0
COST, ROUNDS, TOLERANCE = 1.0, 12, 0.01
Extract = Callable[[object], Iterator[tuple[int, list[np.ndarray]]]]


class Distinct:
    """Distinct values below 2**BITS in linear time: each value remembers the
    last position that wrote it, and only that position stays."""

    def __init__(self):
        self.last = np.zeros(1 << BITS, np.int32)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        at = np.arange(len(ids), dtype=np.int32)
        self.last[ids] = at
        return ids[self.last[ids] == at]


def features_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U(64 - BITS)).astype(np.int32)


def log_count_ratios(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    n = n_pos + n_neg
    r = np.log((pos + SMOOTHING * n_pos / n) / n_pos) - np.log((neg + SMOOTHING * n_neg / n) / n_neg)
    return np.where(pos + neg >= MIN_DOCS, r, 0.0).astype(np.float32)


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of min 1/2 |w|^2 + COST * sum of hinge losses, where
    row i has the value r[f] at each of its features f, and a constant 1."""
    w, bias, alpha = np.zeros(len(r)), 0.0, np.zeros(len(rows))
    values = [r[f].astype(np.float64) for f in rows]
    norms = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(5)
    for _ in range(ROUNDS):
        most = 0.0
        for i in order.permutation(len(rows)):
            f, v = rows[i], values[i]
            g = y[i] * (w[f] @ v + bias) - 1.0
            if (alpha[i] == 0 and g >= 0) or (alpha[i] == COST and g <= 0):
                continue
            most = max(most, abs(g))
            new = min(max(alpha[i] - g / norms[i], 0.0), COST)
            step = (new - alpha[i]) * y[i]
            if step:
                w[f] += step * v
                bias += step
                alpha[i] = new
        if most < TOLERANCE:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and offset of P(1) = 1 / (1 + exp(-(slope * margin + offset))),
    by Newton steps with a small ridge; targets are drawn in from 0 and 1 (Platt)."""
    n1, n0 = weight[y > 0].sum(), weight[y <= 0].sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    b = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (weight * (p - t)) + 1e-3 * (b - np.array([1.0, 0.0]))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-3
        step = np.linalg.solve(h, g)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(b[0]), 1e-3), float(b[1])


def _counts(extract: Extract):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            label = batch["label"].to_numpy(zero_copy_only=False)
            for a, rows in extract(batch["text"]):
                for i, f in enumerate(rows):
                    seen[label[a + i], f] += 1
        at = np.flatnonzero(seen.any(axis=0))
        cut = np.searchsorted(at >> SLICE_BITS, np.arange((1 << (BITS - SLICE_BITS)) + 1))
        for s, (x, y) in enumerate(zip(cut[:-1], cut[1:])):
            if y > x:
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array([s], pa.int32()),
                    "at": pa.array([(at[x:y] & ((1 << SLICE_BITS) - 1)).astype(np.uint16).tobytes()], pa.binary()),
                    "neg": pa.array([seen[0, at[x:y]].astype(np.uint32).tobytes()], pa.binary()),
                    "pos": pa.array([seen[1, at[x:y]].astype(np.uint32).tobytes()], pa.binary())})
    return counts


def _ratios(n_pos: int, n_neg: int):
    def ratios(table: pa.Table) -> pa.Table:
        sums = np.zeros((2, 1 << SLICE_BITS), np.int64)
        for at, neg, pos in zip(table["at"].to_pylist(), table["neg"].to_pylist(), table["pos"].to_pylist()):
            at = np.frombuffer(at, np.uint16)
            sums[0, at] += np.frombuffer(neg, np.uint32)
            sums[1, at] += np.frombuffer(pos, np.uint32)
        r = log_count_ratios(sums[1], sums[0], n_pos, n_neg)
        return pa.table({"slice": table["slice"].slice(0, 1), "r": pa.array([r.tobytes()], pa.binary())})
    return ratios


def _rows(extract: Extract, ratios):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ratios.value
        for batch in batches:
            for a, found in extract(batch["text"]):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch["doc_id"].slice(a, len(found)), "label": batch["label"].slice(a, len(found)),
                    "f": pa.array([f[r[f] != 0].astype(np.int32).tobytes() for f in found], pa.binary())})
    return rows


def _fit(ratios, n: tuple[int, int]):
    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        r = ratios.value
        rows = [np.frombuffer(x.as_buffer(), np.int32) for x in table["f"]]
        label = table["label"].to_numpy()
        y = np.where(label > 0, 1.0, -1.0)
        # every fourth row of each class is left for the curve, if the class has eight or more
        rank = np.zeros(len(y), np.int64)
        for c in (0, 1):
            at = np.flatnonzero(label == c)
            rank[at] = np.arange(len(at)) if len(at) >= 8 else 0
        held = rank % 4 == 3
        w, bias = dual_coordinate_descent([f for f, h in zip(rows, held) if not h], y[~held], r)
        use = held if held.any() else ~held
        margin = np.array([w[f] @ r[f] + bias for f, u in zip(rows, use) if u])
        weight = np.where(label > 0, n[1] / max((label[use] > 0).sum(), 1), n[0] / max((label[use] <= 0).sum(), 1))[use]
        weight *= use.sum() / weight.sum()
        slope, offset = logistic_curve(margin, y[use], weight)
        return pa.table({"w": pa.array([(w * r).astype(np.float32).tobytes()], pa.binary()),
                         "bias": pa.array([float(bias)]), "slope": pa.array([slope]), "offset": pa.array([offset])})
    return fit


def _score(extract: Extract, model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias, slope, offset = model.value
        for batch in batches:
            for a, found in extract(batch["text"]):
                m = np.array([w[f].sum(dtype=np.float64) for f in found]) + bias
                p = 1 / (1 + np.exp(-np.clip(slope * m + offset, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, len(found)) for i in range(batch.num_columns - 1)]
                    + [pa.array(p, pa.float64())], [*batch.schema.names[:-1], "score"])
    return score


def train(docs: DataFrame, labels: DataFrame, extract: Extract):
    """Broadcast (weights, bias, slope, offset) learnt from ``docs`` (doc_id,
    text) and ``labels`` (doc_id, label 0 or 1).

    Rows without an id, a label or a document teach nothing; of an id's
    repeated labels the more frequent one counts (1 on a tie). With labels of
    one class only, or none, the scores are constant: the share of label 1, or
    one half.
    """
    spark = docs.sparkSession
    y = materialize(labels.filter("doc_id is not null and label is not null").groupBy("doc_id")
                    .agg((F.avg("label") >= 0.5).cast("int").alias("label")), "labels")
    n = {r["label"]: r["count"] for r in y.groupBy("label").count().collect()}
    n_neg, n_pos = n.get(0, 0), n.get(1, 0)
    sc = spark.sparkContext
    if not (n_neg and n_pos):
        share = (n_pos + 0.5) / (n_pos + n_neg + 1)
        return sc.broadcast((np.zeros(1 << BITS, np.float32), 0.0, 1.0, float(np.log(share / (1 - share)))))
    labelled = docs.join(small(y, n_neg + n_pos), "doc_id").select("doc_id", "label", "text")
    slices = (labelled.mapInArrow(_counts(extract), "slice int, at binary, neg binary, pos binary")
              .groupBy("slice").applyInArrow(_ratios(n_pos, n_neg), "slice int, r binary").collect())
    r = np.zeros(1 << BITS, np.float32)
    for s in slices:                      # at most 2**(BITS - SLICE_BITS) rows, 4 MB together
        r[s["slice"] << SLICE_BITS:(s["slice"] + 1) << SLICE_BITS] = np.frombuffer(s["r"], np.float32)
    ratios = sc.broadcast(r)
    place = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    taken = F.when(F.col("label") == 1, place < FIT_ROWS / n_pos).otherwise(place < FIT_ROWS / n_neg)
    sample = docs.join(small(y.filter(taken), min(n_pos, FIT_ROWS) + min(n_neg, FIT_ROWS)), "doc_id") \
        .select("doc_id", "label", "text")
    fitted = (sample.mapInArrow(_rows(extract, ratios), "doc_id bigint, label int, f binary")
              .withColumn("one", F.lit(0)).groupBy("one").applyInArrow(_fit(ratios, (n_neg, n_pos)),
                                              "w binary, bias double, slope double, offset double").first())
    if fitted is None:                    # labels without any document
        share = n_pos / (n_pos + n_neg)
        return sc.broadcast((np.zeros(1 << BITS, np.float32), 0.0, 1.0, float(np.log(share / (1 - share)))))
    return sc.broadcast((np.frombuffer(fitted["w"], np.float32), fitted["bias"], fitted["slope"], fitted["offset"]))


def score(docs: DataFrame, model, extract: Extract, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns named in ``carry`` (all by default) as a struct ``row``, and
    ``score`` between 0 and 1, for every whole text; a null text counts as empty."""
    names = docs.columns if carry is None else carry
    rows = F.struct(*[column_named(docs, c) for c in names]).alias("row")
    packed = docs.select(rows, column_named(docs, text_col).cast("string").alias("text"))
    return packed.mapInArrow(_score(extract, model), T.StructType().add("row", packed.schema["row"].dataType)
                             .add("score", "double"))
