"""Ratios, the dual fit, the curve and whole scores of the classifiers against plain computations."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vaultline.llm import nblinear, quality, toxicity


def _primal(rows, y, r, w, bias):
    """1/2 |(w, bias)|^2 + COST * hinge losses."""
    margin = np.array([w[f] @ r[f] + bias for f in rows]) * y
    return 0.5 * (w @ w + bias * bias) + nblinear.COST * np.maximum(0, 1 - margin).sum()


def _problem(seed, n=60, features=25):
    rng = np.random.default_rng(seed)
    rows = [np.flatnonzero(rng.random(features) < 0.3) for _ in range(n)]
    r = rng.normal(size=features).astype(np.float32)
    y = np.array([1.0 if r[f].sum() + rng.normal() > 0 else -1.0 for f in rows])
    return rows, y, r


@pytest.mark.parametrize("seed", range(4))
def test_dual_fit_equals_a_plain_solver(seed, monkeypatch):
    """Projected gradient ascent on the whole dual, many small steps."""
    monkeypatch.setattr(nblinear, "ROUNDS", 2000)
    monkeypatch.setattr(nblinear, "TOLERANCE", 1e-9)
    rows, y, r = _problem(seed)
    w, bias = nblinear.dual_coordinate_descent(rows, y, r)
    x = np.zeros((len(rows), len(r) + 1))
    for i, f in enumerate(rows):
        x[i, f], x[i, -1] = r[f], 1.0
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha, step = np.zeros(len(rows)), 1 / np.linalg.eigvalsh(q).max()
    for _ in range(60_000):
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, nblinear.COST)
    plain = x.T @ (alpha * y)
    assert np.allclose(np.append(w, bias), plain, atol=2e-3)
    # no gap between the primal and the dual value
    assert abs(_primal(rows, y, r, w, bias) - (alpha.sum() - 0.5 * alpha @ q @ alpha)) < 1e-3


def test_default_rounds_come_near_the_optimum():
    rows, y, r = _problem(9, 300, 40)
    w, bias = nblinear.dual_coordinate_descent(rows, y, r)
    best = min(_primal(rows, y, r, w, bias), _primal(rows, y, r, np.zeros(len(r)), 0.0))
    again = _primal(rows, y, r, *nblinear.dual_coordinate_descent(rows * 1, y, r))
    assert best == again < 0.7 * _primal(rows, y, r, np.zeros(len(r)), 0.0)


def test_curve_is_the_weighted_logistic_fit():
    rng = np.random.default_rng(3)
    margin = rng.normal(size=400) * 2
    y = np.where(rng.random(400) < 1 / (1 + np.exp(-(1.5 * margin - 0.5))), 1, -1)
    weight = rng.uniform(0.5, 2, 400)
    slope, offset = nblinear.logistic_curve(margin, y, weight)

    def loss(a, b):
        n1, n0 = weight[y > 0].sum(), weight[y <= 0].sum()
        t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        z = a * margin + b
        return (weight * (np.logaddexp(0, z) - t * z)).sum() + 5e-4 * ((a - 1) ** 2 + b * b)
    at = loss(slope, offset)
    assert all(at <= loss(slope + a, offset + b) + 1e-9 for a in (-.02, 0, .02) for b in (-.02, 0, .02))
    assert abs(slope - 1.5) < 0.5 and abs(offset + 0.5) < 0.4


def _features(op, texts):
    rows = [None] * len(texts)
    for a, found in op.extract(pa.array(texts, pa.string())):
        rows[a:a + len(found)] = found
    return rows


@pytest.mark.parametrize("op, kind, folds, out, bad", [
    (quality, "quality", 5, 0, lambda t: t.upper()), (toxicity, "toxic", 3, 1, lambda t: t + " you utter fools")])
def test_scores_equal_a_single_machine_run(spark, op, kind, folds, out, bad):
    """Counts, ratios, fit, curve and scores of a small corpus, recomputed on one array at a time."""
    rnd = random.Random(8)
    docs, label = [], {}
    for i in range(160):
        t = " ".join(rnd.choice(["one", "two", "three", "four", "é", "six7"]) for _ in range(30))
        label[i] = int(i % 3 == 0)
        docs.append((i, bad(t) if label[i] else t))
    docs += [(900, None), (901, ""), (902, "unseen words only")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.score for r in op.classify(d, spark.createDataFrame(list(label.items()), f"doc_id long, {kind} int")).collect()}

    train = [(i, t) for i, t in docs if i in label and zlib.crc32(str(i).encode()) % folds != out]
    y = np.array([label[i] for i, _ in train])
    found = _features(op, [t for _, t in train])
    counts = np.zeros((2, 1 << nblinear.BITS))
    for f, c in zip(found, y):
        counts[c, f] += 1
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    smooth = [nblinear.SMOOTHING * n1 / len(y), nblinear.SMOOTHING * n0 / len(y)]
    with np.errstate(divide="ignore"):
        r = np.where(counts.sum(0) >= nblinear.MIN_DOCS,
                     np.log((counts[1] + smooth[0]) / n1) - np.log((counts[0] + smooth[1]) / n0), 0).astype(np.float32)
    used = [f[r[f] != 0] for f in found]
    rank = np.zeros(len(y), int)
    for c in (0, 1):
        rank[y == c] = np.arange((y == c).sum())
    held = rank % 4 == 3
    sign = np.where(y > 0, 1.0, -1.0)
    w, bias = nblinear.dual_coordinate_descent([f for f, h in zip(used, held) if not h], sign[~held], r)
    margin = np.array([w[f] @ r[f] + bias for f, h in zip(used, held) if h])
    weight = np.where(y[held] > 0, n1 / (y[held] > 0).sum(), n0 / (y[held] == 0).sum())
    slope, offset = nblinear.logistic_curve(margin, sign[held], weight * held.sum() / weight.sum())
    for (i, _), f in zip(docs, _features(op, [t for _, t in docs])):
        m = sum(float(np.float32(w[x] * r[x])) for x in f) + bias
        assert abs(got[i] - 1 / (1 + np.exp(-(slope * m + offset)))) < 1e-6, i
