"""Boosting against a plain version that looks at every split of every node."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tagloom.operators import boosting as bo
from tagloom.operators import learning as ln


def plain(bins, y, classes, rounds, depth, rate):
    """Training loss before each round; residual trees grown node by node, rows listed per node."""
    n, d = bins.shape
    counts = np.bincount(y, minlength=classes) / n
    raw = np.tile(np.log(counts) if classes > 2 else [np.log(counts[1] / counts[0])], (n, 1))
    losses = []
    for _ in range(rounds):
        if classes > 2:
            p = np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)
            residual = (y[:, None] == np.arange(classes)) - p
        else:
            p1 = 1 / (1 + np.exp(-raw[:, 0]))
            p = np.stack([1 - p1, p1], axis=1)
            residual = (y - p1)[:, None]
        losses.append(-np.log(p[np.arange(n), y]).mean())
        for c in range(raw.shape[1]):
            r = residual[:, c]
            nodes = [(np.arange(n), 0)]
            while nodes:
                rows, level = nodes.pop()
                best = (1e-12, None)
                for j in range(d if level < depth else 0):
                    for cut in range(bo.BINS - 1):
                        left = bins[rows, j] <= cut
                        a, b = left.sum(), (~left).sum()
                        if a and b:
                            gain = (b * r[rows][left].sum() - a * r[rows][~left].sum()) ** 2 / (a * b)
                            if gain > best[0] * (1 + 1e-12):
                                best = (gain, left)
                if best[1] is not None:
                    nodes += [(rows[best[1]], level + 1), (rows[~best[1]], level + 1)]
                    continue
                curve = (np.abs(r[rows]) * (1 - np.abs(r[rows]))).sum()
                shrink = rate * ((classes - 1) / classes if classes > 2 else 1)
                raw[rows, c] += shrink * (r[rows].sum() / curve if curve > 1e-150 else 0)
    return losses


def data(classes, n=120, d=4, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.choice(classes, n, p=np.arange(1, classes + 1) / sum(range(1, classes + 1)))
    x = rng.normal(0, 1, (n, d)) + 0.8 * rng.normal(0, 1, (classes, d))[y]
    x[:, 0] = np.round(x[:, 0])  # many equal values
    return x, y


def frame(spark, x, y):
    rows = [(i, Vectors.dense(r), float(c), 1.0) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "label_idx", "weight"])


@pytest.mark.parametrize("classes", [2, 4])
def test_loss_of_every_round_equals_a_plain_version(spark, classes):
    x, y = data(classes)
    model = ln.fit_gbm(frame(spark, x, y).repartition(3), trees=6, depth=3, rate=0.3)
    assert model.losses == pytest.approx(plain(model.binned(x).astype(int), y, classes, 6, 3, 0.3), abs=1e-9)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:]))


def test_many_blocks_and_chunks_give_the_same_rounds(spark, monkeypatch):
    x, y = data(3, 200, 5)
    train = frame(spark, x, y).repartition(6)
    monkeypatch.setattr(bo, "REPLAYED", 2)  # scores are written twice on the way
    whole = ln.fit_gbm(train, trees=5, depth=2)
    monkeypatch.setattr(bo, "CHUNK_CELLS", 3 * 3 * 2 * bo.BINS)
    spread = ln.fit_gbm(train, trees=5, depth=2, block_cells=50, one_task=0)
    assert spread.losses == pytest.approx(whole.losses, abs=1e-9)
    assert all((a.feature == b.feature).all() and (a.cut == b.cut).all() for a, b in zip(whole.rounds, spread.rounds))


def test_probabilities_reload_and_borders(spark, tmp_path):
    x, y = data(3, 150)
    train = frame(spark, x, y)
    model = ln.fit_gbm(train, trees=20, depth=3)
    assert all(len(b) < bo.BINS for b in model.borders)
    ordered = np.argsort(x[:, 0])
    assert (np.diff(model.binned(x)[ordered, 0].astype(int)) >= 0).all() and set(model.borders[0]) <= set(x[:, 0])
    out = sorted(model.transform(train).select("id", "prediction", "proba").collect())
    p = np.array([r["proba"] for r in out])
    assert np.allclose(p.sum(axis=1), 1) and [r["prediction"] for r in out] == p.argmax(axis=1).tolist()
    assert np.mean(p.argmax(axis=1) == y) > 0.95
    model.save(str(tmp_path / "gbm"))
    again = bo.GradientBoosting.load(spark, str(tmp_path / "gbm"))
    assert sorted(again.transform(train).select("id", "prediction", "proba").collect()) == out and again.losses == model.losses


def test_one_value_and_pure_nodes(spark):
    x, y = np.ones((30, 2)), np.arange(30) % 3
    model = ln.fit_gbm(frame(spark, x, y), trees=3, depth=2)
    assert all((t.feature == -1).all() for t in model.rounds) and model.losses == pytest.approx([np.log(3)] * 3)
