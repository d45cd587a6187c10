"""The feed-forward net against a single-machine run over the same batches, and against finite differences."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tagloom.operators import ffnn
from tagloom.operators import learning as ln


def data(n=240, d=5, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.choice(classes, n, p=[0.6, 0.3, 0.1])
    return rng.normal(0, 1, (n, d)) + 2.5 * rng.normal(0, 1, (classes, d))[y], y


def frame(spark, x, y):
    rows = [(i, Vectors.dense(r), float(c), 1.0) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "label_idx", "weight"])


@pytest.mark.parametrize("dropout", [0.0, 0.4])
def test_gradient_equals_finite_differences(dropout):
    x, y = data(30)
    net = ffnn.Net([5, 7, 4, 3])
    w, weight = net.start(3), np.array([0.5, 1.0, 3.0])
    draw = ffnn._shuffled(np.arange(30, dtype=np.uint64) + np.uint64(9))
    sums = net.gradient(w, x, y, draw, weight, 5, dropout)
    assert sums[1] == pytest.approx(weight[y].sum())
    for i in range(0, net.length, 7):
        e = np.zeros(net.length)
        e[i] = 1e-6
        up, down = (net.gradient(w + s * e, x, y, draw, weight, 5, dropout)[0] for s in (1, -1))
        assert (up - down) / 2e-6 == pytest.approx(sums[2 + i], abs=1e-4)


def test_dropout_hides_the_share_it_should():
    net = ffnn.Net([3, 2000, 2])
    x = np.ones((50, 3))
    w = net.start(1)
    w[: 3 * 2000 + 2000] = 1.0  # every unit is on
    w[3 * 2000 + 2000 :] = 1.0
    draw = ffnn._shuffled(np.arange(50, dtype=np.uint64))
    g = net.gradient(w, x, np.zeros(50, int), draw, np.ones(2), 1, 0.35)[2:]
    seen = np.abs(g[8000:12000].reshape(2000, 2)[:, 0])  # gradient of the output layer: 0.5 x units shown
    assert seen.mean() == pytest.approx(0.5 * 50 * 4, rel=0.03) and seen.std() > 0


def test_losses_do_not_depend_on_packing(spark, monkeypatch):
    x, y = data()
    train = frame(spark, x, y).repartition(5)
    options = dict(hidden=(8, 6), epochs=4, batch_rows=50, dropout=0.3)
    whole = ln.fit_ffnn(train, "id", **options)
    monkeypatch.setattr(ffnn, "BLOCK_ROWS", 13)
    spread = ln.fit_ffnn(train, "id", one_task=0, **options)
    assert spread.losses == pytest.approx(whole.losses, abs=1e-9) and spread.score == whole.score
    assert np.allclose(spread.weights, whole.weights, atol=1e-9)


def test_learns_rare_classes_keeps_the_best_epoch_and_reloads(spark, tmp_path):
    x, y = data(400)
    train = frame(spark, x, y)
    model = ln.fit_ffnn(train, "id", hidden=(32,), epochs=40)
    assert model.losses[-1] < 0.5 * model.losses[0] and model.score > 0.85
    out = sorted(model.transform(train).select("id", "prediction", "proba").collect())
    hit = np.array([r["prediction"] for r in out]) == y
    assert all(hit[y == c].mean() > 0.75 for c in range(3))
    model.save(str(tmp_path / "net"))
    back = ffnn.FeedForward.load(spark, str(tmp_path / "net"))
    assert sorted(back.transform(train).select("id", "prediction", "proba").collect()) == out
