"""The calibrated machines against dense single-machine versions."""

from threading import Barrier

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom.operators import learning as ln
from tagloom.operators import passes as ps
from tagloom.operators import svm
from tagloom.scratch import Scratch


def newton(x, y, cost):
    """Plain minimiser of 1/2 |w|^2 + sum cost max(0, 1 - y w.x)^2."""
    w = np.zeros(x.shape[1])

    def value(w):
        return 0.5 * w @ w + (cost * np.maximum(1 - y * (x @ w), 0) ** 2).sum()

    for _ in range(200):
        slack = np.maximum(1 - y * (x @ w), 0)
        g = w - 2 * x.T @ (cost * y * slack)
        if np.linalg.norm(g) < 1e-10:
            break
        live = slack > 0
        step = -np.linalg.solve(np.eye(len(w)) + 2 * (x[live].T * cost[live]) @ x[live], g)
        t = 1.0
        while value(w + t * step) > value(w) + 1e-4 * t * (g @ step) and t > 1e-8:
            t /= 2
        w = w + t * step
    return w


def data(classes=4, n=300, d=6, seed=0, sparse=False):
    rng = np.random.default_rng(seed)
    y = rng.choice(classes, n, p=np.arange(1, classes + 1) / sum(range(1, classes + 1)))
    x = rng.normal(0, 1, (n, d)) + rng.normal(0, 1, (classes, d))[y]
    if sparse:
        x[rng.random((n, d)) < 0.85] = 0.0
    return x, y


def frame(spark, x, y, sparse=False):
    def vector(row):
        at = np.flatnonzero(row)
        return Vectors.sparse(len(row), at.tolist(), row[at].tolist()) if sparse else Vectors.dense(row)

    rows = [(i, vector(r), float(c), 1.0) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "label_idx", "weight"])


def machine_costs(y, fold, f, k, classes, c=1.0):
    inside = fold != f
    counts = np.bincount(y[inside], minlength=classes)
    balanced = inside.sum() / ((counts > 0).sum() * np.maximum(counts, 1))
    own = np.where(y == k, balanced[k], balanced[0] if classes == 2 else 1.0)
    return inside, np.where(y == k, 1.0, -1.0), c * own


@pytest.mark.parametrize("classes,sparse,cells", [(4, False, svm.HESSIAN_CELLS), (4, False, 0), (2, False, svm.HESSIAN_CELLS), (3, True, 0)])
def test_weights_equal_a_dense_minimiser(spark, classes, sparse, cells):
    d = 40 if sparse else 6
    x, y = data(classes, 300, d, sparse=sparse)
    fold = np.arange(len(y)) % 3
    rows = frame(spark, x, y, sparse).withColumn("fold", (F.col("id") % 3).cast("int")).repartition(4)
    blocks = ps.packed(rows.select("features", "label_idx", "fold"), Scratch(spark, "t"), cells=500)
    assert blocks.count() > 4 and (not sparse or ps.Block(blocks.first()).x.dense is None)
    sizes = np.array([[((fold == f) & (y == k)).sum() for k in range(classes)] for f in range(3)], float)
    passes = ps.Passes(blocks)
    got = svm.fit_margins(passes, d + 1, sizes, 1.0, 100, 1e-9, cells)
    ones = np.hstack([x, np.ones((len(x), 1))])
    for f in range(3):
        for at, k in enumerate([1] if classes == 2 else range(classes)):
            inside, sign, cost = machine_costs(y, fold, f, k, classes)
            assert np.abs(got[:, f, at] - newton(ones[inside], sign[inside], cost[inside])).max() < 1e-4
    # sigmoids: no slope or shift nearby has a smaller loss on the rows held out
    slope, shift = svm.fit_sigmoids(passes, got, sizes)
    for f in range(3):
        held = fold == f
        for at, k in enumerate([1] if classes == 2 else range(classes)):
            m, own = ones[held] @ got[:, f, at], y[held] == k
            t = np.where(own, (own.sum() + 1) / (own.sum() + 2), 1 / ((~own).sum() + 2))

            def loss(a, b):
                z = a * m + b
                return (np.logaddexp(0, z) - t * z).sum()

            best = loss(slope[f, at], shift[f, at])
            assert all(best <= loss(slope[f, at] + i, shift[f, at] + j) + 1e-9 for i in (-0.01, 0, 0.01) for j in (-0.01, 0, 0.01))


def test_many_tasks_add_in_groups(spark, monkeypatch):
    x, y = data(3, 200)
    rows = frame(spark, x, y).withColumn("fold", F.lit(0)).repartition(9)
    blocks = ps.packed(rows, Scratch(spark, "t"), cells=100)
    monkeypatch.setattr(ps, "DIRECT", 2)
    passes = ps.Passes(blocks)
    n, total = passes.summed(lambda r: [[len(ps.Block(r).label)], ps.Block(r).x.dense.sum(axis=0)], [(1,), (7,)])
    assert n[0] == 200 and np.allclose(total[:6], x.sum(axis=0)) and total[6] == 200


@pytest.mark.parametrize("classes", [2, 4])
def test_probabilities_and_reload(spark, tmp_path, classes):
    x, y = data(classes, 240)
    train = frame(spark, x, y)
    model = ln.fit_svc_calibrated(train, "id", 3)
    out = model.transform(train).select("id", "label_idx", "prediction", "proba").collect()
    p = np.array([r["proba"] for r in out])
    assert p.shape == (240, classes) and np.allclose(p.sum(axis=1), 1)
    assert [r["prediction"] for r in out] == p.argmax(axis=1).tolist()
    assert np.mean([r["prediction"] == r["label_idx"] for r in out]) > 0.7
    model.save(str(tmp_path / "svc"))
    again = svm.CalibratedSvc.load(spark, str(tmp_path / "svc")).transform(train).select("id", "proba").collect()
    assert [r["proba"] for r in sorted(again)] == [r["proba"] for r in sorted(out)]


def test_a_label_missing_outside_a_fold(spark):
    x, y = data(3, 60)
    y[:] = np.arange(60) % 2
    y[0] = 2  # a single row
    model = ln.fit_svc_calibrated(frame(spark, x, y), "id", 5)
    assert model.classes == 3 and model.transform(frame(spark, x, y)).count() == 60


def test_one_task_and_many_fit_the_same_machines(spark):
    x, y = data(3, 150)
    train = frame(spark, x, y).repartition(3)
    whole, spread = ln.fit_svc_calibrated(train, "id", 3), ln.fit_svc_calibrated(train, "id", 3, one_task=0)
    assert np.allclose(whole.weights, spread.weights, atol=1e-6) and np.allclose(whole.slope, spread.slope, atol=1e-5)
    assert np.allclose(whole.shift, spread.shift, atol=1e-5)


def test_blocks_hold_their_order_by_column_and_come_in_many(spark):
    """300,000 stored numbers: a pass has several blocks, and none sorts its entries again."""
    rng = np.random.default_rng(5)
    rows = [(Vectors.sparse(5000, sorted(rng.choice(5000, 300, False).tolist()), [1.0] * 300), float(i % 2), i % 5) for i in range(1000)]
    blocks = ps.packed(spark.createDataFrame(rows, ["features", "label_idx", "fold"]).coalesce(1), Scratch(spark, "order")).collect()
    assert len(blocks) > 1
    for row in blocks:
        entry = np.frombuffer(row.entry, np.int64)
        assert np.array_equal(np.frombuffer(row.order, np.int64), np.argsort(entry, kind="stable"))


def test_folds_are_fitted_at_the_same_time(spark):
    both = Barrier(2, timeout=60)

    def fit(train):
        both.wait()
        return ln.fit_majority(train)

    rows = spark.createDataFrame([(i, float(i % 3 == 0)) for i in range(60)], "id long, label_idx double")
    out = ln.cross_validate(fit, rows, "id", 2).orderBy("fold").collect()
    assert [r.fold for r in out] == [0, 1] and all(abs(r.f1_macro - 0.4) < 0.02 for r in out)


def test_a_task_per_machine_fits_the_same_machines(spark, monkeypatch):
    x, y = data(3, 150, 40, sparse=True)
    train = frame(spark, x, y, sparse=True).repartition(3)
    monkeypatch.setattr(svm.in_products, "__defaults__", (0,))
    fits = [ln.fit_svc_calibrated(train, "id", 3, one_task=0, own_tasks=n, tol=1e-9) for n in (1 << 23, 0)]
    assert np.abs(fits[0].weights - fits[1].weights).max() < 1e-5 and fits[0].weights.shape == (41, 3, 3)
    assert np.allclose(fits[0].slope, fits[1].slope, atol=1e-4) and np.allclose(fits[0].shift, fits[1].shift, atol=1e-4)
    single = svm.fit_margins(ps.Held([]), 41, np.ones((3, 3)), 1.0, 5, 1e-5, own=(1, 2))
    assert single.shape == (41, 1, 1)


def test_sparse_products_go_by_pieces_and_skip_empty_rows(monkeypatch):
    monkeypatch.setattr(ps, "PIECE", 16)
    x, _ = data(3, 90, 60, sparse=True)
    x[::7] = 0.0
    row, column = np.nonzero(x)
    start = np.concatenate([[0], np.cumsum((x != 0).sum(axis=1))])
    held, rng = ps.Matrix(60, start, column, x[row, column]), np.random.default_rng(1)
    assert held.dense is None and len(held.pieces()) > 4
    w, r = rng.normal(size=(60, 3)), rng.normal(size=(90, 2))
    w[:, 1] = 0.0
    assert np.allclose(held.times(w), x @ w) and np.allclose(held.transposed_times(r), x.T @ r)
    some = rng.random(90) < 0.5
    assert np.allclose(held.where(some).times(w), x[some] @ w)
