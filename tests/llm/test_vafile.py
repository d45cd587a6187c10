"""VA-file clustering against plain whole-number k-means."""

import hashlib
import math

import numpy as np
import pytest

from tagloom.llm import vafile


def by_hand(rows, dims, k, rounds, scale=64):
    kept = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]

    def order(row):
        i, v = row
        return (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v)

    centroids = [v for _, v in sorted(kept, key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for n, vs in own.items():
            centroids[n] = [sum(xs) // len(vs) for xs in zip(*vs)]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    return out, centroids


def check(spark, rows, dims, k, rounds=3, **more):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string")
    got, centroids = vafile.cluster(df.repartition(3), dims=dims, k=k, rounds=rounds, **more)
    out, expected = by_hand(rows, dims, k, rounds)
    assert centroids == expected
    sums = {}
    for _, c, d in out:
        sums[c] = sums.get(c, 0) + d
    total = sum(sums.values())
    full = [
        (i, c, d, sums[c], total, hashlib.sha256(",".join(map(str, expected[c])).encode()).hexdigest()) for i, c, d in out
    ]

    def fits(x):
        return x if not isinstance(x, int) or x < 1 << 63 else None

    assert sorted(map(tuple, got.collect()), key=repr) == sorted((tuple(map(fits, r)) for r in full), key=repr)


@pytest.mark.parametrize("bits", [2, 5])
def test_blobs_ties_and_rows_left_out(spark, bits):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 2, (5, 6))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.2, 6)).tolist()) for i in range(600)]
    rows += [(i, [0.5, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(700, 900)]  # a hot vector
    rows += rows[:20]  # repeated rows
    rows += [(1000, None), (1001, [0.1] * 5), (1002, [0.1] * 7), (1003, [0.1] * 5 + [None]), (None, [0.2] * 6)]
    rows += [(1004, [float("nan")] * 6), (1005, [float("inf")] + [0.0] * 5), (1006, []), (1007, [float("-inf")] + [0.0] * 5)]
    check(spark, rows, 6, 7, bits=bits, sample=100)


def test_huge_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 4) * 10.0 ** rng.integers(0, 4)).tolist()) for i in range(100)]
    rows += [(200, [1e30, 0.0, -1e30, 1.0]), (201, [3.4e38] * 4), (202, [-1e12, 1e12, 0.5, -0.5])]
    check(spark, rows, 4, 5)
    beyond = spark.createDataFrame([(1, [1e308, 0.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [r.id for r in vafile.cluster(beyond, dims=2)[0].collect()] == [2]


def test_equal_starts_few_rows_and_none(spark):
    check(spark, [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0])], 2, 2)  # equal centroids: the smaller number
    check(spark, [(1, [0.5, 0.25])], 2, 16)
    check(spark, [], 2, 16)
    check(spark, [(1, None)], 2, 16)


def test_vectors_are_fetched_only_where_brackets_overlap():
    rng = np.random.default_rng(8)
    centres = rng.integers(-60, 60, (8, 64))
    vectors = (centres[rng.integers(0, 8, 5000)] + rng.integers(-6, 7, (5000, 64))).astype(float)
    cells = vafile.Cells.fit(vectors[:500], vectors.min(axis=0), vectors.max(axis=0), 4)
    fetched = []

    def fetch(places):
        fetched.extend(places)
        return vectors[places]

    assigner = vafile.Assigner(cells, centres.tolist())
    got, overlap = assigner.nearest(cells.pack(vectors), fetch)
    expected = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (got == expected).all() and list(overlap) == fetched and len(fetched) < 50
    near = vectors[:400] * 0 + (centres[0] + centres[1]) // 2  # between two centroids: the cells cannot decide
    got, overlap = assigner.nearest(cells.pack(near), lambda places: near[places])
    assert len(overlap) == 400
    assert (got == ((near[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_brackets_hold_the_distance():
    rng = np.random.default_rng(9)
    vectors = np.floor(rng.standard_t(2, (2000, 5)) * 40)
    cells = vafile.Cells.fit(vectors[:64], vectors.min(axis=0), vectors.max(axis=0), 3)
    assert (cells.unpack(cells.pack(vectors)) < 8).all()
    a = vafile.Assigner(cells, vectors[:9].astype(int).tolist())
    cell = cells.unpack(cells.pack(vectors))
    low = sum(a.least[j, cell[:, j]] for j in range(5))
    high = sum(a.most[j, cell[:, j]] for j in range(5))
    d = ((vectors[:, None] - vectors[None, :9]) ** 2).sum(axis=2)
    assert (low <= d).all() and (d <= high).all()
