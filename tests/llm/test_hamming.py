"""Exact search against all distances."""

import numpy as np
import pytest

from tagloom.llm import hamming


def by_hand(rows, asked, k):
    items = sorted({(i, c) for i, c in rows if i is not None and c is not None})
    out = set()
    for qi, qc in {(i, c) for i, c in asked if i is not None and c is not None}:
        near = sorted((((c ^ qc) & (2**64 - 1)).bit_count(), i) for i, c in items if i != qi)[:k]
        out |= {(qi, r + 1, i, d) for r, (d, i) in enumerate(near)}
    return out


def codes(rng, n, hot):
    centre = rng.integers(-(2**63), 2**63, 12)
    out = []
    for i in range(n):
        c = int(centre[rng.integers(12)])
        for b in rng.integers(0, 64, rng.integers(0, 14)):
            c ^= 1 << int(b)
        c &= 2**64 - 1
        out.append((i, c - 2**64 if c >= 2**63 else c))
    return [(i, out[0][1]) if i % 3 == 0 else (i, c) for i, c in out] if hot else out


@pytest.mark.parametrize("hot,block", [(False, 1 << 16), (True, 300)])
def test_all_distances(spark, hot, block):
    rows = codes(np.random.default_rng(4), 1200, hot) + [(None, 5), (7000, None)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "id long, code long")
    asked = df.filter("id % 20 = 0")
    got = [tuple(r) for r in hamming.nearest(df, asked, 5, block).collect()]
    assert set(got) == by_hand(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0], 5) and len(got) == len(set(got))


def test_search_stops_only_when_covered():
    rng = np.random.default_rng(9)
    near = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    queries = near[:40] ^ np.uint64(0b1011)
    q, d, i = hamming.Block(near, np.arange(20_000)).search(queries, 3)
    for j in range(40):
        all_d = np.bitwise_count(near ^ queries[j]).astype(int)
        order = np.lexsort((np.arange(20_000), all_d))[:3]
        assert list(i[q == j]) == list(order) and list(d[q == j]) == list(all_d[order])


@pytest.mark.parametrize("n", [3, 40, 500, 2000, 70_000])
def test_index_answers_at_every_size(n):
    """Segments follow the number of codes; what is verified stays a part of them where codes have neighbours."""
    rng = np.random.default_rng(n)
    centres = rng.integers(0, 2**63, max(1, n // 12), dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (n, 3), dtype=np.uint64))
    codes_ = centres[rng.integers(0, len(centres), n)] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]
    block = hamming.Block(codes_, np.arange(n))
    assert sum(block.widths) == 64 and max(block.widths) <= 16 and len(block.widths) == -(-64 // min(max(n.bit_length() - 1, 4), 16))
    queries = codes_[: min(n, 60)]
    q, d, i = block.search(queries, 4)
    for j in range(len(queries)):
        all_d = np.bitwise_count(codes_ ^ queries[j]).astype(int)
        order = np.lexsort((np.arange(n), all_d))[:4]
        assert list(i[q == j]) == list(order) and list(d[q == j]) == list(all_d[order])
    assert block.probed > 0 and 0 < block.verified <= n * len(queries)
    if n >= 500:
        assert block.verified < 0.3 * n * len(queries)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, 3, 0, "a"), (2, 3, 9, "b"), (20, 1, 9, "c")], "id long, code long, rank int, distance string")
    got = sorted(map(tuple, hamming.nearest(df, df.filter("id = 20"), 2).collect()))
    assert got == [(20, 1, 1, 1), (20, 2, 2, 1)]


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(1, 3), (2, 3)], "id long, code long")
    assert sorted(map(tuple, hamming.nearest(df, df).collect())) == [(1, 1, 2, 0), (2, 1, 1, 0)]
    assert hamming.nearest(df.limit(0), df.limit(0)).collect() == []


def test_sign_code(spark):
    df = spark.createDataFrame([([1.0, -1.0, 0.5, 0.0],), (None,), ([None, 2.0],)], "v array<double>")
    assert [r[0] for r in df.select(hamming.sign_code(df.v)).collect()] == [0b1010, None, 1]
