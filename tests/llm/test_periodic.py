"""Periodic runs against a plain search over all periods."""

import hashlib
import itertools
import math
import time
import zlib

import numpy as np
import pytest

from tagloom.llm import periodic


def plain_runs(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)  # the least period comes first
            i = max(j, i + 1)
    return sorted(((s, x, q) for (s, x), q in found.items()), key=lambda r: (r[0], r[2]))


def by_hand(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, x, q in runs for i in range(s + q, s + x)}
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(((-x, s, q) for s, x, q in runs), default=None)
    top = (best[1], -best[0], best[2], math.floor(-1000 * best[0] / best[2])) if best else (None,) * 4
    lines = "".join(f"{s},{x},{q}\n" for s, x, q in runs)
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


@pytest.mark.parametrize("letters,n", [(2, 13), (2, 14), (3, 8)])
def test_every_word_of_a_length(letters, n):
    words = np.array(list(itertools.product(range(letters), repeat=n)))
    joined = np.concatenate([words, np.full((len(words), 1), -1)], axis=1).ravel()
    got = {}
    for s, x, q in periodic.find_runs(joined, 1).tolist():
        got.setdefault(s // (n + 1), []).append((s % (n + 1), x, q))
    for i, word in enumerate(words.tolist()):
        assert got.get(i, []) == plain_runs(word, 1)


def test_nested_repeats():
    rng = np.random.default_rng(2)
    for _ in range(150):
        x = rng.integers(0, 2, int(rng.integers(20, 160)))
        for _ in range(3):
            a, p = int(rng.integers(0, len(x))), int(rng.integers(1, 30))
            for i in range(a + p, len(x)):
                x[i] = x[i - p]
            x[rng.integers(0, len(x))] ^= 1
        assert [tuple(r) for r in periodic.find_runs(x, 1).tolist()] == plain_runs(x.tolist(), 1)


def test_long_sequences_stay_fast():
    start = time.perf_counter()
    assert periodic.find_runs(np.zeros(300_000, np.int64)).tolist() == [[0, 300_000, 1]]
    assert periodic.find_runs(np.tile([0, 1, 0, 2], 50_000)).tolist() == [[0, 200_000, 4]]
    assert len(periodic.find_runs(np.random.default_rng(1).permutation(1_000_000))) == 0
    assert time.perf_counter() - start < 20


DOCS = [
    (1, "a b " * 10), (2, "x " * 12), (3, "x " * 11), (4, "one two three four five six " * 2), (4, "one two three four five six " * 2),
    (5, None), (6, ""), (7, " \t\n\x0b\x0c\r "), (8, "é\xa0ü " * 13 + "end"), (None, "q r s t " * 4), (9, "word"),
    (10, "aa ab " * 7 + "b " + "ab aa " * 7), (11, "a b c d e f\n" * 3 + "a b c x e f\n" * 3),
] + [(i, " ".join(f"w{(i * j) % 23}" for j in range(i % 60))) for i in range(100, 260)]


def test_documents(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "old") for i, t in DOCS], "doc_id long, text string, n_runs int, runs string")
    got = rows(periodic.digests(df.repartition(4)))
    expected = [by_hand(i, t) for i, t in DOCS]
    assert got == sorted(expected, key=repr)
    assert sum(r[1] > 0 for r in expected) > 20
    assert periodic.digests(df.limit(0)).collect() == []


def test_operator_keeps_columns_and_replaces_its_own(spark):
    df = spark.createDataFrame([(1, "go go " * 8 + "home", "kept", "old")], "doc_id int, body string, extra string, runs string")
    row = periodic.periodic_runs(df, "body").first()
    assert (row.extra, row.n_words, row.collapsed) == ("kept", 17, "go home")
    assert [tuple(r) for r in row.runs] == [(0, 16, 1)]
    assert periodic.periodic_runs(df, "body", min_length=17).first().runs == []


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(150_000)) + " tick tock" * 100_000
    row = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert row.n_words == 350_000 and [tuple(r) for r in row.runs] == [(150_000, 200_000, 2)]
    assert row.collapsed.endswith("w149999 tick tock")


def test_whole_table(spark):
    import duckdb

    found = {tuple(r) for r in periodic.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' WHERE length(text) < 6000").fetchall()
    assert {by_hand(i, t) for i, t in docs} <= found and len(found) == 200
