"""Near-duplicate groups against brute force over all pairs."""

import random
import re

import pytest

from tagloom.llm import minhash

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = BLANKS.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute_force(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    common = {}
    for ks in holders.values():
        for a in range(len(ks)):
            for b in range(a):
                common[ks[b], ks[a]] = common.get((ks[b], ks[a]), 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = find(sets[a][0]), find(sets[b][0])
            root[max(x, y)] = min(x, y)
    return {(i, len(s), find(i), i == find(i)) for i, s in sets}


def edited(rng, words, rate):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < rate else w for w in words)


def family(rng, n, size, rates):
    base = [f"w{rng.randrange(4000)}" for _ in range(size)]
    return [edited(rng, base, rng.choice(rates)) for _ in range(n)]


def got(df):
    return {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_families_passages_and_copies(spark):
    rng = random.Random(11)
    texts = family(rng, 120, 150, [0, 0.01, 0.02, 0.03, 0.05]) + family(rng, 40, 30, [0.02, 0.05])
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.choice([10, 30, 90]))) for _ in range(60)]
    base = [f"c{i}" for i in range(200)]
    texts += [" ".join(base[: 200 - 9 * k]) for k in range(16)]  # ever shorter copies: a chain
    texts += ["", "  \t", None, "one two", "ONE two", "one two three", "A b c d e", "a B c d e", texts[0], texts[0]]
    rng.shuffle(texts)
    rows = list(enumerate(texts, start=5))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash.duplicate_groups(df)) == brute_force(rows)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert got(minhash.op5_minhash_dedup(spark, "/root/testdata/sf0.01")) == brute_force(rows)


def test_nulls_repeats_and_clashing_columns(spark):
    t = "a b c d e f g h"
    rows = [(None, t, 1), (3, t, 2), (3, t, 2), (2, t, 3), (9, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    out = sorted(map(tuple, minhash.duplicate_groups(df).collect()), key=repr)
    assert out == sorted([(None, 4, None, True), (3, 4, 2, False), (3, 4, 2, False), (2, 4, 2, True), (9, 0, 9, True)], key=repr)
    kept = sorted(map(tuple, minhash.deduplicated(df).collect()), key=repr)
    assert kept == sorted([(None, t, 1), (2, t, 3), (9, None, 4)], key=repr)
    assert minhash.duplicate_groups(df.limit(0)).collect() == []


def test_densified_bins_agree_as_often_as_sets(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    for size in (8, 60, 900):
        agree = []
        for _ in range(60):
            x = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
            cut = len(x) // 7
            a, b = x[cut:], x[: len(x) - cut]
            a, b = np.sort(a), np.sort(b)
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append((minhash.signature(a) == minhash.signature(b)).mean() - j)
        assert abs(np.mean(agree)) < 0.06
