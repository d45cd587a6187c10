"""The factorization machine: pairs that weights miss, held-out accuracy, odd rows."""

import numpy as np
import pytest

from tagloom.llm import toxicity as tx

SCHEMA = "doc_id long, text string"


def crossed(n, seed):
    """Toxic exactly where an insult meets a group; either alone is harmless and more frequent."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        insult, group = rng.random(2) < 0.5
        words = [f"filler{rng.integers(0, 40)}" for _ in range(int(rng.integers(3, 30)))]
        words += ["rotten"] * bool(insult) + ["neighbours"] * bool(group)
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult == group)))
    return rows


def test_pairs_are_learned_that_weights_cannot_hold():
    """Insult and group agree or differ: no weights fit that, one product does."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (800, 2))
    y = (x[:, 0] == x[:, 1]).astype(float)
    flat = np.concatenate([np.flatnonzero(r) for r in x])
    starts = np.concatenate([[0], np.cumsum(x.sum(axis=1))])

    def hits(factors):
        model = tx.Model(np.arange(2), *tx.train(flat, starts, y, np.ones(800), 2, factors=factors))
        return ((model.logits(flat, starts) > 0) == (y == 1)).mean()

    assert hits(4) == 1.0 and hits(0) < 0.8


def test_insult_with_group_mention(spark):
    rows = crossed(1500, 3)
    both = [(i, t, int("rotten" in t and "neighbours" in t)) for i, t, _ in rows]
    docs = spark.createDataFrame([(i, t) for i, t, _ in both], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in both if i < 1000], "doc_id long, toxic int")
    model = tx.fit(docs, labels, min_ratio=1.5)
    got = {r.doc_id: r.predicted for r in tx.scored(docs, model, threshold=0.5).collect()}
    assert all(got[i] == y for i, _, y in both)


def test_logits_equal_the_sum_over_all_pairs():
    rng = np.random.default_rng(2)
    model = tx.Model(np.arange(9), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    texts = [[0, 3, 8], [], [5], [1, 2, 4, 6, 7]]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = model.logits(np.array([i for t in texts for i in t], np.int64), starts)
    for g, t in zip(got, texts):
        pairs = sum(model.factor[a] @ model.factor[b] for i, a in enumerate(t) for b in t[i + 1 :])
        assert g == pytest.approx(0.3 + sum(model.weight[i] for i in t) + pairs)


def test_odd_rows(spark):
    clean = [(i, f"calm words number {i % 7}") for i in range(40)]
    bad = [(100 + i, f"awful gremlin number {i % 7}") for i in range(20)]
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in clean + bad], SCHEMA + ", predicted string, score double")
    labels = [(i, 0) for i, _ in clean] + [(i, 1) for i, _ in bad]
    labels += [(None, 1), (7, None), (8, 5), (3, 0), (9999, 1)]  # unusable, repeated, without text
    labels = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, toxic int, text string")
    model = tx.fit(docs, labels)
    asked = spark.createDataFrame(
        [(1, None), (2, ""), (3, "\n\t "), (None, "gremlin awful"), (5, "AWFUL Gremlin!"), (5, "AWFUL Gremlin!"), (6, "calm words " * 100_000)], SCHEMA
    )
    got = [(r.doc_id, round(r.score, 6), r.predicted) for r in tx.scored(asked, model).collect()]
    assert got[0][1:] == got[1][1:] == got[2][1:] and got[0][2] == 0
    assert [g[2] for g in got[3:]] == [1, 1, 1, 0] and all(0 <= g[1] <= 1 for g in got)
    assert tx.scored(docs, model).columns == ["doc_id", "text", "predicted", "score"]
    assert tx.scored(asked.limit(0), model).collect() == []


def test_nothing_or_one_label_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a word"), (2, "two words")], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert all(r.score < 1e-9 for r in tx.scored(docs, tx.fit(docs, labels.limit(0))).collect())
    assert [r.predicted for r in tx.scored(docs, tx.fit(docs, labels)).collect()] == [1, 1]
    assert [r.predicted for r in tx.scored(docs, tx.fit(docs.limit(0), labels)).collect()] == [0, 0]


def test_sample_is_bounded_whatever_repeats(spark):
    """A hot id with many texts counts once; both labels stay within their bound."""
    rows = [(1, f"hot text {i}") for i in range(300)] + [(i, f"text {i % 5}") for i in range(2, 200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(1, 200)], "doc_id long, t boolean").selectExpr("doc_id", "int(t) AS toxic")
    sample, counts = tx._sampled(docs, labels, "doc_id", "text", "toxic", 20)
    taken = [r.y for r in sample.collect()]
    assert taken.count(0) <= 20 and taken.count(1) <= 20 and len(taken) == 40 and counts == {0: 133, 1: 66}


def test_held_out_accuracy(spark):
    out = tx.op12_toxicity(spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic"), "doc_id"
    ).filter("held_out").collect()
    toxic = [r.predicted for r in out if r.toxic == 1]
    clean = [r.predicted for r in out if r.toxic == 0]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.01
