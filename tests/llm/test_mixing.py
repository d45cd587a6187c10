"""Mixing against a step-by-step scheduler."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tagloom.llm import mixing

RECIPE = {"a": 5, "b": 3, "c": 1, mixing.OTHER: 2}
CHARS = 100


def by_hand(rows, weights):
    """Slots by a scheduler that looks at one slot after another."""
    group = lambda s: s if s in weights and s != mixing.OTHER else mixing.OTHER
    docs = defaultdict(list)
    for i, t, s in rows:
        docs[group(s)].append((hashlib.md5(str(i).encode()).hexdigest(), i, len(t or "")))
    blocks = {}
    for s, ds in docs.items():
        at = 0
        for _, i, n in sorted(ds):
            blocks[i] = (s, at // CHARS)
            at += n
    names, total = sorted(docs), sum(weights[s] for s in docs)
    done, slot_of = Counter(), {}
    for t in range(total * (2 + max(k for _, k in blocks.values()))):
        ready = [(-(-(done[s] + 1) * total // weights[s]), s) for s in names if done[s] * total // weights[s] <= t]
        s = min(ready)[1]
        slot_of[s, done[s]] = t
        done[s] += 1
    return {i: (s, k, slot_of[s, k]) for i, (s, k) in blocks.items()}, slot_of, total


def test_slots_follow_the_scheduler(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.choice([0, 1, 30, 90, 250, 900]), rng.choices(["a", "b", "c", "d", None], [5, 2, 2, 1, 1])[0]) for i in range(400)]
    rows += [(900, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.schedule(df, RECIPE, CHARS).collect()
    hand, slot_of, total = by_hand(rows, RECIPE)
    assert {r.doc_id: (r.mix_source, r.block, r.slot) for r in got} == hand and len(got) == len(rows)
    for s in {s for s, _ in slot_of}:  # never a whole block away from the share
        taken = sorted(t for (x, _), t in slot_of.items() if x == s)
        for t in range(total):
            assert abs(sum(x < t for x in taken) - t * RECIPE[s] / total) < 1


def test_rows_come_in_order_of_the_mix(spark):
    rows = [(i, "y" * 50, "abc"[i % 3], i) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, slot int")
    out = mixing.interleaved(df, weights=RECIPE, block_chars=CHARS)
    assert out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    hand, _, _ = by_hand([r[:3] for r in rows], RECIPE)
    slots = [hand[r[0]][2] for r in got]
    assert slots == sorted(slots) and sorted(r[0] for r in got) == list(range(90))


def test_edges(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.schedule(spark.createDataFrame([], schema), RECIPE).collect() == []
    got = mixing.schedule(spark.createDataFrame([(None, "a", None), (None, "a", None)], schema), RECIPE).collect()
    assert [(r.mix_source, r.block, r.slot) for r in got] == [(mixing.OTHER, 0, 0)] * 2
    with pytest.raises(ValueError):
        mixing.schedule(spark.createDataFrame([], schema), {"a": 1})
