"""Quality rules against a plain Python version of every measurement."""

import random
import re

import pytest

from tagloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(lines), sum(a == b for a, b in zip(words, words[1:])), sum("A" <= c <= "Z" for c in text),
        sum("a" <= c <= "z" for c in text), text.count("!"),
    )


def texts():
    rng = random.Random(4)
    out = [None, "", " \t\n", "é ß", "a\x1cb c d", "one\r\ntwo\none\n one\n", "w " * 9, "x" * 5000, "a b c d e f g h " * 3]
    for n in (10, 60, 200):
        out += [" ".join(rng.choice("ab") for _ in range(n)), " ".join(f"w{rng.randrange(30)}" for _ in range(n))]
        out += ["\n".join(rng.choice(["A line!", "B | c", "   ", ""]) for _ in range(n))]
    return out


def test_measurements_and_bits(spark):
    given = texts() + ["again"] * 2
    rows = [(i, t, "own", 7) for i, t in enumerate(given)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    out = quality.apply_policy(quality.ledger(docs), quality.PROSE, "verdict").collect()
    assert len(out) == len(given)
    for r in out:
        m = dict(zip(quality.MEASURES, by_hand(given[r.doc_id])))
        assert {k: r[k] for k in m} == m, r.doc_id
        bits = sum(1 << i for i, (_, c) in enumerate(quality.RULES) if eval(c, {}, m))
        assert r.fail_bits == bits and r.verdict == (bits == 0) and r.kept == "own"


def test_policies_and_ablation_read_the_ledger_only(spark):
    ledger = spark.createDataFrame([(b,) for b in (0, 0, 1, 2, 3, 4, 5, 256)], "fail_bits long")
    policy = quality.Policy("two", 3, ("few_words", "symbols"))
    assert policy.mask == 5
    assert quality.apply_policy(ledger, policy).filter("kept").count() == 4
    got = {r.rule: tuple(r)[1:] for r in quality.ablation(ledger, policy).collect()}
    assert got == {"few_words": (3, 2, 6), "symbols": (2, 1, 5)}
    empty = quality.ablation(ledger.limit(0), policy).collect()
    assert [tuple(r)[1:] for r in empty] == [(0, 0, 0)] * 2


def test_passing_changes_no_column(spark):
    good = " ".join(f"word{i}" for i in range(30)) + "."
    docs = spark.createDataFrame([(1, good, 99), (2, "short", 99), (None, good, 99)], "doc_id long, text string, n_words int")
    assert sorted(map(tuple, quality.passing(docs, quality.PROSE).collect()), key=repr) == [(1, good, 99), (None, good, 99)]


@pytest.mark.parametrize("quality_label,least", [(1, 0.97), (0, 0.97)])
def test_labelled_documents(spark, quality_label, least):
    sf = "/root/testdata/sf0.01"
    rows = quality.apply_policy(quality.ledger(spark.read.parquet(f"{sf}/documents.parquet")), quality.PROSE)
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter(f"quality = {quality_label}")
    seen = [r.kept == bool(quality_label) for r in rows.filter("n_words >= 20").join(labels, "doc_id").select("kept").collect()]
    assert sum(seen) >= least * len(seen)
