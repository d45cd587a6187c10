"""Language identification against a slow version of the same trees, and on held-out documents."""

import math
import random
from collections import Counter, defaultdict

import pytest

from tagloom.llm import langid

SF_DIR = "/root/testdata/sf0.01"


class Slow:
    """Trees as dictionaries, one byte at a time."""

    def __init__(self, samples):
        self.langs = sorted(samples)
        self.counts = {x: defaultdict(Counter) for x in self.langs}
        for lang, texts in samples.items():
            for t in texts:
                raw = langid.START + t.encode()
                for i in range(langid.ORDER, len(raw)):
                    for size in range(langid.ORDER + 1):
                        self.counts[lang][raw[i - size : i]][raw[i]] += 1
        total = Counter()
        for lang in self.langs:
            for c, n in self.counts[lang].items():
                total[c] += sum(n.values())
        self.nodes = {c for c, n in total.items() if not c or n >= langid.MIN_CONTEXT}

    def cost(self, lang, context, byte):
        while context not in self.nodes:
            context = context[1:]
        n = self.counts[lang][context]
        weight = sum(n.values()) + len(n)
        if n[byte]:
            return -math.log(n[byte] / weight)
        escape = -math.log(len(n) / weight) if n else 0.0
        return escape + (self.cost(lang, context[1:], byte) if context else math.log(256))

    def lengths(self, text):
        raw = langid.START + text.encode()
        return [sum(self.cost(x, raw[i - langid.ORDER : i], raw[i]) for i in range(langid.ORDER, len(raw))) for x in self.langs]


def test_code_lengths(spark):
    rng = random.Random(1)
    words = {"xx": ["ab", "abba", "é", "cab"], "yy": ["za", "zaz", "ab", "ü"], "zz": ["01", "ab", "za"]}
    samples = {x: [" ".join(rng.choice(w) for _ in range(60)) for _ in range(5)] for x, w in words.items()}
    rows = [(x, t) for x, ts in samples.items() for t in ts] + [(None, "zz zz"), ("xx", None), ("yy", "")]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    slow = Slow(samples)
    texts = ["ab", "abba za é", "q", "01 za cab \n ü", "é" * 40, " ".join(samples["yy"])]
    got = model.compiled().lengths([t.encode() for t in texts + [""]])
    assert model.langs == slow.langs and list(got[-1]) == [0, 0, 0]
    for g, t in zip(got, texts):
        assert g == pytest.approx(slow.lengths(t), rel=1e-5)


def test_thirty_languages_one_of_them_tiny(spark):
    """The bound holds for each language by itself: a rare one keeps its tree."""
    rng = random.Random(5)
    letters = [chr(c) for c in range(0x61, 0x7B)]
    words = {f"l{i:02d}": ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(60)] for i in range(30)}
    rows = [(x, " ".join(rng.choice(w) for _ in range(80))) for x, w in words.items() for _ in range(2 if x == "l17" else 40)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"), grams_per_lang=1100)
    assert model.langs == sorted(words) and all(600 < (model.lang == i).sum() <= 1100 for i in range(30))
    slow = Slow({x: [t for y, t in rows if y == x] for x in words})
    kept = {(int(c), int(x)): (int(t), int(d)) for c, x, t, d in zip(model.context, model.at_lang, model.total, model.distinct)}
    for (code, at), (total, distinct) in list(kept.items())[:500]:
        size = (code.bit_length() - 1) // 8
        counts = slow.counts[model.langs[at]][(code & ((1 << (8 * size)) - 1)).to_bytes(size, "big")]
        assert (total, distinct) == (sum(counts.values()), len(counts))
    asked = [(x, " ".join(rng.choice(w) for _ in range(30))) for x, w in words.items()] + [("l17", " ".join(rng.choice(words["l17"]) for _ in range(40_000)))]
    names, _ = langid.judge(model, [t.encode() for _, t in asked], [True] * len(asked))
    assert list(names) == [x for x, _ in asked]


def test_equal_code_lengths_go_to_the_lesser_name(spark):
    model = langid.fit(spark.createDataFrame([("bb", "abc abc"), ("aa", "abc abc")], "lang string, text string"))
    names, scores = langid.judge(model, [b"abc"], [True])
    assert list(names) == ["aa"] and scores[0] == pytest.approx(0.5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = langid.op3_language_id(spark, SF_DIR).join(docs, "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    for side in (True, False):
        part = [r.lang == r.lang_pred for r in rows if r.held_out == side]
        assert len(part) > 100 and sum(part) >= 0.99 * len(part)


def test_nothing_to_say(spark):
    schema = "doc_id long, text string, score string"
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (3, "12 + 3!", "s"), (4, "abc", "s"), (4, "abc", "s")], schema)
    model = langid.fit(spark.createDataFrame([("aa", "abc abc abd")], "lang string, text string"))
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model).collect())
    assert got == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "aa", 1.0), (4, "aa", 1.0)]
    none = langid.fit(docs.selectExpr("cast(null as string) AS lang", "text"))
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, none).collect()} == {("und", 0.0)}
    assert langid.predict(docs.limit(0), model).collect() == []
