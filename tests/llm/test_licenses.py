"""License scans against all templates on all sections, without bounds."""

import random
import time
from importlib.resources import files

import pytest

from tagloom.llm import licenses


def unbounded(section):
    w = licenses.words_of(section)
    grams = set(zip(w, w[1:]))
    best = [(-2 * len(grams & own) / (len(grams) + n), name) for n, name, own in licenses.templates() if grams]
    d, name = min(best, default=(0, None))
    return (-d, name) if -d >= licenses.THRESHOLD else None


def test_bounds_lose_nothing():
    rng = random.Random(6)
    match = licenses.Matcher(licenses.THRESHOLD)
    texts = [t for t in licenses.NOTICES.values()] + [p.format(n[0]) for p in licenses.PHRASES for n in licenses.NAMES.values()]
    for t in texts:
        for rate in (0, 0.05, 0.15, 0.4):
            w = [x if rng.random() >= rate else rng.choice(["", "foo", x + " bar"]) for x in t.split()]
            section = " ".join(w)
            assert match.best(section) == unbounded(section)


def test_sections(spark):
    mit = licenses.NOTICES["MIT"]
    wrapped = "Prose here.\n\n" + "\n".join(x.strip() for x in mit.split("\n")) + "\n\nMore prose.\n"
    rows = [(1, "Some text.\nReleased under the MIT Licence.", "x"), (2, wrapped, "x"), (3, None, "x"), (4, "", "x"), (5, "word", "x"),
            (6, "This work is licensed under the GNU General Public License, version 3.", "x"), (6, "Licensed under CC BY-NC 4.0.", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    got = {(r.doc_id, r.text): r.licenses for r in licenses.scanned(df).collect()}
    first = got[1, rows[0][1]]
    assert [(s.license, s.dice, s.kind, rows[0][1][s.start : s.end]) for s in first if s.kind == "line"] == [("MIT", 1.0, "line", "Released under the MIT Licence.")]
    (para,) = [s for s in got[2, wrapped] if s.kind == "paragraph"]
    assert para.license == "MIT" and para.dice == 1.0
    assert got[3, None] == got[4, ""] == got[5, "word"] == []
    assert got[6, rows[5][1]][0].license == "GPL-3.0" and got[6, rows[6][1]][0].license == "CC-BY-NC-4.0"
    assert licenses.summary(df.limit(0)).collect() == []


def body_text(name):
    return (files("tagloom.llm") / "license_texts" / f"{name}.txt").read_text()


def test_full_texts_anywhere():
    match = licenses.Matcher(licenses.THRESHOLD)
    rng = random.Random(3)
    prose = "\n\n".join(" ".join(rng.choice("alpha beta gamma delta of the and in a word".split()) for _ in range(90)) for _ in range(6))
    for _, _, name, _ in licenses.bodies():
        body = body_text(name)
        one_line = " ".join(body.split())
        for text in (body, f"{prose}\n\n{body}\n\n{prose}", f"x = 1 {one_line} y = 2 {prose}"):
            best = min(match.scan(text), key=lambda x: (-x[1], x[0]))
            assert best[0] == name and best[1] > 0.95, name
        found = [x for x in match.scan(f"{body}\n\n{prose}\n\n{body}") if x[:1] == (name,) and x[4] - x[3] > 0.9 * len(body)]
        assert len([x for x in found if x[4] - x[3] < 1.5 * len(body)]) == 2, name
    assert [x for x in match.scan(prose) if x[2] == "window"] == []


def all_windows(match, text):
    """Whether any window of words reaches the threshold, per license: every start and every length."""
    w = licenses.words_of(text)
    best = {}
    for size, words, name, own in match.sought:
        for lo in range(len(w) - 1):
            seen, shared = set(), 0
            for hi in range(lo, min(len(w) - 1, lo + 2 * words)):
                g = (w[hi], w[hi + 1])
                if g not in seen:
                    seen.add(g)
                    shared += g in own
                dice = 2 * shared / (len(seen) + size)
                if dice >= match.threshold:
                    best[name] = max(best.get(name, 0), dice)
    return best


def test_windows_against_every_window():
    match = licenses.Matcher(licenses.THRESHOLD)
    match.sought = [x for x in match.sought if x[0] < 60]
    rng = random.Random(8)
    titles = [t for names in licenses.NAMES.values() for t in names]
    filler = "we wrote this code in one summer under a tree and released the music with no license for you".split()
    hit = 0
    for n in range(120):
        title = rng.choice(titles)
        clause = rng.choice(licenses.PHRASES[:-1]).format(title)
        words = clause.split()
        if n % 3 == 0 and len(words) > 4:
            words.insert(rng.randrange(len(words)), "very")
        before, after = (" ".join(rng.choice(filler) for _ in range(rng.randrange(1, 12))) for _ in range(2))
        text = f"{before} {' '.join(words)}, {after}"
        expected = all_windows(match, text)
        full = licenses.Matcher(licenses.THRESHOLD)
        got = full.scan(text)
        best = max(expected.values(), default=0)
        hit += best > 0
        assert bool(got) == bool(expected), text
        if all(x[2] == "window" for x in got):  # a line that matches as a whole stands for its windows
            assert max((x[1] for x in got), default=0) >= best - 1e-9, text
        if got:
            assert any(x[0] in expected for x in got), text
    assert hit > 80


@pytest.mark.parametrize("line,expected", [
    ("This project is licensed under the MIT License, see LICENSE for details and more words about it.", "MIT"),
    ("Released under the MIT License and documented in the manual that comes with the sources.", "MIT"),
    ("We wrote this in one summer, with help from friends. This project is licensed under the MIT License. Send mail to us if it breaks.", "MIT"),
])
def test_clauses_inside_prose(line, expected):
    match = licenses.Matcher(licenses.THRESHOLD)
    ((name, dice, kind, lo, hi),) = match.scan(line)
    assert (name, dice, kind) == (expected, 1.0, "window") and line[lo:hi].lower().endswith("mit license")


@pytest.mark.parametrize("tail", ["of the ", "licensed under the MIT License ", "permission is hereby granted free of charge "])
def test_long_repetitive_texts_take_linear_time(tail):
    match = licenses.Matcher(licenses.THRESHOLD)
    gpl = body_text("GPL-3.0")

    def seconds(n):
        start = time.perf_counter()
        found = match.scan(f"{gpl}\n\n{tail * n}")
        assert any(x[0] == "GPL-3.0" for x in found)
        return time.perf_counter() - start

    seconds(10)
    small, large = seconds(300_000 // len(tail)), seconds(1_200_000 // len(tail))
    assert large < 8 * small + 1 and large < 30


def test_empty_blank_and_odd_line_ends():
    match = licenses.Matcher(licenses.THRESHOLD)
    for text in ("", "\n", " \t", "word", "two words", "\n\n\n", None):
        assert match.scan(text) == []
    for text in ("\n\nLicensed under MIT License", "Licensed under MIT License\n\n", "a\n \t\nLicensed under MIT License\n\r\nb"):
        assert [x[0] for x in match.scan(text) if x[2] == "line"] == ["MIT"]
