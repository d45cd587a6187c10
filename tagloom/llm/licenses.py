"""License scans: sections of a text against license templates by Dice coefficient over word bigrams.

Sections are the lines, the paragraphs and the whole of a text. A section of n distinct bigrams and
a template of m reach a coefficient of t only if n lies between t/(2-t) and (2-t)/t times m, so most
templates are ruled out by size alone.

Templates are also sought as word windows, full license texts anywhere, phrases and notices outside the
sections that match. A window shares at least t/(2-t) of the template's bigrams, so a text that does not
is left at once. A text is split into words once, for all sections and windows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property, lru_cache
from importlib.resources import files
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import bound_batches
from .registry import query, table

THRESHOLD = 0.8

# Licenses by identifier, with the names that notices give them.
NAMES = {
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero 1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0",),
}
PHRASES = (
    "licensed under {}", "licensed under the {}", "released under the {}", "distributed under the {}",
    "this work is licensed under the {}", "this work is licensed under {}", "this project is licensed under the {}",
    "available under the {}", "published under the {}", "SPDX-License-Identifier: {}",
)

# Wording of license notices and texts.
NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any
        later version.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software.""",
}

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[a-z0-9]+")


def words_of(text: str) -> list[str]:
    """Normalised words: ASCII letters and digits in lower case, British spelling made American."""
    return WORD.findall(text.translate(ASCII_LOWER).replace("licence", "license"))


@lru_cache(maxsize=None)
def templates() -> tuple[tuple[int, str, frozenset[tuple[str, str]]], ...]:
    """``(size, license, bigrams)`` by size; the identifier itself follows an SPDX tag."""
    texts = [(name, text) for name, text in NOTICES.items()]
    for name, titles in NAMES.items():
        texts += [(name, phrase.format(title)) for phrase in PHRASES[:-1] for title in titles]
        texts += [(name, PHRASES[-1].format(tag)) for tag in (name, f"{name}-only", f"{name}-or-later")]
    out = set()
    for name, text in texts:
        w = words_of(text)
        grams = frozenset(zip(w, w[1:]))
        out.add((len(grams), name, grams))
    return tuple(sorted(out, key=lambda t: (t[0], t[1], sorted(t[2]))))


#: Of texts that differ in a few sections: the bigram that tells the left one's text as the right license.
VARIANTS = {"GPL-3.0": (("remote", "network"), "AGPL-3.0")}


@lru_cache(maxsize=None)
def bodies() -> tuple[tuple[int, int, str, frozenset[tuple[str, str]]], ...]:
    """``(bigrams, words, license, bigrams)`` of the full license texts, by size."""
    out = []
    for path in (files(__package__) / "license_texts").iterdir():
        if path.name.endswith(".txt"):
            w = words_of(path.read_text(encoding="utf-8"))
            grams = frozenset(zip(w, w[1:]))
            out.append((len(grams), len(w), path.name.removesuffix(".txt"), grams))
    return tuple(sorted(out, key=lambda b: b[:3]))


class Words:
    """A text read once: its normalised words, their lines, and where template bigrams stand.

    ``gram[i]`` numbers the bigram of words i and i+1 if any template has it, else it is -1. ``line[k]`` is the
    first word of line k, with one more entry at the end.
    """

    def __init__(self, text: str, matcher: Matcher):
        self.text = text
        clean = text.translate(ASCII_LOWER).replace("licence", "license")  # no letter changes its place
        lines = clean.split("\n")
        parts = [WORD.findall(x) for x in lines]
        self.clean = clean
        self.end = np.cumsum([len(x) + 1 for x in lines]) - 1  # place where each line ends
        self.words = [w for part in parts for w in part]
        self.line = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        ids = np.fromiter(map(matcher.vocabulary.get, self.words, repeat(-1)), np.int64, len(self.words))
        key = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(matcher.vocabulary) + ids[1:], -1)
        at = np.searchsorted(matcher.gram_keys, key)
        at[at == len(matcher.gram_keys)] = 0
        self.gram = np.where(matcher.gram_keys[at] == key, at, -1)
        self.hits = np.zeros(len(self.words) + 1, np.int64)
        self.hits[1 : len(self.gram) + 1] = np.cumsum(self.gram >= 0)
        self.hits[len(self.gram) + 1 :] = self.hits[len(self.gram)]

    def held(self, lo: int, hi: int) -> int:
        """Places of template bigrams among words lo to hi."""
        return int(self.hits[max(hi - 1, lo)] - self.hits[lo])

    def grams(self, lo: int, hi: int) -> set[tuple[str, str]]:
        return set(zip(self.words[lo : hi - 1], self.words[lo + 1 : hi]))

    @cached_property
    def places(self) -> list[tuple[int, int]]:
        return [m.span() for m in WORD.finditer(self.clean)]


class Matcher:
    """Templates of one threshold, found by size and by the bigrams they hold."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.least = threshold / (2 - threshold)  # share of a template's bigrams that a match holds
        self.known = templates()
        self.sizes = [t[0] for t in self.known]
        self.bodies = bodies()
        #: what windows are sought for: size, words, license, bigrams
        self.sought = [*self.bodies, *((size, size + 1, name, own) for size, name, own in self.known)]
        every = sorted({g for x in self.sought for g in x[3]})
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for g in every for w in g}))}
        keys = [self.vocabulary[a] * len(self.vocabulary) + self.vocabulary[b] for a, b in every]
        order = np.argsort(keys)
        self.gram_keys = np.array(keys, np.int64)[order]
        number = {every[i]: n for n, i in enumerate(order.tolist())}
        self.numbers = [np.array(sorted(number[g] for g in x[3]), np.int64) for x in self.sought]
        self.needed = np.array([math.ceil(self.least * x[0] - 1e-9) for x in self.sought])
        self.fewest = int(self.needed.min())
        pairs = [(n, i) for i, own in enumerate(self.numbers) for n in own.tolist()]
        pairs.sort()
        self.holders = np.array([i for _, i in pairs], np.int64)  # templates of each bigram, one after another
        self.holder_start = np.searchsorted([n for n, _ in pairs], np.arange(len(every) + 1))

    def best_of(self, grams: set[tuple[str, str]]) -> tuple[float, str] | None:
        """Highest coefficient of at least the threshold and its license, by name among equals."""
        n, t = len(grams), self.threshold
        found = None
        for i in range(bisect_left(self.sizes, n * t / (2 - t) - 1e-9), len(self.known)):
            size, name, own = self.known[i]
            if size > n * (2 - t) / t + 1e-9:
                break
            dice = 2 * len(grams & own) / (n + size)
            if dice >= t and (found is None or (-dice, name) < (-found[0], found[1])):
                found = (dice, name)
        return found

    def best(self, section: str) -> tuple[float, str] | None:
        w = words_of(section)
        return self.best_of(set(zip(w, w[1:])))

    def possible(self, text: Words) -> np.ndarray:
        """Templates of which the text holds enough bigrams anywhere."""
        held = np.unique(text.gram[text.gram >= 0])
        if len(held) < self.fewest:
            return held[:0]
        sizes = self.holder_start[held + 1] - self.holder_start[held]
        first = np.repeat(self.holder_start[held] - np.cumsum(sizes) + sizes, sizes)
        counts = np.bincount(self.holders[first + np.arange(sizes.sum())], minlength=len(self.sought))
        return np.flatnonzero(counts >= self.needed)

    def windows_of(self, text: Words, which: int) -> list[tuple[float, int, int]]:
        """``(dice, first word, end)`` of the windows of one template, at most twice its words long.

        A stretch of that length is counted forward, each bigram once while it is inside, and only where it
        holds enough of the template its best window is measured. After a measurement the count goes on
        at least half a template further, so a text is passed a bounded number of times.
        """
        size, words, name, own = self.sought[which]
        at = np.flatnonzero(np.isin(text.gram, self.numbers[which]))
        span, needed = 2 * words, int(self.needed[which])
        out: list[tuple[float, int, int]] = []
        inside: dict[int, int] = {}
        lo, free = 0, 0  # first counted hit, and the word before which no window may begin
        for hi in range(len(at)):
            g = int(text.gram[at[hi]])
            inside[g] = inside.get(g, 0) + 1
            while lo <= hi and (at[lo] < free or at[hi] - at[lo] >= span):
                old = int(text.gram[at[lo]])
                inside[old] -= 1
                if not inside[old]:
                    del inside[old]
                lo += 1
            if lo > hi or len(inside) < needed:
                continue
            start = begin = int(at[lo])
            for _ in range(2):  # the first stretch may begin in front of the window and so end inside it
                end = self._reach(text, own, begin, 1, span)
                begin = self._reach(text, own, end, -1, end - start + 1)
            grams = text.grams(begin, end + 2)
            dice = 2 * len(grams & own) / (len(grams) + size)
            if dice >= self.threshold:
                out.append((dice, begin, end + 2))
                free = end + 1
            else:
                free = start + max(1, words // 2)
        return out

    def _reach(self, text: Words, own: frozenset, at: int, step: int, most: int) -> int:
        """The place, at most ``most`` steps away, up to which 2 x shared - t x distinct bigrams is greatest."""
        seen, score, best, where, w = set(), 0.0, 0.0, at, text.words
        for i in range(at, max(-1, at - most) if step < 0 else min(len(w) - 1, at + most), step):
            g = (w[i], w[i + 1])
            if g not in seen:
                seen.add(g)
                score += 2 - self.threshold if g in own else -self.threshold
                if score > best:
                    best, where = score, i
        return where

    def scan(self, text: str | None) -> list[tuple[str, float, str, int, int]]:
        """``(license, dice, kind, start, end)`` of every matching section, in page order."""
        text = Words(text or "", self)
        possible = self.possible(text)
        if not len(possible):
            return []
        out, seen = [], {}
        lines = text.line
        ends = text.end
        starts = np.concatenate([[0], ends[:-1] + 1])

        def judge(kind: str, first: int, last: int) -> None:
            """Lines first to last as one section."""
            lo, hi = int(lines[first]), int(lines[last + 1])
            place = (int(starts[first]), int(ends[last]))
            if place in seen or text.held(lo, hi) < self.fewest:
                return
            match = self.best_of(text.grams(lo, hi))
            if match:
                seen[place] = len(out)
                out.append((match[1], match[0], kind, *place))

        counts = text.hits[np.maximum(lines[1:] - 1, lines[:-1])] - text.hits[lines[:-1]]
        for k in np.flatnonzero(counts >= self.fewest).tolist():
            judge("line", k, k)
        blank = [not text.text[a:b].strip(" \t\r\f\v") for a, b in zip(starts.tolist(), ends.tolist())]
        first = 0
        for k in range(len(blank)):
            # a blank line ends a paragraph; the first and the last line of a text never are a break by themselves
            if blank[k] and 0 < k < len(blank) - 1:
                if first < k:
                    judge("paragraph", first, k - 1)
                first = k + 1
        if first < len(blank):
            judge("paragraph", first, len(blank) - 1)
        judge("text", 0, len(blank) - 1)
        taken = [(x[3], x[4]) for x in out if x[2] != "text"]
        found = [[], []]  # full texts, then phrases and notices
        for which in possible.tolist():
            other = VARIANTS.get(self.sought[which][2])
            for dice, lo, hi in self.windows_of(text, which):
                name = other[1] if other and which < len(self.bodies) and other[0] in text.grams(lo, hi) else self.sought[which][2]
                found[which >= len(self.bodies)].append((-dice, name, text.places[lo][0], text.places[hi - 1][1]))
        for phrases, windows in enumerate(found):
            covered = bytearray(len(text.clean))
            for lo, hi in taken if phrases else []:
                covered[lo:hi] = b"\1" * (hi - lo)
            for dice, name, lo, hi in sorted(windows):
                if covered.find(1, lo, hi) >= 0:
                    continue
                covered[lo:hi] = b"\1" * (hi - lo)
                taken.append((lo, hi))
                n = seen.setdefault((lo, hi), len(out))
                if n == len(out):
                    out.append((name, -dice, "window", lo, hi))
                elif -dice > out[n][1]:
                    out[n] = (name, -dice, "window", lo, hi)
        return sorted(out, key=lambda x: (x[3], x[4]))


@lru_cache(maxsize=4)
def _matcher(threshold: float) -> Matcher:
    return Matcher(threshold)


SPANS = T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("kind", T.StringType()),
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))


def scanned(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``licenses``, one (license, dice, kind, start, end) per matching section.

    Places are code points, ends exclusive. A null or empty text, and one without two words in a
    row, matches nothing. Each section shows its best template, by name among equals. Of overlapping
    windows the best one stays; a window is at most twice as long as its template. Rows are
    judged one by one; repeated rows stay, an existing ``licenses`` is replaced.
    """

    @F.pandas_udf(SPANS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = _matcher(threshold).scan
        for part in parts:
            yield pd.Series([
                [dict(zip(("license", "dice", "kind", "start", "end"), x)) for x in scan(t)] for t in part
            ], dtype=object)

    bound_batches(docs.sparkSession)
    return docs.withColumn("licenses", run(F.col(f"`{text}`").cast("string")))


def summary(docs: DataFrame) -> DataFrame:
    """Per document: the best license and its coefficient, null if none, and the matching sections."""
    rows = scanned(docs.select("doc_id", "text"))
    best = F.array_min(F.transform("licenses", lambda x: F.struct((-x["dice"]).alias("d"), x["license"].alias("license"))))
    return rows.withColumn("best", best).select(
        "doc_id", F.col("best.license").alias("license"), (-F.col("best.d")).alias("dice"),
        F.size("licenses").cast("long").alias("n_sections"),
    )


def _templates_sql() -> str:
    return ", ".join(
        f"({i}, '{name}', [{', '.join(repr(' '.join(g)) for g in sorted(grams))}])" for i, (_, name, grams) in enumerate(templates())
    )


#: Lines, paragraphs and whole texts. Windows have no SQL form; the tests hold them against a search of all windows.
OP2_SQL = rf"""
WITH k(tid, license, grams) AS (VALUES {_templates_sql()}),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS s FROM d),
ps AS (SELECT rid, string_split_regex(t, '\n(?:[ \t\r\f\v]*\n)+') AS p FROM d),
p AS (SELECT rid, s FROM (SELECT rid, unnest(p) AS s, len(p) AS n FROM ps) WHERE n > 1 AND contains(s, chr(10))),
w AS (SELECT rid, t AS s FROM d WHERE contains(t, chr(10))),
s AS (SELECT row_number() OVER () AS sid, rid,
        regexp_extract_all(replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'licence', 'license'),
          '[a-z0-9]+') AS ws FROM (FROM l UNION ALL FROM p UNION ALL FROM w)),
g AS (SELECT sid, rid, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS grams
      FROM s WHERE len(ws) > 1),
n AS (SELECT sid, k.license, max(2 * len(list_intersect(g.grams, k.grams))::DOUBLE / (len(g.grams) + len(k.grams))) AS dice
      FROM g JOIN k ON len(list_intersect(g.grams, k.grams)) > 0 GROUP BY ALL),
b AS (SELECT sid, arg_min(license, (-dice, license)) AS license, max(dice) AS dice FROM n WHERE dice >= {THRESHOLD} GROUP BY sid),
r AS (SELECT rid, arg_min(license, (-dice, license)) AS license, max(dice) AS dice, count(*) AS n FROM b JOIN g USING (sid) GROUP BY rid)
SELECT doc_id, license, dice, coalesce(n, 0) AS n_sections FROM d LEFT JOIN r USING (rid)"""


@query(OP2_SQL)
def op2_license_scan(spark, sf_dir):
    return summary(table(spark, sf_dir, "documents"))
