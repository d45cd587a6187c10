"""Main text of HTML pages by composite text density.

A page is read into a tree of blocks; inline elements count towards their block. Each block has its
characters per tag, adjusted for links. The blocks' sums over their children point at the subtree
that holds the article, and the least density on the way from the body to it is the threshold for
what else belongs to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import bound_batches
from .registry import query, table

TAG = re.compile(
    r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*)>"
    r"|/?(?P<odd>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes template svg canvas object".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre section summary table caption tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"html", "body"} | {"hr"}
SIBLINGS = {  # an element of the left kind ends an open one of the right kinds, up to the given borders
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
NOISE_TAGS = frozenset("head nav footer aside form dialog menu button select fieldset".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner nav navbar "
    "navigation menu submenu sidebar sidebars breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice "
    "notices notification popup modal overlay newsletter subscribe subscription signup login paywall share sharing social "
    "related recommended recommendations pagination pager toolbar widget widgets comment comments commentlist disqus "
    "respond replies skip outbrain taboola".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
HEADINGS = frozenset("header masthead banner".split())  # noise unless inside the article
CONTENT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre ul ol dl figure table section".split())
PROSE_TAGS = frozenset("p blockquote pre".split())
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre li dt dd td th caption figcaption".split())
OFF, DOUBTFUL = 2, 1  # noise for certain; noise by a class or id unless it holds most of the page
WORD = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _noise(name: str, attrs: str, inside: bool) -> int:
    """Whether an element is no part of any article, by its name, role, classes or id.

    Inside an article, classes and ids say nothing about its headings, paragraphs and cells, and a
    compound such as "related-work" is doubtful only.
    """
    if name in ("form", "fieldset") and not inside:
        return DOUBTFUL
    if name in NOISE_TAGS or (name == "header" and not inside):
        return OFF
    if not attrs or name in ("html", "body"):
        return 0
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)}
    if found.get("role", "").lower() in NOISE_ROLES or found.get("aria-hidden", "").lower() == "true":
        return OFF
    if HIDDEN.search(found.get("style", "")) or re.search(r"(?:^|\s)hidden(?=[\s/]|$)", attrs):
        return OFF
    if inside and name in TEXT_TAGS:
        return 0
    named = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = set(WORD.findall(named))
    if words & COMMENT_WORDS and name != "main":
        return OFF
    if not words & NOISE_WORDS or name in ("article", "main") or (inside and words & HEADINGS):
        return 0
    if inside and not NOISE_WORDS.isdisjoint(named.split()):
        return OFF
    return DOUBTFUL


class Page:
    """Blocks of one page, numbered in page order; a parent comes before its children."""

    def __init__(self, html: str):
        self.parent, self.name, self.noise = [-1], ["html"], [0]
        self.chars, self.tags, self.link_chars, self.link_tags = [0], [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []  # node, run of text between block borders, text
        self._read(html)

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, bool, bool]] = [("html", 0, False, False)]  # name, node, in a link, in an article
        run, at = 0, 0

        def text(piece: str) -> None:
            name, node, link, _ = stack[-1]
            words = unescape(piece).split()
            if words or piece:
                self.pieces.append((node, run, unescape(piece)))
            size = sum(map(len, words)) + max(0, len(words) - 1)
            self.chars[node] += size
            if link:
                self.link_chars[node] += size

        def close(names: set[str] | frozenset[str], borders: set[str] | frozenset[str]) -> bool:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in names:
                    del stack[depth:]
                    return True
                if stack[depth][0] in borders:
                    return False
            return False

        while True:
            m = TAG.search(html, at)
            if m is None:
                text(html[at:])
                return
            if m.start() > at:
                text(html[at : m.start()])
            at = m.end()
            name = (m["name"] or m["odd"] or "").lower()
            if m["cdata"]:
                text(m["cdata"].replace("&", "&amp;"))
            if not name:
                continue
            if m["close"] or html.startswith("</", m.start()):
                if name in BLOCKS:
                    run += 1
                    if name not in ("html", "body"):
                        close({name}, frozenset() if name not in ("p", "li") else {"table"})
                else:
                    close({name}, BLOCKS)
                continue
            attrs = m["attrs"] or ""
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            if name == "br" or name == "hr":
                if name == "hr":
                    run += 1
                    close({"p"}, BLOCKS - {"p"})
                self.pieces.append((stack[-1][1], run, " "))
                self.tags[stack[-1][1]] += 1
                continue
            if name in VOID:
                self.tags[stack[-1][1]] += 1
                continue
            if name in CLOSES_P:
                close({"p"}, BLOCKS - {"p"})
            if name in SIBLINGS:
                close(*SIBLINGS[name])
            inside = stack[-1][3] or name in ("article", "main")
            if name in ("article", "main"):
                for _, node, _, _ in stack:
                    if self.name[node] in ("form", "fieldset"):
                        self.noise[node] = 0
            noise = _noise(name, attrs, stack[-1][3])
            _, node, link, _ = stack[-1]
            if name in BLOCKS or noise:
                run += 1
                if name in ("html", "body"):
                    continue
                self.parent.append(node)
                self.name.append(name)
                self.noise.append(noise)
                for counts in (self.chars, self.link_chars, self.link_tags):
                    counts.append(0)
                self.tags.append(1)
                node = len(self.parent) - 1
            else:
                self.tags[node] += 1
                self.link_tags[node] += name == "a"
            if not attrs.endswith("/") or name in BLOCKS:
                stack.append((name, node, link or name == "a", inside))

    def _off(self) -> list[bool]:
        """Blocks inside noise.

        A doubtful one is none where it holds most of a page without an article, or where it is mostly
        link-poor paragraphs inside an article.
        """
        n = len(self.parent)
        sure, off, inside = [False] * n, [False] * n, [False] * n
        prose, whole = self._prose()
        for i in range(n):
            up = self.parent[i]
            inside[i] = self.name[i] in ("article", "main") or (i > 0 and inside[up])
            sure[i] = self.noise[i] == OFF or (i > 0 and sure[up])
            doubt = self.noise[i] == DOUBTFUL and not (i > 0 and inside[up] and 2 * prose[i] >= whole[i])
            off[i] = self.noise[i] == OFF or doubt or (i > 0 and off[up])
        if any(self.name[i] in ("article", "main") and not off[i] for i in range(n)):
            return off
        size = [0 if sure[i] else self.chars[i] - self.link_chars[i] for i in range(n)]
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
        for i in range(n):
            doubt = self.noise[i] == DOUBTFUL and 2 * size[i] <= size[0]
            off[i] = sure[i] or doubt or (i > 0 and off[self.parent[i]])
        return off

    def _prose(self) -> tuple[list[int], list[int]]:
        """Characters of each block in link-poor paragraphs, and all of its characters."""
        n = len(self.parent)
        prose, whole, links = [0] * n, self.chars[:], self.link_chars[:]
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            if self.name[i] in PROSE_TAGS and 10 * links[i] <= 3 * whole[i]:
                prose[i] = whole[i]
            prose[up], whole[up], links[up] = prose[up] + prose[i], whole[up] + whole[i], links[up] + links[i]
        return prose, whole

    def main_nodes(self) -> list[bool]:
        """Which blocks belong to the main text."""
        n = len(self.parent)
        off = self._off()
        body_links = sum(self.link_chars)
        body_chars = max(1, sum(self.chars))
        c, t, lc, lt = ([0 if off[i] else x[i] for i in range(n)] for x in (self.chars, self.tags, self.link_chars, self.link_tags))
        has_child = [False] * n
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            c[p], t[p], lc[p], lt[p] = c[p] + c[i], t[p] + t[i], lc[p] + lc[i], lt[p] + lt[i]
            has_child[p] = has_child[p] or c[i] > 0
        density = [0.0] * n
        for i in range(n):
            if c[i]:
                tags, links = max(1, t[i]), max(1, lt[i])
                base = log(c[i] / max(1, c[i] - lc[i]) * lc[i] + body_links / body_chars * c[i] + e)
                weight = log(max(e, c[i] / max(1, lc[i]) * tags / links)) / max(0.5, log(max(base, 1.0)))
                density[i] = c[i] / tags * weight
        total = [0.0 if has_child[i] else density[i] for i in range(n)]
        for i in range(1, n):
            total[self.parent[i]] += density[i]
        if not any(density):
            return [False] * n
        best = max(range(n), key=lambda i: (total[i], -i))
        path = [best]
        while path[-1]:
            path.append(self.parent[path[-1]])
        article = [i for i in path if self.name[i] == "article"] or [i for i in path if self.name[i] == "main"]
        # density grows with size, so the best subtree says nothing about what smaller parts of it must have
        threshold = min((density[i] for i in path[1:]), default=density[best])
        roots = {article[-1] if article else best}
        if article and self.name[article[-1]] == "article":  # an article may come in several elements side by side
            prose, _ = self._prose()
            for i in range(1, n):
                if self.name[i] == "article" and self.parent[i] == self.parent[article[-1]] and c[i] and 10 * lc[i] <= 3 * c[i]:
                    if density[i] >= threshold or 2 * prose[i] >= c[i]:
                        roots.add(i)
        if not article:  # what else on the way is as dense as the body, the headings, lists and paragraphs right
            own = [0] * n  # beside the best subtree, and containers beside it that are mostly such paragraphs
            for i in range(1, n):
                if self.name[i] in PROSE_TAGS and not off[i] and 10 * lc[i] <= 3 * c[i]:
                    own[self.parent[i]] += c[i]
            prose = own[:]
            for i in range(n - 1, 0, -1):
                prose[self.parent[i]] += 0 if self.name[i] in PROSE_TAGS else prose[i]
            for i in range(1, n):
                if self.parent[i] in path and i not in path and c[i]:
                    beside = best and self.parent[i] == self.parent[best] and 10 * lc[i] <= 3 * c[i]
                    text = self.name[i] in CONTENT_TAGS or 2 * prose[i] >= c[i]
                    if density[i] >= threshold or (beside and text):
                        roots.add(i)
        keep = [False] * n
        for i in range(n):
            keep[i] = (i in roots or (i > 0 and keep[self.parent[i]])) and not off[i]
        return keep

    def text(self) -> str:
        keep = self.main_nodes()
        blocks: list[str] = []
        last, parts = None, []
        for node, run, piece in [*self.pieces, (0, -1, "")]:
            if run != last:
                words = "".join(parts).split()
                if words:
                    blocks.append(" ".join(words))
                last, parts = run, []
            if keep[node]:
                parts.append(piece)
        return "\n\n".join(blocks)


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


@F.pandas_udf(T.StringType())
def _main_texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield pd.Series([main_text(h) for h in part], dtype=object)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``; same-named columns are replaced.

    White space inside a block becomes one space, blocks follow in page order with two line feeds
    between them. A null or empty page, and one of nothing but noise, has an empty text. Rows are
    read one by one, whole pages however long; repeated rows stay.
    """
    bound_batches(pages.sparkSession)
    out = pages.withColumn("text", _main_texts(F.col(f"`{html}`").cast("string")))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


@query()
def op9_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extracted(pages).select("page_id", "url", "text", "n_chars")
