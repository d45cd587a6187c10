"""Article title and paragraphs from stored HTML, with native expressions only."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, col, trim_space

HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
ARTICLE = r"(?is)<article\b[^>]*>(.*?)(?:</article\s*>|\z)"
HEADING = r"(?is)<h1\b[^>]*>(.*?)(?:</h1\s*>|\z)"

# Elements whose start or end closes an open paragraph (HTML5 implied close).
BLOCK_TAGS = [
    "address", "article", "aside", "blockquote", "details", "dialog", "div", "dl", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "table", "ul",
]
BLOCK_START = rf"(?i)(?=</?(?:{'|'.join(BLOCK_TAGS)})[\s/>])"

# Frequent named character references; the ampersand comes last so nothing is decoded twice.
ENTITIES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&copy;": "©",
    "&middot;": "·", "&ndash;": "–", "&mdash;": "—", "&lsquo;": "‘",
    "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”", "&hellip;": "…", "&amp;": "&",
}

# Reasons in the failures table, in the order they are tested; the second is our own.
NO_ARTICLE = "No <article> tag found."
NO_CONTAINER = "No content container found inside <article>."
NO_PARAGRAPH = "No <p> text found."


def visible(html: str | Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(col(html), HIDDEN, "")


def _numeric_entities(text: Column) -> Column:
    def decode(piece: Column) -> Column:
        hex_digits = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]{1,6});", 1)
        digits = F.regexp_extract(piece, r"^&#([0-9]{1,7});", 1)
        code = F.when(hex_digits != "", F.lower(hex_digits)).when(digits != "", F.hex(digits.cast("long")))
        char = F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
        rest = F.regexp_replace(piece, r"^&#[0-9a-zA-Z]+;", "")
        return F.when(code.isNull(), piece).otherwise(F.concat(char, rest))

    pieces = F.transform(F.split(text, "(?=&#)"), decode)
    return F.when(text.contains("&#"), F.array_join(pieces, "")).otherwise(text)


def _named_entities(text: Column) -> Column:
    """References of the HTML5 table beyond the frequent ones, which are left for later."""
    frequent = [name[1:] for name in ENTITIES]
    rest = {name: char for name, char in sorted(html5.items()) if name.endswith(";") and name not in frequent}
    table = F.from_json(F.lit(json.dumps(rest)), "map<string,string>")  # folded into one literal

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^&([a-zA-Z][a-zA-Z0-9]*;)", 1)
        char = F.when((name != "") & ~name.isin(*frequent), F.try_element_at(table, name))
        return F.when(char.isNull(), piece).otherwise(F.concat(char, F.substr(piece, F.length(name) + 2)))

    pieces = F.transform(F.split(text, "(?=&)"), decode)
    return F.when(text.rlike("&[a-zA-Z]"), F.array_join(pieces, "")).otherwise(text)


def unescape(text: Column) -> Column:
    text = _named_entities(_numeric_entities(text))
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def strip_tags(markup: Column, joiner: str = " ") -> Column:
    """Text of a fragment: tags replaced by ``joiner``, entities decoded, white space collapsed."""
    text = unescape(F.regexp_replace(markup, r"<[^>]*>", joiner))
    return trim_space(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def article_body(page: Column) -> Column:
    """Inside of the first article element, null when there is none."""
    body = F.regexp_extract(page, ARTICLE, 1)
    return F.when(page.rlike(r"(?i)<article\b"), body)


def container_body(article: Column, container: str | None) -> Column:
    """Inside of the first div carrying the class; nested divs are balanced by depth."""
    if container is None:
        return article
    opening = rf"""(?is)^<div\b[^>]*\bclass\s*=\s*["']?[^"'>]*(?<![\w-]){container}(?![\w-])"""
    pieces = F.split(article, r"(?i)(?=</?div\b)")

    def step(state: Column, piece: Column) -> Column:
        begins = (state["depth"] == 0) & ~state["done"] & piece.rlike(opening)
        inside = state["depth"] > 0
        depth = (
            F.when(begins, 1)
            .when(inside & piece.rlike(r"(?i)^<div\b"), state["depth"] + 1)
            .when(inside & piece.rlike(r"(?i)^</div\b"), state["depth"] - 1)
            .otherwise(state["depth"])
        )
        keep = begins | (inside & (depth > 0))
        return F.struct(
            depth.alias("depth"),
            (state["done"] | (inside & (depth == 0))).alias("done"),
            (state["found"] | begins).alias("found"),
            F.when(keep, F.concat(state["body"], piece)).otherwise(state["body"]).alias("body"),
        )

    start = F.struct(
        F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit(False).alias("found"), F.lit("").alias("body")
    )
    return F.aggregate(pieces, start, step, lambda s: F.when(s["found"], s["body"]))


def paragraph_texts(body: Column, joiner: str = " ") -> Column:
    """Ordered non-empty paragraph texts; an unclosed paragraph ends at the next block tag."""
    pieces = F.filter(F.split(body, BLOCK_START), lambda p: p.rlike(r"(?i)^<p[\s/>]"))
    return F.filter(F.transform(pieces, lambda p: strip_tags(p, joiner)), lambda t: t != "")


def page_title(page: Column, joiner: str = " ") -> Column:
    return strip_tags(F.regexp_extract(page, HEADING, 1), joiner)
