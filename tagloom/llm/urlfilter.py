"""URL filters in DataFrame functions only: rules indexed by their rarest literal token.

A rule is a pattern over the address (lower-case host and path) and names literal tokens that every
matching address holds. It is indexed under the one of them that is rarest in the corpus. The tokens
of a URL fetch the rules indexed under them, and only those run their pattern. The index is part of
the plan, so URLs are judged where they are read, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import query, table

MAX_RULES = 20_000  # the rules travel in the plan; a longer list is refused, not cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN_ENDS = r"[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` over host and path, literal tokens it needs, and what it says.

    ``length`` decides between rules that fit: the longest one wins, the earlier one among equals.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    action: str
    length: int

    @classmethod
    def address(cls, host: str, path: str, action: str) -> "Rule":
        """Fits the host and all its subdomains where the path starts with ``path``."""
        whole = re.split(TOKEN_ENDS, host.translate(str.maketrans(UPPER, LOWER)))
        steps = re.split(TOKEN_ENDS, path.translate(str.maketrans(UPPER, LOWER)))[:-1]  # the last may go on in the URL
        pattern = rf"\A(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
        return cls(host + path, pattern, tuple(t for t in whole + steps if t), action, len(host + path))

    @classmethod
    def word(cls, word: str, action: str) -> "Rule":
        """Fits a host with the token ``word``."""
        return cls(word, rf"\A(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?![a-z0-9])", (word,), action, len(word))


#: Address rules of the query, then patterns of hosts that the method blocks by itself.
ADDRESSES = (
    Rule.address("org", "/", "allow"), Rule.address("example.org", "/es/", "block"),
    Rule.address("example.org", "/en/1", "block"), Rule.address("com", "/fr/", "allow"),
    Rule.address("com", "/de/", "block"),
)
WORDS = tuple(Rule.word(w, "block") for w in (
    "casino", "poker", "bet", "bets", "betting", "pills", "viagra", "porn", "adult", "xxx", "spam", "malware", "phishing", "ads", "track", "tracker",
))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(host: Column, path: Column) -> Column:
    return F.array_distinct(F.split(F.translate(F.concat(host, path), UPPER, LOWER), TOKEN_ENDS))


def rarest_tokens(urls: DataFrame, rules: tuple[Rule, ...], url: str = "url") -> list[str]:
    """The index token of each rule: of its literals the one in the fewest URLs of ``urls``.

    Counts come back for the literals of the rules only, summed up where they are read.
    """
    literals = sorted({t for r in rules for t in r.tokens})
    tokens = tokens_of(host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`")))
    known = F.array_intersect(tokens, F.array(*map(F.lit, literals)))
    seen = urls.select(F.explode(known).alias("token")).groupBy("token").count().collect()
    count = {r["token"]: r["count"] for r in seen}
    return [min(r.tokens, key=lambda t: (count.get(t, 0), t)) for r in rules]


class Index:
    """Rules by the hash of their index token, as a literal of the plan."""

    def __init__(self, rules: tuple[Rule, ...], tokens: list[str]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit into a plan")
        for r in rules:
            if not r.tokens:
                raise ValueError(f"rule {r.name!r} has no literal token to be found by")
        self.rules = rules
        self.width = 1 << max(1, len(rules)).bit_length()
        cells: list[list[tuple[str, int]]] = [[] for _ in range(self.width)]
        for i, token in enumerate(tokens):
            cells[zlib.crc32(token.encode()) % self.width].append((token, i))
        empty = F.array().cast("array<struct<token:string,rule:int>>")
        self.cells = F.array(*[
            F.array(*[F.struct(F.lit(t).alias("token"), F.lit(i).alias("rule")) for t, i in cell]) if cell else empty
            for cell in cells
        ])
        self.patterns = F.array(*[F.lit(r.pattern) for r in rules])
        self.ranks = F.array(*[F.lit(r.length) for r in rules])
        self.names = F.array(*[F.lit(r.name) for r in rules])
        self.actions = F.array(*[F.lit(r.action) for r in rules])

    def candidates(self, tokens: Column) -> Column:
        def fetch(token: Column) -> Column:
            cell = F.element_at(self.cells, (F.crc32(token.cast("binary")) % self.width + 1).cast("int"))
            return F.transform(F.filter(cell, lambda e: e["token"] == token), lambda e: e["rule"])

        return F.flatten(F.transform(tokens, fetch))

    def best(self, tokens: Column, address: Column) -> Column:
        """The winning rule, or null."""
        fits = F.filter(self.candidates(tokens), lambda i: F.call_function("rlike", address, F.element_at(self.patterns, i + 1)))
        return (-F.array_max(F.transform(fits, lambda i: F.struct(F.element_at(self.ranks, i + 1).alias("rank"), (-i).alias("i"))))["i"])

    def at(self, values: Column, rule: Column) -> Column:
        return F.when(rule.isNotNull(), F.element_at(values, rule + 1))


def judged(
    pages: DataFrame, addresses: tuple[Rule, ...] = ADDRESSES, words: tuple[Rule, ...] = WORDS, url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; same-named columns are replaced.

    The longest fitting address rule decides; without one, a fitting word rule does, else the page
    is allowed. A null URL or one without ``://`` has an empty host and path, which no rule fits.
    Rows are judged one by one; repeated rows stay.
    """
    every = addresses + words
    tokens = rarest_tokens(pages, every, url) if every else []
    new = ("host", "path", "rule", "verdict")
    given = F.col("__url")
    out = pages.withColumn("__url", F.col(f"`{url}`").cast("string")).drop(*[c for c in new if c in pages.columns and c != url])
    out = out.withColumns({"host": host_of(given), "path": path_of(given)})
    out = out.withColumn("__tokens", tokens_of(F.col("host"), F.col("path"))).withColumn("__address", F.concat("host", "path"))

    def winner(rules: tuple[Rule, ...], at: list[str]) -> tuple[Index | None, Column]:
        if not rules:
            return None, F.lit(None).cast("int")
        index = Index(rules, at)
        return index, index.best(F.col("__tokens"), F.col("__address"))

    first, rule = winner(addresses, tokens[: len(addresses)])
    second, word = winner(words, tokens[len(addresses):])
    out = out.withColumns({"__rule": rule, "__word": word})
    said = [i.at(i.actions, F.col(c)) for i, c in ((first, "__rule"), (second, "__word")) if i is not None]
    name = first.at(first.names, F.col("__rule")) if first else F.lit(None).cast("string")
    out = out.withColumns({"rule": name, "verdict": F.coalesce(*said, F.lit("allow"))})
    return out.drop("__url", "__tokens", "__address", "__rule", "__word")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OP6_SQL = rf"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(h, p, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
w AS (SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
      FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(w.action, CASE WHEN regexp_matches(host,
  '(^|[^a-z0-9])({"|".join(r.name for r in WORDS)})($|[^a-z0-9])') THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN w USING (rid)"""


@query(OP6_SQL)
def op6_url_filter(spark, sf_dir):
    return judged(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
