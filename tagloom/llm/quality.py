"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per
rule; a policy is a named, versioned mask over those bits, so changing a policy or asking what a rule
costs never touches the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import bound_batches
from .registry import query, table

WINDOW = 8

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_adjacent", "n_upper", "n_lower", "n_bangs",
)

#: Rule name and the SQL condition under which a document fails it. The position is the bit; rules
#: are only ever appended, so that stored ledgers stay readable.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("adjacent_repeats", "100 * n_adjacent > 20 * n_words"),
    ("upper_case", "100 * n_upper > 40 * (n_upper + n_lower)"),
    ("exclamations", "10 * n_bangs > 3 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 12 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document failing any of them is rejected."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        order = [name for name, _ in RULES]
        return sum(1 << order.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
PROSE = Policy("prose", 1, tuple(name for name, _ in RULES))

UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def _repeated(ids: np.ndarray, width: int) -> np.ndarray:
    """Flags of windows whose exact id sequence occurs twice or more."""
    code, span = ids, 1
    while span < width:
        step = min(span, width - span)
        code = np.unique(np.stack([code[: len(code) - step], code[step:]]), axis=1, return_inverse=True)[1].ravel()
        span += step
    return np.bincount(code)[code] > 1


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by ``width``-word windows that occur twice or more, overlaps counted once."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    code = h[:n].copy()
    for k in range(1, width):
        code *= np.uint64(0x9E3779B97F4A7C15)
        code += h[k : n + k]
    code.sort()
    if not (code[1:] == code[:-1]).any():
        return 0
    seen: dict[bytes, int] = {}  # hashes agree somewhere: decide on the words themselves
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    starts = np.flatnonzero(_repeated(ids, width))
    if not len(starts):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES; null counts as empty."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: exactly space and \t to \r
    lines = [x for x in raw.split(b"\n") if x.strip()]
    blank = len(raw) - sum(map(len, words))
    return (
        len(words), len(text) - blank, sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)),
        repeat_words(words), len(lines), sum(map(eq, words, words[1:])),
        len(raw) - len(raw.translate(None, UPPER)), len(raw) - len(raw.translate(None, LOWER)), raw.count(b"!"),
    )


@F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        yield pd.DataFrame([measure_text(t) for t in part], columns=list(MEASURES), dtype="int64")


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every measurement and ``fail_bits``; such columns already there are replaced.

    A null or empty text measures 0 throughout and fails ``few_words``. Rows are judged one by one:
    repeated rows and ids stay, no shuffle is needed.
    """
    bound_batches(docs.sparkSession)
    struct = "quality rule measurements"
    out = docs.withColumn(struct, measures(F.col(f"`{text}`").cast("string")))
    out = out.withColumns({m: F.col(f"`{struct}`.{m}") for m in MEASURES}).drop(struct)
    return out.withColumn("fail_bits", failure_bits())


def passes(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policy(rows: DataFrame, policy: Policy, column: str = "kept") -> DataFrame:
    return rows.withColumn(column, passes(policy))


def passing(docs: DataFrame, policy: Policy, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the policy, with no column added or replaced."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text}`").alias("text"))
    return apply_policy(ledger(rows), policy).filter("kept").select("doc.*")


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents failing it, rejected by it alone, and kept without it.

    Masks are counted first, so that at most one row per distinct failure pattern is shuffled.
    """
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("p")).count()
    cells = []
    for i, (name, _) in enumerate(RULES):
        if name in policy.rules:
            bit = F.lit(1 << i).cast("long")
            def total(condition):
                return F.coalesce(F.sum(F.when(condition, F.col("count"))), F.lit(0))
            cells.append(F.struct(
                F.lit(name).alias("rule"),
                total(F.col("p").bitwiseAND(bit) != 0).alias("n_failing"),
                total(F.col("p") == bit).alias("n_rejected_alone"),
                total((F.col("p") == 0) | (F.col("p") == bit)).alias("n_kept_without"),
            ))
    return patterns.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _bits_sql() -> str:
    return " + ".join(f"CASE WHEN {fails} THEN {1 << i} ELSE 0 END" for i, (_, fails) in enumerate(RULES))


OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
wins AS (SELECT rid, i, array_to_string(ws[i:i+{WINDOW - 1}], ' ') AS win
         FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
twice AS (SELECT rid, i FROM wins QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
reps AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range({WINDOW}) r(k) GROUP BY rid),
ls AS (SELECT rid, l FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
lc AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM ls GROUP BY rid),
m AS (
  SELECT d.doc_id, len(ws) AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lc.dup, 0) AS n_dup_lines, coalesce(reps.n, 0) AS n_repeat_words, coalesce(lc.n, 0) AS n_lines,
    coalesce(len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])), 0) AS n_adjacent,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
    length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs
  FROM d JOIN w USING (rid) LEFT JOIN lc USING (rid) LEFT JOIN reps USING (rid)),
b AS (SELECT *, ({_bits_sql()})::BIGINT AS fail_bits FROM m)
SELECT doc_id, {", ".join(m + "::BIGINT AS " + m for m in MEASURES)}, fail_bits,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, fail_bits = 0 AS kept FROM b"""


@query(OP4_SQL)
def op4_quality_rules(spark, sf_dir):
    rows = ledger(table(spark, sf_dir, "documents"))
    rows = apply_policy(rows, BASE, "base_kept")
    rows = apply_policy(rows, PROSE)
    return rows.select("doc_id", *MEASURES, "fail_bits", (~F.col("base_kept")).alias("base_failed"), "kept")
