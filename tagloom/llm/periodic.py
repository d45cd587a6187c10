"""Periodic runs of words by a dictionary of basic factors.

Basic factors are the stretches of 2^k words. Level by level each position is named after its factor:
two positions share a name if their factors are equal, and level k+1 follows from pairs of names of
level k. A run of period q, with L = 2^k <= q < 2L, repeats its first basic factor of length L after
q words. Occurrences of one factor no further than L/2 apart form an arithmetic progression; all
distances from L to 2L between two progressions are proposed as periods, again as progressions. That
proposes every period of every run, in a number that grows with the text alone. The names answer how
far a proposal extends to both sides; equal runs are merged and the least period stays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import bound_batches
from .registry import query, table

MIN_LENGTH = 12
BLOCK = 1 << 18  # words of short texts looked at together
PROGRESSIONS = 4  # of one factor that can lie within 2L words of another

RUNS = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType()),
]))
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType()),
])


def _grouped(left: np.ndarray, right: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ordered by (left, right, position), and flags where a new pair begins."""
    bits = max(1, int(size).bit_length())
    if 3 * bits < 64:
        key = np.sort((left << (2 * bits)) | (right << bits) | at)
        order, pair = key & ((1 << bits) - 1), key >> bits
        return order, np.concatenate([[True], pair[1:] != pair[:-1]])
    by = np.lexsort((at, right, left))
    new = (left[by][1:] != left[by][:-1]) | (right[by][1:] != right[by][:-1])
    return at[by], np.concatenate([[True], new])


def _proposals(pos: np.ndarray, new: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) pairs proposed by the occurrences of the factors of ``size`` words."""
    head = new.copy()
    head[1:] |= np.diff(pos) > size // 2
    of = np.cumsum(head) - 1  # progression of each occurrence
    first, last, factor = pos[head], pos[np.append(np.flatnonzero(head)[1:] - 1, len(pos) - 1)], (np.cumsum(new) - 1)[head]
    at, period = [], []
    for step in range(1, PROGRESSIONS + 1):
        linked = np.flatnonzero((factor[step:] == factor[:-step]) & (first[step:] - last[:-step] < 2 * size))
        if not len(linked):
            break
        ahead = np.full(len(first), -1, np.int64)
        ahead[linked] = first[linked + step]
        behind = np.full(len(first), -1, np.int64)
        behind[linked + step] = first[linked]
        some = ahead[of] >= 0  # each occurrence against the first of a later progression
        at.append(pos[some])
        period.append(ahead[of][some] - pos[some])
        some = behind[of] >= 0  # the first of an earlier progression against each occurrence
        at.append(behind[of][some])
        period.append(pos[some] - behind[of][some])
    if not at:
        return pos[:0], pos[:0]
    at, period = np.concatenate(at), np.concatenate(period)
    fits = (period >= size) & (period < 2 * size)
    wide = int(pos.max()) + 2
    pairs = np.unique(period[fits] * wide + at[fits])
    lone = np.ones(len(pairs), bool)  # neighbours with one period lie in one stretch: keep the first
    lone[1:] = pairs[1:] != pairs[:-1] + 1
    return pairs[lone] % wide, pairs[lone] // wide


def _extended(names: Sequence[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last position t of the stretch around ``at`` with word t = word t + period."""
    lo, hi, n = at.copy(), at.copy(), len(names[0])
    for k in range(len(names) - 1, -1, -1):
        size, name = 1 << k, names[k]
        inside = hi + period + size <= n
        same = np.zeros(len(hi), bool)
        same[inside] = name[hi[inside]] == name[hi[inside] + period[inside]]
        hi[same] += size
        inside = lo >= size
        same = np.zeros(len(lo), bool)
        same[inside] = name[lo[inside] - size] == name[lo[inside] - size + period[inside]]
        lo[same] -= size
    return lo, hi


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """``(start, length, period)`` rows of all runs of a sequence of word numbers, by start and period.

    Negative numbers equal nothing, so they keep texts in one sequence apart. A run is a maximal stretch
    with least period q and at least max(min_length, 2q) words.
    """
    n = len(ids)
    alone = -1 - np.arange(n, dtype=np.int64)  # the name of a factor that occurs once
    names, at, period = [], [], []
    size, left, right = 1, np.asarray(ids, np.int64), np.zeros(n, np.int64)
    active = np.flatnonzero(left >= 0)
    while len(active):
        pos, new = _grouped(left[active], right[active], active, max(n, int(left.max(initial=0)) + 1))
        group = np.cumsum(new) - 1
        again = np.bincount(group)[group] > 1
        if not again.any():
            break
        pos, new, group = pos[again], new[again], group[again]
        name = alone.copy()
        name[pos] = group
        names.append(name)
        found = _proposals(pos, new, size)
        at.append(found[0])
        period.append(found[1])
        left, right = name, np.concatenate([name[size:], alone[: min(size, n)]])
        active = np.flatnonzero((left >= 0) & (right >= 0))
        size *= 2
    if not names:
        return np.empty((0, 3), np.int64)
    at, period = np.concatenate(at), np.concatenate(period)
    lo, hi = _extended(names, at, period)
    length = hi - lo + period
    keep = (hi - lo >= period) & (length >= min_length)
    runs = np.stack([lo, length, period], axis=1)[keep]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    least = np.ones(len(runs), bool)  # of equal stretches, the one with the least period
    least[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[least]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Flags of the words that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def _judged(texts: Sequence[list[bytes]], min_length: int) -> Iterator[tuple[int, list, str]]:
    """Results of a block of texts, searched as one sequence with a lone number after every text."""
    seen: dict[bytes, int] = {}
    number = [seen.setdefault(w, len(seen)) for words in texts for w in (*words, None)]
    ids = np.array(number, np.int64)
    if texts:
        ids[ids == seen[None]] = -1
    runs = find_runs(ids, min_length)
    start = 0
    for words in texts:
        own = runs[np.searchsorted(runs[:, 0], start) : np.searchsorted(runs[:, 0], start + len(words))] - [start, 0, 0]
        left = words
        if len(own):
            left = [words[i] for i in np.flatnonzero(kept_words(len(words), own))]
        shown = [{"start": s, "length": x, "period": p} for s, x, p in own.tolist()]
        yield len(words), shown, b" ".join(left).decode("utf-8", "surrogatepass")
        start += len(words) + 1


def _blocks(texts: pd.Series) -> Iterator[list[list[bytes]]]:
    block, size = [], 0
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()  # of bytes: exactly space and \t to \r
        if block and size + len(words) > BLOCK:
            yield block
            block, size = [], 0
        block.append(words)
        size += len(words)
    if block:
        yield block


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``; columns of these names are replaced.

    ``runs`` holds ``(start, length, period)`` in words, by start and period; ``collapsed`` is the text
    without the words that repeat a run's first period, joined by single spaces. A null or empty text, or
    one of blanks, has no word, no run and an empty rest. Rows are judged one by one from their whole
    texts: repeated rows and ids stay, no shuffle is needed, and a run never reaches into another row.
    """
    bound_batches(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def search(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [row for block in _blocks(part) for row in _judged(block, min_length)]
            yield pd.DataFrame(found, columns=["n_words", "runs", "collapsed"])

    struct = "periodic run search"
    out = docs.withColumn(struct, search(F.col(f"`{text}`").cast("string")))
    return out.withColumns({f.name: F.col(f"`{struct}`.{f.name}") for f in RESULT.fields}).drop(struct)


def with_repeats(doc_id: int | None, text: str | None) -> str | None:
    """The text with its end made periodic where the digest of the id says so; a null id changes nothing."""
    if doc_id is None or pd.isna(doc_id):
        return text
    h = zlib.crc32(str(int(doc_id)).encode())
    words = (text or "").encode("utf-8", "surrogatepass").split() if h % 10 == 0 else []
    if not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)]).decode("utf-8", "surrogatepass")


@F.pandas_udf(T.StringType())
def _with_repeats(keys: pd.Series, texts: pd.Series) -> pd.Series:
    return pd.Series([with_repeats(int(k) if k != "" else None, t) for k, t in zip(keys, texts)], dtype=object)


def digests(docs: DataFrame) -> DataFrame:
    """The longest run of every document (ties: least start, then period) and digests of runs and rest."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = periodic_runs(docs.select("doc_id", _with_repeats(key, F.col("text").cast("string")).alias("text")))
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("m"), r["start"].alias("s"), r["period"].alias("p")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    out = rows.withColumn("top", F.array_min(ranked))
    length = -F.col("top.m")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.s").alias("start"), length.alias("length"),
        F.col("top.p").alias("period"), F.floor(F.expr("(-top.m * 1000) div top.p")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query()
def op13_periodic_runs(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
