"""Near-duplicate detection: one-permutation MinHash, optimal densification, banded buckets, stars.

Texts of equal shingle sets collapse into one representative. Each representative gets one signature
from a single hash of its shingles; empty bins are filled by optimal densification. Equal bands meet
in a bucket, and a bucket emits only the star around its most central member, so the number of pairs
stays below buckets times members. Star edges are confirmed on full sets.

Stars alone can lose a link between two members that both miss their hub. Buckets that still span
several components therefore go through an exact step: only shingles that at least two of their
texts share can make a link, which settles almost every text by counting; the rest meets through the
rarest shared shingles, across components only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch
from .batches import bound_batches
from .registry import query, table

WORDS = 5  # words of a shingle
BANDS, ROWS = 48, 5  # a pair at similarity 0.75 shares no band with probability 2e-6
BINS = BANDS * ROWS

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = 0xD1342543DE82EF95
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
BLOCK = 1 << 20  # bytes of text hashed at a time
SALTS = 64  # tasks over which the rows of one set are spread


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for positions up to ``n``."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a block."""
    data = np.frombuffer(raw, np.uint8)
    blank = np.concatenate([[True], _BLANK[data], [True]])
    flips = np.flatnonzero(blank[1:] != blank[:-1])
    first, end = flips[0::2], flips[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return _mix((sums[end] - sums[first]) * down[first]), first


def _block_sets(raws: list[bytes]) -> Iterator[np.ndarray]:
    words, first = _word_hashes(b"\n".join(raws))
    offsets = np.cumsum([0] + [len(r) + 1 for r in raws])
    bounds = np.searchsorted(first, offsets)
    n = max(0, len(words) - WORDS + 1)
    grams = words[:n].copy()
    for k in range(1, WORDS):
        grams *= _M1
        grams ^= grams >> np.uint64(29)
        grams += words[k : n + k]
    grams = _mix(grams)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= WORDS:
            yield np.unique(grams[lo : hi - WORDS + 1])
        elif hi > lo:
            h = hashlib.blake2b(words[lo:hi].tobytes(), digest_size=8).digest()
            yield np.frombuffer(h, np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def shingle_sets(texts: Iterator[str | None]) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text, in order of the texts."""
    block: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if block and size + len(raw) > BLOCK:
            yield from _block_sets(block)
            block, size = [], 0
        block.append(raw)
        size += len(raw) + 1
    if block:
        yield from _block_sets(block)


def _probes() -> np.ndarray:
    """For each bin, where optimal densification looks in turn; every bin appears in the end."""
    rng = np.random.Generator(np.random.PCG64(7))
    drawn = rng.integers(0, BINS, (BINS, 64))
    rest = np.stack([rng.permutation(BINS) for _ in range(BINS)])
    return np.concatenate([drawn, rest], axis=1)


_PROBES = _probes()


def signature(shingles: np.ndarray) -> np.ndarray:
    """One value per bin: the least shingle hash that falls into it, empty bins densified."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))  # sorted: the least comes first
    out = np.zeros(BINS, np.uint64)
    full = np.zeros(BINS, bool)
    out[bins[first]], full[bins[first]] = shingles[first], True
    empty, t = np.flatnonzero(~full), 0
    while len(empty):
        seen = _PROBES[empty, t]
        hit = full[seen]
        out[empty[hit]] = out[seen[hit]]
        empty, t = empty[~hit], t + 1
    return out


_BAND_SALT = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _M1)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One bucket key per band; the band is part of the key."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS)
    key = np.broadcast_to(_BAND_SALT, rows.shape[:2]).copy()
    for r in range(ROWS):
        key = _mix(key * _M1 + rows[:, :, r])
    return key.view(np.int64)


SKETCH = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])


@F.pandas_udf(SKETCH)
def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        sizes, keys, bands = [], [], []
        for s in shingle_sets(part):
            sizes.append(len(s))
            keys.append(hashlib.md5(s.tobytes()).digest())
            bands.append(band_keys(signature(s)[None])[0] if len(s) else None)
        yield pd.DataFrame({"n": np.array(sizes, np.int64), "key": keys, "bands": pd.Series(bands, dtype=object)})


@F.pandas_udf(T.ArrayType(T.LongType()))
def shingles(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series([s.view(np.int64) for s in shingle_sets(part)], dtype=object)


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(node, root)`` of every linked node: the least node of its component.

    Alternates large and small stars over written tables until nothing changes; both keep to one
    row per edge, and hub nodes are only joined, never gathered.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges = scratch.write(edges, f"{name}-0")
    done, turn = None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == done:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.*").filter("u > v").distinct()
        done, turn = state, turn + 1
        edges = scratch.write(small, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets reach the similarity of 0.75."""
    left = sets.select(F.col("rep").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * common >= 75 * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _repeated(rows: DataFrame, key: str, count: str) -> DataFrame:
    """Keys that occur twice or more; counted where they are read, so a hot key is no single task."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def star_pairs(hits: DataFrame) -> DataFrame:
    """Per bucket, every member paired with its hub: the member that meets most texts overall."""
    central = hits.groupBy("rep").agg(F.sum("met").alias("central"))
    seen = hits.join(central, "rep")
    hubs = seen.groupBy("bucket").agg(F.max(F.struct("central", (-F.col("rep")).alias("r"))).alias("h"))
    hubs = hubs.select("bucket", (-F.col("h.r")).alias("hub"))
    return hits.join(hubs, "bucket").filter("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()


def crossing_shingles(hits: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rarest shared shingles of the texts whose buckets span several components.

    Two texts of n and m shingles are linked by an overlap of 3/7 (n + m), where m is at least 3/4 n
    and at least the least size in any bucket in question. Only the a shingles that another of these
    texts holds can overlap, so one of the a - overlap + 1 rarest is shared by every link.
    """
    placed = hits.join(roots, hits.rep == roots.node, "left").select(
        "bucket", "rep", "n", F.coalesce("root", "rep").alias("comp")
    )
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("n").alias("low"))
    mixed = mixed.filter("c0 < c1").select("bucket", "low")
    open_ = placed.join(mixed, "bucket").groupBy("rep", "comp").agg(F.min("low").alias("low"))
    rows = sets.join(open_, "rep").select("rep", "comp", "low", F.size("s").alias("n"), F.explode("s").alias("x"))
    rows = rows.join(_repeated(rows, "x", "df"), "x")
    by_rarity = Window.partitionBy("rep", "comp").orderBy("df", "x")
    rows = rows.withColumn("rank", F.row_number().over(by_rarity)).withColumn(
        "a", F.count("*").over(Window.partitionBy("rep", "comp"))
    )
    need = F.expr("(3 * (n + greatest(low, (3 * n + 3) div 4)) + 6) div 7")
    return rows.filter(F.col("rank") <= F.col("a") - need + 1).select("rep", "comp", "n", "a", "rank", "x")


def _across(prefixes: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs across components over written prefixes; the largest component of a shingle only answers.

    What each step joins is written first: Spark can then split a shingle that many texts share.
    """
    sizes = prefixes.select("rep", "comp").distinct().groupBy("comp").agg(F.count("*").alias("size"))
    held = prefixes.groupBy("x", "comp").agg(F.lit(1).alias("one")).join(sizes, "comp")
    main = held.groupBy("x").agg(F.count("*").alias("comps"), F.max(F.struct("size", "comp")).alias("m"))
    main = scratch.write(main.filter("comps > 1").select("x", F.col("m.comp").alias("main")), "mixed-shingles")
    rows = scratch.write(prefixes.join(main, "x"), "mixed-prefixes")
    ask = rows.filter("comp <> main").select("x", *[F.col(c).alias(f"{c}1") for c in ("rep", "comp", "n", "a", "rank")])
    need = F.expr("(3 * (n1 + n) + 6) div 7")
    meet = (
        (F.col("comp1") != F.col("comp")) & ((F.col("comp") == F.col("main")) | (F.col("rep1") < F.col("rep")))
        & (F.col("rank1") <= F.col("a1") - need + 1) & (F.col("rank") <= F.col("a") - need + 1)
    )
    pairs = ask.join(rows, "x").filter(meet)
    return pairs.select(F.least("rep1", "rep").alias("a"), F.greatest("rep1", "rep").alias("b")).distinct()


def _representatives(named: DataFrame) -> DataFrame:
    """``(key, salt, rep)`` for sets that several rows have: least id of the set, once per salt in use.

    A set meets its rows by salt, so that a group of copies of any size is spread over SALTS tasks.
    """
    parts = named.groupBy("key", "salt").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    first = parts.groupBy("key").agg(F.min("least").alias("rep"), F.sum("n").alias("n")).filter("n > 1")
    return parts.select("key", "salt").join(first.select("key", "rep"), "key")


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Linked are texts whose sets of 5-word shingles (A-Z lower-cased, words split at ASCII white
    space, fewer words: the whole sequence) have a Jaccard similarity of 0.75 or more;
    ``component_id`` is the least key reachable over links. A null text or one without words has an
    empty set and stays alone. A null key cannot be named: its row stays out of all groups, with a
    null component, and is kept. Rows that repeat a key are one node; each row shows the component
    of its own text. ``key`` must be a long; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "minhash")
    source = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    base = scratch.write(source.select("id", sketch("text").alias("s")).select("id", "s.*"), "sketches")
    named = base.filter("n > 0 AND id IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    heads = scratch.write(_representatives(named), "heads")
    members = named.join(heads, ["key", "salt"], "left").withColumn("rep", F.coalesce("rep", "id"))
    members = scratch.write(
        members.select("id", "rep", "n", F.when(F.col("id") == F.col("rep"), F.col("bands")).alias("bands")), "members"
    )
    exploded = members.filter("id = rep").select("rep", F.col("n").cast("int").alias("n"), F.explode("bands").alias("bucket"))
    hits = scratch.write(exploded.join(_repeated(exploded, "bucket", "met"), "bucket"), "hits")
    wanted = hits.select(F.col("rep").alias("id")).distinct()
    sets = source.join(wanted, "id").select(F.col("id").alias("rep"), shingles("text").alias("s"))
    sets = scratch.write(sets, "sets")
    links = scratch.write(confirmed(star_pairs(hits), sets), "star-links")
    roots = scratch.write(components(links, scratch, "stars"), "star-roots")
    prefixes = scratch.write(crossing_shingles(hits, sets, roots), "prefixes")
    more = scratch.write(confirmed(_across(prefixes, scratch), sets), "more-links")
    if not more.isEmpty():
        tree = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = scratch.write(components(tree.unionByName(more), scratch, "all"), "roots")
    placed = members.join(roots, members.rep == roots.node, "left").select(
        "id", "n", F.coalesce("root", "rep").alias("component_id")
    )
    alone = base.filter("NOT (n > 0 AND id IS NOT NULL)").select("id", "n", F.col("id").alias("component_id"))
    out = placed.unionByName(alone)
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those whose group holds a lesser key; all columns are kept."""
    gone = duplicate_groups(docs, key, text).filter("NOT kept").select(F.col(key).alias("__gone")).distinct()
    return docs.join(gone, docs[key] == F.col("__gone"), "left_anti")


@query()
def op5_minhash_dedup(spark, sf_dir):
    return duplicate_groups(table(spark, sf_dir, "documents"))
