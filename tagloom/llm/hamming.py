"""Exact top-k search over 64-bit codes by incremental multi-index hashing.

A code is cut into segments of about log2(n) bits for a block of n codes, each with its own index, so that
an entry holds about one code. Codes within distance m*a + b of a
query (m segments) agree with it in one of the first b + 1 segments up to radius a, or in another up
to a - 1. The search grows the radii segment by segment and stops for a query as soon as its k-th
verified distance is covered that way, so the result is exact.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import query, table

BITS = 64
WIDTHS = (4, 16)  # least and greatest bits of a segment
BLOCK = 1 << 16  # codes, and queries, that meet in one task
TOGETHER = 1 << 21  # probes or candidates looked at together

K = 10


def sign_code(vector: Column) -> Column:
    """Signs of up to 64 components as one long, null for a null vector; null components count as 0."""
    bits = F.aggregate(
        F.transform(vector, lambda x: F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")),
        F.lit(0).cast("long"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b),
    )
    return F.when(F.size(vector) <= BITS, bits).when(
        F.size(vector) > BITS, F.raise_error(F.lit(f"codes hold at most {BITS} components")).cast("long")
    )


@lru_cache(maxsize=None)
def _masks(width: int, radius: int) -> np.ndarray:
    """All segments with ``radius`` bits set; none beyond the width."""
    return np.array([sum(1 << i for i in c) for c in combinations(range(width), radius)], np.int64)


def segment_widths(n: int) -> list[int]:
    """Bits of each segment for a block of ``n`` codes."""
    wanted = min(max(n.bit_length() - 1, WIDTHS[0]), WIDTHS[1])
    count = -(-BITS // wanted)
    return [BITS // count + (i < BITS % count) for i in range(count)]


class Block:
    """Multi-index over one block of codes; ``probed`` and ``verified`` count the entries and codes looked at."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids
        self.widths = segment_widths(len(codes))
        self.shifts = np.cumsum([0, *self.widths[:-1]])
        self.order, self.start = [], []
        self.probed = self.verified = 0
        for segment, width in enumerate(self.widths):
            part = self._part(codes, segment)
            self.order.append(np.argsort(part, kind="stable"))
            self.start.append(np.concatenate([[0], np.cumsum(np.bincount(part, minlength=1 << width))]))

    def _part(self, codes: np.ndarray, segment: int) -> np.ndarray:
        low = np.uint64((1 << self.widths[segment]) - 1)
        return ((codes >> np.uint64(self.shifts[segment])) & low).astype(np.int64)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, distance, id)`` rows of the k least (distance, id) of every query.

        Radii grow until a query's k-th distance is covered, at the most to the widths of the segments,
        where every code has been found.
        """
        best = _Best(len(queries), k)
        active = np.arange(len(queries))
        count = len(self.widths)
        for radius in range(max(self.widths) + 1):
            for segment, width in enumerate(self.widths):
                masks = _masks(width, radius)
                step = max(1, TOGETHER // max(1, len(masks)))
                for lo in range(0, len(active) if len(masks) else 0, step):
                    best.add(*self._found(active[lo : lo + step], queries, radius, segment, masks))
                active = active[~(best.kth(active) <= count * radius + segment)]
            if not len(active):
                break
        return best.rows()

    def _found(self, some, queries, radius, segment, masks):
        values = (self._part(queries[some], segment)[:, None] ^ masks).ravel()
        lo, hi = self.start[segment][values], self.start[segment][values + 1]
        filled = np.flatnonzero(hi > lo)
        size = (hi - lo)[filled]
        total = int(size.sum())
        at = np.repeat(lo[filled] - np.cumsum(size) + size, size) + np.arange(total)
        rows = self.order[segment][at]
        who = np.repeat(some[filled // len(masks)], size)
        apart = self.codes[rows] ^ queries[who]
        # each code counts once: where its segments first come within reach
        first = np.ones(total, bool)
        for other in range(len(self.widths)):
            if other != segment:
                d = np.bitwise_count(self._part(apart, other))
                first &= d > radius if other < segment else d >= radius
        self.probed += len(values)
        self.verified += int(first.sum())
        return who[first], np.bitwise_count(apart[first]).astype(np.int64), self.ids[rows[first]]


class _Best:
    """The k least (distance, id) of each query seen so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.distance = np.full((n, k), BITS + 1, np.int64)
        self.id = np.zeros((n, k), np.int64)

    def kth(self, queries: np.ndarray) -> np.ndarray:
        return self.distance[queries, self.k - 1]

    def add(self, who: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        near = distance <= self.kth(who)
        who, distance, ids = who[near], distance[near], ids[near]
        touched = np.unique(who)
        q = np.concatenate([np.repeat(touched, self.k), who])
        d = np.concatenate([self.distance[touched].ravel(), distance])
        i = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((i, d, q))
        q, d, i = q[order], d[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        top = place < self.k
        self.distance[q[top], place[top]], self.id[q[top], place[top]] = d[top], i[top]

    def rows(self):
        q, place = np.nonzero(self.distance <= BITS)
        return q, self.distance[q, place], self.id[q, place]


FOUND = T.StructType([
    T.StructField("qcode", T.LongType()), T.StructField("distance", T.LongType()), T.StructField("id", T.LongType()),
])


def _search(k: int):
    def run(codes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        block = Block(codes["code"].to_numpy(np.int64).view(np.uint64), codes["id"].to_numpy(np.int64))
        queries = asked["qcode"].to_numpy(np.int64)
        q, distance, ids = block.search(queries.view(np.uint64), k)
        return pd.DataFrame({"qcode": queries[q], "distance": distance, "id": ids})

    return run


def nearest(codes: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, id, distance)``: the k other ids of least (Hamming distance, id) per query.

    Both frames have ``id`` and ``code``, two longs. Rows without id or code are neither found nor
    asked; repeated rows count once. Of equal codes only the k + 1 least ids can ever be among the
    nearest, and equal queries are searched once, so a code that a third of all rows share stays
    small. Codes and queries meet in blocks of bounded size, every block of one with every block of
    the other; each block answers with its best k + 1.
    """
    pairs = codes.select("id", "code").filter("id IS NOT NULL AND code IS NOT NULL").distinct()
    least = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    pairs = pairs.withColumn("r", least).filter(F.col("r") <= k + 1).drop("r")
    asked = queries.select("id", "code").filter("id IS NOT NULL AND code IS NOT NULL").distinct()
    distinct = asked.select(F.col("code").alias("qcode")).distinct()
    n, m = codes.count(), queries.count()
    blocks, asks = max(1, -(-n // block)), max(1, -(-m // block))

    def spread(name: str, count: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = pairs.withColumn("b", F.pmod(F.xxhash64("code", "id"), F.lit(blocks)).cast("int")).withColumn("a", every(asks))
    right = distinct.withColumn("a", spread("qcode", asks)).withColumn("b", every(blocks))
    found = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(_search(k + 1), FOUND)
    place = F.row_number().over(Window.partitionBy("qcode").orderBy("distance", "id"))
    found = found.withColumn("r", place).filter(F.col("r") <= k + 1)
    lists = found.groupBy("qcode").agg(F.array_sort(F.collect_list(F.struct("distance", "id"))).alias("near"))
    hits = asked.join(lists, F.col("code") == F.col("qcode"))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    return hits.select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias("id"), F.col("x.distance").alias("distance")
    )


OP8_SQL = f"""
WITH e AS (SELECT vec_id AS id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS c
           FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.id AS query_id, e.id, hamming(q.c, e.c)::BIGINT AS distance
      FROM e q JOIN e ON q.id % 20 = 0 AND e.id <> q.id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INT AS rank, id, distance FROM p
QUALIFY rank <= {K}"""


@query(OP8_SQL)
def op8_hamming_top_k(spark, sf_dir):
    codes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code"))
    return nearest(codes, codes.filter("id % 20 = 0"))
