"""Centroid clustering on a VA-file.

Every vector is compressed once to a cell of a few bits per dimension. For a set of centroids, two
lookup tables (dimension x cell) give the least and the greatest squared distance any vector of a
cell can have, so summing table entries brackets the distance to each centroid. A full vector is
fetched only where the brackets of several centroids overlap, where it has moved to another centroid
(the sums change by moved vectors alone), and at the end for its one reported distance.

Components are the whole numbers floor(scale * x), so sums, means and distances are exact and do not
depend on the order in which tasks finish.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch
from .batches import bound_batches
from .registry import query, table

DIMS, SCALE, K, ROUNDS = 64, 64, 16, 3
BITS = 7  # of a cell
SAMPLE = 2048  # vectors of least digest from which the cell borders are taken
SAFE = 1 << 24  # components up to here leave distances and block sums far within 64 bits
LIMB = 40  # bits of a part of a sum, so that sums of any size stay exact
BLOCK = 1 << 14  # vectors looked at together


def usable(vector: Column, dims: int, scale: int = 1) -> Column:
    """True for arrays of exactly ``dims`` components, none null, NaN or infinite, also when scaled."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dims) & finite, F.lit(False))


@dataclass(frozen=True)
class Cells:
    """Borders of the cells: dimension j's cell c holds the whole numbers lo[j, c] .. hi[j, c]."""

    lo: np.ndarray
    hi: np.ndarray
    bits: int

    @classmethod
    def fit(cls, sample: np.ndarray, least: np.ndarray, most: np.ndarray, bits: int) -> Cells:
        """Cells of about equal numbers of sampled vectors; the outer ones reach ``least`` and ``most``."""
        n, dims = 1 << bits, sample.shape[1]
        lo, hi = np.empty((dims, n)), np.empty((dims, n))
        for j in range(dims):
            ordered = np.sort(sample[:, j])
            starts = np.unique(ordered[(np.arange(1, n) * len(ordered)) // n])
            starts = starts[starts > least[j]]
            edges = np.concatenate([[least[j]], starts, np.full(n - 1 - len(starts), np.inf)])
            lo[j] = edges
            # numbers are whole, so a cell ends one below the next; beyond 2**53 this rounds to the next itself
            hi[j] = np.minimum(np.concatenate([edges[1:] - 1, [np.inf]]), most[j])
        return cls(lo, hi, bits)

    def pack(self, vectors: np.ndarray) -> list[bytes]:
        cell = np.empty(vectors.shape, np.uint8)
        for j in range(vectors.shape[1]):
            cell[:, j] = np.searchsorted(self.lo[j], vectors[:, j], side="right") - 1
        flags = np.unpackbits(cell[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return [row.tobytes() for row in np.packbits(flags.reshape(len(vectors), -1), axis=1)]

    def unpack(self, packed: Sequence[bytes]) -> np.ndarray:
        dims = len(self.lo)
        raw = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
        flags = np.unpackbits(raw, axis=1)[:, : dims * self.bits].reshape(len(packed), dims, self.bits)
        return flags @ (1 << np.arange(self.bits - 1, -1, -1))


def _exact(vectors: np.ndarray, centroids: list[list[int]], which: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to its centroid in ``which``; whole numbers of any size."""
    wide = np.abs(vectors).max(axis=1, initial=0) > SAFE
    if max((abs(c) for row in centroids for c in row), default=0) > SAFE:
        wide[:] = True
    out = np.zeros(len(vectors), object)
    if not wide.all():
        near = np.array([[min(max(c, -SAFE), SAFE) for c in row] for row in centroids], np.int64)
        diff = vectors[~wide].astype(np.int64) - near[which[~wide]]
        out[~wide] = (diff * diff).sum(axis=1).tolist()
    for i in np.flatnonzero(wide):
        out[i] = sum((int(x) - c) ** 2 for x, c in zip(vectors[i], centroids[which[i]]))
    return out


class Assigner:
    """Nearest centroids of blocks of packed vectors."""

    def __init__(self, cells: Cells, centroids: list[list[int]]):
        self.cells, self.centroids = cells, centroids
        points = np.array(centroids, dtype=object).astype(np.float64).reshape(len(centroids), -1)
        lo, hi, p = cells.lo[None], cells.hi[None], points[:, :, None]
        empty = lo > hi  # cells beyond the last border hold nothing
        with np.errstate(invalid="ignore", over="ignore"):
            below, above = np.where(empty, 0.0, lo - p), np.where(empty, 0.0, p - hi)
            least = np.maximum(np.maximum(below, above), 0.0) ** 2
            most = np.maximum(np.abs(below), np.abs(above)) ** 2
        self.least = np.ascontiguousarray(least.transpose(1, 2, 0))  # dimension, cell, centroid
        self.most = np.ascontiguousarray(most.transpose(1, 2, 0))

    def nearest(self, packed: Sequence[bytes], fetch) -> tuple[np.ndarray, np.ndarray]:
        """Centroid of every vector (ties: the smaller number) and which vectors were fetched for it."""
        cell = self.cells.unpack(packed)
        low = np.zeros((len(cell), len(self.centroids)))
        high = np.zeros_like(low)
        for j in range(cell.shape[1]):
            low += self.least[j, cell[:, j]]
            high += self.most[j, cell[:, j]]
        # table entries are rounded only beyond 2**53; the slack keeps the brackets wide enough there
        open_to = low * (1 - 1e-9) <= (high * (1 + 1e-9)).min(axis=1, keepdims=True)
        out = open_to.argmax(axis=1)
        overlap = np.flatnonzero(open_to.sum(axis=1) > 1)
        if len(overlap):
            vectors = fetch(overlap)
            best = np.full(len(overlap), None, object)
            for c in range(len(self.centroids)):
                some = np.flatnonzero(open_to[overlap, c])
                d = _exact(vectors[some], self.centroids, np.full(len(some), c))
                for i, x in zip(some, d):
                    if best[i] is None or x < best[i]:
                        best[i], out[overlap[i]] = x, c
        return out, overlap


def _vectors(raw: Sequence[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), dims)


def _blocks(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for at in range(0, len(frame), BLOCK):
        yield frame.iloc[at : at + BLOCK]


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    sign, rest, i = (1, total, 0) if total >= 0 else (-1, -total, 0)
    while rest:
        yield i, sign * (rest & ((1 << LIMB) - 1))
        rest, i = rest >> LIMB, i + 1


def _added(vectors: np.ndarray) -> list[int]:
    """Exact componentwise sums."""
    wide = np.abs(vectors).max(axis=1, initial=0) > SAFE
    sums = [int(x) for x in vectors[~wide].astype(np.int64).sum(axis=0)] if len(vectors) else []
    for row in vectors[wide]:
        sums = [s + int(x) for s, x in zip(sums, row)]
    return sums


class VaFile:
    """The written approximations of a table's usable vectors, and rounds of clustering on them."""

    PARTS = T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("dim", T.IntegerType()),
        T.StructField("limb", T.IntegerType()), T.StructField("part", T.LongType()),
    ])

    def __init__(self, rows: DataFrame, id: str, vector: str, dims: int, scale: int, k: int, bits: int, sample: int):
        if not 1 <= bits <= 8:
            raise ValueError("cells have 1 to 8 bits")
        spark = rows.sparkSession
        bound_batches(spark)
        raw = F.col(f"`{vector}`").cast("array<double>")
        kept = rows.select(F.col(f"`{id}`").alias("id"), raw.alias("v")).filter(usable(F.col("v"), dims, scale))
        digest = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")).cast("binary"), 256)
        first = kept.withColumn("digest", digest).orderBy(F.col("digest").asc_nulls_last(), "v").limit(max(sample, k))
        first = np.array([r.v for r in first.select("v").collect()], np.float64).reshape(-1, dims)
        drawn = np.floor(scale * first)
        self.dims, self.scratch = dims, Scratch(spark, "vafile")
        self.centroids = [[int(x) for x in row] for row in drawn[:k]]
        schema = T.StructType([
            T.StructField("id", rows.schema[id].dataType), T.StructField("cells", T.BinaryType()),
            T.StructField("vector", T.BinaryType()),
        ])
        if not len(drawn):
            self.cells, self.table = None, spark.createDataFrame([], schema)
            return
        ends = kept.agg(
            F.array(*[F.min(F.get("v", F.lit(j))) for j in range(dims)]).alias("least"),
            F.array(*[F.max(F.get("v", F.lit(j))) for j in range(dims)]).alias("most"),
        ).first()
        cells = self.cells = Cells.fit(drawn, np.floor(scale * np.array(ends.least)), np.floor(scale * np.array(ends.most)), bits)

        def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for part in _blocks(frame):
                    whole = np.floor(scale * np.stack(part["v"].to_list()))
                    yield pd.DataFrame({
                        "id": part["id"], "cells": cells.pack(whole), "vector": [x.astype("<f8").tobytes() for x in whole],
                    })

        self.table = self.scratch.write(kept.mapInPandas(packed, schema), "cells")

    def _moves(self, old: list[list[int]] | None, new: list[list[int]]) -> dict[tuple[int, int], int]:
        """What enters and leaves each cluster: per (cluster, dimension) the change of the sum.

        Dimension ``dims`` holds the change of the number of vectors. Without ``old`` every vector enters.
        """
        cells, dims = self.cells, self.dims

        def changes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            now, before = Assigner(cells, new), Assigner(cells, old) if old is not None else None
            totals: dict[int, list[int]] = {}
            for frame in frames:
                for part in _blocks(frame):
                    packed, raw = part["cells"].to_list(), part["vector"].to_numpy()

                    def fetch(places, raw=raw):
                        return _vectors(raw[places], dims)

                    to, _ = now.nearest(packed, fetch)
                    source = before.nearest(packed, fetch)[0] if before else np.full(len(to), -1)
                    moved = np.flatnonzero(to != source)
                    vectors = fetch(moved)
                    for side, sign in ((to, 1), (source, -1)):
                        for c in np.unique(side[moved]):
                            if c < 0:
                                continue
                            own = vectors[side[moved] == c]
                            sums = totals.setdefault(int(c), [0] * (dims + 1))
                            for j, x in enumerate([*_added(own), len(own)]):
                                sums[j] += sign * x
            out = [(c, j, i, x) for c, sums in totals.items() for j, s in enumerate(sums) for i, x in _limbs(s)]
            yield pd.DataFrame(out, columns=["cluster", "dim", "limb", "part"])

        parts = self.table.select("cells", "vector").mapInPandas(changes, self.PARTS)
        out: dict[tuple[int, int], int] = {}
        for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum("part").alias("part")).collect():
            out[r.cluster, r.dim] = out.get((r.cluster, r.dim), 0) + (r.part << (LIMB * r.limb))
        return out

    def fit(self, rounds: int) -> list[list[int]]:
        """Final centroids after ``rounds`` of assignment and exact floor(mean); empty clusters stay."""
        if not self.centroids:
            return self.centroids
        sums = [[0] * (self.dims + 1) for _ in self.centroids]
        old = None
        for _ in range(rounds):
            for (c, j), change in self._moves(old, self.centroids).items():
                sums[c][j] += change
            old = self.centroids
            self.centroids = [[x // s[-1] for x in s[:-1]] if s[-1] else own for s, own in zip(sums, old)]
        return self.centroids

    def assigned(self) -> DataFrame:
        """``(id, cluster, distance)`` of every usable row; a distance beyond a long is null."""
        cells, centroids, dims = self.cells, self.centroids, self.dims
        schema = T.StructType([
            self.table.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
        ])
        if not centroids:
            return self.table.sparkSession.createDataFrame([], schema)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            nearest = Assigner(cells, centroids)
            for frame in frames:
                for part in _blocks(frame):
                    raw = part["vector"].to_numpy()
                    to, _ = nearest.nearest(part["cells"].to_list(), lambda places: _vectors(raw[places], dims))
                    far = _exact(_vectors(raw, dims), centroids, to)
                    far = pd.array([int(d) if d < 1 << 63 else None for d in far], dtype="Int64")
                    yield pd.DataFrame({"id": part["id"].to_numpy(), "cluster": to.astype(np.int32), "distance": far})

        return self.scratch.write(self.table.mapInPandas(run, schema), "assigned")


def centroid_digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = DIMS, scale: int = SCALE,
            k: int = K, rounds: int = ROUNDS, bits: int = BITS, sample: int = SAMPLE) -> tuple[DataFrame, list[list[int]]]:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per usable row, and the centroids.

    A row counts if its vector has exactly ``dims`` components, none null, NaN or infinite, nor infinite as a
    double once scaled; the others are left out, other columns are not read. Rows are clustered one by one: repeated ids and repeated
    vectors stay, each with its own result row. The first centroids are the vectors of the ``k`` rows with the
    least sha256 of ``1:<id>``, equal digests by their components; a null id never comes before another.
    Fewer rows than ``k`` give as many centroids as rows, an empty table gives no rows and no centroid.
    Distances beyond a long, from components of 10^9 and more, are null, and so are the sums they belong to.
    """
    spark = rows.sparkSession
    va = VaFile(rows, id, vector, dims, scale, k, bits, sample)
    centroids = va.fit(rounds)
    out = va.assigned()
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.try_sum("distance"))
    sums = {r.cluster: r.inertia for r in out.groupBy("cluster").agg(whole.alias("inertia")).collect()}  # k rows
    total = sum(sums.values()) if None not in sums.values() else None
    total = total if total is not None and total < 1 << 63 else None
    facts = spark.createDataFrame(
        [(c, s, total, centroid_digest(centroids[c])) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return out.join(F.broadcast(facts), "cluster").select("id", *out.columns[1:], *facts.columns[1:]), centroids


def _sql() -> str:
    def assign(name: str, centroids: str) -> str:
        return f"""{name} AS MATERIALIZED (SELECT rid, v.vec_id, v.x, arg_min(c.n, [d, c.n]) AS n, min(d) AS d FROM (
  SELECT v.rid, c.n, list_sum(list_transform(range(1, {DIMS + 1}), lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j])))::BIGINT AS d
  FROM v, {centroids} c) c JOIN v USING (rid) GROUP BY rid, v.vec_id, v.x)"""

    def update(name: str, before: str, assigned: str) -> str:
        return f"""{name} AS MATERIALIZED (SELECT b.n, coalesce(m.x, b.x) AS x FROM {before} b LEFT JOIN (
  SELECT n, list(m ORDER BY j) AS x FROM (SELECT n, j, floor(sum(x[j])::DOUBLE / count(*))::BIGINT AS m
    FROM {assigned}, range(1, {DIMS + 1}) r(j) GROUP BY n, j) GROUP BY n) m USING (n))"""

    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMS})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS n, x FROM v
  QUALIFY n < {K})""",
    ]
    for r in range(ROUNDS):
        steps += [assign(f"a{r}", f"c{r}"), update(f"c{r + 1}", f"c{r}", f"a{r}")]
    steps.append(assign("a", f"c{ROUNDS}"))
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, a.n::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.n))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a JOIN c{ROUNDS} c USING (n)"""


OP11_SQL = _sql()


@query(OP11_SQL)
def op11_centroid_clusters(spark, sf_dir):
    return cluster(table(spark, sf_dir, "embeddings"))[0].withColumnRenamed("id", "vec_id")
