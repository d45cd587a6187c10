"""Gradient boosting of K trees a round on one softmax, over quantile bins.

Features are binned once. For every level of a round's trees, each task adds up the residuals of its rows
by class, node, feature and bin; histograms are merged per chunk of features, and only the best split of
each node reaches the driver. Rows keep the raw scores of a written table; the few rounds since then are
replayed from their trees. Rows of up to ONE_TASK cells need no merging: their rounds all run in the one
task that holds them, by the same code.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as cfg
from ..scratch import Scratch

BINS = 32
BLOCK_CELLS = 1 << 21  # row x feature cells of a block
ONE_TASK = 1 << 20  # cells up to which the rounds run where the rows are
CHUNK_CELLS = 1 << 17  # histogram cells that are merged in one place
REPLAYED = 8  # rounds after which the raw scores are written anew

_BLOCK = T.StructType([
    T.StructField("bins", T.BinaryType()), T.StructField("label", T.BinaryType()), T.StructField("raw", T.BinaryType()),
])
_PART = T.StructType([
    T.StructField("chunk", T.IntegerType()), T.StructField("task", T.IntegerType()), T.StructField("sums", T.BinaryType()),
])
_TREES = T.StructType([T.StructField("round", T.IntegerType()), T.StructField("trees", T.BinaryType()), T.StructField("loss", T.DoubleType())])


@dataclass
class Trees:
    """One round: per score column a tree as arrays over its nodes; node i has children 2i+1 and 2i+2.

    ``feature`` is -1 at leaves; rows with a bin above ``cut`` go right. ``value`` is the leaf's step.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def leaves(cls, columns: int, depth: int) -> Trees:
        shape = (columns, (1 << (depth + 1)) - 1)
        return cls(np.full(shape, -1, np.int32), np.zeros(shape, np.int32), np.zeros(shape))

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node of every row in every column's tree after ``depth`` levels."""
        out = np.zeros((len(bins), len(self.feature)), np.int64)
        row = np.arange(len(bins))
        for c in range(len(self.feature)):
            at = out[:, c]
            for _ in range(depth):
                f = self.feature[c, at]
                right = bins[row, np.maximum(f, 0)] > self.cut[c, at]
                at = np.where(f >= 0, 2 * at + 1 + right, at)
            out[:, c] = at
        return out

    def scores(self, bins: np.ndarray, depth: int) -> np.ndarray:
        at = self.nodes(bins, depth)
        return np.stack([self.value[c, at[:, c]] for c in range(len(self.feature))], axis=1)

    def pack(self) -> bytes:
        return self.feature.tobytes() + self.cut.tobytes() + self.value.tobytes()

    @classmethod
    def unpack(cls, raw: bytes, columns: int) -> Trees:
        n = len(raw) // 16
        ints = np.frombuffer(raw[: 8 * n], np.int32).reshape(2, columns, -1)
        return cls(ints[0], ints[1], np.frombuffer(raw[8 * n :]).reshape(columns, -1))


def probabilities(raw: np.ndarray) -> np.ndarray:
    """Of the classes; one column of raw scores is the log odds of the second of two classes."""
    if raw.shape[1] == 1:
        p = 1 / (1 + np.exp(-np.clip(raw, -700, 700)))
        return np.concatenate([1 - p, p], axis=1)
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Rows:
    """A block's binned rows with their labels and current raw scores."""

    def __init__(self, row, width: int, columns: int):
        self.bins = np.frombuffer(row.bins, np.uint8).reshape(-1, width)
        self.label = np.frombuffer(row.label, np.int64)
        self.raw = np.frombuffer(row.raw).reshape(-1, columns).copy()
        self.by_feature = np.ascontiguousarray(self.bins.T, np.int64)

    def advance(self, trees: Trees, depth: int) -> None:
        self.raw += trees.scores(self.bins, depth)

    def loss(self) -> float:
        p = probabilities(self.raw)[np.arange(len(self.label)), self.label]
        return float(-np.log(np.maximum(p, 1e-300)).sum())

    def residuals(self) -> np.ndarray:
        p = probabilities(self.raw)
        hit = self.label[:, None] == np.arange(p.shape[1])
        return (hit - p)[:, -self.raw.shape[1] :]

    def histograms(self, trees: Trees, level: int) -> np.ndarray:
        """(3, column, node of the level, feature, bin): sums of residuals, of their curvature, and rows."""
        columns, width, first, n = len(trees.feature), self.bins.shape[1], (1 << level) - 1, 1 << level
        out = np.empty((3, columns, width, n * BINS))
        r, at = self.residuals(), trees.nodes(self.bins, level)
        for c in range(columns):
            here = np.flatnonzero(at[:, c] >= first)  # leaves of earlier levels take no part
            node, own = (at[here, c] - first) * BINS, r[here, c]
            curve = np.abs(own) * (1 - np.abs(own))
            for j in range(width):  # the sums of one feature stay in the processor's cache
                cell = node + self.by_feature[j, here]
                for s, w in enumerate((own, curve, None)):
                    out[s, c, j] = np.bincount(cell, w, n * BINS)
        return out.reshape(3, columns, width, n, BINS).swapaxes(2, 3)


def best_splits(sums: np.ndarray, first: int = 0) -> np.ndarray:
    """Per (column, node): gain, feature, cut, and (residuals, curvature, rows) of the left side and of all.

    Ties go to the smaller feature, then to the smaller cut. ``first`` is the number of the first feature.
    """
    left = sums.cumsum(axis=4)
    total = left[:, :, :, 0, -1]
    left = left[..., :-1]
    right = total[:, :, :, None, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (right[2] * left[0] - left[2] * right[0]) ** 2 / (left[2] * right[2])
    gain = np.where((left[2] > 0) & (right[2] > 0), gain, -1.0)
    flat = gain.reshape(*gain.shape[:2], -1)
    at = flat.argmax(axis=2)
    feature, cut = at // gain.shape[3], at % gain.shape[3]
    c, n = np.indices(at.shape)
    side = left[:, c, n, feature, cut]
    return np.concatenate([
        np.stack([flat[c, n, at], feature + first, cut]), side, total,
    ]).transpose(1, 2, 0)


def grow(best_of_level, columns: int, classes: int, depth: int, rate: float) -> tuple[Trees, float]:
    """One round: ``best_of_level(trees, level)`` gives best_splits over all rows, and the loss at level 0."""
    trees = Trees.leaves(columns, depth)
    shrink = rate * ((classes - 1) / classes if columns > 1 else 1.0)
    loss = 0.0

    def step(sums: np.ndarray) -> np.ndarray:
        return shrink * np.where(sums[..., 1] > 1e-150, sums[..., 0] / np.maximum(sums[..., 1], 1e-150), 0.0)

    for level in range(depth):
        found, now = best_of_level(trees, level)
        loss = now if level == 0 else loss
        nodes = np.arange((1 << level) - 1, (2 << level) - 1)
        total, left = found[..., 6:9], found[..., 3:6]
        if level == 0:
            trees.value[:, nodes] = step(total)
        split = found[..., 0] > 1e-12
        c, n = np.nonzero(split)
        at = nodes[n]
        trees.feature[c, at], trees.cut[c, at] = found[c, n, 1], found[c, n, 2]
        trees.value[c, 2 * at + 1], trees.value[c, 2 * at + 2] = step(left[c, n]), step(total[c, n] - left[c, n])
        if not split.any():
            break
    return trees, loss


def _deepest(trees: Trees) -> int:
    return int(math.log2(trees.feature.shape[1] + 1)) - 1


class GradientBoosting:
    """Fitted trees of all rounds with the borders of the bins; ``losses`` is the mean training loss before each round."""

    def __init__(self, borders: Sequence[np.ndarray], start: np.ndarray, rounds: Sequence[Trees], losses: Sequence[float]):
        self.borders, self.start, self.rounds, self.losses = list(borders), start, list(rounds), list(losses)

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for j, border in enumerate(self.borders):
            out[:, j] = np.searchsorted(border, x[:, j], side="left")
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        raw = np.repeat(self.start[None], len(x), axis=0)
        for trees in self.rounds:
            raw = raw + trees.scores(bins, _deepest(trees))
        return probabilities(raw)

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                yield pd.Series(list(shared.value.probabilities(np.stack(part.to_list()))) if len(part) else [], dtype=object)

        out = df.withColumn("proba", score(vector_to_array("features")))
        return out.withColumn("prediction", (F.array_position("proba", F.array_max("proba")) - 1).cast("double"))

    def save(self, path: str) -> None:
        from pyspark.sql import SparkSession

        spark = SparkSession.active()
        rows = [(i, bytes(t.pack()), float(x)) for i, (t, x) in enumerate(zip(self.rounds, self.losses))]
        spark.createDataFrame(rows, _TREES).write.parquet(f"{path}/trees")
        borders = [(j, b.tolist()) for j, b in enumerate(self.borders)] + [(-1, self.start.tolist())]
        spark.createDataFrame(borders, "feature int, borders array<double>").write.parquet(f"{path}/borders")

    @classmethod
    def load(cls, spark, path: str) -> GradientBoosting:
        start, *borders = [np.array(r.borders) for r in spark.read.parquet(f"{path}/borders").orderBy("feature").collect()]
        rows = spark.read.parquet(f"{path}/trees").orderBy("round").collect()
        return cls(borders, start, [Trees.unpack(bytes(r.trees), len(start)) for r in rows], [r.loss for r in rows])


class _Spread:
    """Levels over a table of blocks, merged by chunks of features."""

    def __init__(self, table: DataFrame, scratch: Scratch, width: int, columns: int, depth: int):
        self.scratch, self.width, self.columns, self.depth = scratch, width, columns, depth
        self.replay: list[Trees] = []
        self.written = 0
        self._take(table)

    def _take(self, table: DataFrame) -> None:
        self.table = table
        self.groups = math.ceil(math.sqrt(table.rdd.getNumPartitions()))

    def level(self, trees: Trees, level: int):
        width, columns, depth, replay = self.width, self.columns, self.depth, list(self.replay)
        per = max(1, CHUNK_CELLS // (3 * columns * (1 << level) * BINS))  # features of a chunk
        shape = (3, columns, 1 << level)

        def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, loss = np.zeros((*shape, width, BINS)), 0.0
            for frame in frames:
                for row in frame.itertuples(index=False):
                    rows = Rows(row, width, columns)
                    for done in replay:
                        rows.advance(done, depth)
                    total += rows.histograms(trees, level)
                    loss += rows.loss() if level == 0 else 0.0
            parts = [(i, 0, total[:, :, :, j : j + per].tobytes()) for i, j in enumerate(range(0, width, per))]
            yield pd.DataFrame([*parts, (-1, 0, np.array([loss]).tobytes())], columns=["chunk", "task", "sums"])

        def merged(frame: pd.DataFrame) -> pd.DataFrame:
            total = 0
            for raw in frame["sums"]:
                total = total + np.frombuffer(raw)
            return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "task": frame["task"].iloc[:1], "sums": [total.tobytes()]})

        def best(frame: pd.DataFrame) -> pd.DataFrame:
            out = merged(frame)
            chunk = int(out["chunk"].iloc[0])
            if chunk >= 0:
                sums = np.frombuffer(out["sums"].iloc[0]).reshape(*shape, -1, BINS)
                out["sums"] = [best_splits(sums, chunk * per).tobytes()]
            return out

        parts = self.table.mapInPandas(add, _PART)
        if self.groups > 4:
            parts = parts.withColumn("task", (F.spark_partition_id() % self.groups).cast("int"))
            parts = parts.groupBy("chunk", "task").applyInPandas(merged, _PART)
        rows = sorted(parts.groupBy("chunk").applyInPandas(best, _PART).collect(), key=lambda r: r.chunk)
        found = np.stack([np.frombuffer(bytes(r.sums)).reshape(columns, 1 << level, 9) for r in rows[1:]])
        at = found[..., 0].argmax(axis=0)
        return np.take_along_axis(found, at[None, ..., None], axis=0)[0], float(np.frombuffer(bytes(rows[0].sums))[0])

    def advance(self, trees: Trees) -> None:
        self.replay.append(trees)
        if len(self.replay) < REPLAYED:
            return
        width, columns, depth, replay = self.width, self.columns, self.depth, self.replay

        def rescored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                raws = []
                for row in frame.itertuples(index=False):
                    rows = Rows(row, width, columns)
                    for done in replay:
                        rows.advance(done, depth)
                    raws.append(rows.raw.tobytes())
                yield frame.assign(raw=raws)

        old = f"scores{self.written}"
        self.written += 1
        self._take(self.scratch.write(self.table.mapInPandas(rescored, _BLOCK), f"scores{self.written}"))
        self.replay = []
        if self.written > 1:
            self.scratch.drop(old)


def bin_borders(train: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Borders of at most ``bins`` bins per feature, from quantiles of all rows."""
    cells = train.select(F.posexplode(vector_to_array("features")).alias("feature", "x"))
    asked = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    rows = cells.groupBy("feature").agg(F.percentile_approx("x", asked, 10_000).alias("q"), F.max("x").alias("most")).collect()
    return [np.array([q for q in sorted(set(r.q)) if q < r.most]) for r in sorted(rows, key=lambda r: r.feature)]


def fit_gbm(train: DataFrame, trees: int = cfg.GBM_TREES, depth: int = cfg.GBM_DEPTH, rate: float = cfg.GBM_RATE,
            block_cells: int = BLOCK_CELLS, one_task: int = ONE_TASK) -> GradientBoosting:
    """Boosting on the multinomial loss (two classes: the log odds of the second), unweighted like its model.

    Raw scores start from the log shares of the labels. A split must leave rows on both sides; its gain is the
    squared difference of the mean residuals, weighted by the harmonic row counts.
    """
    spark, scratch = train.sparkSession, Scratch(train.sparkSession, "gbm")
    rows = scratch.write(train.select("features", F.col("label_idx").cast("long").alias("label")), "rows")
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    classes = max(2, 1 + max(sizes))
    n = sum(sizes.values())
    share = np.maximum(np.array([sizes.get(k, 0) for k in range(classes)]) / n, 1e-15)
    start = np.log(share) if classes > 2 else np.log(share[1:] / share[:1])
    model = GradientBoosting(bin_borders(rows), start, [], [])
    width, columns = len(model.borders), len(start)
    per_block = max(1, block_cells // max(1, width))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), per_block):
                own = frame.iloc[at : at + per_block]
                bins = model.binned(np.stack(own["x"].to_list()))
                raw = np.repeat(start[None], len(own), axis=0)
                yield pd.DataFrame({"bins": [bins.tobytes()], "label": [own["label"].to_numpy(np.int64).tobytes()], "raw": [raw.tobytes()]})

    one = n * width <= one_task
    source = rows.select(vector_to_array("features").alias("x"), "label")
    blocks = scratch.write((source.coalesce(1) if one else source).mapInPandas(pack, _BLOCK), "scores0")
    if one:

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = [Rows(row, width, columns) for frame in frames for row in frame.itertuples(index=False)]

            def level(grown: Trees, at: int):
                return best_splits(sum(b.histograms(grown, at) for b in own)), sum(b.loss() for b in own) if at == 0 else 0.0

            out = []
            for i in range(trees if own else 0):
                grown, loss = grow(level, columns, classes, depth, rate)
                for b in own:
                    b.advance(grown, depth)
                out.append((i, grown.pack(), loss / n))
            yield pd.DataFrame(out, columns=["round", "trees", "loss"])

        found = blocks.coalesce(1).mapInPandas(run, _TREES).orderBy("round").collect()
        model.rounds = [Trees.unpack(bytes(r.trees), columns) for r in found]
        model.losses = [r.loss for r in found]
        return model
    spread = _Spread(blocks, scratch, width, columns, depth)
    for _ in range(trees):
        grown, loss = grow(spread.level, columns, classes, depth, rate)
        spread.advance(grown)
        model.rounds.append(grown)
        model.losses.append(loss / n)
    return model
