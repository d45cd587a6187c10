"""Feed-forward net trained by weighted mini-batch Adam with dropout, gradients summed over tasks.

Rows are dealt to mini-batches by a hash of their key and packed into blocks. A step sends the weights to
the tasks that hold the batch and adds up their weighted gradients; the optimiser runs on the sums. What
dropout hides depends on the row, the step and the unit alone, so losses do not depend on how rows are
packed. Rows of up to ONE_TASK cells are trained on in the one task that holds them, by the same code.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as cfg
from ..scratch import Scratch, compact
from .passes import Passes
from .ranking import stratified_kfold

ONE_TASK = 1 << 20
BLOCK_ROWS = 4096
MOST_STEPS = 32  # of an epoch; larger training sets get larger batches

_BLOCK = T.StructType([
    T.StructField("batch", T.IntegerType()), T.StructField("x", T.BinaryType()), T.StructField("label", T.BinaryType()),
    T.StructField("draw", T.BinaryType()),
])
_RESULT = T.StructType([T.StructField("weights", T.BinaryType()), T.StructField("losses", T.BinaryType()), T.StructField("score", T.DoubleType())])


def _shuffled(z: np.ndarray) -> np.ndarray:
    """A well mixed function of 64-bit numbers."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Net:
    """Weights of all layers in one vector; ReLU between the layers."""

    def __init__(self, sizes: Sequence[int]):
        self.sizes = list(sizes)
        shapes = [((a, b), (b,)) for a, b in zip(sizes, sizes[1:])]
        self.shapes = [s for pair in shapes for s in pair]
        self.length = sum(math.prod(s) for s in self.shapes)

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return np.concatenate([
            rng.uniform(-1, 1, math.prod(s)) / math.sqrt(self.sizes[i // 2]) for i, s in enumerate(self.shapes)
        ])

    def layers(self, w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        cuts = np.split(w, np.cumsum([math.prod(s) for s in self.shapes])[:-1])
        parts = [c.reshape(s) for c, s in zip(cuts, self.shapes)]
        return list(zip(parts[::2], parts[1::2]))

    def logits(self, w: np.ndarray, x: np.ndarray) -> np.ndarray:
        *inner, last = self.layers(w)
        for a, b in inner:
            x = np.maximum(x @ a + b, 0.0)
        return x @ last[0] + last[1]

    def gradient(self, w: np.ndarray, x, label, draw, class_weight, step: int, dropout: float) -> np.ndarray:
        """Weighted loss, sum of weights, and the weighted gradient, of one block."""
        layers, inputs, masks = self.layers(w), [x], []
        for i, (a, b) in enumerate(layers[:-1]):
            h = np.maximum(inputs[-1] @ a + b, 0.0)
            code = np.uint64((step * len(layers) + i + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
            unit = _shuffled(np.arange(1, h.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) ^ code)
            chance = _shuffled(draw[:, None] + unit) >> np.uint64(11)
            masks.append((h > 0) * (chance >= np.uint64(int(dropout * 2**53))) / (1 - dropout))
            inputs.append(h * (chance >= np.uint64(int(dropout * 2**53))) / (1 - dropout))
        z = inputs[-1] @ layers[-1][0] + layers[-1][1]
        z = z - z.max(axis=1, keepdims=True)
        log_p = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        own = class_weight[label]
        delta = np.exp(log_p)
        delta[np.arange(len(label)), label] -= 1
        delta *= own[:, None]
        out = []
        for i in range(len(layers) - 1, -1, -1):
            out += [delta.sum(axis=0), (inputs[i].T @ delta).ravel()]
            if i:
                delta = (delta @ layers[i][0].T) * masks[i - 1]
        loss = -(own * log_p[np.arange(len(label)), label]).sum()
        return np.concatenate([[loss, own.sum()], *out[::-1]])


def optimise(net: Net, w: np.ndarray, batches: int, epochs: int, seed: int, gradient, correct, rate: float = cfg.FFNN_RATE,
             decay: float = cfg.FFNN_WEIGHT_DECAY) -> tuple[np.ndarray, list[float], float]:
    """Weights of the epoch with the most hits on the rows held out, mean loss per epoch, and that share.

    ``gradient(w, batch, step)`` sums over a batch's rows, ``correct(w)`` gives hits and rows held out.
    """
    rng, m, v = np.random.default_rng(seed), np.zeros_like(w), np.zeros_like(w)
    best, best_score, losses, step = w, -1.0, [], 0
    for _ in range(epochs):
        total = np.zeros(2)
        for batch in rng.permutation(batches):
            sums = gradient(w, int(batch), step)
            total += sums[:2]
            if sums[1] == 0:
                continue
            step += 1
            g = sums[2:] / sums[1] + decay * w
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        losses.append(float(total[0] / max(total[1], 1e-300)))
        hits, rows = correct(w)
        score = hits / rows if rows else 0.0
        if score > best_score:
            best, best_score = w, score
    return best, losses, best_score


class FeedForward:
    """A trained net; ``losses`` is the mean weighted training loss of each epoch, ``score`` the best accuracy held out."""

    def __init__(self, sizes: Sequence[int], weights: np.ndarray, losses: Sequence[float], score: float):
        self.net, self.weights, self.losses, self.score = Net(sizes), weights, [float(x) for x in losses], float(score)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = self.net.logits(self.weights, x)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

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

        row = [(self.net.sizes, bytes(self.weights.tobytes()), self.losses, float(self.score))]
        schema = "sizes array<int>, weights binary, losses array<double>, score double"
        SparkSession.active().createDataFrame(row, schema).write.parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> FeedForward:
        row = spark.read.parquet(path).first()
        return cls(row.sizes, np.frombuffer(bytes(row.weights)).copy(), row.losses, row.score)


class _Rows:
    def __init__(self, row):
        self.batch, self.label = row.batch, np.frombuffer(row.label, np.int64)
        self.x = np.frombuffer(row.x).reshape(len(self.label), -1)
        self.draw = np.frombuffer(row.draw, np.uint64)


def fit_ffnn(train: DataFrame, key: str, hidden: Sequence[int] = cfg.FFNN_HIDDEN, epochs: int = cfg.FFNN_EPOCHS,
             seed: int = cfg.SEED, classes: int | None = None, batch_rows: int = cfg.FFNN_BATCH_SIZE,
             dropout: float = cfg.FFNN_DROPOUT, one_task: int = ONE_TASK) -> FeedForward:
    """Net on balanced class weights; the epoch with the best accuracy on a fold held out is kept.

    Batches hold about ``batch_rows`` rows, or more where an epoch would else have over MOST_STEPS steps.
    """
    spark, scratch = train.sparkSession, Scratch(train.sparkSession, "ffnn")
    rows = stratified_kfold(train.select(key, "features", "label_idx"), "label_idx", key)
    rows = scratch.write(rows.select(
        vector_to_array("features").alias("x"), F.col("label_idx").cast("long").alias("label"), (F.col("fold") == 0).alias("out"),
        F.xxhash64(F.col(key).cast("string"), F.lit(seed)).alias("draw"),
    ), "rows")
    counted = rows.groupBy("out", "label").agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).collect()
    width = max(r.width for r in counted)
    classes = classes or max(2, 1 + max(r.label for r in counted))
    sizes = np.zeros(classes)
    for r in counted:
        sizes[r.label] += 0 if r.out else r.n
    n = sizes.sum()
    class_weight = np.where(sizes > 0, n / (max(1, (sizes > 0).sum()) * np.maximum(sizes, 1)), 0.0)
    batches = max(1, min(MOST_STEPS, math.ceil(n / batch_rows)))
    batch = F.when(F.col("out"), F.lit(-1)).otherwise(F.pmod(F.col("draw"), F.lit(batches)).cast("int"))
    one = sum(r.n for r in counted) * width <= one_task
    dealt = rows.withColumn("batch", batch)
    share = max(1, min(spark.sparkContext.defaultParallelism, math.ceil(4 * n / batches / BLOCK_ROWS)))
    dealt = dealt.coalesce(1) if one else dealt.repartition(share, "draw").sortWithinPartitions("batch")  # every task has a share of every batch

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b, own in frame.groupby("batch"):
                for at in range(0, len(own), BLOCK_ROWS):
                    part = own.iloc[at : at + BLOCK_ROWS]
                    yield pd.DataFrame({
                        "batch": [b], "x": [np.stack(part["x"].to_list()).astype(np.float64).tobytes()],
                        "label": [part["label"].to_numpy(np.int64).tobytes()], "draw": [part["draw"].to_numpy(np.int64).tobytes()],
                    }).astype({"batch": "int32"})

    blocks = scratch.write(dealt.select("batch", "x", "label", "draw").mapInPandas(pack, _BLOCK), "blocks")
    net = Net([width, *hidden, classes])
    start = net.start(seed)

    def block_gradient(w: np.ndarray, own: _Rows, step: int) -> np.ndarray:
        return net.gradient(w, own.x, own.label, own.draw, class_weight, step, dropout)

    def block_hits(w: np.ndarray, own: _Rows) -> np.ndarray:
        return np.array([(net.logits(w, own.x).argmax(axis=1) == own.label).sum(), len(own.label)], float)

    if one:

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = [_Rows(row) for frame in frames for row in frame.itertuples(index=False)]
            if not held:
                return
            w, losses, score = optimise(
                net, start, batches, epochs, seed,
                lambda w, b, step: sum((block_gradient(w, x, step) for x in held if x.batch == b), np.zeros(2 + net.length)),
                lambda w: sum((block_hits(w, x) for x in held if x.batch == -1), np.zeros(2)),
            )
            yield pd.DataFrame({"weights": [w.tobytes()], "losses": [np.array(losses).tobytes()], "score": [score]})

        row = blocks.coalesce(1).mapInPandas(run, _RESULT).first()
        return FeedForward(net.sizes, np.frombuffer(bytes(row.weights)).copy(), np.frombuffer(bytes(row.losses)), row.score)
    with compact(blocks) as cached:
        parts = {b: Passes(cached.where(F.col("batch") == b)) for b in range(-1, batches)}
        w, losses, score = optimise(
            net, start, batches, epochs, seed,
            lambda w, b, step: parts[b].summed(lambda r: [block_gradient(w, _Rows(r), step)], [(2 + net.length,)])[0],
            lambda w: parts[-1].summed(lambda r: [block_hits(w, _Rows(r))], [(2,)])[0],
        )
    return FeedForward(net.sizes, w, losses, score)
