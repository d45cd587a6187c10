"""Random forest on quantile bins, whose trees are finished where their rows are.

Nodes of many rows are split together: each task adds up its rows by node, drawn feature, bin and class, and
only the best split of a node reaches the driver. The rows of smaller nodes then go to one task each, which
grows that part of the tree to its end, level by level in NumPy. Finished parts stay in a written table; rows to
be scored meet them by tree and node, and votes are whole numbers, so their sums do not depend on task order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as cfg
from ..scratch import Scratch
from .boosting import BINS, bin_borders

BLOCK_CELLS = 1 << 19  # row x feature cells of a block
OWN_CELLS = 1 << 23  # cells of a node up to which one task grows what is below it
PASS_CELLS = 1 << 22  # histogram cells that a task adds up in one pass
STEP_CELLS = 1 << 20  # cells that are compared at once inside a task
LANES = (2, 4, 8, 16)  # nodes of up to so many rows are sorted, larger ones counted by bin
ONE_VOTE = 1 << 32
TASK_BYTES = 1 << 26  # of rows that one task grows or scores
HELD_CELLS = 1 << 23  # votes that a task holds before it hands them on

_PAD = 255


def _struct(**kinds) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_LONG, _BYTES = T.LongType(), T.BinaryType()
_BLOCK = _struct(block=_LONG, bins=_BYTES, label=_BYTES, weight=_BYTES)
_SUMS = _struct(slot=_LONG, sums=_BYTES)
_PIECE = _struct(tree=_LONG, node=_LONG, block=_LONG, bins=_BYTES, label=_BYTES, weight=_BYTES)
_PART = _struct(tree=_LONG, node=_LONG, feature=_BYTES, cut=_BYTES, next=_BYTES, votes=_BYTES)
_ASKED = _struct(block=_LONG, bins=_BYTES, row=_BYTES)
_QUESTION = _struct(tree=_LONG, node=_LONG, block=_LONG, rows=_LONG, place=_BYTES, bins=_BYTES)
_VOTES = _struct(block=_LONG, votes=_BYTES)
_SCORED = _struct(__row=_LONG, proba=T.ArrayType(T.DoubleType()))


def drawn_features(seed: int, tree: int, path: np.ndarray, width: int, m: int) -> np.ndarray:
    """(node, m): features a node may split on, by a hash of seed, tree, node and feature."""
    if m >= width:
        return np.broadcast_to(np.arange(width), (len(path), width))
    with np.errstate(over="ignore"):
        x = np.uint64(seed & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree) * np.uint64(0xD1B54A32D192ED03)
        x = x + path.astype(np.uint64)[:, None] * np.uint64(0x8CB92BA72F3D8DD7) + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        x ^= x >> np.uint64(31)
    return np.sort(np.argpartition(x, m - 1, axis=1)[:, :m], axis=1)


def best_splits(left: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the gain, drawn feature and place of the best split; gain -1 where none is valid.

    ``left`` (node, feature, place, class) holds the weights up to each place. The gain is the fall of the
    Gini impurity; ties go to the first feature, then to the first place.
    """
    total = left[:, 0, -1]
    n, squares = left.sum(axis=3), np.einsum("nfpc,nfpc->nfp", left, left)
    all_squares = (total * total).sum(axis=1)[:, None, None]
    others = all_squares - 2 * np.einsum("nfpc,nc->nfp", left, total) + squares
    whole = total.sum(axis=1)[:, None, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = squares / n + others / (whole - n) - all_squares / whole
    gain = np.where(valid, np.round(gain / whole, 10), -1.0).reshape(len(left), -1)  # equal up to rounding is equal
    at = gain.argmax(axis=1)
    gain = gain[np.arange(len(left)), at]
    return np.where(gain > 0, gain, -1.0), at // left.shape[2], at % left.shape[2]


def _runs(size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of all entries of the runs that begin at ``first``."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _splits(bins, label, weight, rows, first, size, features, classes):
    """Gain, feature and cut of every node; node i has the rows ``rows[first[i] : first[i] + size[i]]``."""
    k, m = features.shape
    gain, feature, cut = np.full(k, -1.0), np.zeros(k, np.int64), np.zeros(k, np.int64)
    lane = np.searchsorted(LANES, size)
    for i in np.unique(lane):
        nodes = np.flatnonzero(lane == i)
        length = LANES[i] if i < len(LANES) else BINS
        per = max(1, STEP_CELLS // (length * m * classes))
        if i == len(LANES):  # of large nodes the gathered rows count, too
            per = min(per, max(1, STEP_CELLS // int(size[nodes].mean() * m + 1)))
        for at in range(0, len(nodes), per):
            own = nodes[at : at + per]
            n, f, entry = size[own], features[own], rows[_runs(size[own], first[own])]
            node = np.repeat(np.arange(len(own)), n)
            if i < len(LANES):
                place = _runs(n, np.zeros(len(own), np.int64))
                value = np.full((len(own), length, m), _PAD, np.uint8)
                value[node, place] = bins[entry[:, None], f[node]]
                value = value.transpose(0, 2, 1)
                order = value.argsort(axis=2, kind="stable")
                value = np.take_along_axis(value, order, axis=2)
                each = np.zeros((len(own), length, classes))
                each[node, place, label[entry]] = weight[entry]
                left = each[np.arange(len(own))[:, None, None], order]
                valid = np.zeros(value.shape, bool)
                valid[:, :, :-1] = (value[:, :, :-1] < value[:, :, 1:]) & (value[:, :, 1:] < _PAD)
                np.cumsum(left, axis=2, out=left)
            else:
                cell = (node[:, None] * m + np.arange(m)) * BINS + bins[entry[:, None], f[node]]
                cell = cell * classes + label[entry][:, None]
                left = np.bincount(cell.ravel(), np.repeat(weight[entry], m), len(own) * m * BINS * classes)
                left = left.reshape(len(own), m, BINS, classes).cumsum(axis=2)
                seen = left.sum(axis=3)
                valid, value = (seen > 0) & (seen < seen[:, :, -1:]), None
            gain[own], j, where = best_splits(left, valid)
            here = np.arange(len(own))
            feature[own] = f[here, j]
            cut[own] = where if value is None else value[here, j, where]
    return gain, feature, cut


def grown(bins, label, weight, classes: int, levels: int, features_of, path: int):
    """``feature, cut, next, votes`` of the tree over all rows, ``levels`` deep at most.

    ``next`` is a node's left child, the right one follows; a negative one is -1 - (row of ``votes``).
    ``features_of(paths)`` draws the features; the children of path p are 2p + 1 and 2p + 2.
    """
    rows, size, paths = np.arange(len(label)), np.array([len(label)]), np.array([path], np.int64)
    features, cuts, nexts, leaves, made = [], [], [], [], 1
    for level in range(levels + 1):
        k = len(size)
        node = np.repeat(np.arange(k), size)
        total = np.bincount(node * classes + label[rows], weight[rows], k * classes).reshape(k, classes)
        open_ = np.flatnonzero((total > 0).sum(axis=1) > 1) if level < levels else np.zeros(0, np.int64)
        gain, feature, cut = np.full(k, -1.0), np.zeros(k, np.int64), np.zeros(k, np.int64)
        if len(open_):
            drawn = features_of(paths[open_])
            first = np.cumsum(size) - size
            gain[open_], feature[open_], cut[open_] = _splits(bins, label, weight, rows, first[open_], size[open_], drawn, classes)
        split = gain > 0
        after = np.zeros(k, np.int64)
        after[split] = made + 2 * np.arange(split.sum())
        made += 2 * int(split.sum())
        after[~split] = -1 - (sum(map(len, leaves)) + np.arange((~split).sum()))
        leaves.append(total[~split])
        features.append(feature), cuts.append(cut), nexts.append(after)
        if not split.any():
            break
        keep = split[node]
        rows, node = rows[keep], node[keep]
        right = bins[rows, feature[node]] > cut[node]
        child = 2 * (np.cumsum(split) - 1)[node] + right
        rows, size = rows[child.argsort(kind="stable")], np.bincount(child, minlength=2 * int(split.sum()))
        paths = (2 * paths[split][:, None] + [1, 2]).ravel()
    leaf = np.concatenate(leaves)
    votes, kind = np.unique(np.floor(leaf / leaf.sum(axis=1, keepdims=True) * ONE_VOTE).astype(np.int64), axis=0, return_inverse=True)
    after = np.concatenate(nexts)
    after[after < 0] = -1 - kind.reshape(-1)[-1 - after[after < 0]]
    return np.concatenate(features).astype(np.int16), np.concatenate(cuts).astype(np.uint8), after.astype(np.int32), votes


def reached(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The node without children that every row ends at."""
    at = np.zeros(len(bins), np.int64)
    live = np.flatnonzero(after[at] > 0)
    while len(live):
        here = at[live]
        at[live] = after[here] + (bins[live, feature[here]] > cut[here])
        live = live[after[at[live]] > 0]
    return at


class Top:
    """The first nodes of one tree, as far as they are split together; ``path`` names a node in the whole tree."""

    def __init__(self):
        self.feature, self.cut, self.next, self.path = [0], [0], [-1], [0]

    def split(self, node: int, feature: int, cut: int) -> int:
        self.feature[node], self.cut[node], self.next[node] = feature, cut, len(self.path)
        self.path += [2 * self.path[node] + 1, 2 * self.path[node] + 2]
        self.feature += [0, 0]
        self.cut += [0, 0]
        self.next += [-1, -1]
        return self.next[node]

    def places(self, bins: np.ndarray) -> np.ndarray:
        return reached(bins, np.array(self.feature), np.array(self.cut), np.array(self.next))


def _binned(x: np.ndarray, borders: Sequence[np.ndarray]) -> np.ndarray:
    if not np.isfinite(x).all():
        raise ValueError("features must be finite")
    out = np.empty(x.shape, np.uint8)
    for j, border in enumerate(borders):
        out[:, j] = np.searchsorted(border, x[:, j], side="left")
    return out


def _spread(df: DataFrame, count: int) -> DataFrame:
    """Blocks dealt to tasks, a few to each."""
    return df.repartition(max(2 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(count / 8)), "block")


def _dealt(df: DataFrame, size: int) -> DataFrame:
    """Parts of trees dealt to tasks; they are small for the work that they carry."""
    return df.repartition(max(4 * df.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES), "tree", "node")


def _numbered(frames: Iterator[pd.DataFrame], per: int) -> Iterator[tuple[int, pd.DataFrame]]:
    number = TaskContext.get().partitionId() << 32
    for frame in frames:
        for at in range(0, len(frame), per):
            yield number, frame.iloc[at : at + per]
            number += 1


class RandomForest:
    """Tops of the trees, a table of what grew below them, and the borders of the bins."""

    def __init__(self, borders: Sequence[np.ndarray], classes: int, tops: Sequence[Top], parts: DataFrame):
        self.borders, self.classes, self.tops, self.parts = list(borders), classes, list(tops), parts

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``proba``, the mean over the trees, and ``prediction``, its first greatest class."""
        spark, scratch = df.sparkSession, Scratch(df.sparkSession, "forest-scores")
        borders, classes, tops = self.borders, self.classes, self.tops
        per = max(1, 4 * BLOCK_CELLS // max(1, len(borders)))
        rows = scratch.write(df.withColumn("__row", F.monotonically_increasing_id()), "rows")

        def pack(frames):
            for number, own in _numbered(frames, per):
                bins = _binned(np.stack(own["x"].to_list()), borders)
                yield pd.DataFrame({"block": [number], "bins": [bins.tobytes()], "row": [own["__row"].to_numpy(np.int64).tobytes()]})

        blocks = scratch.write(rows.select("__row", vector_to_array("features").alias("x")).mapInPandas(pack, _ASKED), "blocks")

        def ask(frames):
            for frame in frames:
                for b in frame.itertuples(index=False):
                    bins = np.frombuffer(b.bins, np.uint8).reshape(-1, len(borders))
                    for tree, top in enumerate(tops):
                        at = top.places(bins)
                        for node in np.unique(at):
                            here = np.flatnonzero(at == node)
                            yield pd.DataFrame({
                                "tree": [tree], "node": [node], "block": [b.block], "rows": [len(bins)],
                                "place": [here.astype(np.int32).tobytes()], "bins": [bins[here].tobytes()],
                            })

        def answer(frames):
            held: dict[int, np.ndarray] = {}

            def handed():
                out = pd.DataFrame({"block": list(held), "votes": [v.tobytes() for v in held.values()]})
                held.clear()
                return out

            for frame in frames:
                for q in frame.itertuples(index=False):
                    bins = np.frombuffer(q.bins, np.uint8).reshape(-1, len(borders))
                    after = np.frombuffer(q.next, np.int32)
                    at = reached(bins, np.frombuffer(q.feature, np.int16), np.frombuffer(q.cut, np.uint8), after)
                    votes = np.frombuffer(q.votes, np.int64).reshape(-1, classes)
                    if q.block not in held and sum(v.size for v in held.values()) + q.rows * classes > HELD_CELLS and held:
                        yield handed()
                    total = held.setdefault(q.block, np.zeros((q.rows, classes), np.int64))
                    total[np.frombuffer(q.place, np.int32)] += votes[-1 - after[at]]
            if held:
                yield handed()

        def merged(frame):
            total = sum(np.frombuffer(v, np.int64) for v in frame["votes"])
            return pd.DataFrame({"block": frame["block"].iloc[:1], "votes": [total.tobytes()]})

        def opened(frames):
            for frame in frames:
                for b in frame.itertuples(index=False):
                    total = np.frombuffer(b.votes, np.int64).reshape(-1, classes)
                    total = np.where(total.any(axis=1, keepdims=True), total, 1)
                    yield pd.DataFrame({"__row": np.frombuffer(b.row, np.int64), "proba": list(total / total.sum(axis=1, keepdims=True))})

        count = blocks.count()
        questions = _dealt(_spread(blocks, count).mapInPandas(ask, _QUESTION), count * per * len(tops) * (len(borders) + 4))
        # by its estimate a question is as large as a block, though every tree asks for each row: never broadcast
        votes = questions.hint("merge").join(self.parts, ["tree", "node"]).mapInPandas(answer, _VOTES).groupBy("block").applyInPandas(merged, _VOTES)
        scored = scratch.write(blocks.select("block", "row").join(votes, "block").mapInPandas(opened, _SCORED), "scored")
        out = rows.join(scored, "__row").drop("__row")
        return out.withColumn("prediction", (F.array_position("proba", F.array_max("proba")) - 1).cast("double")).select(*df.columns, "prediction", "proba")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.parts.write.parquet(f"{path}/parts")
        tops = [(i, self.classes, t.feature, t.cut, t.next, t.path) for i, t in enumerate(self.tops)]
        spark.createDataFrame(tops, "tree int, classes int, feature array<int>, cut array<int>, next array<int>, path array<long>").write.parquet(f"{path}/tops")
        spark.createDataFrame([(j, b.tolist()) for j, b in enumerate(self.borders)], "feature int, borders array<double>").write.parquet(f"{path}/borders")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RandomForest:
        borders = [np.array(r.borders) for r in spark.read.parquet(f"{path}/borders").orderBy("feature").collect()]
        tops, rows = [], spark.read.parquet(f"{path}/tops").orderBy("tree").collect()
        for r in rows:
            tops.append(Top())
            tops[-1].feature, tops[-1].cut, tops[-1].next, tops[-1].path = r.feature, r.cut, r.next, r.path
        return cls(borders, rows[0].classes, tops, spark.read.parquet(f"{path}/parts"))


class _Rows:
    """A block's binned rows; how often a tree draws each of them follows from seed, tree and block."""

    def __init__(self, row, width: int, seed: int, trees: int):
        self.bins = np.frombuffer(row.bins, np.uint8).reshape(-1, width)
        self.label, self.weight = np.frombuffer(row.label, np.int64), np.frombuffer(row.weight)
        self.block, self.seed, self.trees = row.block, seed, trees

    def drawn(self, tree: int) -> np.ndarray:
        """Weight of every row in a tree, 0 where it is not drawn; a single tree takes all rows."""
        if self.trees == 1:
            return self.weight
        return self.weight * np.random.default_rng([self.seed & 0xFFFFFFFF, tree, self.block]).poisson(1.0, len(self.label))


def _split_together(blocks: DataFrame, tops: list[Top], n: int, limit: int, width: int, classes: int, m: int, depth: int, seed: int) -> dict:
    """Splits nodes of over ``limit`` rows; returns (tree, node) -> class weights of those that stay leaves."""
    trees, leaves = len(tops), {}
    level = 0
    large = [(t, 0) for t in range(trees)] if n > limit else []
    shape = (m, BINS, classes + 1)  # the last is the number of rows
    per = max(1, PASS_CELLS // math.prod(shape))
    while large:
        found = []
        for first in range(0, len(large), per):
            asked = large[first : first + per]

            def add(frames, asked=asked):
                total = np.zeros((len(asked), math.prod(shape)))
                for frame in frames:
                    for row in frame.itertuples(index=False):
                        b, tree = _Rows(row, width, seed, trees), -1
                        for slot, (t, node) in enumerate(asked):
                            if t != tree:
                                tree, weight, at = t, b.drawn(t), tops[t].places(b.bins)
                            here = np.flatnonzero((at == node) & (weight > 0))
                            f = drawn_features(seed, t, np.array([tops[t].path[node]]), width, m)[0]
                            cell = (np.arange(m) * BINS + b.bins[here[:, None], f]) * (classes + 1)
                            total[slot] += np.bincount((cell + b.label[here, None]).ravel(), np.repeat(weight[here], m), total.shape[1])
                            total[slot] += np.bincount((cell + classes).ravel(), minlength=total.shape[1])
                yield pd.DataFrame({"slot": np.arange(len(asked)), "sums": [t.tobytes() for t in total]})

            def best(frame):
                left = sum(np.frombuffer(v) for v in frame["sums"]).reshape(1, *shape).cumsum(axis=2)
                rows = left[..., -1]
                gain, j, cut = best_splits(left[..., :-1], (rows > 0) & (rows < rows[:, :, -1:]))
                out = np.concatenate([gain, j, cut, rows[0, j, cut], rows[0, 0, -1:], left[0, 0, -1, :-1]])
                return pd.DataFrame({"slot": frame["slot"].iloc[:1], "sums": [out.tobytes()]})

            got = {r.slot: np.frombuffer(bytes(r.sums)) for r in blocks.mapInPandas(add, _SUMS).groupBy("slot").applyInPandas(best, _SUMS).collect()}
            found += [got[slot] for slot in range(len(asked))]
        level += 1
        after = []
        for (t, node), (gain, j, cut, left, rows, *total) in zip(large, found):
            if gain <= 0 or np.count_nonzero(total) < 2 or level > depth:
                leaves[t, node] = total
                continue
            feature = drawn_features(seed, t, np.array([tops[t].path[node]]), width, m)[0][int(j)]
            child = tops[t].split(node, int(feature), int(cut))
            after += [(t, child + side) for side, own in ((0, left), (1, rows - left)) if own > limit]
        large = after
    return leaves


def fit_forest(train: DataFrame, trees: int = cfg.RF_TREES, depth: int = cfg.RF_MAX_DEPTH, seed: int = cfg.SEED,
               own_cells: int = OWN_CELLS, block_cells: int = BLOCK_CELLS) -> RandomForest:
    """Trees on rows drawn with replacement, by weighted Gini impurity over the square root of the features.

    As in Spark's forest, rows are drawn by Poisson counts, a single tree takes all rows and features, a node without a
    gain among its drawn features is a leaf, and the class shares of the leaves are averaged.
    """
    scratch = Scratch(train.sparkSession, "forest")
    rows = scratch.write(train.select("features", F.col("label_idx").cast("long").alias("label"), F.col("weight").cast("double").alias("weight")), "rows")
    n, classes = rows.agg(F.count("*"), F.max("label") + 1).first()
    borders = bin_borders(rows)
    width = len(borders)
    m = width if trees == 1 else math.ceil(math.sqrt(width))
    per, limit = max(1, block_cells // width), max(1, own_cells // width)

    def pack(frames):
        for _, own in _numbered(frames, per):
            parts = _binned(np.stack(own["x"].to_list()), borders), own["label"].to_numpy(np.int64), own["weight"].to_numpy(np.float64)
            whole = np.concatenate([p.view(np.uint8).reshape(len(own), -1) for p in parts], axis=1)
            order = whole.view(f"V{whole.shape[1]}").ravel().argsort()  # a block is named by its rows in any order
            name = int.from_bytes(blake2b(whole[order].tobytes(), digest_size=7).digest())
            yield pd.DataFrame({"block": [name], **{c: [p[order].tobytes()] for c, p in zip(("bins", "label", "weight"), parts)}})

    source = rows.select(vector_to_array("features").alias("x"), "label", "weight")
    blocks = scratch.write(source.mapInPandas(pack, _BLOCK), "blocks")
    blocks = _spread(blocks, blocks.count())
    tops = [Top() for _ in range(trees)]
    leaves = _split_together(blocks, tops, n, limit, width, classes, m, depth, seed)

    def deal(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                b = _Rows(row, width, seed, trees)
                for tree, top in enumerate(tops):
                    weight = b.drawn(tree)
                    at = top.places(b.bins)
                    for node in np.unique(at):
                        if (tree, node) not in leaves:
                            here = np.flatnonzero((at == node) & (weight > 0))
                            yield pd.DataFrame({
                                "tree": [tree], "node": [node], "block": [b.block], "bins": [b.bins[here].tobytes()],
                                "label": [b.label[here].astype(np.int32).tobytes()], "weight": [weight[here].tobytes()],
                            })

    def grow(frame):
        tree, node = int(frame["tree"].iloc[0]), int(frame["node"].iloc[0])
        path, frame = tops[tree].path[node], frame.sort_values("block")  # sums in the same order whenever they are taken
        bins, label, weight = (np.frombuffer(b"".join(frame[c]), kind) for c, kind in (("bins", np.uint8), ("label", np.int32), ("weight", np.float64)))
        if not len(label):  # no row drawn: no opinion
            parts = np.zeros(1, np.int16), np.zeros(1, np.uint8), np.full(1, -1, np.int32), np.zeros((1, classes), np.int64)
        else:
            levels = depth - int(math.log2(path + 1))
            parts = grown(bins.reshape(-1, width), label, weight, classes, levels, lambda p: drawn_features(seed, tree, p, width, m), path)
        return pd.DataFrame({"tree": [tree], "node": [node], **{c: [p.tobytes()] for c, p in zip(_PART.names[2:], parts)}})

    pieces = _dealt(blocks.mapInPandas(deal, _PIECE), n * trees * (width + 12))
    below = pieces.groupBy("tree", "node").applyInPandas(grow, _PART)
    done = []
    for (tree, node), total in leaves.items():
        votes = np.floor(np.array(total) / sum(total) * ONE_VOTE).astype(np.int64)
        done.append((tree, node, bytes(2), bytes(1), np.full(1, -1, np.int32).tobytes(), votes.tobytes()))
    if done:
        below = below.unionByName(train.sparkSession.createDataFrame(done, _PART))
    return RandomForest(borders, classes, tops, scratch.write(below, "parts"))
