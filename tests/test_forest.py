"""The random forest against splits by hand, Spark's own forest, and itself with smaller parts."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tagloom.operators import forest as fo
from tagloom.operators import learning as ln


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 9))
    label = (x[:, 0] > 0).astype(int) + (x[:, 1] + 0.3 * rng.normal(size=1200) > 0.5)
    rows = [(i, v.tolist(), float(c), 1.0 + float(c)) for i, (v, c) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "id long, v array<double>, label_idx double, weight double")
    return df.select("id", array_to_vector("v").alias("features"), "label_idx", "weight").persist()


def by_hand(bins, label, weight, features, classes):
    def gini(at):
        w = np.array([weight[at & (label == c)].sum() for c in range(classes)])
        return w.sum() - (w**2).sum() / w.sum()

    every, best = np.ones(len(label), bool), (1e-9, -1, -1)
    for f in features:
        for cut in np.unique(bins[:, f])[:-1]:
            side = bins[:, f] <= cut
            gain = gini(every) - gini(side) - gini(~side)
            if gain > best[0] + 1e-9:
                best = (gain, f, cut)
    return best


@pytest.mark.parametrize("size", [2, 3, 7, 16, 17, 90])
def test_splits_by_hand(size):
    rng = np.random.default_rng(size)
    for _ in range(10):
        bins, label = rng.integers(0, 12, (size, 6)).astype(np.uint8), rng.integers(0, 3, size)
        weight = rng.integers(1, 4, size) * 0.5
        features = np.sort(rng.permutation(6)[:3])
        gain, f, cut = fo._splits(bins, label, weight, np.arange(size), np.array([0]), np.array([size]), features[None], 3)
        hand = by_hand(bins, label, weight, features, 3)
        assert gain[0] == pytest.approx(hand[0] / weight.sum()) if hand[1] >= 0 else gain[0] == -1
        if hand[1] >= 0:
            assert (f[0], cut[0]) == hand[1:]


def test_full_trees_separate_all_distinct_rows():
    rng = np.random.default_rng(1)
    bins, label = rng.integers(0, 32, (500, 8)).astype(np.uint8), rng.integers(0, 4, 500)
    feature, cut, after, votes = fo.grown(bins, label, np.ones(500), 4, 30, lambda p: fo.drawn_features(1, 0, p, 8, 8), 0)
    got = votes[-1 - after[fo.reached(bins, feature, cut, after)]]
    assert (got.argmax(axis=1) == label).all() and (got.max(axis=1) == fo.ONE_VOTE).all()
    stump = fo.grown(bins, label, np.ones(500), 4, 1, lambda p: fo.drawn_features(1, 0, p, 8, 8), 0)
    assert (stump[2] > 0).sum() <= 1


def scores(model, df):
    return [(r.id, r.prediction, r.proba) for r in model.transform(df).orderBy("id").collect()]


def test_nodes_split_together_give_the_same_forest(frame, tmp_path):
    whole = fo.fit_forest(frame, 6, 12, block_cells=2000)
    cut = fo.fit_forest(frame, 6, 12, own_cells=9 * 150, block_cells=2000)
    assert all(len(t.path) == 1 for t in whole.tops) and all(len(t.path) > 5 for t in cut.tops)
    expected = scores(whole, frame)
    assert scores(cut, frame) == expected
    cut.save(str(tmp_path / "forest"))
    assert scores(fo.RandomForest.load(frame.sparkSession, str(tmp_path / "forest")), frame) == expected


def test_as_good_as_sparks_forest(frame):
    train, test = frame.where("id < 800"), frame.where("id >= 800")
    spark_model = RandomForestClassifier(numTrees=40, maxDepth=30, seed=1, weightCol="weight", featuresCol="features", labelCol="label_idx").fit(train)
    share = F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))
    theirs = spark_model.transform(test).agg(share).first()[0]
    out = ln.fit_rf(train, 40, 30, 1).transform(test)
    assert out.columns == [*frame.columns, "prediction", "proba"]
    assert out.agg(share).first()[0] >= theirs - 0.03 > 0.7
    assert out.where(F.abs(F.aggregate("proba", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).isEmpty()


def test_copies_and_one_class(spark):
    rows = [([1.0, 2.0], float(i % 4 == 0), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "v array<double>, label_idx double, weight double").select(array_to_vector("v").alias("features"), "label_idx", "weight")
    out = fo.fit_forest(df, 5, own_cells=8).transform(df).select("prediction", "proba").distinct().collect()
    assert len(out) == 1 and out[0].prediction == 0.0 and 0.1 < out[0].proba[1] < 0.45
    only = fo.fit_forest(df.where("label_idx = 0"), 3).transform(df).select("prediction", "proba").distinct().collect()
    assert [tuple(r) for r in only] == [(0.0, [1.0])]
    with pytest.raises(Exception, match="finite"):
        fo.fit_forest(df.withColumn("features", array_to_vector(F.array(F.lit(float("nan")), F.lit(1.0)))), 2)


def test_questions_are_not_broadcast(spark, frame, monkeypatch):
    """Their estimate is that of the rows, while every tree asks for each row."""
    plans, write = {}, fo.Scratch.write

    def noted(self, df, name, *more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name, *more)

    model = fo.fit_forest(frame, trees=3, depth=4)
    monkeypatch.setattr(fo.Scratch, "write", noted)
    assert model.transform(frame).count() == 1200
    assert "SortMergeJoin [tree" in plans["scored"] and "BroadcastHashJoin [tree" not in plans["scored"]
