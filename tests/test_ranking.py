import pytest
from pyspark.sql import functions as F

from tagloom.operators import learning as ln
from tagloom.operators import ranking as rk


@pytest.fixture(scope="module")
def classes(spark):
    sizes = {"a": 1, "b": 4, "c": 64, "d": 65, "e": 1000}
    data = [(i, c) for i, c in enumerate(c for c, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(data, "id long, label string").repartition(5)


def test_split_partitions_ids(classes):
    out = rk.stratified_split(classes, "label", "id").groupBy("label", "split").count().collect()
    got = {(r["label"], r["split"]): r["count"] for r in out}
    assert got[("e", "test")] == 200 and got[("b", "test")] == 1 and ("a", "test") not in got and got[("d", "test")] == 13
    assert sum(got.values()) == 1134


def test_folds_are_even_and_stable(classes):
    a = rk.stratified_kfold(classes, "label", "id")
    sizes = [r["count"] for r in a.where("label = 'd'").groupBy("fold").count().collect()]
    assert sizes == [13] * 5
    b = rk.stratified_kfold(classes.repartition(13), "label", "id")
    assert a.exceptAll(b.select(a.columns)).isEmpty()


def test_few_shot_and_cap(classes):
    got = {r["label"]: r["count"] for r in rk.few_shot_sample(classes, "label", "id").groupBy("label").count().collect()}
    assert got == {"a": 1, "b": 4, "c": 64, "d": 64, "e": 64}
    assert rk.sample_cap(classes, "id", 300).count() == 300 and rk.sample_cap(classes, "id", 5000).count() == 1134


def test_oversample_reaches_majority(classes):
    out = rk.oversample(classes, "label", "id")
    assert {r["count"] for r in out.groupBy("label").count().collect()} == {1000}
    assert out.where("copy = 0").count() == 1134


def test_salted_top_n_equals_plain(classes):
    order = [F.desc("id")]
    salted = rk.top_n_per_group(classes, ["label"], order, 2000, ["id"])
    assert salted.count() == 1134
    small = rk.top_n_per_group(classes, ["label"], order, 2)
    assert {(r["label"], r["rank"]) for r in small.collect()} >= {("e", 1), ("e", 2), ("a", 1)}


def test_top_k_ties_and_short_rows(spark):
    df = spark.createDataFrame([(1, [0.4, 0.4, 0.2])], "id long, p array<double>")
    r = rk.top_k_tags(df, "id", "p", ["x", "y", "z"], 5).first()
    assert (r["tag_1"], r["tag_2"], r["tag_3"]) == ("x", "y", "z") and "tag_4" not in r.asDict()
    with pytest.raises(ValueError):
        rk.top_k_tags(df.withColumn("p", F.col("p")[0]), "id", "p", ["x"])


def test_majority_vote_tie(spark):
    df = spark.createDataFrame([(1, 2, 0, 1), (2, 2, 2, 0)], "id long, a int, b int, c int")
    assert dict(ln.majority_vote(df, "id", ["a", "b", "c"]).collect()) == {1: 0, 2: 2}


def test_ordered_rank(spark):
    df = spark.createDataFrame([("r", i) for i in (5, 9000, 1, 4100)], "run string, at long")
    got = {r["at"]: r["rank"] for r in rk.ordered_rank(df, ["run"], "at", F.floor(F.col("at") / 4096)).collect()}
    assert got == {1: 1, 5: 2, 4100: 3, 9000: 4}
