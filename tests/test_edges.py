"""Cases that once gave wrong answers: bounds in other forms, null labels, entities, retries."""

import pytest
from pyspark.sql import functions as F

from tagloom.functions import html as hx
from tagloom.operators import filters as fl
from tagloom.operators import ranking as rk
from tagloom.operators import tokens as tk
from tagloom.operators.blocks import knn_graph, silhouette
from tagloom.operators.clustering import density_clusters
from tagloom.scratch import Scratch, clean
from tagloom.streaming.incremental import IncrementalExtract


@pytest.mark.parametrize("start,end", [
    ("2025-02-01", "2025-03-01"), ("2025-02-01T00:00", "2025-03-01T00:00"), ("2025-2-1", "2025-3-1"), ("2025-02-01 00:00:00", "2025-03-01 00:00:00"),
])
def test_bounds_in_any_form(spark, start, end):
    days = ["2025-01-31 23:59", "2025-02-01 00:00", "2025-02-28 23:59", "2025-03-01 00:00"]
    rows = [("p", d, "user_need: update-me") for d in days]
    df = spark.createDataFrame(rows, "`Post id` string, `Publish date` string, Tags string")
    assert sorted(r["Publish date"] for r in fl.filter_articles(df, start, end).collect()) == days[1:3]


def test_a_bound_inside_a_minute_keeps_the_minute(spark):
    df = spark.createDataFrame([("p", "2025-03-01 00:00", None)], "`Post id` string, `Publish date` string, Tags string")
    assert fl.filter_articles(df, None, "2025-03-01 00:00:30").count() == 1


def test_null_label_is_a_group(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(30)], "id long, label string")
    split = rk.stratified_split(df, "label", "id")
    assert split.count() == 30 and split.filter("label IS NULL AND split = 'test'").count() == 2
    folds = rk.stratified_kfold(df, "label", "id", 5)
    assert sorted(r["count"] for r in folds.filter("label IS NULL").groupBy("fold").count().collect()) == [2] * 5
    grown = rk.oversample(df, "label", "id")
    assert {r["label"]: r["count"] for r in grown.groupBy("label").count().collect()} == {"a": 20, None: 20}


@pytest.mark.parametrize("raw,text", [
    ("caf&eacute; &euro;5", "café €5"), ("&amp;eacute;", "&eacute;"), ("a &unknown; &b; &amp c", "a &unknown; &b; &amp c"),
    ("&lt;b&gt; &#233;&hellip;&NotEqualTilde;", "<b> é…≂̸"), ("", ""),
])
def test_entities(spark, raw, text):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(hx.unescape(df.t)).first()[0] == text


def test_latest_failure_is_shown(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "page_id long, url string, html string"
    spark.createDataFrame([(1, "u", "<p>none</p>")], schema).write.parquet(src)
    job = IncrementalExtract(spark, src, out).run()
    assert job.failures().first()["error"].startswith("No <article>")
    for html, reason in (("<article><p>x</p></article>", "No content"), ("<article><div class=entry-content></div></article>", "No <p>")):
        job.retry(spark.createDataFrame([(2, "u", html)], schema))
        assert job.failures().first()["error"].startswith(reason)


def test_lemmas_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(1, "cities city"), (1, "walks walk"), (None, "cities")], "id long, a string")
    got = sorted((r["id"] or 0, r["a_tokens"]) for r in tk.token_arrays(df, "id", ["a"]).collect())
    assert got == [(0, ["city"]), (1, ["city", "city"]), (1, ["walk", "walk"])]


def test_no_token_is_shuffled_by_itself(spark):
    df = spark.createDataFrame([(1, "cities and towns", "t")], "id long, text string, Title string")
    plan = tk.token_arrays(df, "id", ["Title", "text"])._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan


def test_string_keys(spark):
    rows = [(f"u{i:02d}", [float(i // 20) * 9, float(i % 20) / 10], i // 20) for i in range(40)]
    df = spark.createDataFrame(rows, "url string, v array<double>, c long")
    by_id = df.withColumn("id", F.substring("url", 2, 2).cast("long"))
    near = {(r["url"], r["rank"], r["neighbour"]) for r in knn_graph(df, "url", "v", 3, ("euclidean",)).collect()}
    same = {(f"u{r['id']:02d}", r["rank"], f"u{r['neighbour']:02d}") for r in knn_graph(by_id, "id", "v", 3, ("euclidean",)).collect()}
    assert near == same
    assert silhouette(df, "url", "v", "c").first()[0] == pytest.approx(silhouette(by_id, "id", "v", "c").first()[0])
    found = density_clusters(df, "url", "v", 0.3, 5, 3)
    assert {r["cluster"]: r["count"] for r in found.groupBy("cluster").count().collect()} == {"u00": 20, "u20": 20}


def test_working_tables_can_be_removed(spark):
    import os

    table = Scratch(spark, "edge").write(spark.range(3), "t")
    path = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    clean(spark)
    assert not os.path.exists(path)
