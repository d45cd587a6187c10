"""The resumable page stream: once per URL, retries, folders, a crash between the two writes."""

import pytest
from pyspark.sql import functions as F

from tagloom.catalog import relational
from tagloom.streaming.incremental import PAGE_SCHEMA, IncrementalExtract

PAGE = "<article><h1>T</h1><div class='entry-content'><p>a</p><p>b</p></div></article>"


def deliver(spark, src, rows):
    spark.createDataFrame(rows, PAGE_SCHEMA).write.mode("append").parquet(src)


def test_once_per_url_and_retries(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliver(spark, src, [(1, "u1", PAGE), (2, "u2", "<p>x</p>"), (3, None, PAGE)])
    job = IncrementalExtract(spark, src, out).run()
    assert job.paragraphs().count() == 2 and [r["url"] for r in job.failures().collect()] == ["u2"]
    assert IncrementalExtract(spark, src, out).run().paragraphs().count() == 2
    deliver(spark, src, [(4, "u1", PAGE), (5, "u2", PAGE)])
    job.run()
    assert job.paragraphs().count() == 4 and job.failures().isEmpty()
    assert {(r["url"], r["attempt"]) for r in job.successes().collect()} == {("u1", 1), ("u2", 2)}
    deliver(spark, src, [(6, "u6", "<p>x</p>")])
    job.run()
    fixed = spark.createDataFrame([(7, "u6", PAGE), (8, "u1", PAGE)], PAGE_SCHEMA)
    assert job.retry(fixed).paragraphs().count() == 6 and job.failures().isEmpty()
    assert not any(k.endswith("providerClass") for k in [spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")])


def test_newest_page_of_a_hot_url_counts(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliver(spark, src, [(i, "hot", "<p>x</p>") for i in range(300)] + [(300, "hot", PAGE)] + [(i, f"u{i}", PAGE) for i in range(20)])
    job = IncrementalExtract(spark, src, out).run()
    assert job.successes().count() == 21 and job.failures().isEmpty()


def test_a_batch_that_fails_half_way_is_made_up_for(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliver(spark, src, [(1, "u1", PAGE), (2, "u2", "<p>x</p>")])
    write = IncrementalExtract._write

    def broken(self, rows, table, batch_id):
        write(self, rows, table, batch_id)
        raise RuntimeError("killed after the first table")

    monkeypatch.setattr(IncrementalExtract, "_write", broken)
    with pytest.raises(Exception, match="killed"):
        IncrementalExtract(spark, src, out).run()
    monkeypatch.setattr(IncrementalExtract, "_write", write)
    job = IncrementalExtract(spark, src, out).run()
    assert job.successes().count() == 1 and [r["url"] for r in job.failures().collect()] == ["u2"]
    deliver(spark, src, [(3, "u1", PAGE), (4, "u2", PAGE)])
    assert {(r["url"], r["attempt"]) for r in job.run().successes().collect()} == {("u1", 1), ("u2", 2)}


def test_query_reads_a_table_in_many_files(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages.repartition(5).write.parquet(str(tmp_path / "pages.parquet"))
    got = relational.incremental_extract(spark, str(tmp_path))
    whole = relational.incremental_extract(spark, "/root/testdata/sf0.001")
    assert got.count() == whole.count() > 300 and got.exceptAll(whole).isEmpty()
    assert got.agg(F.countDistinct("url")).first()[0] > 40
