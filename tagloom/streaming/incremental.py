"""Resumable extraction of stored pages as a file stream with a state per URL."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.articles import extract_pages
from ..scratch import checkpoint_root

PAGE_SCHEMA = "page_id long, url string, html string"
_ROWS = "url string, page_id long, title string, paragraphs array<string>, error string, attempt long"
_SUCCESS = "url string, title string, paragraphs array<string>, attempt long, batch_id long"
_FAILURE = "url string, error string, attempt long, batch_id long"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _latest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The newest page of every URL of a batch of rows, so that a hot URL is not shuffled whole."""
    for frame in frames:
        yield frame.sort_values("page_id", kind="stable").drop_duplicates("url", keep="last")


class _OncePerUrl(StatefulProcessor):
    """Passes a URL's newest page on until one of its pages has succeeded; counts the attempts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "attempts long, done boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        attempts, done = self.seen.get() if self.seen.exists() else (0, False)
        newest = None
        for frame in rows:  # all are read, the newest is kept
            if len(frame):
                last = frame.sort_values("page_id", kind="stable").tail(1)
                if newest is None or last["page_id"].iloc[0] >= newest["page_id"].iloc[0]:
                    newest = last
        if newest is not None and not done:
            self.seen.update((attempts + 1, bool(newest["error"].isna().iloc[0])))
            yield newest.assign(attempt=attempts + 1)

    def close(self) -> None:
        pass


class IncrementalExtract:
    """Pages in, paragraphs and failures out, each URL extracted until it has succeeded once.

    The stream's checkpoint remembers which files were read and, in RocksDB, how often each URL was tried
    and whether it is done; a micro-batch touches the state of its own URLs only, so its cost does not grow
    with history. It writes into its own partition, so delivering it again after a crash replaces its rows
    instead of repeating them. A failed URL is tried again whenever it is delivered again or on ``retry``.
    Pages without a URL are left out; of several pages of a URL in one batch the newest counts.
    """

    def __init__(self, spark: SparkSession, source: str, out: str, container: str | None = "entry-content",
                 files_per_batch: int = 1000):
        self.spark, self.source, self.out = spark, source, out
        self.container, self.files_per_batch = container, files_per_batch

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.out}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def successes(self) -> DataFrame:
        return self._read("successes", _SUCCESS)

    def failures(self) -> DataFrame:
        """Latest failure of every URL that has not succeeded since."""
        failed = self._read("failures", _FAILURE).groupBy("url").agg(F.max_by("error", "attempt").alias("error"))
        return failed.join(self.successes().select("url"), "url", "left_anti")

    def paragraphs(self) -> DataFrame:
        return self.successes().select("url", "title", F.posexplode("paragraphs").alias("pos", "text")).select(
            "url", "title", (F.col("pos") + 1).alias("paragraph"), "text"
        )

    def _write(self, rows: DataFrame, table: str, batch_id: int) -> None:
        rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(f"{self.out}/{table}")

    def _batch(self, extracted: DataFrame, batch_id: int) -> None:
        extracted = extracted.persist()
        try:
            good = extracted.where(F.col("error").isNull())
            self._write(good.select("url", "title", "paragraphs", "attempt"), "successes", batch_id)
            self._write(extracted.where(F.col("error").isNotNull()).select("url", "error", "attempt"), "failures", batch_id)
        finally:
            extracted.unpersist()

    def _pages(self) -> DataFrame:
        """Delivered pages and, from their own folder, those of retries."""
        again = f"{self.out}/retries"
        self.spark.createDataFrame([], PAGE_SCHEMA).write.mode("append").parquet(again)
        reader = self.spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", self.files_per_batch)
        return reader.parquet(self.source).unionByName(reader.parquet(again)).where(F.col("url").isNotNull())

    def run(self) -> IncrementalExtract:
        """Process everything that has arrived since the last run, then stop."""
        before = self.spark.conf.get(_PROVIDER, None)
        self.spark.conf.set(_PROVIDER, _ROCKSDB)
        try:
            newest = self._pages().mapInPandas(_latest, PAGE_SCHEMA)
            extracted = extract_pages(newest, self.container).select("url", "page_id", "title", "paragraphs", "error")
            once = extracted.groupBy("url").transformWithStateInPandas(_OncePerUrl(), _ROWS, "Append", "None")
            query = (
                once.writeStream.foreachBatch(self._batch).outputMode("append")
                .option("checkpointLocation", f"{self.out}/checkpoint").trigger(availableNow=True).start()
            )
            query.awaitTermination()
        finally:
            if before is None:
                self.spark.conf.unset(_PROVIDER)
            else:
                self.spark.conf.set(_PROVIDER, before)
        return self

    def retry(self, pages: DataFrame) -> IncrementalExtract:
        """Try the failed URLs again on these pages, which the stream reads like delivered ones."""
        failed = self.failures().select("url")
        again = pages.select(*[F.col(c).cast(t) for c, t in (f.split() for f in PAGE_SCHEMA.split(", "))])
        again.join(failed, "url", "left_semi").write.mode("append").parquet(f"{self.out}/retries")
        return self.run()


def scratch_output(spark: SparkSession, name: str) -> str:
    """A fresh output folder below the session's checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
