"""Shared working storage: written tables cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for local masters."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    root = root or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tagloom-")
    sc.setCheckpointDir(root)
    return root


_WRITTEN: list[str] = []


def _delete(spark: SparkSession, location: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clean(spark: SparkSession) -> None:
    """Remove every working table this process has written; frames that read them are void then."""
    while _WRITTEN:
        _delete(spark, _WRITTEN.pop())


class Scratch:
    """Named Parquet tables of one run below the checkpoint folder.

    A table is written once and read back, so later steps never recompute it, its real size is
    known to the optimizer, and losing an executor costs one task instead of the whole lineage.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        _WRITTEN.append(self.path)

    def write(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}", compression=compression)
        return self.read(name, df.schema)

    def read(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        """Remove a table of a finished iteration round."""
        _delete(self.spark, f"{self.path}/{name}")


def settled(df: DataFrame) -> DataFrame:
    """A small result written before the join that needs it.

    Its size is then known when the join is planned: within the session's broadcast threshold the
    large side stays where it is, beyond it the join is shuffled. Left lazy, the large side would
    already be shuffling on its hot keys by the time the small side turns out to be small.
    """
    return Scratch(df.sparkSession, "settled").write(df, "table")


@contextmanager
def compact(df: DataFrame) -> Iterator[DataFrame]:
    """The frame cached in its columnar form for the many passes of an iterative fit."""
    out = df.persist()
    try:
        yield out
    finally:
        out.unpersist()
