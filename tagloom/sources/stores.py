"""Embedding store, model registry and model persistence."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


REGISTRY_SCHEMA = "name string, path string, metrics map<string,double>, saved_at timestamp"
EMBEDDING_SCHEMA = "key string, embedding array<float>"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one when nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class EmbeddingStore:
    """Vectors per model and task in one store; only missing keys are ever computed.

    Every write goes to a folder of its own and counts once its number is in the commit log. A commit is
    a file that can be created only once, so of two writers that saw the same state one has to look
    again. A write that breaks off, or is repeated, leaves no key twice: folders without a commit are not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where, jvm

    def commits(self) -> list[dict]:
        """The commit log in order: number, folder, model, task, and whether it replaces what was before."""
        files, where, _ = self._files()
        if not files.exists(where):
            return []
        rows = self.spark.read.schema("number long, folder string, model string, task string, fresh boolean").json(str(where))
        return sorted((r.asDict() for r in rows.collect()), key=lambda r: r["number"])

    def _commit(self, number: int, **entry) -> bool:
        """False where another writer has taken the number."""
        files, where, jvm = self._files()
        path = jvm.org.apache.hadoop.fs.Path(where, f"{number:012d}.json")
        try:
            out = files.create(path, False)
        except Py4JJavaError:
            if files.exists(path):
                return False
            raise
        out.write(bytearray((json.dumps({"number": number, **entry}) + "\n").encode()))
        out.close()
        return True

    def _stored(self, commits: list[dict], model: str, task: str) -> DataFrame:
        own = [c for c in commits if (c["model"], c["task"]) == (model, task)]
        last = max((i for i, c in enumerate(own) if c["fresh"]), default=0)
        folders = [f"{self.path}/vectors/{c['folder']}" for c in own[last:]]
        if not folders:
            return self.spark.createDataFrame([], EMBEDDING_SCHEMA)
        return self.spark.read.schema(EMBEDDING_SCHEMA).parquet(*folders)

    def vectors(self, model: str, task: str) -> DataFrame:
        return self._stored(self.commits(), model, task)

    def missing(self, df: DataFrame, key: str, model: str, task: str, force_recompute: bool = False) -> DataFrame:
        """Rows to compute, one per key; a null key is none."""
        rows = df.where(F.col(key).isNotNull()).dropDuplicates([key])
        if force_recompute:
            return rows
        return missing_rows(rows, self.vectors(model, task).select("key"), key)

    def ensure(self, df: DataFrame, key: str, model: str, task: str, encode, force_recompute: bool = False) -> DataFrame:
        """Stored vectors after ``encode(rows) -> (key, embedding)`` has filled in the missing ones."""
        commits = self.commits()
        todo = self.missing(df, key, model, task, force_recompute)
        if not force_recompute and todo.isEmpty():
            return self._stored(commits, model, task)
        made = encode(todo).select(F.col(key).cast("string").alias("key"), F.col("embedding").cast("array<float>").alias("embedding"))
        while True:
            folder = uuid.uuid4().hex
            made.write.parquet(f"{self.path}/vectors/{folder}")
            made = self.spark.read.schema(EMBEDDING_SCHEMA).parquet(f"{self.path}/vectors/{folder}")
            if made.isEmpty() and not force_recompute:
                return self.vectors(model, task)
            number = 1 + max((c["number"] for c in commits), default=0)
            if self._commit(number, folder=folder, model=model, task=task, fresh=force_recompute):
                return self.vectors(model, task)
            commits = self.commits()  # someone was faster: keep only what is still missing
            if not force_recompute:
                made = missing_rows(made, self._stored(commits, model, task).select("key"), "key")


def missing_rows(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the one-column table of finished keys."""
    done = done.select(F.col(done.columns[0]).cast("string").alias("__done"))
    return df.join(done, F.col(key).cast("string") == F.col("__done"), "left_anti")


def read_embedding_store(store: DataFrame, task: str) -> DataFrame:
    """``(url, embedding)`` of one task from a table with a vector column per task."""
    columns = {"classification": "classification_embedding", "clustering": "cluster_embedding"}
    if task not in columns:
        raise ValueError(f"task must be one of {tuple(columns)}, got {task!r}")
    return store.select("url", F.col(columns[task]).alias("embedding"))


def save_model_registry(registry: DataFrame, path: str) -> None:
    """``(name, path, metrics)`` replaces the stored registry."""
    registry.select("name", "path", "metrics", F.current_timestamp().alias("saved_at")).write.mode("overwrite").parquet(path)


def load_model_registry(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path, REGISTRY_SCHEMA)


def save_model(model, path: str, name: str, metrics: dict[str, float] | None = None) -> None:
    """The fitted model below ``path/name`` and its metadata, with the time it was saved."""
    model.save(f"{path}/{name}/model")
    spark = SparkSession.active()
    rows = [(name, f"{path}/{name}/model", {k: float(v) for k, v in (metrics or {}).items()})]
    meta = spark.createDataFrame(rows, "name string, path string, metrics map<string,double>")
    save_model_registry(meta, f"{path}/{name}/metadata")


def load_model(spark: SparkSession, path: str, name: str, model_class):
    """The stored classifier wrapped as it was fitted, and its metadata table."""
    from ..operators.learning import FittedClassifier

    location = f"{path}/{name}/model"
    load = getattr(model_class, "load")
    model = load(spark, location) if model_class.__module__.startswith("tagloom") else FittedClassifier(load(location))
    return model, load_model_registry(spark, f"{path}/{name}/metadata")


def save_label_encoder(codes: DataFrame, path: str) -> None:
    codes.write.mode("overwrite").parquet(f"{path}/label_encoder")


def load_label_encoder(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/label_encoder")


def save_vectorizer(model, path: str) -> None:
    model.vocab.write.mode("overwrite").parquet(f"{path}/tfidf_vectorizer")


def load_vectorizer(spark: SparkSession, path: str, key: str, lo: int = 1, hi: int = 2):
    from ..operators.learning import TfidfModel

    vocab = spark.read.parquet(f"{path}/tfidf_vectorizer")
    return TfidfModel(key, vocab, vocab.count(), lo, hi)
