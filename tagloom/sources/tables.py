"""Article sources and sinks: export files, stage outputs, run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as cfg
from ..operators.articles import with_derived_text
from ..operators.ranking import ordered_rank

# Columns of the metrics export that are read; the rest of the file is skipped.
EXPORT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in
     ("Apikey", "URL", "Title", "Publish date", "Authors", "Section", "Tags", "Post id")]
    + [T.StructField(c, T.DoubleType()) for c in
       ("Views", "Avg. views", "Engaged minutes", "Avg. minutes", "Desktop views", "Mobile views", "Tablet views")]
)


def read_export(spark: SparkSession, path: str, header: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Metrics export with a header row.

    With ``multi_line`` quoted fields may hold line breaks; such a file is read by one task, any
    other one is split.

    ``header`` names all columns of the file in order when it has more than those of
    ``EXPORT_SCHEMA``; unknown ones are read as text and pruned when unused.
    """
    known = {f.name: f for f in EXPORT_SCHEMA}
    schema = EXPORT_SCHEMA if header is None else T.StructType(
        [known.get(c, T.StructField(c, T.StringType())) for c in header]
    )
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
        .option("escape", '"').option("mode", "FAILFAST").csv(path)
    )


def load_articles(spark: SparkSession, path: str, key: str = "URL", fmt: str = "parquet") -> DataFrame:
    """Stored articles with their derived text columns; missing ones are computed, not persisted."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return with_derived_text(reader.format(fmt).load(path), key)


def _csv_options(writer, fmt: str):
    if fmt != "csv":
        return writer
    options = dict(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return writer.options(**options)


def write_articles(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """A new stage output; an existing one is never overwritten."""
    writer = _csv_options(df.write.mode("errorifexists").format(fmt), fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Rows added to a table, which is created by the first of them; no rows write nothing."""
    rows = df.persist()  # computed once for the question and for the write
    try:
        if not rows.isEmpty():
            _csv_options(rows.write.mode("append").format(fmt), fmt).save(path)
    finally:
        rows.unpersist()


def append_run_log(runs: DataFrame, path: str) -> None:
    """One JSON line per run, fractions rounded to 4 places; ``saved_at`` gives the log its order."""
    rounded = [
        F.round(F.col(f"`{f.name}`"), 4).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in runs.schema
    ]
    out = runs.select(*rounded)
    if "saved_at" not in out.columns:
        out = out.withColumn("saved_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    out.write.mode("append").json(path)


def training_log_metrics(log: DataFrame, run_name: str = "run_name", order: str = "saved_at",
                         slice_of: Column | None = None) -> DataFrame:
    """Numeric metrics of each run as ``(run_name, run_index, metric, value)``.

    Runs are numbered hour by hour, so a log of one busy run name is not sorted in one task.
    """
    numeric = [
        f.name for f in log.schema if f.name not in cfg.RUN_LOG_SKIP and isinstance(f.dataType, T.NumericType)
    ]
    hour = F.substring(F.col(order).cast("string"), 1, 13) if slice_of is None else slice_of
    ranked = ordered_rank(log, [run_name], order, hour)
    wide = ranked.select(
        run_name, (F.col("rank") - 1).alias("run_index"), *[F.col(f"`{c}`").cast("double").alias(c) for c in numeric]
    )
    return wide.unpivot([run_name, "run_index"], numeric, "metric", "value").where(F.col("value").isNotNull())
