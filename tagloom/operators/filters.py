"""Row filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions import text as tx
from .joins import merge_article_text


def filter_articles(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Article rows in ``[start, end)`` with ``Publish_date`` and ``User_Needs`` attached.

    The export's date text sorts like the date, so the bounds, whatever way they are written, are
    also applied to the text in its own format; that form reaches the scan, while the parsed date
    keeps the result exact.
    """
    stored = "yyyy-MM-dd HH:mm"
    out = df.where(F.col("`Post id`").isNotNull())
    if start:
        out = out.where(F.col("`Publish date`") >= F.date_format(F.lit(start).cast("timestamp"), stored))
    if end:
        out = out.where(F.col("`Publish date`") <= F.date_format(F.lit(end).cast("timestamp"), stored))
    out = out.withColumn("Publish_date", F.to_timestamp("`Publish date`", stored))
    if start:
        out = out.where(F.col("Publish_date") >= F.lit(start).cast("timestamp"))
    if end:
        out = out.where(F.col("Publish_date") < F.lit(end).cast("timestamp"))
    return out.withColumn("User_Needs", tx.extract_user_need("Tags")).where(
        F.col("User_Needs") != cfg.DROPPED_LABEL
    )


def valid_labels(df: DataFrame, labels: Iterable[str], label: str = "User_Needs", keep: bool = True) -> DataFrame:
    """Rows whose label is in the list, or with ``keep=False`` all others, null labels included."""
    hit = F.coalesce(F.col(label).isin(*labels), F.lit(False))
    return df.where(hit if keep else ~hit)


def min_word_count(df: DataFrame, text: str = "text", more_than: int = cfg.MIN_WORD_PIECES) -> DataFrame:
    """Texts with more than n single-space pieces; empty pieces count."""
    return df.where(F.size(F.split(F.col(text), " ", -1)) > more_than)


def dropna_any(df: DataFrame, fill: dict[str, float] | None = None) -> DataFrame:
    """Rows without any null, after filling the named columns."""
    fill = {"Tablet views": 0.0} if fill is None else fill
    out = df.withColumns({c: F.coalesce(tx.col(c), F.lit(v)) for c, v in fill.items()}) if fill else df
    complete = F.lit(True)
    for c in out.columns:
        complete = complete & tx.col(c).isNotNull()
    return out.where(complete)


def split_labeled_unlabeled(df: DataFrame, label: str = "User_Needs") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(label) != cfg.UNLABELED), df.where(F.col(label) == cfg.UNLABELED)


def _project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[tx.col(c) for c in columns])


def ml_rows(articles: DataFrame, texts: DataFrame) -> DataFrame:
    """Joined, projected, complete rows; ``is_labeled`` tells tagged from untagged."""
    rows = dropna_any(_project(merge_article_text(articles, texts), cfg.ML_COLUMNS), {})
    return rows.withColumn("is_labeled", F.col("User_Needs") != cfg.UNLABELED)


def save_ml_datasets(articles: DataFrame, texts: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Tagged and untagged rows as stored below ``path``, from one pass over the join."""
    rows = ml_rows(articles, texts)
    rows.write.mode("overwrite").partitionBy("is_labeled").parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return stored.where("is_labeled").drop("is_labeled"), stored.where("NOT is_labeled").drop("is_labeled")


def save_eda_dataset(articles: DataFrame, texts: DataFrame) -> DataFrame:
    return dropna_any(_project(merge_article_text(articles, texts), cfg.EDA_COLUMNS))


def conf_threshold(df: DataFrame, label: str = "pseudo_label", confidence: str = "pseudo_confidence",
                   at_least: float = cfg.PSEUDO_LABEL_THRESHOLD) -> DataFrame:
    """Confident rows counted per label."""
    return df.where(F.col(confidence) >= at_least).groupBy(label).agg(F.count("*").alias("n"))


def null_counts(df: DataFrame) -> DataFrame:
    """Null and non-null count of every column in one pass."""
    stats = [F.count_if(tx.col(c).isNull()).alias(c) for c in df.columns]
    total = "__rows"
    wide = df.agg(F.count("*").alias(total), *stats)
    long = wide.unpivot([total], [tx.col(c) for c in df.columns], "column", "nulls")
    return long.select("column", "nulls", (F.col(total) - F.col("nulls")).alias("non_nulls"))
