"""Data preparation as one lazy plan: filter, join, complete rows, derived text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import combine_paragraphs
from ..operators.articles import preprocess_articles
from ..operators.filters import filter_articles, ml_rows, save_eda_dataset
from ..operators.ranking import stratified_split
from ..scratch import settled
from .. import config as cfg


def eda_articles(export: DataFrame, paragraphs: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return save_eda_dataset(filter_articles(export, start, end), combine_paragraphs(paragraphs))


def ml_articles(export: DataFrame, paragraphs: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return ml_rows(filter_articles(export, start, end), combine_paragraphs(paragraphs))


def prepare_articles(export: DataFrame, paragraphs: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Export and paragraphs to the article table with its derived text columns."""
    return preprocess_articles(eda_articles(export, paragraphs, start, end), "Apikey")


def prepare_supervised(df: DataFrame, key: str, label: str = "User_Needs", test_size: float = cfg.TEST_SIZE,
                       seed: int = cfg.SEED) -> DataFrame:
    """All rows with ``split`` (train, test, unlabeled) and ``label_idx``.

    Text variants stay columns of their row, so every variant and the label are always aligned.
    """
    from ..operators.articles import encode_labels

    labeled = df.where(F.col(label) != cfg.UNLABELED)
    splits = stratified_split(labeled.select(key, label), label, key, test_size, seed).select(key, "split")
    codes = settled(encode_labels(labeled, label))
    out = df.join(splits, key, "left").join(codes, label, "left")
    return out.withColumn("split", F.coalesce("split", F.lit("unlabeled")))
