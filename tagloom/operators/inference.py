"""Ranked tags with confidences for new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions.vectors import softmax
from .joins import attach_predictions
from .ranking import top_k_tags


def predict_top_k(model, df: DataFrame, key: str, labels: Sequence[str], k: int = cfg.TOP_K) -> DataFrame:
    """Top-k tags of any fitted model whose output holds ``proba``."""
    return top_k_tags(model.transform(df), key, "proba", labels, k)


def predict_top_k_logits(df: DataFrame, key: str, logits: str, labels: Sequence[str], k: int = cfg.TOP_K) -> DataFrame:
    return top_k_tags(df.withColumn("__p", softmax(F.col(logits))), key, "__p", labels, k)


def score_unlabeled(model, articles: DataFrame, key: str, labels: Sequence[str], label: str = "User_Needs",
                    title: str = "Title", k: int = cfg.TOP_K) -> DataFrame:
    """Top-k tags beside the title for every row without a label."""
    rows = articles.where(F.col(label) == cfg.UNLABELED)
    return attach_predictions(rows, predict_top_k(model, rows, key, labels, k), key, title)
