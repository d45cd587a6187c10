"""Corpus exploration: the tables behind the exploratory report, from one article frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as cfg
from ..operators import features as ft
from ..operators.aggregates import label_distribution


def corpus_documents(articles: DataFrame, key: str, label: str = "User_Needs", lo: int = 1, hi: int = 2) -> DataFrame:
    """The distinct terms of the combined clean text of every article and their counts, with its label.

    Vocabularies and weights both start from these counts, so they are written once: cleaning and
    counting the texts again would cost far more than reading them back.
    """
    return ft.packed_terms(ft.document_tokens(articles, key, keep=[label]), key, [label], lo, hi)


def corpus_terms(articles: DataFrame, key: str, label: str = "User_Needs", lo: int = 1, hi: int = 2) -> DataFrame:
    """Term counts of the combined clean text of every article, with its label."""
    return ft.unpacked(corpus_documents(articles, key, label, lo, hi), key, [label])


def corpus_tfidf(articles: DataFrame, key: str, min_df: int = cfg.VOCAB_MIN_DF, max_df: float = cfg.VOCAB_MAX_DF,
                 max_features: int = cfg.VOCAB_SIZE, label: str = "User_Needs") -> DataFrame:
    packed = corpus_documents(articles, key, label)
    counts = ft.unpacked(packed, key, [label])
    vocab = ft.vocabulary(counts, ft.row_count(articles), min_df, max_df, max_features)
    if max_features:
        return ft.packed_tfidf(packed, vocab, key, [label])
    return ft.tfidf(counts, vocab, key, [label], bounded=False)


def top_terms_per_class(articles: DataFrame, key: str, label: str = "User_Needs", n_top: int = 15,
                        lo: int = 1, hi: int = 1) -> DataFrame:
    """Flagship: tokens, n-grams, a TF-IDF fit per class and ranked terms, in one job."""
    labeled = articles.where(F.col(label) != cfg.UNLABELED)
    counts = corpus_terms(labeled, key, label, lo, hi)
    return ft.class_top_terms(counts, label_distribution(labeled, label), key, label, n_top=n_top)


def class_distributions(articles: DataFrame, key: str, labels: list[str], label: str = "User_Needs") -> DataFrame:
    labeled = articles.where(F.col(label) != cfg.UNLABELED)
    counts = corpus_terms(labeled, key, label)
    return ft.class_term_distribution(counts, ft.row_count(labeled), labels, label)
