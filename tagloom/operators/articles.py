"""Derived article columns, label codes and stored-page extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions import html as hx
from ..functions import text as tx
from .tokens import token_arrays


def preprocess_articles(df: DataFrame, key: str = "URL", title_weight: int = cfg.TITLE_WEIGHT,
                        lexicon: DataFrame | None = None, stop_words=None) -> DataFrame:
    """The four derived text columns beside the input's own."""
    cleaned = token_arrays(df, key, ["Title", "text"], lexicon, stop_words).select(
        F.col(key).alias("__key"), "Title_tokens", "text_tokens"
    )
    empty = F.array().cast("array<string>")
    return (
        df.join(cleaned, F.col(f"`{key}`") == F.col("__key"), "left")
        .withColumns(
            {
                "combined_text": tx.combined_text(),
                "combined_short": tx.combined_short(),
                "clean_combined": tx.clean_combined(
                    F.coalesce("Title_tokens", empty), F.coalesce("text_tokens", empty), title_weight
                ),
                "raw_combined": tx.raw_combined(),
            }
        )
        .drop("__key", "Title_tokens", "text_tokens")
    )


def with_derived_text(df: DataFrame, key: str = "URL", **options) -> DataFrame:
    """The frame as loaded, its derived columns computed only when one is missing."""
    if all(c in df.columns for c in cfg.DERIVED_TEXT_COLUMNS):
        return df
    return preprocess_articles(df.drop(*cfg.DERIVED_TEXT_COLUMNS), key, **options)


def text_lengths(df: DataFrame, title: str = "Title", text: str = "text", label: str = "User_Needs") -> DataFrame:
    return df.withColumns(
        {
            "text_len_chars": F.length(text),
            "text_len_words": tx.word_count(text),
            "title_len_words": tx.word_count(title),
            "total_len_words": tx.word_count(title) + tx.word_count(text),
            "is_labeled": F.col(label) != cfg.UNLABELED,
        }
    )


def combine_variants(df: DataFrame, key: str, short_chars: int = 500, title_weight: int = cfg.TITLE_WEIGHT,
                     lexicon: DataFrame | None = None) -> DataFrame:
    """Cleaned title and body; the same with a truncated body; the same with the title repeated."""
    cut = df.withColumn("short", F.left(tx.blank("text"), F.lit(short_chars)))
    out = token_arrays(cut, key, ["Title", "text", "short"], lexicon)
    return out.select(
        key,
        tx.clean_combined(F.col("Title_tokens"), F.col("text_tokens"), 1).alias("combined"),
        tx.clean_combined(F.col("Title_tokens"), F.col("short_tokens"), 1).alias("combined_short"),
        tx.clean_combined(F.col("Title_tokens"), F.col("text_tokens"), title_weight).alias("upweighted"),
    )


def parse_publish_date(df: DataFrame, column: str = "Publish date", strict: bool = True,
                       pattern: str = "yyyy-MM-dd HH:mm") -> DataFrame:
    parse = F.to_timestamp if strict else F.try_to_timestamp
    pattern_arg = pattern if strict else F.lit(pattern)
    return df.withColumn("Publish_date", parse(tx.col(column), pattern_arg))


def date_parts(df: DataFrame, column: str = "Publish date") -> DataFrame:
    c = tx.col(column)
    return df.withColumns(
        {
            "year": F.substring(c, 1, 4), "month": F.substring(c, 1, 7), "day": F.substring(c, 1, 10),
        }
    )


def encode_labels(df: DataFrame, label: str = "User_Needs", order_by: str | None = None) -> DataFrame:
    """Label dimension with 0-based codes: sorted labels, or first appearance by ``order_by``.

    One row per label, so numbering runs on the label list and never on the data.
    """
    from pyspark.sql import Window

    first = F.min(order_by) if order_by else F.lit(0)
    labels = df.where(F.col(label).isNotNull()).groupBy(label).agg(first.alias("__first"))
    code = F.row_number().over(Window.orderBy("__first", label)) - 1
    return labels.select(label, code.alias("label_idx"))


def extract_pages(pages: DataFrame, container: str | None = "entry-content", html: str = "html",
                  joiner: str = " ") -> DataFrame:
    """``title``, ordered ``paragraphs`` and the first applicable ``error`` of every stored page."""
    body = hx.container_body(F.col("__article"), container)
    error = (
        F.when(F.col("__article").isNull(), hx.NO_ARTICLE)
        .when(F.col("__body").isNull(), hx.NO_CONTAINER)
        .when(F.size("paragraphs") == 0, hx.NO_PARAGRAPH)
    )
    return (
        pages.withColumn("__page", hx.visible(html))
        .withColumn("__article", hx.article_body(F.col("__page")))
        .withColumn("__body", body)
        .withColumn("paragraphs", F.coalesce(hx.paragraph_texts(F.col("__body"), joiner), F.array().cast("array<string>")))
        .withColumn("title", hx.page_title(F.col("__page"), joiner))
        .withColumn("error", error)
        .drop("__page", "__article", "__body", html)
    )


def extraction_errors(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("error").isNotNull()).select("url", "error")


def paragraph_rows(extracted: DataFrame) -> DataFrame:
    """One row per paragraph of the good pages, numbered from 1."""
    return extracted.where(F.col("error").isNull()).select(
        "url", "title", F.posexplode("paragraphs").alias("pos", "text")
    ).select("url", "title", (F.col("pos") + 1).alias("paragraph"), "text")
