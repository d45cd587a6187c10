"""Joins. Sides are never hinted; adaptive execution broadcasts by measured size and splits skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _only_new(articles: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Text columns that do not repeat an article column (names compare without case)."""
    taken = {c.lower() for c in articles.columns}
    extra = [c for c in texts.columns if c.lower() not in taken and c != key]
    return texts.select(F.col(key).alias("__url"), *[F.col(f"`{c}`") for c in extra])


def merge_article_text(articles: DataFrame, texts: DataFrame, how: str = "inner") -> DataFrame:
    """Articles with their text by URL; a repeated URL multiplies rows."""
    right = _only_new(articles, texts, "url")
    return articles.join(right, F.col("URL") == F.col("__url"), how).drop("__url")


def left_merge_text(articles: DataFrame, texts: DataFrame) -> DataFrame:
    return merge_article_text(articles, texts, "left")


def distinct_urls(df: DataFrame, url: str = "URL") -> DataFrame:
    return df.select(url).where(F.col(url).isNotNull()).distinct()


def remaining_urls(df: DataFrame, done: DataFrame, url: str = "URL") -> DataFrame:
    """Distinct URLs that are not done yet."""
    return distinct_urls(df, url).join(done.select(F.col(url)), url, "left_anti")


def label_topk_topics(df: DataFrame, k: int = 12, topic: str = "topic") -> DataFrame:
    """Rows of the k most frequent topics, noise left out; ties go to the smaller topic."""
    rows = df.where(F.col(topic) != -1)
    top = rows.groupBy(topic).count().orderBy(F.desc("count"), topic).limit(k).select(topic)
    return rows.join(top, topic, "left_semi")


def attach_predictions(source: DataFrame, tags: DataFrame, key: str, title: str = "Title") -> DataFrame:
    return source.select(key, title).join(tags, key)


def split_embeddings(vectors: DataFrame, splits: DataFrame, key: str) -> DataFrame:
    """Vectors with the split (train, test or unlabeled) of their key."""
    return vectors.join(splits.select(key, "split"), key)


def masked_embeddings(articles: DataFrame, vectors: DataFrame, key: str, mask) -> DataFrame:
    """Frame and vectors filtered together, so their rows always belong to each other."""
    return articles.join(vectors, key).where(mask)


def union_texts(*frames: DataFrame, columns: list[str]) -> DataFrame:
    """Bag union of the named columns."""
    out = frames[0].select(*columns)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*columns))
    return out
