"""Corpus statistics. Every table is partially aggregated before its only exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions import text as tx
from ..scratch import settled
from .ranking import top_n_per_group

_PARAGRAPHS_PER_CHUNK = 256


def combine_paragraphs(df: DataFrame, url: str = "url", order: str = "paragraph") -> DataFrame:
    """One row per URL: first non-null title, non-null texts joined in paragraph order.

    Paragraphs are first joined in chunks, so a page with very many of them is sorted and joined
    by many tasks; only the chunk strings of a page meet at the end.
    """
    rows = df.where(F.col(url).isNotNull()).withColumn(
        "__chunk", F.floor(F.col(order) / _PARAGRAPHS_PER_CHUNK)
    )
    position = F.when(F.col("title").isNotNull(), F.col(order))
    chunks = rows.groupBy(url, "__chunk").agg(
        F.min_by("title", position).alias("title"),
        F.min(position).alias("__at"),
        F.expr(f"listagg(text, ' ') within group (order by `{order}`)").alias("text"),
    )
    return chunks.groupBy(url).agg(
        F.min_by("title", "__at").alias("title"),
        F.coalesce(F.expr("listagg(text, ' ') within group (order by `__chunk`)"), F.lit("")).alias("text"),
    )


def _metric_rows(wide: DataFrame, key: str = "metric", value: str = "value") -> DataFrame:
    return wide.unpivot([], [tx.col(c) for c in wide.columns], key, value)


def corpus_statistics(df: DataFrame) -> DataFrame:
    """Counts and length statistics as ``(metric, value)`` text rows.

    Lengths are whole numbers, so the exact median keeps one counter per distinct length.
    """
    unlabeled = F.count_if(~F.col("is_labeled"))
    chars, words = F.col("text_len_chars"), F.col("text_len_words")

    def shown(c: Column) -> Column:
        return F.format_string("%.4f", c.cast("double"))

    wide = df.agg(
        F.count("*").cast("string").alias("total_articles"),
        F.count_if("is_labeled").cast("string").alias("labeled"),
        unlabeled.cast("string").alias("unlabeled"),
        F.format_string("%.1f%%", unlabeled * 100 / F.count("*")).alias("pct_unlabeled"),
        shown(F.avg(chars)).alias("text_len_mean"),
        shown(F.percentile(chars, F.lit(0.5))).alias("text_len_median"),
        shown(F.stddev_samp(chars)).alias("text_len_std"),
        shown(F.max(chars)).alias("text_len_max"),
        shown(F.min(chars)).alias("text_len_min"),
        shown(F.avg(words)).alias("word_count_mean"),
        shown(F.percentile(words, F.lit(0.5))).alias("word_count_median"),
        shown(F.max(words)).alias("word_count_max"),
    )
    return _metric_rows(wide)


def label_distribution(df: DataFrame, label: str = "User_Needs") -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, "n", (F.col("n") / total).alias("share"))


def imbalance_ratio(df: DataFrame, label: str = "User_Needs") -> DataFrame:
    """Per labeled class: count, largest count over it, and the overall max/min ratio."""
    counts = df.where(F.col(label) != cfg.UNLABELED).groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()
    top, low = F.max("n").over(whole), F.min("n").over(whole)
    return counts.select(label, "n", (top / F.col("n")).alias("ratio"), (top / low).alias("overall_ratio"))


def monthly_volume(df: DataFrame, labels: Sequence[str], date: str = "Publish_date",
                   label: str = "User_Needs") -> DataFrame:
    """Articles per month with one zero-filled column per label, in the given order."""
    month = F.date_format(date, "yyyy-MM")
    dated = df.withColumn("month", month).where(F.col("month").isNotNull())
    return dated.groupBy("month").pivot(label, list(labels)).count().na.fill(0).orderBy("month")


def label_topic_crosstab(df: DataFrame, rows: str = "User_Needs", columns: str = "topic",
                         digits: int | None = None) -> DataFrame:
    """Long crosstab normalised within ``rows``; combinations that never occur are absent."""
    counts = df.groupBy(rows, columns).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(rows))
    return counts.withColumn("share", share if digits is None else F.round(share, digits))


def top_topic_per_class(crosstab: DataFrame, rows: str = "User_Needs", columns: str = "topic") -> DataFrame:
    best = F.max(F.struct("share", (-F.col(columns)).alias("minus"))).alias("b")
    return crosstab.groupBy(rows).agg(best).select(
        rows, (-F.col("b.minus")).alias(columns), F.col("b.share").alias("share")
    )


def length_describe(df: DataFrame, value: str, label: str = "User_Needs") -> DataFrame:
    """Count, mean, standard deviation, extremes and quartiles per label, rounded to 1 place."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = df.groupBy(label).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), q.alias("q"), F.max(value).alias("max"),
    )
    names = ["q25", "q50", "q75"]
    return out.select(
        label, "n", *[F.round(c, 1).alias(c) for c in ("mean", "std")], "min",
        *[F.round(F.get("q", F.lit(i)), 1).alias(n) for i, n in enumerate(names)], "max",
    )


def histogram(df: DataFrame, value: str, bins: int = 80) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are rows too.

    Mean and median ride along as markers.
    """
    v = F.col(value).cast("double")
    stats = df.agg(
        F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"),
        F.percentile(value, F.lit(0.5)).alias("median"),
    )
    # Equal values everywhere: one unit wide, as a histogram of a constant is drawn.
    flat = F.col("lo") == F.col("hi")
    limits = stats.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
            "mean", "median",
        ).alias("s")
    )
    placed = df.where(F.col(value).isNotNull()).select(v.alias("v")).withColumn("s", limits.scalar())
    bin_of = F.least(F.floor((F.col("v") - F.col("s.lo")) * bins / (F.col("s.hi") - F.col("s.lo"))), F.lit(bins - 1))
    counts = placed.groupBy(bin_of.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    frame = limits.select("s", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("s.lo") + width * F.col("bin")).alias("left_edge"),
        (F.col("s.lo") + width * (F.col("bin") + 1)).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"), F.col("s.mean").alias("mean"), F.col("s.median").alias("median"),
    )


def length_box_stats(df: DataFrame, value: str = "text_len_chars", label: str = "User_Needs") -> DataFrame:
    """Quartiles and whiskers per class; ``position`` orders classes by median.

    Whiskers are the extreme values inside 1.5 interquartile ranges. They are looked up among the
    distinct values of a class, which the first aggregation has already reduced.
    """
    distinct = df.where(F.col(label) != cfg.UNLABELED).groupBy(label, value).agg(F.count("*").alias("__n"))
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("__n"))
    quartiles = distinct.groupBy(label).agg(q.alias("q"), F.sum("__n").alias("n"))
    q1, q2, q3 = (F.get("q", F.lit(i)) for i in range(3))
    reach = 1.5 * (q3 - q1)
    inside = F.col(value).between(q1 - reach, q3 + reach)
    out = distinct.join(quartiles, label).where(inside).groupBy(label).agg(
        F.first("n").alias("n"), F.first(q1).alias("q1"), F.first(q2).alias("median"), F.first(q3).alias("q3"),
        F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"),
    )
    return out.withColumn("position", F.row_number().over(Window.orderBy("median", label)))


def class_word_freq(tokens: DataFrame, label: str = "User_Needs", token: str = "token", n: int = 80) -> DataFrame:
    counts = tokens.groupBy(label, token).agg(F.count("*").alias("n"))
    return top_n_per_group(counts, [label], [F.desc("n"), F.asc(token)], n)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k · count) per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()
    weight = F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))
    return counts.withColumn("weight", weight)


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    return df.join(settled(class_weights(df, label).select(label, "weight")), label)


def class_centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector and size of each labeled class, merged map-side without exploding vectors."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    rows = vectors.where(F.col(label).isNotNull() & (F.col(label).cast("string") != cfg.UNLABELED))
    v = array_to_vector(F.col(vector).cast("array<double>"))
    return rows.groupBy(label).agg(
        vector_to_array(Summarizer.mean(v)).alias("centroid"), F.count("*").alias("n")
    )


def prediction_distribution(tags: DataFrame) -> DataFrame:
    return tags.groupBy("tag_1").agg(F.count("*").alias("n"))


def confidence_stats(tags: DataFrame, confidence: str = "confidence_1") -> DataFrame:
    """Mean, median, extremes. Confidences have 4 places, so the median counts ≤ 10,001 values."""
    return tags.agg(
        F.avg(confidence).alias("mean"), F.percentile(confidence, F.lit(0.5)).alias("median"),
        F.min(confidence).alias("min"), F.max(confidence).alias("max"),
    )


def data_summary(df: DataFrame, title: str = "Title", text: str = "text", label: str = "User_Needs") -> DataFrame:
    """Rows, columns, nulls, text lengths and label counts as ``(item, value)`` rows."""
    size = F.length(text)
    wide = df.agg(
        F.count("*").cast("double").alias("rows"), F.lit(float(len(df.columns))).alias("columns"),
        F.count_if(F.col(title).isNull()).cast("double").alias("title_nulls"),
        F.count_if(F.col(text).isNull()).cast("double").alias("text_nulls"),
        F.avg(size).alias("text_len_mean"), F.percentile(size, F.lit(0.5)).alias("text_len_median"),
        F.max(size).cast("double").alias("text_len_max"),
    )
    labels = df.groupBy(label).agg(F.count("*").cast("double").alias("value"))
    return _metric_rows(wide, "item").unionByName(
        labels.select(F.concat(F.lit("label:"), label).alias("item"), "value")
    )


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size per cluster beside the number of clusters, the noise count and its percentage."""
    counts = df.groupBy(cluster).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()
    noise = F.sum(F.when(F.col(cluster) == -1, F.col("n")).otherwise(0)).over(whole)
    return counts.select(
        cluster, "n", F.count_if(F.col(cluster) != -1).over(whole).alias("n_clusters"),
        noise.alias("n_noise"), (noise * 100 / F.sum("n").over(whole)).alias("pct_noise"),
    )


def avg_clean_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Mean word count of the alphanumerically cleaned text."""
    return df.agg(F.avg(F.size(tx.words(tx.clean_alnum(text)))).alias("avg_words"))
