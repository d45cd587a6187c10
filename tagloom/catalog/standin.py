"""The given tables in the shapes the operators expect. Every frame is a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as cfg

LABELS = ["q0t0", "q0t1", "q1t0", "q1t1"]
VECTOR_LABELS = [str(i) for i in range(10)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with title, section and label."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.concat(F.lit("q"), "quality", F.lit("t"), "toxic").alias("label")
    )
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return docs.select(
        "doc_id", F.left(F.substring_index("text", "\n", 1), F.lit(80)).alias("Title"), "text",
        F.col("source").alias("Section"), F.coalesce("label", F.lit(cfg.UNLABELED)).alias("User_Needs"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings; every fifth vector counts as unlabeled."""
    e = table(spark, sf_dir, "embeddings")
    need = F.when(F.col("vec_id") % 5 == 0, cfg.UNLABELED).otherwise(F.col("label").cast("string"))
    return e.withColumn("User_Needs", need)


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as rows of the metrics export; URLs repeat like customers do."""
    o = table(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    tags = (
        F.when(priority == "1-URGENT", None)
        .when(priority == "4-NOT SPECIFIED", "orders, user_need: other-not-news")
        .when(priority == "5-LOW", "orders,low")
        .otherwise(F.concat(F.lit("orders , user_need: "), priority, F.lit(", user_need: second")))
    )
    price = F.col("o_totalprice")
    return o.select(
        F.col("o_orderkey").cast("string").alias("Apikey"), F.col("o_custkey").cast("string").alias("URL"),
        F.concat(F.lit("Order "), "o_orderkey").alias("Title"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("Publish date"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("Authors"),
        priority.alias("Section"), tags.alias("Tags"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("Post id"),
        price.alias("Views"), (price / 2).alias("Avg. views"), price.alias("Engaged minutes"),
        price.alias("Avg. minutes"), price.alias("Desktop views"), price.alias("Mobile views"),
        F.when(F.col("o_orderkey") % 3 != 0, price).alias("Tablet views"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as extracted texts; some have none."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("url"), F.col("c_name").alias("title"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("text"),
    )


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as paragraphs of a page."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("url"), F.when(F.col("turn") > 0, F.col("role")).alias("title"),
        F.col("turn").alias("paragraph"), "text",
    )


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("Publish_date"), F.col("o_orderpriority").alias("User_Needs"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("Publish date"),
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
