"""The corpus pipeline: five stages over ``documents``, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, minhash, mixing, quality, secrets
from tagloom.scratch import Scratch, checkpoint_root, settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the prose policy.

    A null or empty text has no words and goes; repeated rows are judged alike; all columns stay.
    """
    return quality.passing(docs, quality.PROSE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Texts without words and rows without an id are in no group and stay.
    """
    return minhash.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials masked; copied examples and all other text stay as they are.

    Null texts stay null, repeated rows are masked alike, ``n_chars`` follows the new text.
    """
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the mix draws them from the sources.

    Row order is lost when the next stage reads the files, so the schedule itself is written beside
    them, for byte_bpe to return its rows in that order, to the folder that SCHEDULE names or else below the checkpoint folder; ``mix_schedule`` reads it
    from any process. Empty and null texts take no room, null sources are pooled, repeated rows stay.
    """
    placed = mixing.schedule(docs).select("doc_id", "mix_source", "block", "slot")
    placed.write.mode("overwrite").parquet(_schedule_path(spark))
    return mixing.interleaved(docs)


#: Setting that names the folder of the schedule; a run replaces what an earlier one left there.
SCHEDULE = "spark.tagloom.mixSchedule"


def _schedule_path(spark: SparkSession) -> str:
    return spark.conf.get(SCHEDULE, None) or f"{checkpoint_root(spark).rstrip('/')}/mix_schedule"


def mix_schedule(spark: SparkSession) -> DataFrame:
    """``(doc_id, mix_source, block, slot)``, a row per document of the last source_mix."""
    return spark.read.parquet(_schedule_path(spark))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every remaining document, in the order of the mix.

    A null text counts as empty. Rows of one id follow each other at its first slot; rows without a slot
    come last. Only digests are sorted, by the schedule that source_mix has left.
    """
    placed = settled(mix_schedule(spark).groupBy(F.col("doc_id").alias("__id")).agg(F.min("slot").alias("__slot")))
    coded = bpe.digests(docs, bpe.Tokenizer(spark))
    found = coded.join(placed, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    order = [F.asc_nulls_last("__slot"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))]
    return found.orderBy(*order).select(coded.columns)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot encode byte pairs, so a brute-force version in the tests stands in for it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``; every stage works on what the one before wrote."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
