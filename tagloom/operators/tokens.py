"""Token tables and the vocabulary-level lemma job."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..scratch import Scratch, settled

MAP_TOKENS = 1 << 20  # changed tokens up to which their lemmas are sent to every task

# Noun endings and their replacements, in the order they are tried.
NOUN_ENDINGS = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]


def token_rows(df: DataFrame, key: str, columns: Sequence[str], stop_words=None) -> DataFrame:
    """``(key, part, pos, token)``: content words of each text column, one row per token."""
    texts = F.posexplode(F.array(*[tx.raw_tokens(c) for c in columns])).alias("part", "__tokens")
    return (
        df.select(tx.col(key).alias(key), texts)
        .select(key, "part", F.posexplode("__tokens").alias("pos", "token"))
        .where(tx.is_content_word(F.col("token"), stop_words))
    )


def lemma_candidates(token: Column) -> Column:
    """Array of ``(length, ord, lemma)`` for every ending rule that fits."""
    options = []
    for order, (ending, replacement) in enumerate(NOUN_ENDINGS):
        stem = F.concat(F.left(token, F.length(token) - len(ending)), F.lit(replacement))
        options.append(
            F.when(
                token.endswith(ending),
                F.struct(F.length(stem).alias("length"), F.lit(order).alias("ord"), stem.alias("lemma")),
            )
        )
    return F.array_compact(F.array(*options))


def lemma_map(tokens: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """``(token, lemma)`` for the tokens that change, decided once per distinct token.

    A stem counts when the lexicon holds it; the shortest wins, then the earlier rule. The default
    lexicon is the corpus' own vocabulary: then every token is sent to its own spelling, as an
    entry, and to its possible stems, as a question, so the texts are read once and nothing is
    joined. At most one token per rule asks for the same stem.
    """
    vocabulary = tokens.select("token").distinct()
    options = lemma_candidates(F.col("token"))
    if lexicon is not None:
        known = lexicon.select(F.col(lexicon.columns[0]).alias("w")).distinct()
        asked = vocabulary.select("token", F.explode(options).alias("c"))
        found = asked.join(known, F.col("c.lemma") == F.col("w"), "left_semi")
    else:
        question = F.transform(options, lambda c: F.struct(c["lemma"].alias("w"), F.col("token"), c.alias("c")))
        entry = F.struct(F.col("token").alias("w"), F.lit(None).cast("string").alias("token"),
                         F.lit(None).cast("struct<length:int,ord:int,lemma:string>").alias("c"))
        sent = vocabulary.select(F.explode(F.concat(F.array(entry), question)).alias("e")).select("e.*")
        met = sent.groupBy("w").agg(
            F.bool_or(F.col("token").isNull()).alias("is_word"),
            F.collect_list(F.when(F.col("token").isNotNull(), F.struct("token", "c"))).alias("asked"),
        )
        found = met.where("is_word").select(F.explode("asked").alias("a")).select("a.token", "a.c")
    return found.groupBy("token").agg(F.min("c").alias("c")).select("token", "c.lemma")


def _may_change(token: Column) -> Column:
    """Only words with a noun ending can have another lemma."""
    return token.endswith("s") | token.endswith("men")


def _replaced_in_place(arrays: DataFrame, names: Sequence[str], lemmas: DataFrame) -> DataFrame:
    known = lemmas.where(F.col("token").isNotNull()).toArrow()
    tokens, changed = (known.column(c).combine_chunks().cast(pa.string()) for c in ("token", "lemma"))
    rest = [c for c in arrays.columns if c not in names]

    def lemma(lists: pa.ListArray) -> pa.ListArray:
        words = lists.flatten()
        hit = changed.take(pc.index_in(words, value_set=tokens))
        sizes = pc.fill_null(pc.list_value_length(lists), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])
        return pa.ListArray.from_arrays(offsets, pc.coalesce(hit, words), mask=pc.is_null(lists))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            yield pa.RecordBatch.from_arrays([*columns[: len(rest)], *map(lemma, columns[len(rest) :])], [*rest, *names])

    rows = arrays.select(*[tx.col(c) for c in [*rest, *names]])
    return rows.mapInArrow(replace, rows.schema)


def _with_lemmas(arrays: DataFrame, key: str, names: Sequence[str], lexicon: DataFrame | None) -> DataFrame:
    """Token arrays with every token replaced by its lemma, in place.

    Up to MAP_TOKENS changed tokens go to every task, and no document moves. Beyond that only the
    distinct words of a document that can change are looked up. The hits, a few per document, come
    back as one map to the document's row; no other token is ever moved.
    """
    every = F.flatten(F.array(*names))
    vocabulary = arrays.select(F.explode(F.array_distinct(every)).alias("token"))
    lemmas = settled(lemma_map(vocabulary, lexicon))
    if lemmas.count() <= MAP_TOKENS:
        return _replaced_in_place(arrays, names, lemmas)
    asked = F.array_distinct(F.filter(every, _may_change))
    words = arrays.select(F.col(key).alias("__key"), F.explode(asked).alias("token"))
    hits = words.join(lemmas, "token").groupBy("__key").agg(
        F.map_from_entries(F.collect_set(F.struct("token", "lemma"))).alias("__lemmas")
    )

    def replaced(name: str) -> Column:
        def lemma(t: Column) -> Column:
            return F.when(_may_change(t), F.coalesce(F.try_element_at("__lemmas", t), t)).otherwise(t)

        return F.when(F.col("__lemmas").isNull(), F.col(name)).otherwise(F.transform(name, lemma)).alias(name)

    out = arrays.join(hits, F.col(key).eqNullSafe(F.col("__key")), "left")
    return out.select(*[tx.col(c) for c in arrays.columns if c not in names], *[replaced(n) for n in names])


def token_arrays(df: DataFrame, key: str, columns: Sequence[str], lexicon: DataFrame | None = None,
                 stop_words=None, keep: Sequence[str] = ()) -> DataFrame:
    """``<column>_tokens`` per row, lemmatised and in text order; empty texts give empty arrays.

    Texts are read and cleaned once; what they yield is written, for the lemma job and for the rows.
    """
    names = [f"{c}_tokens" for c in columns]
    arrays = df.select(
        tx.col(key).alias(key), *[tx.col(c).alias(c) for c in keep if c != key],
        *[tx.clean_tokens(c, stop_words).alias(n) for c, n in zip(columns, names)],
    )
    arrays = Scratch(df.sparkSession, "tokens").write(arrays, "arrays")
    return _with_lemmas(arrays, key, names, lexicon).select(key, *keep, *names)


def lemmatized_rows(df: DataFrame, key: str, columns: Sequence[str], lexicon: DataFrame | None = None,
                    stop_words=None) -> DataFrame:
    """``(key, part, pos, token)`` of the lemmatised tokens; positions count content words."""
    arrays = token_arrays(df, key, columns, lexicon, stop_words)
    parts = F.posexplode(F.array(*[f"`{c}_tokens`" for c in columns])).alias("part", "__tokens")
    return arrays.select(key, parts).select(key, "part", F.posexplode("__tokens").alias("pos", "token"))


def clean_text(df: DataFrame, key: str, text: str = "text", lexicon: DataFrame | None = None,
               stop_words=None) -> DataFrame:
    out = token_arrays(df, key, [text], lexicon, stop_words)
    return out.select(key, F.array_join(f"{text}_tokens", " ").alias("clean_text"))
