"""N-grams, vocabularies and term weights as long tables ``(document, term, weight)``.

The terms of a document are counted, and weighted by a bounded vocabulary, in the task that holds its row;
only documents whose key comes again are brought together. A vocabulary is capped by ``max_features``, so
sending it to every task is bounded by that parameter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as cfg
from ..functions import text as tx
from ..scratch import Scratch, settled
from .ranking import top_n_per_group
from .tokens import token_arrays


def document_tokens(df: DataFrame, key: str, title: str = "Title", text: str = "text",
                    title_weight: int = cfg.TITLE_WEIGHT, keep: Sequence[str] = (),
                    lexicon: DataFrame | None = None, stop_words=None) -> DataFrame:
    """``tokens`` of the combined clean text, stop words removed again after lemmatising."""
    out = token_arrays(df, key, [title, text], lexicon, stop_words, keep)
    repeated = F.flatten(F.array_repeat(F.col(f"{title}_tokens"), title_weight))
    tokens = F.filter(F.concat(repeated, F.col(f"{text}_tokens")), lambda t: tx.is_content_word(t, stop_words))
    return out.select(key, *keep, tokens.alias("tokens"))


_SLICE = 1 << 20  # words that are counted at a time, about


def _slices(lists: pa.ListArray, most: int = _SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` list entries; a row is never cut."""
    part = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(lists)])


def _counted(group: np.ndarray, groups: int, words: pa.ListArray, lo: int, hi: int):
    """Offsets by group, terms and their counts for the n-grams of all rows of a group."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode(null_encoding="encode")
    names, word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    end, group = np.repeat(np.cumsum(sizes), sizes), np.repeat(group.astype(np.int64), sizes)
    at, gram, spelled = np.arange(len(word)), word, names
    found, known, offset = [], [], 0
    for n in range(1, hi + 1):
        if n > 1:
            inside = at + n - 1 < end[at]
            at, gram = at[inside], gram[inside]
            gram, pairs = pd.factorize(gram * len(names) + word[at + n - 1])
            spelled = pc.binary_join_element_wise(spelled.take(pa.array(pairs // max(len(names), 1))),
                                                  names.take(pa.array(pairs % max(len(names), 1))), " ")
        if n >= lo:
            found.append((group[at], gram + offset))
            known.append(spelled)
            offset += len(spelled)
    coded = pa.concat_arrays(known).dictionary_encode(null_encoding="encode")  # one spelling, one term
    term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    many = max(len(coded.dictionary), 1)
    met, tf = np.unique(np.concatenate([g * many + term[i] for g, i in found]), return_counts=True)
    starts = np.searchsorted(met // many, np.arange(groups + 1))
    return starts.astype(np.int32), coded.dictionary.take(pa.array(met % many)), pa.array(tf, pa.int64())


_TERMS = [T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("tfs", T.ArrayType(T.LongType()))]


def packed_terms(docs: DataFrame, key: str, keep: Sequence[str] = (), lo: int = 1, hi: int = 2) -> DataFrame:
    """``(key, keep…, terms, tfs)``: the distinct n-grams of every row's ``tokens`` and their counts, written.

    A row is counted where it is. Rows of one key stay apart; ``unpacked`` adds them up.
    """
    rows = docs.select(key, *keep, "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(i, j - i)
                words = part.column(part.num_columns - 1)
                starts, terms, tf = _counted(np.arange(len(words)), len(words), words, lo, hi)
                lists = [pa.ListArray.from_arrays(starts, x) for x in (terms, tf)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *lists], names)

    names = [*rows.columns[:-1], "terms", "tfs"]
    schema = T.StructType([*rows.schema.fields[:-1], *_TERMS])
    return Scratch(docs.sparkSession, "terms").write(rows.mapInArrow(count, schema), "counts", compression="zstd")


def _by_key(packed: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key comes once, and the others; None if there are none."""
    again = settled(packed.groupBy(F.col(key).alias("__key")).count().where("count > 1").select("__key"))
    if again.isEmpty():
        return packed, None
    same = F.col(key).eqNullSafe(F.col("__key"))
    return packed.join(again, same, "left_anti"), packed.join(again, same, "left_semi")


def _long(packed: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    entries = packed.select(key, *keep, F.explode(F.arrays_zip("terms", "tfs")).alias("__e"))
    return entries.select(key, *keep, F.col("__e.terms").alias("term"), F.col("__e.tfs").alias("tf"))


def _added(packed: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    return _long(packed, key, keep).groupBy(key, *keep, "term").agg(F.sum("tf").alias("tf"))


def unpacked(packed: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, keep…, term, tf)`` of packed terms; rows of one key are added up."""
    once, more = _by_key(packed, key)
    counts = _long(once, key, keep)
    return counts if more is None else counts.unionByName(_added(more, key, keep))


def term_counts(docs: DataFrame, key: str, keep: Sequence[str] = (), lo: int = 1, hi: int = 2) -> DataFrame:
    """``(key, keep…, term, tf)`` for all n-grams of the ``tokens`` column."""
    return unpacked(packed_terms(docs, key, keep, lo, hi), key, keep)


_HELD = 1 << 19  # counts of a task that are added up at a time, about


def class_counts(docs: DataFrame, by: str, lo: int = 1, hi: int = 2, summed: bool = True) -> DataFrame:
    """``(by, term, tf)``: n-grams counted per class where the tokens are, without passing by documents.

    Not ``summed``, rows of one class and term come from several tasks, as ``ctfidf`` takes them.
    """
    rows = docs.select(by, "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _slices(batch.column(1)):
                part = batch.slice(i, j - i)
                coded = part.column(0).dictionary_encode(null_encoding="encode")
                starts, terms, tf = _counted(coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary), part.column(1), lo, hi)
                of = np.repeat(np.arange(len(coded.dictionary)), np.diff(starts))
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(of)), terms, tf], names)

    names = [by, "term", "tf"]
    counts = rows.mapInArrow(count, _class_schema(rows, by))
    return _class_sums(counts, by) if summed else counts


def packed_class_counts(packed: DataFrame, by: str, summed: bool = True) -> DataFrame:
    """``class_counts`` of packed terms."""
    rows = packed.select(by, "terms", "tfs")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _slices(batch.column(1)):
                of, terms, tfs = batch.slice(i, j - i).columns
                doc = pc.list_parent_indices(terms)
                long = pa.table({by: of.take(doc), "term": terms.flatten(), "tf": tfs.flatten()})
                yield from long.group_by([by, "term"]).aggregate([("tf", "sum")]).rename_columns([by, "term", "tf"]).to_batches()

    counts = rows.mapInArrow(add, _class_schema(rows, by))
    return _class_sums(counts, by) if summed else counts


def _class_schema(rows: DataFrame, by: str) -> T.StructType:
    return T.StructType([rows.schema[by], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])


def _class_sums(counts: DataFrame, by: str) -> DataFrame:
    """Counts of the tasks added up, all classes of a term in one place."""
    return counts.repartition("term").groupBy(by, "term").agg(F.sum("tf").alias("tf"))


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count("*").alias("n")).scalar()


def vocabulary(counts: DataFrame, n_docs: Column, min_df: int = cfg.VOCAB_MIN_DF,
               max_df: float = cfg.VOCAB_MAX_DF, max_features: int | None = cfg.VOCAB_SIZE) -> DataFrame:
    """``(term, df, tf, idf)`` of the most frequent terms inside the document-frequency bounds."""
    terms = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))
    terms = terms.withColumn("n_docs", n_docs)
    terms = terms.where((F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("n_docs")))
    if max_features:
        terms = terms.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    idf = F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1
    return terms.select("term", "df", "tf", idf.alias("idf"))


def tfidf(counts: DataFrame, vocab: DataFrame, key: str, keep: Sequence[str] = (),
          bounded: bool = True) -> DataFrame:
    """Sublinear, smoothed, unit-length TF-IDF weights; terms outside the vocabulary drop out."""
    fitted = vocab.select("term", "df", "idf")
    joined = counts.join(F.broadcast(fitted) if bounded else fitted, "term")
    raw = joined.withColumn("__w", (1 + F.log("tf")) * F.col("idf"))
    length = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(key)))
    return raw.select(key, *keep, "term", "df", "tf", (F.col("__w") / length).alias("weight"))


def packed_tfidf(packed: DataFrame, vocab: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """``tfidf`` of packed terms by a bounded vocabulary, each document in the task that holds it.

    The length of a document spans all rows of its key, so keys that come again go the way of ``tfidf``.
    """
    once, more = _by_key(packed, key)
    fitted = Scratch(packed.sparkSession, "vocabulary").write(vocab.select("term", "df", "idf"), "fitted")
    rows = fitted.where(F.col("term").isNotNull()).toPandas()
    known = pa.array(rows["term"], pa.string())
    df, idf = rows["df"].to_numpy(np.int64), rows["idf"].to_numpy(np.float64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _slices(batch.column(batch.num_columns - 2)):
                part = batch.slice(i, j - i)
                terms, tfs = part.columns[-2:]
                doc = np.repeat(np.arange(len(terms)), pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False))
                term = terms.flatten()
                at = pc.fill_null(pc.index_in(term, value_set=known), -1).to_numpy(zero_copy_only=False)
                held = at >= 0
                doc, at, tf = doc[held], at[held], tfs.flatten().to_numpy(zero_copy_only=False)[held]
                w = (1 + np.log(tf)) * idf[at]
                length = np.sqrt(np.bincount(doc, w * w, len(terms)))
                of = pa.array(doc)
                columns = [known.take(pa.array(at)), pa.array(df[at]), pa.array(tf), pa.array(w / length[doc])]
                yield pa.RecordBatch.from_arrays([*[c.take(of) for c in part.columns[:-2]], *columns], names)

    names = [key, *keep, "term", "df", "tf", "weight"]
    once = once.select(key, *keep, "terms", "tfs")
    schema = T.StructType([*once.schema.fields[:-2], T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
                           T.StructField("tf", T.LongType()), T.StructField("weight", T.DoubleType())])
    weights = once.mapInArrow(weigh, schema)
    return weights if more is None else weights.unionByName(tfidf(_added(more, key, keep), fitted, key, keep))


def class_top_terms(counts: DataFrame, class_sizes: DataFrame, key: str, label: str = "User_Needs",
                    max_features: int = cfg.CLASS_VOCAB_SIZE, min_df: int = 2, n_top: int = 15) -> DataFrame:
    """Top mean TF-IDF terms with one vocabulary and one idf fit per class, all classes in one job."""
    terms = counts.groupBy(label, "term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    vocab = top_n_per_group(
        terms.where(F.col("df") >= min_df), [label], [F.desc("total"), F.asc("term")], max_features, ["term"]
    ).select(label, "term", "df")
    fitted = vocab.join(class_sizes.select(label, F.col("n").alias("n_class")), label)
    fitted = settled(fitted.withColumn("idf", F.log((1 + F.col("n_class")) / (1 + F.col("df"))) + 1))
    raw = counts.join(fitted, [label, "term"]).withColumn("__w", (1 + F.log("tf")) * F.col("idf"))
    length = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(key)))
    weights = raw.withColumn("__w", F.col("__w") / length)
    means = weights.groupBy(label, "term").agg(
        F.round(F.sum("__w") / F.first("n_class"), 4).alias("mean_tfidf"), F.sum("__w").alias("__s")
    )
    order = [F.desc(F.round("__s", 9)), F.asc("term")]
    return top_n_per_group(means, [label], order, n_top).select(label, "rank", "term", "mean_tfidf")


def class_term_distribution(counts: DataFrame, n_docs: Column, labels: Sequence[str],
                            label: str = "User_Needs", max_features: int = cfg.CLASS_VOCAB_SIZE,
                            min_df: int = cfg.VOCAB_MIN_DF) -> DataFrame:
    """Smoothed term distribution of each class over one shared vocabulary.

    Classes are counted for terms of the vocabulary only, which is written and sent to the counts.
    """
    vocab = settled(vocabulary(counts, n_docs, min_df, 1.0, max_features).select("term"))
    grid = vocab.select("term", F.explode(F.array(*[F.lit(x) for x in labels])).alias(label))
    known = counts.join(F.broadcast(vocab) if max_features else vocab, "term", "left_semi")
    per_class = known.groupBy(label, "term").agg(F.sum("tf").alias("n"))
    mass = F.coalesce(F.col("n"), F.lit(0)) + F.lit(1e-10)
    return grid.join(per_class, [label, "term"], "left").select(
        label, "term", (mass / F.sum(mass).over(Window.partitionBy(label))).alias("p")
    )


def _sums(table: pa.Table, by: Sequence[str]) -> pa.Table:
    return table.group_by(list(by), use_threads=False).aggregate([("n", "sum")]).select([*by, "n_sum"]).rename_columns([*by, "n"])


def _frequent_terms(counts: DataFrame, topic: str, min_df: int) -> DataFrame:
    """``(topic, term, n, f)`` of the terms of ``min_df`` topics or more; ``f`` adds up all topics.

    The counts of a term meet in one task and follow each other there, sorted by a digest of the term, so
    a task reads them once and holds a few batches.
    """
    rows = counts.where(F.col("term").isNotNull()).select(topic, "term", F.col("tf").cast("long").alias("n"))
    rows = rows.repartition("term").withColumn("at", F.xxhash64("term")).sortWithinPartitions("at")

    def whole_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            n += batch.num_rows
            if n < _HELD:
                continue
            table = pa.concat_tables(held).combine_chunks()
            at = table.column("at").to_numpy()
            cut = int(np.searchsorted(at, at[-1]))  # the last term may go on
            if cut:
                yield table.slice(0, cut)
            rest = _sums(table.slice(cut), [topic, "term", "at"]).select(names)
            held, n = [rest], len(rest)
        if held:
            yield pa.concat_tables(held)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_terms(batches):
            sums = _sums(table, [topic, "term"])
            n = sums.column("n").to_numpy()
            term = sums.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            f = np.zeros(int(term.max(initial=-1)) + 1, np.int64)
            np.add.at(f, term, n)
            held = np.bincount(term, minlength=len(f))[term] >= min_df
            yield from sums.append_column("f", pa.array(f[term])).filter(pa.array(held)).to_batches()

    names = [topic, "term", "n", "at"]
    long = [T.StructField(c, T.LongType()) for c in ("n", "f")]
    return rows.mapInArrow(frequent, T.StructType([rows.schema[topic], rows.schema["term"], *long]))


def ctfidf(counts: DataFrame, topic: str = "topic", min_df: int = 5) -> DataFrame:
    """Class-based TF-IDF with damped frequent words; document frequency counts topics.

    Rows of one topic and term are added up.
    """
    kept = Scratch(counts.sparkSession, "ctfidf").write(_frequent_terms(counts, topic, min_df), "kept")
    sizes = kept.groupBy(topic).agg(F.sum("n").alias("topic_size"))
    mean_size = F.floor(sizes.agg(F.avg("topic_size").alias("a")).scalar())
    weight = F.sqrt(F.col("n") / F.col("topic_size")) * F.log(1 + mean_size / F.col("f"))
    return kept.join(sizes, topic).select(topic, "term", "n", weight.alias("weight"))


def top_words(weights: DataFrame, topic: str = "topic", n: int = 6, weight: str = "weight") -> DataFrame:
    order = [F.desc(F.round(weight, 9)), F.asc("term")]
    return top_n_per_group(weights, [topic], order, n)


def hashed_embedding(weights: DataFrame, key: str, dim: int = 64) -> DataFrame:
    """Dense document vectors by signed feature hashing of term weights."""
    digest = F.md5("term")
    bucket = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")
    sign = F.when(F.substring(digest, 32, 1).rlike("[0-7]"), 1.0).otherwise(-1.0)
    sums = weights.groupBy(key, bucket.alias("b")).agg(F.sum(F.col("weight") * sign).alias("v"))
    filled = sums.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("b", "v"))).alias("m"))
    values = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0)))
    return filled.select(key, values.alias("embedding"))
