"""Non-negative topics, topic words and their alignment with labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as cfg
from ..scratch import Scratch, settled
from .aggregates import label_topic_crosstab
from .blocks import key_type
from .features import ctfidf, packed_class_counts, top_words
from .joins import label_topk_topics

_SWEEPS = 60


def _document_factors(batch: pd.DataFrame, h: np.ndarray):
    """Non-negative least-squares document factors for fixed topics, by coordinate sweeps."""
    sizes = batch["idx"].map(len).to_numpy()
    rows = np.repeat(np.arange(len(batch)), sizes)
    idx = np.concatenate(batch["idx"].to_numpy())
    val = np.concatenate(batch["val"].to_numpy())
    ah = np.zeros((len(batch), len(h)))
    for j in range(len(h)):
        ah[:, j] = np.bincount(rows, weights=val * h[j, idx], minlength=len(batch))
    gram = h @ h.T
    w = np.maximum(ah / np.maximum(np.diag(gram), 1e-12), 0.0) / len(h)
    for _ in range(_SWEEPS):
        for j in range(len(h)):
            if gram[j, j] > 0:
                w[:, j] = np.maximum(w[:, j] + (ah[:, j] - w @ gram[:, j]) / gram[j, j], 0.0)
    loss = float((val * val).sum() - 2.0 * (w * ah).sum() + ((w.T @ w) * gram).sum())
    return rows, idx, val, w, loss


class NmfTopics:
    """Fitted topics: ``topics`` is ``(topic, term, weight)``, ``losses`` the squared error per round."""

    def __init__(self, topics: DataFrame, vocab: DataFrame, h: np.ndarray, losses: list[float], key: str):
        self.topics, self.vocab, self.losses, self._h, self._key = topics, vocab, losses, h, key

    def document_topics(self, weights: DataFrame) -> DataFrame:
        """``(key, topics)`` with the factor of every topic as an array."""
        h = self._h

        def factors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    w = _document_factors(batch, h)[3]
                    yield pd.DataFrame({self_key: batch[self_key], "topics": list(w)})

        self_key = self._key
        packed = pack_documents(weights, self.vocab, self._key)
        return packed.mapInPandas(factors, f"`{self_key}` {key_type(weights, self_key)}, topics array<double>")

    def top_words(self, n: int = 12) -> DataFrame:
        return top_words(self.topics, "topic", n)


MAX_TERMS = 1_000_000  # a model of topics × vocabulary must fit the driver


def index_terms(weights: DataFrame) -> DataFrame:
    """``(term, term_idx)`` of a vocabulary that is refused beyond MAX_TERMS."""
    terms = settled(weights.select("term").distinct())
    if terms.count() > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms: bound the vocabulary with max_features")
    return terms.select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("term_idx"))


def pack_documents(weights: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    indexed = weights.join(vocab, "term")  # the vocabulary is written, so its size decides how
    packed = indexed.groupBy(key).agg(F.collect_list(F.struct("term_idx", "weight")).alias("e"))
    return packed.select(key, F.col("e.term_idx").alias("idx"), F.col("e.weight").alias("val"))


def nmf_topics(weights: DataFrame, key: str, n_topics: int = cfg.N_TOPICS, max_iter: int = cfg.NMF_MAX_ITER,
               tol: float = 1e-4, seed: int = cfg.SEED) -> NmfTopics:
    """Non-negative factors of the document-term weights by alternating least squares.

    One round is one scan: every task solves the factors of its own documents for the current
    topics and returns only the topics × vocabulary sums the update needs. Documents never move and
    no factor is stored per document. The topics (n_topics × vocabulary) live on the driver; both
    sizes are parameters.
    """
    scratch = Scratch(weights.sparkSession, "nmf")
    weights = scratch.write(weights.select(key, "term", "weight"), "weights")
    vocab = scratch.write(index_terms(weights), "vocab")
    docs = scratch.write(pack_documents(weights, vocab, key), "docs")
    n_terms = vocab.count()
    mean = weights.agg(F.sum("weight") / (F.count_distinct(key) * n_terms)).first()[0] or 0.0
    rng = np.random.default_rng(seed)
    h = np.abs(rng.standard_normal((n_topics, n_terms))) * np.sqrt(mean / n_topics)
    names = [f"t{j}" for j in range(n_topics)]
    losses: list[float] = []
    for _ in range(max_iter):
        def statistics(batches: Iterator[pd.DataFrame], h=h) -> Iterator[pd.DataFrame]:
            wa, ww, loss, seen = np.zeros_like(h), np.zeros((len(h), len(h))), 0.0, False
            for batch in batches:
                if not len(batch):
                    continue
                rows, idx, val, w, part = _document_factors(batch, h)
                for j in range(len(h)):
                    wa[j] += np.bincount(idx, weights=val * w[rows, j], minlength=h.shape[1])
                ww += w.T @ w
                loss, seen = loss + part, True
            if seen:
                # Rows: one per term, then one per topic of the Gram matrix, then the loss.
                table = np.vstack([wa.T, ww, np.full((1, len(h)), loss)])
                used = np.flatnonzero(table.any(axis=1))
                yield pd.DataFrame(table[used], columns=names).assign(row=used)

        schema = "row long, " + ", ".join(f"{c} double" for c in names)
        sums = docs.select("idx", "val").mapInPandas(lambda b: (x[["row", *names]] for x in statistics(b)), schema)
        got = sums.groupBy("row").agg(*[F.sum(c).alias(c) for c in names]).toPandas().set_index("row")
        table = got.reindex(range(n_terms + n_topics + 1), fill_value=0.0).to_numpy()
        wa, ww, loss = table[:n_terms].T, table[n_terms:-1], float(table[-1, 0])
        losses.append(loss)
        for _ in range(_SWEEPS):
            for j in range(n_topics):
                if ww[j, j] > 0:
                    h[j] = np.maximum(h[j] + (wa[j] - ww[j] @ h) / ww[j, j], 0.0)
        if len(losses) > 1 and losses[-2] - loss < tol * losses[0]:
            break
    spark = weights.sparkSession
    rows = pd.DataFrame(h.T, columns=[str(j) for j in range(n_topics)]).assign(term_idx=np.arange(n_terms))
    long = spark.createDataFrame(rows).unpivot("term_idx", [str(j) for j in range(n_topics)], "topic", "weight")
    topics = long.join(vocab, "term_idx").select(F.col("topic").cast("int").alias("topic"), "term", "weight")
    return NmfTopics(topics, vocab, h, losses, key)


def topic_alignment(model: NmfTopics, weights: DataFrame, labels: DataFrame, key: str,
                    label: str = "User_Needs") -> DataFrame:
    """Dominant topic by label, normalised by label, labeled rows only, with the topic's words."""
    from ..functions.vectors import argmax

    dominant = model.document_topics(weights).select(key, argmax(F.col("topics")).alias("topic"))
    labeled = labels.where(F.col(label) != cfg.UNLABELED).select(key, label)
    crosstab = label_topic_crosstab(dominant.join(labeled, key), label, "topic")
    words = model.top_words(12).groupBy("topic").agg(_in_rank_order(F.struct("rank", "term")).alias("words"))
    return crosstab.join(words, "topic")


def _in_rank_order(entry):
    return F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["term"]), " ")


def cluster_topics(counts: DataFrame, assignments: DataFrame, key: str, min_df: int = 5, n_words: int = 6) -> DataFrame:
    """Size and leading words of every topic; noise is not a topic.

    ``counts`` are long or packed; packed ones meet their topic as one row per document.
    """
    topics = assignments.where(F.col("topic") != -1)
    met = counts.join(topics.select(key, "topic"), key)
    if "terms" in counts.columns:
        met = packed_class_counts(met, "topic", summed=False)
    weights = ctfidf(met, "topic", min_df)
    words = top_words(weights, "topic", n_words).groupBy("topic").agg(
        _in_rank_order(F.struct("rank", "term")).alias("words")
    )
    sizes = topics.groupBy("topic").agg(F.count("*").alias("n"))
    return sizes.join(words, "topic", "left")


def cluster_topic_crosstab(assignments: DataFrame, label: str = "User_Needs", largest: int = 12) -> DataFrame:
    """Label by topic over the largest topics of the labeled rows."""
    labeled = assignments.where(F.col(label) != cfg.UNLABELED)
    return label_topic_crosstab(label_topk_topics(labeled, largest), label, "topic")


def topic_similarity(weights: DataFrame, sizes: DataFrame, largest: int = 15) -> DataFrame:
    """Cosine of the class-based weights between the largest topics."""
    top = sizes.orderBy(F.desc("n"), "topic").limit(largest).select("topic")
    rows = weights.join(top, "topic", "left_semi")
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("topic")))
    unit = rows.select("topic", "term", (F.col("weight") / length).alias("u"))
    a = unit.select(F.col("topic").alias("topic_a"), "term", F.col("u").alias("ua"))
    b = unit.select(F.col("topic").alias("topic_b"), "term", F.col("u").alias("ub"))
    return a.join(b, "term").groupBy("topic_a", "topic_b").agg(F.sum(F.col("ua") * F.col("ub")).alias("similarity"))
