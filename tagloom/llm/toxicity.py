"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: words and the openings of longer words, so that inflected forms share
terms, each hashed to 32 bits. Its logit is a bias, a weight per term, and for every pair of terms the
product of their factor vectors. The pairs carry what weights alone cannot: two terms that are
harmless apart and not together. With x the sum of the factor vectors, all pairs of a text cost one
pass: half of |x|^2 less the sum of the squared lengths.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch
from .batches import bound_batches
from .registry import query, table

ROWS_PER_LABEL = 4000  # the bounded sample that is learned from: whole texts, chosen by digest of their ids
MIN_ROWS = 4  # of the sample that a term must be in
MIN_CHI = 16  # chi-square that a term must reach; chance alone passes one term in sixteen thousand
MIN_RATIO = 3.0  # by which a term must be more frequent under one label than under the other
MAX_TERMS = 1 << 15  # of a model: those that tell the labels apart best
FACTORS, EPOCHS = 8, 200
RATE, PENALTY = 0.05, 3e-5  # of full passes of Adam; the penalty is on half the squared weights and factors
OPENINGS = (4, 5, 6)  # letters of a word's openings
CACHE = 1 << 18  # words whose terms a task remembers
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")


def terms(word: str) -> list[int]:
    """Hashes of a lower-case word and of its openings."""
    kinds = [f"={word}", *(f"^{word[:n]}" for n in OPENINGS if len(word) >= n)]
    return [zlib.crc32(k.encode("utf-8", "surrogatepass")) for k in kinds]


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Model:
    """Weights and factors of the kept terms; ``hashes`` are in ascending order."""

    hashes: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def rows(self, texts: Sequence[str | None], known: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Kept terms of the texts, one after another, and where each text's begin."""
        flat: list[int] = []
        starts = [0]
        for text in texts:
            found: set[int] = set()
            for word in words(text):
                own = known.get(word)
                if own is None:
                    if len(known) >= CACHE:
                        known.clear()
                    h = np.array(terms(word), np.int64)
                    at = np.searchsorted(self.hashes, h)
                    at[at == len(self.hashes)] = 0
                    own = known[word] = tuple(at[self.hashes[at] == h].tolist()) if len(self.hashes) else ()
                found.update(own)
            flat.extend(sorted(found))
            starts.append(len(flat))
        return np.array(flat, np.int64), np.array(starts, np.int64)

    def logits(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        linear, x, squares = _sums(self.weight, self.factor, flat, starts)
        return self.bias + linear + 0.5 * ((x * x).sum(axis=1) - squares)


def _sums(weight, factor, flat, starts):
    """Per text: summed weights, summed factor vectors, summed squared lengths."""

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
        return total[starts[1:]] - total[starts[:-1]]

    v = factor[flat]
    return per_text(weight[flat]), per_text(v), per_text((v * v).sum(axis=1))


def train(flat: np.ndarray, starts: np.ndarray, y: np.ndarray, importance: np.ndarray, n_terms: int,
          factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors that minimise the weighted log loss; ``factors`` 0 leaves the pairs out."""
    rng = np.random.default_rng(seed)
    share = np.average(y, weights=importance)
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    params = [np.zeros(1), np.zeros(n_terms), rng.normal(0, 0.05, (n_terms, factors))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    importance = importance / importance.sum()
    sizes = np.diff(starts)
    own = np.repeat(np.arange(len(y)), sizes)
    for step in range(1, epochs + 1):
        linear, x, squares = _sums(params[1], params[2], flat, starts)
        logit = bias + params[0][0] + linear + 0.5 * ((x * x).sum(axis=1) - squares)
        error = importance * (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y)
        slopes = [np.array([error.sum()]), np.bincount(flat, error[own], n_terms) + PENALTY * params[1], PENALTY * params[2]]
        for k in range(factors):
            slopes[2][:, k] += np.bincount(flat, error[own] * (x[own, k] - params[2][flat, k]), n_terms)
        rate = RATE * (1 - (step - 1) / epochs)
        for p, slope, (m, s) in zip(params, slopes, moments):
            m += 0.1 * (slope - m)
            s += 0.01 * (slope * slope - s)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return bias + float(params[0][0]), params[1], params[2]


TERM_ROWS = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("term", T.LongType())])


def _sampled(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, rows_per_label: int):
    """The sample as a written table ``(y, text)``, and the number of labelled ids with label 0 and 1."""
    spark = docs.sparkSession
    marked = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    marked = marked.filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    scratch = Scratch(spark, "toxicity")
    marked = scratch.write(marked.withColumn("draw", F.xxhash64("id")), "marked")
    counts = {r.y: r.n for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [marked.filter(F.col("y") == y).orderBy("draw", "id").limit(rows_per_label) for y in (0, 1)]
    drawn = scratch.write(drawn[0].unionByName(drawn[1]).select("id", "y"), "drawn")
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).filter("text <> ''")
    rows = texts.join(drawn, "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return scratch.write(rows, "sample"), counts


def _term_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for y, text in zip(frame["y"], frame["text"]):
            found = {h for word in words(text) for h in terms(word)}
            yield pd.DataFrame({"y": y, "term": list(found)}).astype({"y": "int32", "term": "int64"})


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
        rows_per_label: int = ROWS_PER_LABEL, max_terms: int = MAX_TERMS, min_rows: int = MIN_ROWS,
        min_chi: float = MIN_CHI, min_ratio: float = MIN_RATIO, factors: int = FACTORS, epochs: int = EPOCHS) -> Model:
    """A machine learned from at most ``rows_per_label`` whole texts of either label.

    The sample is chosen by a digest of the ids and weighted back to the shares of the labels among all
    labelled rows. Left out are terms in fewer than ``min_rows`` sampled texts, of a chi-square below ``min_chi``,
    and less than ``min_ratio`` times as frequent under one label as under the other, so that a long text gathers
    no evidence by its length; of the rest the ``max_terms`` with the greatest chi-square are kept. Rows with a
    null id, null label or a label other than 0 and 1 teach nothing, nor do ids without text; an id with
    several labels has the greater one, an id with several texts is learned from one of them. Without any such
    row every score is below 1e-9, with one label only the score is that label's share, smoothed.
    """
    bound_batches(docs.sparkSession)
    sample, counts = _sampled(docs, labels, id, text, label, rows_per_label)
    taken = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    empty = Model(np.zeros(0, np.int64), -40.0, np.zeros(0), np.zeros((0, factors)))
    if not taken:
        return empty
    if len(taken) == 1:
        n, y = sum(taken.values()), next(iter(taken))
        share = (n * y + 0.5) / (n + 1)
        empty.bias = float(np.log(share / (1 - share)))
        return empty
    n0, n1 = float(taken[0]), float(taken[1])
    seen = sample.mapInPandas(_term_rows, TERM_ROWS).groupBy("term").agg(
        F.sum(F.col("y")).cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b"),
    ).filter(F.col("a") + F.col("b") >= min_rows)
    both = F.col("a") + F.col("b")
    gap = F.col("a") * n0 - F.col("b") * n1
    chi = gap * gap * (n0 + n1) / (n0 * n1 * both * F.greatest(F.lit(n0 + n1) - both, F.lit(0.5)))
    odds = (F.col("a") + 0.5) / (n1 + 1) / ((F.col("b") + 0.5) / (n0 + 1))
    telling = (chi >= min_chi) & ((odds >= min_ratio) | (odds <= 1 / min_ratio))
    ranked = seen.filter(telling).select("term", chi.alias("chi"))
    kept = ranked.orderBy(F.desc("chi"), "term").limit(max_terms).collect()
    hashes = np.sort(np.array([r.term for r in kept], np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(Model(hashes, 0.0, np.zeros(len(hashes)), np.zeros((len(hashes), 0))))

    def indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for frame in frames:
            flat, starts = shared.value.rows(frame["text"].to_list(), known)
            cut = np.split(flat.astype("<i4"), starts[1:-1]) if len(frame) else []
            yield pd.DataFrame({"id": frame["id"], "y": frame["y"], "terms": [x.tobytes() for x in cut]})

    schema = T.StructType([sample.schema["id"], sample.schema["y"], T.StructField("terms", T.BinaryType())])
    rows = sample.mapInPandas(indexed, schema).orderBy("id").collect()  # at most twice rows_per_label
    y = np.array([r.y for r in rows], np.float64)
    starts = np.concatenate([[0], np.cumsum([len(r.terms) // 4 for r in rows])]).astype(np.int64)
    flat = np.frombuffer(b"".join(r.terms for r in rows), "<i4").astype(np.int64)
    importance = np.where(y == 1, counts[1] / n1, counts[0] / n0)
    return Model(hashes, *train(flat, starts, y, importance, len(hashes), factors, epochs))


def scored(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; columns of these names are replaced.

    A null or empty text has no terms and scores the bias alone. Rows are judged one by one from their
    whole text: repeated rows and ids stay, no shuffle is needed.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[int, ...]] = {}
        for part in parts:
            logit = shared.value.logits(*shared.value.rows(part.to_list(), known))
            yield pd.Series(1 / (1 + np.exp(-np.clip(logit, -700, 700))))

    out = docs.withColumn("score", run(F.col(f"`{text}`").cast("string")))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(doc_id: str = "doc_id"):
    """Rows kept from learning; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query()
def op12_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return scored(rows, fit(docs.select("doc_id", "text"), labels)).select("doc_id", "held_out", "score", "predicted")
