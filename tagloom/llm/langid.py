"""Language identification by partial matching.

Each language has a tree of byte contexts of up to ORDER bytes with the counts of the bytes that
follow. A byte unseen after a context escapes to the next shorter one (method C: the escape has the
weight of the number of distinct followers). With frozen counts the cost of every byte after every
context is fixed, so a text costs each language an exact number of bits; the cheapest one wins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch, settled
from .batches import bound_batches
from .registry import query, table

ORDER = 3
ROWS_PER_LANG = 400  # the bounded sample that a tree is learned from: whole texts, chosen by digest
MIN_CONTEXT = 4  # a longer context must be seen so often, over all languages, to get a node
GRAMS_PER_LANG = 100_000  # most frequent (context, byte) counts that a model keeps of each language
START = b"\n" * ORDER  # stands before every text
BLOCK = 1 << 20
UNKNOWN = "und"

GRAMS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType()),
])


def _codes(data: np.ndarray, size: int) -> np.ndarray:
    """Each run of ``size`` bytes as a number, tagged with its length."""
    code = np.full(len(data) - size + 1, size, np.int64)
    for k in range(size):
        code = (code << 8) | data[k : len(code) + k]
    return code


def _count_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"]):
            data = np.frombuffer(START + text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
            grams, n = np.unique(
                np.concatenate([_codes(data[ORDER - size + 1 :], size) for size in range(1, ORDER + 2)]), return_counts=True
            )
            yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})


@dataclass
class Model:
    """Frozen counts, as rows.

    Language ``lang[i]`` holds gram ``gram[i]`` (context and follower) ``n[i]`` times. Of the kept contexts, language
    ``at_lang[j]`` has context ``context[j]`` with ``total[j]`` followers, ``distinct[j]`` different ones, whether
    all of them are kept or not.
    """

    langs: list[str]
    lang: np.ndarray
    gram: np.ndarray
    n: np.ndarray
    at_lang: np.ndarray
    context: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def compiled(self) -> "Costs":
        if self.name not in _COMPILED:
            _COMPILED.clear()
            _COMPILED[self.name] = Costs(self)
        return _COMPILED[self.name]


class Costs:
    """The trees unrolled: ``cost[context * 256 + byte]`` in nats for every language."""

    def __init__(self, model: Model):
        contexts, of = np.unique(model.gram >> 8, return_inverse=True)  # length tag counts the follower
        total, different = np.zeros((2, len(contexts), len(model.langs)))
        place = np.searchsorted(contexts, model.context)
        total[place, model.at_lang], different[place, model.at_lang] = model.total, model.distinct
        often = total.sum(axis=1) >= MIN_CONTEXT
        size = np.zeros(len(contexts), np.int64)
        for length in range(ORDER + 1):
            size[(contexts >> (8 * length)) == length + 1] = length
        kept = {}  # context bytes -> node; shorter contexts first, so parents exist
        chosen = [i for i in np.lexsort((contexts, size)) if size[i] == 0 or often[i]]
        self.cost = np.zeros((max(1, len(chosen)) * 256, len(model.langs)), np.float32)
        order = np.argsort(of, kind="stable")
        bounds = np.searchsorted(of[order], np.arange(len(contexts) + 1))
        table = self.cost.reshape(-1, 256, len(model.langs))
        nodes = []
        for i in chosen:
            length = int(size[i])
            key = (length, int(contexts[i]) & ((1 << (8 * length)) - 1))
            parent = np.full((256, len(model.langs)), np.log(256.0))
            for shorter in range(length - 1, -1, -1):
                up = kept.get((shorter, key[1] & ((1 << (8 * shorter)) - 1)))
                if up is not None:
                    parent = table[up]
                    break
            node = kept[key] = len(nodes)
            nodes.append(key)
            rows = order[bounds[i] : bounds[i + 1]]
            seen = np.zeros((256, len(model.langs)))
            seen[model.gram[rows] & 255, model.lang[rows]] = model.n[rows]
            distinct = different[i]
            weight = np.maximum(total[i] + distinct, 1)
            escape = np.where(distinct > 0, -np.log(np.maximum(distinct, 1) / weight), 0.0)
            with np.errstate(divide="ignore"):
                table[node] = np.where(seen > 0, -np.log(seen / weight), parent + escape)
        # deepest node for the last bytes read: by the last two, then by a third where one exists
        self.two = np.zeros(65536, np.int32)
        pairs: dict[int, int] = {}
        for node, (length, code) in enumerate(nodes):
            if length == 1:
                self.two[code::256] = node
        for node, (length, code) in enumerate(nodes):
            if length == 2:
                self.two[code] = node
            elif length == 3:
                pairs.setdefault(code >> 8, len(pairs))
        self.pair = np.full(65536, len(pairs), np.int32)
        self.three = np.full((len(pairs) + 1) * 256, -1, np.int32)
        for code, p in pairs.items():
            self.pair[code] = p
        for node, (length, code) in enumerate(nodes):
            if length == 3:
                self.three[pairs[code >> 8] * 256 + (code & 255)] = node

    def lengths(self, raws: list[bytes]) -> np.ndarray:
        """Code length in nats of every text for every language."""
        data = np.frombuffer(b"".join(START + r for r in raws), np.uint8).astype(np.int32)
        two = (data[:-1] << 8) | data[1:]
        three = self.three[(self.pair[two[:-1]] << 8) | data[2:]]
        node = np.where(three >= 0, three, self.two[two[1:]])  # after bytes 0..i+2
        cost = self.cost[(node[:-1] << 8) | data[3:]]
        sizes = np.array([len(r) + ORDER for r in raws])
        starts = np.cumsum(sizes) - sizes  # of each text's first real byte, counted from the third
        out = np.zeros((len(raws), cost.shape[1]))
        some = np.flatnonzero(sizes > ORDER)
        if len(some):
            edges = np.stack([starts[some], starts[some] + sizes[some] - ORDER], axis=1).ravel()
            padded = np.concatenate([cost, np.zeros((1, cost.shape[1]), np.float32)])
            out[some] = np.add.reduceat(padded, edges, axis=0, dtype=np.float64)[::2]
        return out


_COMPILED: dict[str, Costs] = {}


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text", rows_per_lang: int = ROWS_PER_LANG,
        grams_per_lang: int = GRAMS_PER_LANG) -> Model:
    """Trees of every language of ``labelled``, from about ``rows_per_lang`` whole texts each.

    Texts are chosen by a digest of the text, repeated ones once; rows without a text or label teach
    nothing. A model keeps the ``grams_per_lang`` most frequent counts of each language, the same number for
    all, with the true totals and numbers of distinct followers of every context it keeps.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text <> ''")
    sizes = settled(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")))
    rows = rows.withColumn("draw", F.xxhash64("text"))
    share = F.expr("(draw & 1048575) / 1048576")
    drawn = rows.join(sizes, "lang").filter(share * F.col("rows") < 1.25 * rows_per_lang).dropDuplicates(["lang", "draw"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    sample = drawn.withColumn("place", place).filter(F.col("place") <= rows_per_lang).select("lang", "text")
    sample = Scratch(spark, "langid").write(sample, "sample")
    grams = sample.mapInPandas(_count_grams, GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    scratch = Scratch(spark, "langid-grams")
    grams = scratch.write(grams.withColumn("context", F.shiftright("gram", 8)), "grams")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = scratch.write(grams.withColumn("rank", rank).filter(F.col("rank") <= grams_per_lang).drop("rank"), "kept")
    contexts = grams.join(kept.select("context").distinct(), "context", "left_semi")
    contexts = contexts.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"))
    k, c = kept.toPandas(), contexts.toPandas()
    langs = sorted(set(k["lang"]))
    number = {x: i for i, x in enumerate(langs)}

    def column(frame: pd.DataFrame, name: str) -> np.ndarray:
        return frame[name].to_numpy(np.int64)

    of_k, of_c = (np.array([number[x] for x in f["lang"]], np.int64) for f in (k, c))
    return Model(langs, of_k, column(k, "gram"), column(k, "n"), of_c, column(c, "context"), column(c, "total"), column(c, "distinct"))


VERDICT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def _blocks(part: pd.Series) -> Iterator[tuple[list[bytes], list[bool]]]:
    raws, letters, size = [], [], 0
    for text in part:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if raws and size + len(raw) > BLOCK:
            yield raws, letters
            raws, letters, size = [], [], 0
        raws.append(raw)
        letters.append(any(map(str.isalpha, text or "")))
        size += len(raw) + ORDER
    if raws:
        yield raws, letters


def judge(model: Model, raws: list[bytes], letters: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Cheapest language of each text, by name among equals, and its share of the probability."""
    if not model.langs:
        return np.full(len(raws), UNKNOWN, object), np.zeros(len(raws))
    nats = model.compiled().lengths(raws)
    best = nats.argmin(axis=1)
    odds = np.exp(nats.min(axis=1, keepdims=True) - nats)
    known = np.array(letters, bool)
    names = np.where(known, np.array(model.langs, object)[best], UNKNOWN)
    return names, np.where(known, 1 / odds.sum(axis=1), 0.0)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; same-named columns are replaced.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if the model
    learned nothing. Rows are judged one by one from their text alone.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(VERDICT)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = [judge(shared.value, *block) for block in _blocks(part)]
            yield pd.DataFrame({
                "lang_pred": np.concatenate([o[0] for o in out]) if out else [],
                "score": np.concatenate([o[1] for o in out]) if out else [],
            })

    verdict = "language verdict"
    out = docs.withColumn(verdict, run(F.col(f"`{text}`").cast("string")))
    return out.withColumns({"lang_pred": F.col(f"`{verdict}`.lang_pred"), "score": F.col(f"`{verdict}`.score")}).drop(verdict)


def held_out(doc_id: str = "doc_id"):
    """Documents kept from learning; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query()
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()).select("lang", "text"))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
