"""Byte-level BPE encoding by overlapping chunks, and decoding by concatenating raw bytes.

A text of one chunk is encoded as it is. A longer text is cut into overlapping chunks that are
pre-tokenised in parallel on any executor. Where the pre-token boundaries of a chunk and of its
successor agree inside their overlap, both tokenisers are in the same state, so the text is stitched
there; the pieces between stitches are then encoded independently, again in parallel.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import takewhile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch
from .batches import bound_batches
from .registry import query, table

CHUNK = 1 << 15  # characters from the start of a chunk to the start of the next
OVERLAP = 1 << 10  # characters of the next chunk that a chunk also holds
SLICE = 256  # values that leave a task's Python process at a time
MAX_BLANKS = 100_000  # longer runs of white space exceed the stack of the library's pattern engine


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Codec:
    """Encoder and token bytes of one rank file."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}

        def encoder(split: str):
            return tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=merges, special_tokens={}).encode_ordinary

        self.encode = lru_cache(None)(lambda: encoder(pattern))  # built by those who encode
        self.encode_one = lru_cache(None)(lambda: encoder(r"(?s).+"))
        self.pattern = regex.compile(pattern)
        self.blanks = regex.compile(r"\s{%d,}" % MAX_BLANKS)
        self.tokens = [b""] * (max(merges.values()) + 1)
        for token, rank in merges.items():
            self.tokens[rank] = token

    def ids(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if len(text) >= MAX_BLANKS and self.blanks.search(text):
            found = [i for m in self.pattern.finditer(text) for i in self.encode_one()(m[0])]
        else:
            found = self.encode()(text)
        return np.array(found, dtype="<u4").tobytes()

    def raw(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def ends(self, text: str) -> Iterator[int]:
        return (m.end() for m in self.pattern.finditer(text))


@lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


class Tokenizer:
    """A rank file made available to every executor; the file itself is read on the driver only.

    ``path`` names the rank file and ``pattern`` the pre-token pattern; both default to the public
    multilingual 50k vocabulary. The broadcast has the size of the rank file (below 1 MB for 50k).
    """

    def __init__(self, spark: SparkSession, path: str | None = None, pattern: str | None = None):
        import public_tokenizers

        bound_batches(spark)
        with open(path or default_ranks(), "rb") as f:
            self.ranks = spark.sparkContext.broadcast(f.read())
        self.pattern = pattern or public_tokenizers.PATTERN

    def codec(self) -> Callable[[], Codec]:
        ranks, pattern = self.ranks, self.pattern
        return lambda: _codec(ranks.value, pattern)


def _sliced(parts: Iterator[pa.Array], work: Callable) -> Iterator[pa.Array]:
    """``work`` on every value, handed on in slices, so that no batch of results piles up."""
    for part in parts:
        for at in range(0, len(part), SLICE):
            yield pa.array([work(x) if x else b"" for x in part.slice(at, SLICE).to_pylist()], pa.binary())


def encode_texts(tokenizer: Tokenizer, text: Column) -> Column:
    """Ids of each text as packed little-endian 32-bit integers; null counts as empty."""
    codec = tokenizer.codec()

    @F.arrow_udf(T.BinaryType())
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _sliced(parts, codec().ids)

    return run(text)


def decode_ids(tokenizer: Tokenizer, ids: Column) -> Column:
    """Raw bytes of packed ids; null counts as no ids."""
    codec = tokenizer.codec()

    @F.arrow_udf(T.BinaryType())
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _sliced(parts, codec().raw)

    return run(ids)


CHUNKS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("k", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("last", T.BooleanType()),
    T.StructField("part", T.StringType()),
])
BOUNDARIES = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("k", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("last", T.BooleanType()),
    T.StructField("sure", T.LongType()), T.StructField("head", T.ArrayType(T.LongType())),
    T.StructField("tail", T.ArrayType(T.LongType())),
])


def _chunked(chunk: int, overlap: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, text in zip(frame["row"], frame["text"]):
                starts = range(0, max(1, len(text) - overlap), chunk)
                for lo in range(0, len(starts), 256):  # a very long text leaves in several batches
                    some = starts[lo : lo + 256]
                    yield pd.DataFrame({
                        "row": row, "k": range(lo, lo + len(some)), "start": list(some),
                        "last": [s == starts[-1] for s in some],
                        "part": [text[s:] if s == starts[-1] else text[s : s + chunk + overlap] for s in some],
                    })
    return run


def _sure(text: str, ends: list[int], chunk: int) -> int | None:
    """First end before the overlap where white space follows something else.

    No pre-token holds white space after another character, so such a place is a boundary of the
    whole text, whatever came before it.
    """
    sure = (e for e in takewhile(lambda e: e < chunk, ends) if text[e] in " \t\n\r")
    return next((e for e in sure if not text[e - 1].isspace()), None)


def _boundaries(codec: Callable[[], Codec], chunk: int, overlap: int):
    def usable(text: str, ends: list[int]) -> list[int]:
        return [e for e in ends if not text[e - 1].isspace()]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = codec().ends
        for frame in frames:
            rows = []
            for start, last, text in zip(frame["start"], frame["last"], frame["part"]):
                ends = [] if last else list(of(text))[:-1]  # the last one may be cut off
                head = [e for e in (ends if ends else takewhile(lambda e: e < overlap, of(text))) if e < overlap]
                sure = _sure(text, ends, chunk)
                tail = usable(text, [e for e in ends if e >= chunk])
                head = usable(text, head)
                rows.append((
                    None if sure is None else start + sure, [start + e for e in head], [start + e for e in tail],
                ))
            out = frame[["row", "k", "start", "last"]].copy()
            out["sure"] = pd.array([r[0] for r in rows], dtype="Int64")
            out["head"], out["tail"] = [r[1] for r in rows], [r[2] for r in rows]
            yield out
    return run


def stitch(chunks: DataFrame, tokenizer: Tokenizer, chunk: int, overlap: int) -> DataFrame:
    """``(row, piece, part)``: texts between the boundaries at which neighbouring chunks agree.

    A chunk is trusted if it starts the text, holds a boundary that stands whatever came before,
    or agrees with a trusted predecessor. Without an agreed boundary the neighbours stay one piece.
    """
    found = chunks.mapInPandas(_boundaries(tokenizer.codec(), chunk, overlap), BOUNDARIES)
    ahead = found.select("row", (F.col("k") + 1).alias("k"), F.col("tail").alias("before"))
    both = found.drop("tail").join(ahead, ["row", "k"], "left")
    met = both.select("row", "k", "start", "sure", F.array_min(F.array_intersect("before", "head")).alias("met"))
    so_far = Window.partitionBy("row").orderBy("k")
    anchor = F.max(F.when((F.col("k") == 0) | F.col("sure").isNotNull(), F.col("k"))).over(so_far)
    broken = F.max(F.when(F.col("met").isNull() & (F.col("k") > 0), F.col("k"))).over(so_far)
    trusted = met.withColumn("trusted", F.coalesce(anchor >= broken, F.lit(True)))
    cuts = trusted.withColumn("cut", F.when(F.lag("trusted").over(so_far), F.col("met")))
    spans = cuts.select(
        "row", "k", F.count("cut").over(so_far).alias("piece"),
        F.coalesce("cut", "start").alias("lo"),
        F.lead(F.coalesce("cut", "start")).over(so_far).alias("hi"),
    )
    own = chunks.join(spans, ["row", "k"])
    part = F.when(F.col("hi").isNull(), F.expr("substring(part, int(lo - start + 1))")).otherwise(
        F.expr("substring(part, int(lo - start + 1), int(hi - lo))")
    )
    parts = own.select("row", "piece", F.struct("k", part.alias("text")).alias("p"))
    texts = F.transform(F.array_sort(F.collect_list("p")), lambda p: p["text"])
    return parts.groupBy("row", "piece").agg(F.array_join(texts, "").alias("part"))


def encode(
    docs: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` with the packed token ids of every whole text in column ``ids``.

    Null and empty texts have no ids. Rows are independent of each other: repeated rows and ids
    stay, other columns are kept, an existing column ``ids`` is replaced. Texts of one chunk need
    no shuffle; longer ones are written once, so that their row numbers stay what they are.
    """
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    is_long = F.char_length(whole) > chunk + overlap
    columns = [c for c in docs.columns if c != ids]
    docs = docs.select(*[F.col(f"`{c}`") for c in columns])
    short = docs.filter(~is_long).withColumn(ids, encode_texts(tokenizer, whole))

    scratch = Scratch(docs.sparkSession, "bpe")
    packed = docs.filter(is_long).select(
        F.monotonically_increasing_id().alias("row"), whole.alias("text"), F.struct(*[f"`{c}`" for c in columns]).alias("doc")
    )
    rows = scratch.write(packed, "long")
    chunks = rows.select("row", "text").mapInPandas(_chunked(chunk, overlap), CHUNKS)
    chunks = scratch.write(chunks.repartition("row", "k"), "chunks")
    pieces = stitch(chunks, tokenizer, chunk, overlap)
    coded = pieces.select("row", "piece", encode_texts(tokenizer, F.col("part")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("piece", "x")))
    joined = F.aggregate(ordered, F.lit(b""), lambda acc, p: F.concat(acc, p["x"]))
    by_row = coded.groupBy("row").agg(joined.alias(ids))
    long = rows.join(by_row, "row").select(*[F.col("doc")[c].alias(c) for c in columns], F.col(f"`{ids}`"))
    return short.unionByName(long)


def decode(docs: DataFrame, tokenizer: Tokenizer, ids: str = "ids", raw: str = "raw") -> DataFrame:
    """``docs`` with the bytes that ``ids`` stand for in column ``raw``."""
    return docs.withColumn(raw, decode_ids(tokenizer, F.col(f"`{ids}`")))


def digests(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Per document: number of tokens and digests of its ids and of their decoding."""
    coded = decode(encode(docs.select("doc_id", "text"), tokenizer), tokenizer)
    return coded.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"),
    )


@query()
def op1_byte_bpe(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"), Tokenizer(spark))
