"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Every source is cut into blocks of equal length. With integer weights w and their sum W, block k of
a source (from 0) is released at slot floor(k*W/w) and due by slot ceil((k+1)*W/w). Taking the
released block of the earliest deadline in every slot keeps each source within one block of its
share at any time. All windows repeat after W slots, so one period is scheduled and every block
finds its slot by arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table

BLOCK_CHARS = 1 << 16
SHARDS = 3  # hex digits: a source is summed up in 16^3 shards, so that a large one is no single task
OTHER = "(other)"

#: Target weights of the mix: slots of each source among the sum of the weights.
WEIGHTS = {f"src{i}": 1 + i % 3 for i in range(20)} | {OTHER: 1}


def mix_source(source: Column, weights: dict[str, int]) -> Column:
    """Sources without a weight of their own, and null, are pooled as OTHER."""
    return F.when(source.isin(*[s for s in weights if s != OTHER]), source).otherwise(F.lit(OTHER))


def period(sources: DataFrame) -> DataFrame:
    """``(mix_source, weight, turn, slot, period)``: one period by earliest deadline first.

    ``sources`` has one row (mix_source, weight) per source of the recipe that has documents.
    """
    one = sources.groupBy().agg(F.array_sort(F.collect_list(F.struct("mix_source", "weight"))).alias("ws"))
    one = one.filter(F.size("ws") > 0).withColumn("period", F.aggregate("ws", F.lit(0), lambda a, w: a + w["weight"]))
    ws, total = F.col("ws"), F.col("period")

    def pick(done: Column, slot: Column) -> Column:
        def deadline(w: Column, i: Column) -> Column:
            k = F.element_at(done, i + 1)
            released = F.floor(k * total / w["weight"]) <= slot
            due = F.ceil((k + 1) * total / w["weight"])
            return F.when(released & (k < w["weight"]), F.struct(due.alias("due"), i.alias("i")))

        return F.array_min(F.transform(ws, deadline))["i"]

    def step(acc: Column, slot: Column) -> Column:
        return F.struct(
            F.transform(acc["done"], lambda k, i: k + F.when(i == acc["next"], 1).otherwise(0)).alias("done"),
            F.concat(acc["picked"], F.array(acc["next"])).alias("picked"),
            F.lit(None).cast("int").alias("next"),
        )

    def turn(acc: Column, slot: Column) -> Column:
        chosen = F.struct(acc["done"].alias("done"), acc["picked"].alias("picked"), pick(acc["done"], slot).alias("next"))
        # the choice is made once and then used for every source
        return F.element_at(F.transform(F.array(chosen), lambda c: step(c, slot)), 1)

    start = F.struct(
        F.transform(ws, lambda w: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("picked"),
        F.lit(None).cast("int").alias("next"),
    )
    picked = F.aggregate(F.sequence(F.lit(0), total - 1), start, turn, lambda acc: acc["picked"])
    slots = one.select("ws", "period", F.posexplode(picked).alias("slot", "i"))
    slots = slots.select(F.element_at("ws", F.col("i") + 1).alias("w"), "slot", "period").select("w.*", "slot", "period")
    turns = Window.partitionBy("mix_source").orderBy("slot")
    return slots.withColumn("turn", F.row_number().over(turns) - 1)


def schedule(
    docs: DataFrame, weights: dict[str, int] = WEIGHTS, block_chars: int = BLOCK_CHARS,
    key: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """``docs`` with ``mix_source``, ``block``, ``slot`` and ``mix_order``.

    Within a source documents follow in the order of ``mix_order``, a digest of their key, and fill
    blocks by characters; a document belongs to the block in which it starts, and one longer than a
    block covers the following ones. Sorting by ``slot`` and ``mix_order`` interleaves the sources.
    When a source is used up, its slots stay empty and the others go on in proportion. No row is
    dropped or repeated. Null and empty texts take no room, a null key sorts as empty text, null
    and unknown sources are pooled, repeated rows follow each other; same-named columns are replaced.
    The recipe must be small: weights are whole numbers above 0 whose sum is the length of a period.
    """
    if OTHER not in weights or any(w != int(w) or w < 1 for w in weights.values()):
        raise ValueError(f"weights must be whole numbers above 0, with one for {OTHER}")
    new = ("mix_source", "block", "slot", "mix_order")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    size = F.coalesce(F.char_length(F.col(f"`{text}`").cast("string")), F.lit(0)).cast("long")
    rows = rows.withColumns({
        "mix_source": mix_source(F.col(f"`{source}`"), weights), "__size": size,
        "mix_order": F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))),
    }).withColumn("__shard", F.left("mix_order", F.lit(SHARDS)))
    shards = rows.groupBy("mix_source", "__shard").agg(F.sum("__size").alias("__chars"))
    before = Window.partitionBy("mix_source").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("mix_source", "__shard", F.coalesce(F.sum("__chars").over(before), F.lit(0)).alias("__before"))

    weight = F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("mix_source"))
    slots = period(shards.select("mix_source").distinct().withColumn("weight", weight))

    inside = Window.partitionBy("mix_source", "__shard").orderBy("mix_order", F.col(f"`{key}`"), "__size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(shards, ["mix_source", "__shard"])
    start = F.col("__before") + F.coalesce(F.sum("__size").over(inside), F.lit(0))
    rows = rows.withColumn("block", F.floor(start / F.lit(block_chars)).cast("long"))
    rows = rows.drop("__size", "__shard", "__before")
    rows = rows.withColumn("turn", (F.col("block") % weight).cast("int"))
    slots = slots.select("mix_source", "turn", "weight", F.col("slot").alias("__slot"), "period")
    placed = rows.join(F.broadcast(slots), ["mix_source", "turn"])  # one row per slot of the recipe
    slot = F.floor(F.col("block") / F.col("weight")) * F.col("period") + F.col("__slot")
    return placed.withColumn("slot", slot.cast("long")).drop("turn", "weight", "__slot", "period")


def interleaved(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in the order of the mix: files and rows follow the slots."""
    mixed = schedule(docs, **options)
    ordered = mixed.repartitionByRange("slot", "mix_order").sortWithinPartitions("slot", "mix_order")
    return ordered.select(*[F.col(f"`{c}`") for c in docs.columns])


def _recipe_sql() -> str:
    return ", ".join(f"('{s}', {w})" for s, w in WEIGHTS.items())


OP7_SQL = f"""
WITH RECURSIVE recipe(s, w) AS (VALUES {_recipe_sql()}),
d AS (SELECT doc_id, CASE WHEN source IN (SELECT s FROM recipe WHERE s <> '{OTHER}') THEN source ELSE '{OTHER}' END AS src,
       coalesce(length(text), 0) AS n, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
b AS (SELECT doc_id, src, h, (coalesce(sum(n) OVER (PARTITION BY src ORDER BY h, doc_id, n
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {BLOCK_CHARS})::BIGINT AS block FROM d),
c AS (SELECT list(s ORDER BY s) AS ss, list(w ORDER BY s) AS ws, sum(w)::INT AS total
      FROM recipe WHERE s IN (SELECT src FROM d)),
edf(t, done) AS (
  SELECT 0, list_transform(ws, lambda w: 0) FROM c
  UNION ALL
  SELECT t + 1, list_transform(done, lambda k, i: k + CASE WHEN i = pick THEN 1 ELSE 0 END)
  FROM (SELECT t, done, total, list_min(list_transform(ws, lambda w, i: CASE WHEN done[i] * total // w <= t AND done[i] < w
          THEN ((done[i] + 1) * total + w - 1) // w * 1000 + i END)) % 1000 AS pick FROM edf, c) WHERE t < total),
slots AS (SELECT ss[i] AS src, ws[i] AS w, total, t, n0 AS turn FROM (
   SELECT a.t, i, a.done[i] AS n0 FROM edf a JOIN edf z ON z.t = a.t + 1, range(1, 1000) r(i)
   WHERE i <= len(a.done) AND z.done[i] > a.done[i]), c)
SELECT doc_id, b.src AS mix_source, block, (block // w * total + t)::BIGINT AS slot
FROM b JOIN slots ON slots.src = b.src AND turn = block % w"""


@query(OP7_SQL)
def op7_mix_sources(spark, sf_dir):
    mixed = schedule(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "mix_source", "block", "slot")
