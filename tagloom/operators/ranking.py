"""Top-n, hash-ordered ranks, samples, splits and folds without a hot task.

Every random choice is the order of ``md5(seed‖id)``. Because the hash is uniform, its first three
hex digits cut any label, however large, into 4,096 even slices: a rank is the number of rows in
earlier slices plus the rank inside one slice, and a cut-off needs ranks in a single slice only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions import text as tx
from ..scratch import settled

_GROUP_LIMIT = 1000  # Spark trims row_number() <= n before the shuffle up to this n
_SALTS = 64


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int,
                    salt: Sequence[str] | None = None, rank: str = "rank") -> DataFrame:
    """First n rows of each group. Above Spark's own limit a salted first round trims hot groups."""
    if n > _GROUP_LIMIT and salt:
        w = Window.partitionBy(*by, "__salt").orderBy(*order)
        df = (
            df.withColumn("__salt", F.pmod(F.xxhash64(*salt), F.lit(_SALTS)))
            .withColumn(rank, F.row_number().over(w))
            .where(F.col(rank) <= n)
            .drop("__salt", rank)
        )
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def topn_per_class(df: DataFrame, n: int = cfg.PSEUDO_LABEL_TOP_N, label: str = "pseudo_label",
                   score: str = "pseudo_confidence", key: str = "vec_id") -> DataFrame:
    """n best rows of every class; callers sort the small result by score."""
    return top_n_per_group(df, [label], [F.desc(score), F.asc(key)], n)


def hash_key(key: str, seed: int = cfg.SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), tx.col(key).cast("string")))


def _sliced(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("__hash", hash_key(key, seed)).withColumn("__slice", F.substring("__hash", 1, 3))


def _slice_starts(sliced: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows in earlier slices and the group's size; at most 4,096 rows per group."""
    counts = sliced.groupBy(*by, "__slice").agg(F.count("*").alias("__in_slice"))
    upto = Window.partitionBy(*by).orderBy("__slice")
    whole = Window.partitionBy(*by)
    return counts.select(
        *by, "__slice", "__in_slice",
        (F.sum("__in_slice").over(upto) - F.col("__in_slice")).alias("__before"),
        F.sum("__in_slice").over(whole).alias("group_size"),
    )


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null is a group of its own."""
    right = right.withColumnsRenamed({k: f"__g{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & tx.col(k).eqNullSafe(F.col(f"__g{i}"))
    return left.join(right, same, how).drop(*[f"__g{i}" for i in range(len(keys))])


def _rank_within(by: Sequence[str], key: str) -> Column:
    return F.row_number().over(Window.partitionBy(*by, "__slice").orderBy("__hash", key))


def hash_rank(df: DataFrame, by: Sequence[str], key: str, seed: int = cfg.SEED) -> DataFrame:
    """Exact 1-based ``hash_rank`` in hash order within each group, plus ``group_size``."""
    sliced = _sliced(df, key, seed)
    starts = _slice_starts(sliced, by).drop("__in_slice")
    ranked = _join_groups(sliced.withColumn("__r", _rank_within(by, key)), starts, [*by, "__slice"])
    return ranked.withColumn("hash_rank", F.col("__before") + F.col("__r")).drop(
        "__hash", "__slice", "__before", "__r"
    )


def ordered_rank(df: DataFrame, by: Sequence[str], order: str, slice_of: Column, rank: str = "rank") -> DataFrame:
    """Exact 1-based rank by ``order`` within each group.

    ``slice_of`` is a coarse, monotone form of ``order`` (its hour, its leading digits), so even a
    group holding most rows is ranked slice by slice in many tasks.
    """
    sliced = df.withColumn("__slice", slice_of)
    starts = _slice_starts(sliced, by).select(*by, "__slice", "__before")
    within = F.row_number().over(Window.partitionBy(*by, "__slice").orderBy(order))
    ranked = _join_groups(sliced.withColumn("__r", within), starts, [*by, "__slice"])
    return ranked.withColumn(rank, F.col("__before") + F.col("__r")).drop("__slice", "__before", "__r")


def hash_mark(df: DataFrame, by: Sequence[str], key: str, take: Column, flag: str,
              seed: int = cfg.SEED) -> DataFrame:
    """``flag`` marks the first ``take`` rows of each group in hash order; adds ``group_size``.

    ``take`` is an expression of ``group_size``. Two passes over the narrow key columns find the
    last marked row of every group; the wide rows are then only compared with it.
    """
    narrow = _sliced(df.select(*by, tx.col(key)), key, seed)
    starts = _slice_starts(narrow, by).withColumn("__take", F.least(take, F.col("group_size")))
    edge = starts.where(
        (F.col("__before") < F.col("__take")) & (F.col("__take") <= F.col("__before") + F.col("__in_slice"))
    ).select(*by, "__slice", (F.col("__take") - F.col("__before")).alias("__nth"))
    last = (
        _join_groups(narrow, edge, [*by, "__slice"])
        .withColumn("__r", _rank_within(by, key))
        .where(F.col("__r") == F.col("__nth"))
        .select(*by, F.struct("__hash", tx.col(key).alias("__key")).alias("__last"))
    )
    sizes = starts.groupBy(*by).agg(F.max("group_size").alias("group_size"))
    here = F.struct(hash_key(key, seed).alias("__hash"), tx.col(key).alias("__key"))
    if by:
        out = _join_groups(df, settled(_join_groups(sizes, last, by, "left")), by)
    else:
        out = df.withColumns(
            {"group_size": sizes.select("group_size").scalar(), "__last": last.select("__last").scalar()}
        )
    return out.withColumn(flag, F.coalesce(here <= F.col("__last"), F.lit(False))).drop("__last")


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = cfg.TEST_SIZE,
                     seed: int = cfg.SEED) -> DataFrame:
    """``split`` is test for the first round(test_size · n) rows of a label, else train."""
    marked = hash_mark(df, [label], key, F.round(F.col("group_size") * test_size), "__test", seed)
    split = F.when(F.col("__test"), "test").otherwise("train")
    return marked.withColumn("split", split).drop("__test", "group_size")


def stratified_kfold(df: DataFrame, label: str, key: str, folds: int = cfg.FOLDS,
                     seed: int = cfg.SEED) -> DataFrame:
    """``fold`` 0..folds-1, sizes within a label differ by at most one."""
    fold = F.pmod(F.col("hash_rank") - 1, F.lit(folds)).cast("int")
    return hash_rank(df, [label], key, seed).withColumn("fold", fold).drop("hash_rank", "group_size")


def hash_sample_per_group(df: DataFrame, by: str, key: str, n: int, seed: int = cfg.SEED) -> DataFrame:
    """n rows of each group in hash order; smaller groups stay whole."""
    out = df.withColumn("__hash", hash_key(key, seed))
    return top_n_per_group(out, [by], [F.col("__hash"), F.col(key)], n, [key]).drop("__hash")


def few_shot_sample(df: DataFrame, label: str, key: str, shots: int = cfg.SHOTS_PER_CLASS,
                    seed: int = cfg.SEED) -> DataFrame:
    return hash_sample_per_group(df, label, key, shots, seed).drop("rank")


def cluster_sample_titles(df: DataFrame, cluster: str, key: str, title: str, n: int = 3,
                          seed: int = cfg.SEED) -> DataFrame:
    """Up to n sample titles per cluster with the cluster's size; noise is skipped."""
    rows = df.where(F.col(cluster) != -1)
    sizes = rows.groupBy(cluster).agg(F.count("*").alias("cluster_size"))
    picked = hash_sample_per_group(rows.select(cluster, key, title), cluster, key, n, seed)
    return picked.join(sizes, cluster).select(
        cluster, "cluster_size", "rank", key, F.left(F.col(title), F.lit(100)).alias("title")
    )


def oversample(df: DataFrame, label: str, key: str, seed: int = cfg.SEED) -> DataFrame:
    """Every class grown to the majority size; ``copy`` 0 is the original row.

    Extra copies go round the class in hash order, so each row makes its own copies and no task
    has to produce those of a whole class.
    """
    sizes = df.groupBy(label).agg(F.count("*").alias("__n"))
    target = sizes.agg(F.max("__n").alias("m")).select("m").scalar()
    extra = target - F.col("group_size")
    marked = hash_mark(df, [label], key, F.pmod(extra, F.col("group_size")), "__more", seed)
    copies = F.floor(extra / F.col("group_size")) + F.col("__more").cast("int")
    out = marked.withColumn("copy", F.explode(F.sequence(F.lit(0), copies.cast("int"))))
    return out.drop("__more", "group_size")


def sample_cap(df: DataFrame, key: str, n: int, seed: int = cfg.SEED) -> DataFrame:
    """Uniform sample of n rows, all rows when there are fewer."""
    return hash_mark(df, [], key, F.lit(n), "__in", seed).where("__in").drop("__in", "group_size")


def top_k_tags(df: DataFrame, key: str, probabilities: str, labels: Sequence[str],
               k: int = cfg.TOP_K) -> DataFrame:
    """k best classes per row as tag_i, confidence_i; ties go to the earlier class."""
    if not dict(df.dtypes)[probabilities].startswith("array<") or "array<array" in dict(df.dtypes)[probabilities]:
        raise ValueError(f"{probabilities} must hold one probability vector per row")
    k = min(k, len(labels))
    names = F.array(*[F.lit(name) for name in labels])
    ranked = F.array_sort(
        F.transform(
            F.col(probabilities),
            lambda p, i: F.struct((-p).alias("minus_p"), i.alias("i")),
        )
    )
    out = df.withColumn("__top", F.slice(ranked, 1, k))
    columns = []
    for r in range(k):
        best = F.get(F.col("__top"), F.lit(r))
        columns.append(F.get(names, best["i"]).alias(f"tag_{r + 1}"))
        columns.append(F.round(-best["minus_p"], 4).alias(f"confidence_{r + 1}"))
    return out.select(key, *columns)
