"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by pattern, with their places in the text. Hashes of the candidate values are
counted over the corpus by distinct owners and repositories: a value that several owners hold is a
widely copied example, one that stays with its owner looks like a live credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .registry import query, table

# The base patterns of the scan, in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run too short holds no longer match inside, so the bound may stand here
HEX = r"[0-9a-f]{24,}"
VENDOR = (
    r"(?:gh[oprsu]_|github_pat_)[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
    r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{20,}-----END [A-Z ]{0,20}PRIVATE KEY-----"
)
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("vendor", VENDOR))
BASE_KINDS = 3  # the first ones always count; the others only as live credentials

ASSIGN_MIN = 6  # characters of an assigned value
EXAMPLE_OWNERS = 3  # a value with so many owners is a copied example,
EXAMPLE_REPOS = 100  # and so is one that two owners hold in so many repositories
CHUNK = 256  # matches of a text whose places are added up together
LIVE_CHARS = 6  # distinct characters of a value that is no placeholder
MASK = "<secret>"

SPAN = "struct<start:int,no:int,end:int,kind:string,value:string>"


def _before(sizes: Column) -> Column:
    """Sum of the numbers in front of each one, in chunks, so that long arrays are not copied again and again."""
    size, last = F.size(sizes), F.lit(CHUNK)
    none = F.array().cast("array<long>")

    def add(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def running(xs: Column) -> Column:
        return F.aggregate(xs, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), add)

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(size - 1, F.lit(0)) / last).cast("int")), lambda i: running(F.slice(sizes, i * last + 1, last))
    )
    return _let(chunks, lambda parts: F.flatten(F.zip_with(
        running(F.transform(parts, lambda p: p["at"]))["out"], F.transform(parts, lambda p: p["out"]),
        lambda first, xs: F.transform(xs, lambda x: x + first),
    )))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(text: Column, no: int) -> Column:
    """Matches of one kind with their places in code points.

    The text is cut at its matches once; a match stands where the pieces and matches before it end.
    """
    kind, pattern = KINDS[no]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p).cast("long"))

    def spans(cut: Column) -> Column:
        gap = F.slice(cut["pieces"], F.lit(1), F.size(cut["found"]))
        both = F.zip_with(gap, cut["found"], lambda p, m: p + F.char_length(m))
        starts = F.zip_with(_before(both), gap, lambda s, p: s + p)

        def span(start: Column, m: Column) -> Column:
            value = F.regexp_extract(m, ASSIGN, 2) if kind == "assign" else m
            return F.struct(
                start.alias("start"), F.lit(no).alias("no"), (start + F.char_length(m)).alias("end"),
                F.lit(kind).alias("kind"), value.alias("value"),
            ).cast(SPAN)

        return F.zip_with(starts, cut["found"], span)

    out = _let(F.struct(found.alias("found"), pieces.alias("pieces")), spans)
    return F.filter(out, lambda s: F.char_length(s["value"]) >= ASSIGN_MIN) if kind == "assign" else out


def candidates(text: Column) -> Column:
    """All candidate spans of a text by start, then kind."""
    none = F.array().cast(f"array<{SPAN}>")
    found = [F.when(text.rlike(pattern), _places(text, no)).otherwise(none) for no, (_, pattern) in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def ownership(found: DataFrame, owner: str, repository: str) -> DataFrame:
    """``(hash, n_owners, n_repos)`` of every candidate value; a repository belongs to its owner.

    Distinct (value, owner, repository) rows are counted in two levels, so a value that a third of
    all documents hold is summed up where it is read.
    """
    rows = found.select(
        F.col(f"`{owner}`").alias("owner"), F.col(f"`{repository}`").alias("repo"),
        F.explode(F.array_distinct(F.transform("__spans", lambda s: F.sha2(s["value"], 256)))).alias("hash"),
    )
    held = rows.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    per_owner = held.groupBy("hash", "owner").agg(F.sum("one").alias("repos"))
    return per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id",
         keep_text: bool = True) -> DataFrame:
    """``docs`` with ``secret_spans``, an array of (start, no, end, kind, value, n_owners, n_repos, live).

    Base spans are all there; spans of further kinds only if live: no placeholder, and held by fewer than
    EXAMPLE_OWNERS owners, of whom two not in EXAMPLE_REPOS repositories or more. Every text is searched
    once, and what was found is written with the rows, without the texts if ``keep_text`` is False. Places are code points, ends exclusive. A null or empty text has an empty
    array. A null owner or repository counts as one of its own. Repeated rows stay, other columns
    are kept, an existing ``secret_spans`` is replaced. Verdicts depend on the text and the corpus
    alone, so rows meet their verdicts by a digest of the text and rows without candidates do not
    meet at all.
    """
    columns = [c for c in docs.columns if c != "secret_spans"]
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in columns if keep_text or c != text]
    scratch = Scratch(docs.sparkSession, "secrets")
    searched = docs.select(*kept, candidates(whole).alias("__spans"), whole.alias("__whole"))
    held = F.size("__spans") > 0
    searched = searched.withColumn("__text", F.when(held, F.sha2(F.col("__whole"), 256))).drop("__whole")
    searched = scratch.write(searched, "searched")
    found = searched.filter(held)

    one = found.groupBy("__text").agg(F.first("__spans").alias("spans"))
    spans = one.select("__text", F.explode("spans").alias("s")).withColumn("hash", F.sha2("s.value", 256))
    judged = spans.join(ownership(found, owner, repository), "hash")
    varied = F.size(F.array_distinct(F.split("s.value", ""))) >= LIVE_CHARS
    copied = (F.col("n_owners") >= EXAMPLE_OWNERS) | ((F.col("n_owners") > 1) & (F.col("n_repos") >= EXAMPLE_REPOS))
    judged = judged.withColumn("live", ~copied & varied).filter(F.col("live") | (F.col("s.no") < BASE_KINDS))
    judged = judged.groupBy("__text").agg(F.array_sort(F.collect_list(F.struct("s.*", "n_owners", "n_repos", "live"))).alias("secret_spans"))
    judged = scratch.write(judged, "judged")
    none = F.array().cast(judged.schema["secret_spans"].dataType)
    out = found.drop("__spans").join(judged, "__text", "left").withColumn("secret_spans", F.coalesce("secret_spans", none))
    rest = searched.filter(~held).drop("__spans").withColumn("secret_spans", none)
    return rest.unionByName(out).drop("__text")


def redact(docs: DataFrame, text: str = "text", **scan_options) -> DataFrame:
    """``docs`` with the value of every live credential replaced by MASK; nothing else changes.

    Values that overlap are masked together, from the first start to the greatest end.
    """
    found = scan(docs, text, **scan_options)
    whole = F.col(f"`{text}`")

    def add(acc: Column, s: Column) -> Column:
        kept = F.substring(whole, acc["at"], s["first"] - acc["at"])
        after = F.struct((s["end"] + 1).alias("at"), F.concat(acc["out"], kept, F.lit(MASK)).alias("out"))
        longer = F.struct(F.greatest(acc["at"], s["end"] + 1).alias("at"), acc["out"].alias("out"))
        return F.when(s["first"] < acc["at"], longer).otherwise(after)

    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    live = F.filter("secret_spans", lambda s: s["live"])
    # a value starts later than its span, so values come in an order of their own
    values = F.array_sort(F.transform(live, lambda s: F.struct((s["end"] - F.char_length(s["value"]) + 1).alias("first"), s["end"].alias("end"))))
    clean = F.aggregate(values, start, add, lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"], F.char_length(whole))))
    return found.withColumn(text, F.when(F.size(live) > 0, clean).otherwise(whole)).drop("secret_spans")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per document: number of base spans by kind, digest of the base spans, and all spans."""
    rows = scan(docs.select("doc_id", "text", "source"), keep_text=False)
    base = F.filter("secret_spans", lambda s: s["no"] < BASE_KINDS)

    def number(no: int) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["no"] == no)).cast("long").alias(f"n_{KINDS[no][0]}")

    counts = [number(no) for no in range(BASE_KINDS)]
    return rows.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secret_spans")).alias("spans"),
        F.size(F.filter("secret_spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def _kind_sql(no: int) -> str:
    kind, pattern = KINDS[no]
    quoted = pattern.replace("'", "''")
    return f"""SELECT rid, {no} AS no, '{kind}' AS kind, regexp_extract_all(t, '{quoted}') AS ms,
      string_split_regex(t, '{quoted}') AS ps FROM d"""


OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_kind_sql(no) for no in range(len(KINDS)))}),
p AS (SELECT rid, no, kind, ms[i] AS m, (list_sum(list_transform(ps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0))::BIGINT AS s
      FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m)),
v AS (SELECT rid, no, kind, s, s + length(m) AS e,
        CASE WHEN no = 0 THEN regexp_extract(m, '{ASSIGN.replace("'", "''")}', 2) ELSE m END AS value FROM p),
c AS (SELECT v.*, doc_id, source FROM v JOIN d USING (rid) WHERE no > 0 OR length(value) >= {ASSIGN_MIN}),
o AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners,
        count(DISTINCT [coalesce(source, chr(0)), coalesce(doc_id::VARCHAR, '')]) AS repos FROM c GROUP BY value),
j AS (SELECT c.*, owners < {EXAMPLE_OWNERS} AND (owners = 1 OR repos < {EXAMPLE_REPOS}) AND len(list_distinct(string_split(value, ''))) >= {LIVE_CHARS} AS live
      FROM c JOIN o USING (value)),
g AS (SELECT rid, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access,
        count(*) FILTER (no = 2) AS n_hex, count(*) FILTER (live) AS n_live,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) FILTER (no < {BASE_KINDS}) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) FILTER (no < {BASE_KINDS} OR live) AS spans
      FROM j GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN g USING (rid)"""


@query(OP10_SQL)
def op10_secret_scan(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"))
