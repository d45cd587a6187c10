"""Sources, filters, projections, joins, aggregates, ranking and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as cfg
from ..functions import text as tx
from ..functions import vectors as vx
from ..operators import aggregates as ag
from ..operators import articles as ar
from ..operators import filters as fl
from ..operators import joins as jn
from ..operators import ranking as rk
from ..operators import tokens as tk
from ..plans import prepare as pr
from ..sources import stores as st
from ..sources import tables as tb
from ..streaming.incremental import IncrementalExtract, scratch_output
from . import sql as q
from . import standin as s
from .registry import query


def rounded(df, *columns: str, digits: int = 4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_vector(column: str, digits: int):
    return F.transform(F.col(column).cast("array<double>"), lambda x: F.round(x, digits))


# Sources and sinks

@query("SELECT doc_id::VARCHAR AS apikey, text AS title, source AS section, n_chars::DOUBLE AS views FROM documents")
def read_export(spark, d):
    out = scratch_output(spark, "export")
    rows = s.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("Apikey"), F.col("text").alias("Title"),
        F.col("source").alias("Section"), F.col("n_chars").cast("double").alias("Views"),
    )
    tb.write_articles(rows, out, "csv")
    back = tb.read_export(spark, out, rows.columns, multi_line=True)
    return back.select(F.col("Apikey").alias("apikey"), F.col("Title").alias("title"),
                       F.col("Section").alias("section"), F.col("Views").alias("views"))


DERIVED = f"""WITH {q.ARTICLES}, {q.tokens("articles", {0: "title", 1: "text"})},
{q.joined(0, "ct")}, {q.joined(1, "cb")}
SELECT a.doc_id, title || '. ' || text AS combined_text, title || '. ' || left(text, 2000) AS combined_short,
  coalesce(ct.s,'') || ' ' || coalesce(ct.s,'') || ' ' || coalesce(ct.s,'') || ' ' || coalesce(cb.s,'') AS clean_combined,
  regexp_replace(title, '^\\s+|\\s+$', '', 'g') || ' [SEP] ' || array_to_string(list_slice(list_filter(
    string_split_regex(text, '\\s+'), lambda w: w <> ''), 1, 512), ' ') AS raw_combined
FROM articles a LEFT JOIN ct USING (doc_id) LEFT JOIN cb USING (doc_id)"""


@query(DERIVED)
def load_articles(spark, d):
    out = scratch_output(spark, "articles")
    tb.write_articles(s.articles(spark, d), out)
    return tb.load_articles(spark, out, "doc_id").select("doc_id", *cfg.DERIVED_TEXT_COLUMNS)


@query("SELECT doc_id, text, source AS section FROM documents")
def write_articles(spark, d):
    out = scratch_output(spark, "stage")
    tb.write_articles(s.articles(spark, d), out, partition_by=["Section"])
    return spark.read.parquet(out).select("doc_id", "text", F.col("Section").alias("section"))


@query("SELECT conv_id AS url, turn AS paragraph, text FROM conversations")
def append_rows(spark, d):
    out = scratch_output(spark, "rows")
    rows = s.paragraphs(spark, d).select("url", "paragraph", "text")
    tb.append_rows(rows.where("paragraph = 0"), out)
    tb.append_rows(rows.where("paragraph > 0"), out)
    tb.append_rows(rows.where("paragraph < 0"), out)
    return spark.read.parquet(out)


_COUNTED = "aeiou"
_COUNTS = ", ".join(f"length(text) - length(replace(text, '{c}', ''))" for c in _COUNTED)


@query(f"""SELECT doc_id::VARCHAR AS key, i::INTEGER AS pos, v[i + 1]::DOUBLE AS x
FROM (SELECT doc_id, [{_COUNTS}] AS v FROM documents), range({len(_COUNTED)}) r(i)""")
def embedding_store(spark, d):
    """Labeled documents first, then all: the second call computes the others only."""

    def encode(rows):
        counts = [F.length("text") - F.length(F.replace("text", F.lit(c), F.lit(""))) for c in _COUNTED]
        return rows.select("doc_id", F.array(*counts).alias("embedding"))

    docs = s.table(spark, d, "documents").select("doc_id", "text")
    store = st.EmbeddingStore(spark, scratch_output(spark, "vectors"))
    store.ensure(docs.join(s.table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi"), "doc_id", "letters", "counts", encode)
    stored = store.ensure(docs, "doc_id", "letters", "counts", encode)
    return stored.select("key", F.posexplode("embedding").alias("pos", "x")).withColumn("x", F.col("x").cast("double"))


@query("""SELECT vec_id::VARCHAR AS url, i::INTEGER AS pos, round(-x::DOUBLE, 4) AS x
FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)""")
def read_embedding_store(spark, d):
    e = s.vectors(spark, d)
    store = e.select(
        F.col("vec_id").cast("string").alias("url"), F.col("embedding").alias("classification_embedding"),
        F.transform("embedding", lambda x: -x).alias("cluster_embedding"),
    )
    rows = st.read_embedding_store(store, "clustering").select("url", F.posexplode("embedding").alias("pos", "x"))
    return rows.withColumn("x", F.round(F.col("x").cast("double"), 4))


@query("SELECT event_type AS run_name, event_id, round(value / 7, 4) AS loss FROM events")
def append_run_log(spark, d):
    out = scratch_output(spark, "runs")
    runs = s.table(spark, d, "events").select(
        F.col("event_type").alias("run_name"), "event_id", (F.col("value") / 7).alias("loss")
    )
    tb.append_run_log(runs, out)
    return spark.read.schema("run_name string, event_id long, loss double").json(out)


@query("""WITH r AS (SELECT event_type AS run_name, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS run_index,
  value, user_id FROM events)
SELECT run_name, run_index, 'loss' AS metric, value AS value FROM r
UNION ALL SELECT run_name, run_index, 'epochs', user_id::DOUBLE FROM r WHERE user_id IS NOT NULL""")
def training_log_metrics(spark, d):
    log = s.table(spark, d, "events").select(
        F.col("event_type").alias("run_name"), "event_id", F.col("value").alias("loss"), F.col("user_id").alias("epochs"),
        F.lit(1.0).alias("elapsed_seconds"),
    )
    skip_order = tb.training_log_metrics(log, order="event_id", slice_of=F.floor(F.col("event_id") / 4096))
    return skip_order.where(F.col("metric") != "event_id")


@query("SELECT event_type AS name, 'models/' || event_type AS path, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def model_registry(spark, d):
    out = scratch_output(spark, "registry")
    rows = s.table(spark, d, "events").groupBy(F.col("event_type").alias("name")).agg(F.avg("value").alias("m"))
    registry = rows.select(
        "name", F.concat(F.lit("models/"), "name").alias("path"), F.create_map(F.lit("mean"), "m").alias("metrics")
    )
    st.save_model_registry(registry, out)
    return st.load_model_registry(spark, out).select("name", "path", F.round(F.col("metrics")["mean"], 4).alias("mean"))


# Filters and predicates

@query(f"""WITH {q.EXPORT} SELECT apikey, pub_date AS publish_date, need AS user_needs FROM kept
WHERE pub_date >= TIMESTAMP '1996-01-01' AND pub_date < TIMESTAMP '1999-07-01'""")
def filter_articles(spark, d):
    out = fl.filter_articles(s.export(spark, d), "1996-01-01", "1999-07-01")
    return out.select(F.col("Apikey").alias("apikey"), F.col("Publish_date").cast("timestamp_ntz").alias("publish_date"),
                      F.col("User_Needs").alias("user_needs"))


@query(f"""WITH {q.EXPORT} SELECT apikey, coalesce(nullif(regexp_extract(tags, '(?:^|,)\\s*user_need: ([^,]*)', 1), ''), 'none') AS need FROM export""")
def extract_user_need(spark, d):
    return s.export(spark, d).select(F.col("Apikey").alias("apikey"), tx.extract_user_need("Tags").alias("need"))


@query(f"""WITH {q.ARTICLES} SELECT doc_id, label, true AS listed FROM articles WHERE label IN ('q0t0','q1t1')
UNION ALL SELECT doc_id, label, false FROM articles WHERE label NOT IN ('q0t0','q1t1')""")
def valid_labels(spark, d):
    a = s.articles(spark, d).select("doc_id", F.col("User_Needs").alias("label"))
    listed = ["q0t0", "q1t1"]
    parts = [fl.valid_labels(a, listed, "label", keep).withColumn("listed", F.lit(keep)) for keep in (True, False)]
    return parts[0].unionByName(parts[1])


@query("SELECT doc_id FROM documents WHERE len(string_split(text, ' ')) > 50")
def min_word_count(spark, d):
    return fl.min_word_count(s.table(spark, d, "documents")).select("doc_id")


@query(f"""WITH {q.EXPORT} SELECT apikey, coalesce(tablet, 0) AS tablet FROM export
WHERE authors IS NOT NULL AND tags IS NOT NULL AND post_id IS NOT NULL""")
def dropna_any(spark, d):
    return fl.dropna_any(s.export(spark, d)).select(F.col("Apikey").alias("apikey"), F.col("Tablet views").alias("tablet"))


@query(f"""WITH {q.ARTICLES} SELECT doc_id, label, label <> 'none' AS is_labeled FROM articles""")
def split_labeled_unlabeled(spark, d):
    a = s.articles(spark, d).select("doc_id", "User_Needs")
    yes, no = fl.split_labeled_unlabeled(a)
    out = yes.withColumn("is_labeled", F.lit(True)).unionByName(no.withColumn("is_labeled", F.lit(False)))
    return out.withColumnRenamed("User_Needs", "label")


@query(f"""WITH {q.EXPORT} SELECT url, title, text, need AS user_needs, need <> 'none' AS is_labeled FROM merged WHERE text IS NOT NULL""")
def save_ml_datasets(spark, d):
    tagged, untagged = fl.save_ml_datasets(fl.filter_articles(s.export(spark, d)), s.texts(spark, d), scratch_output(spark, "ml"))
    out = tagged.withColumn("is_labeled", F.lit(True)).unionByName(untagged.withColumn("is_labeled", F.lit(False)))
    return out.select(F.col("URL").alias("url"), F.col("Title").alias("title"), "text",
                      F.col("User_Needs").alias("user_needs"), "is_labeled")


@query(f"""WITH {q.EXPORT} SELECT apikey, url, title, text, pub_date AS publish_date, authors, section, need AS user_needs,
  price AS views, price / 2 AS avg_views, coalesce(tablet, 0) AS tablet FROM merged WHERE text IS NOT NULL AND authors IS NOT NULL""")
def save_eda_dataset(spark, d):
    out = fl.save_eda_dataset(fl.filter_articles(s.export(spark, d)), s.texts(spark, d))
    names = {"Apikey": "apikey", "URL": "url", "Title": "title", "text": "text", "Authors": "authors", "Section": "section",
             "User_Needs": "user_needs", "Views": "views", "Avg. views": "avg_views", "Tablet views": "tablet"}
    return out.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items()],
                      F.col("Publish_date").cast("timestamp_ntz").alias("publish_date"))


_EXPORT_COLUMNS = {
    "Apikey": "apikey", "URL": "url", "Title": "title", "Publish date": "pub", "Authors": "authors", "Section": "section",
    "Tags": "tags", "Post id": "post_id", "Views": "price", "Avg. views": "price / 2", "Engaged minutes": "price",
    "Avg. minutes": "price", "Desktop views": "price", "Mobile views": "price", "Tablet views": "tablet",
}
_NULLS = ", ".join(f'count(*) - count({x}) AS "{c}"' for c, x in _EXPORT_COLUMNS.items())
_QUOTED = ", ".join(f'"{c}"' for c in _EXPORT_COLUMNS)


@query(f"""WITH {q.EXPORT} SELECT c AS "column", nulls::BIGINT AS nulls, (n - nulls)::BIGINT AS non_nulls
FROM (SELECT count(*) AS n, {_NULLS} FROM export) UNPIVOT (nulls FOR c IN ({_QUOTED}))""")
def null_counts(spark, d):
    return fl.null_counts(s.export(spark, d))


# Projections and scalar functions

@query(f"""WITH {q.ARTICLES}, {q.tokens("articles", {0: "text"})}, {q.joined(0, "c")}
SELECT doc_id, coalesce(s, '') AS clean_text FROM articles LEFT JOIN c USING (doc_id)""")
def clean_text(spark, d):
    return tk.clean_text(s.table(spark, d, "documents"), "doc_id")


@query("""SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS clean FROM documents""")
def clean_text_alnum(spark, d):
    return s.table(spark, d, "documents").select("doc_id", tx.clean_alnum("text").alias("clean"))


@query(f"WITH {q.ARTICLES} SELECT doc_id, title || '. ' || text AS combined_text FROM articles")
def combined_text(spark, d):
    return s.articles(spark, d).select("doc_id", tx.combined_text().alias("combined_text"))


@query(f"WITH {q.ARTICLES} SELECT doc_id, title || '. ' || left(text, 2000) AS combined_short FROM articles")
def combined_short(spark, d):
    return s.articles(spark, d).select("doc_id", tx.combined_short().alias("combined_short"))


@query(f"""WITH d AS ({DERIVED}) SELECT doc_id, clean_combined FROM d""")
def clean_combined(spark, d):
    return ar.preprocess_articles(s.articles(spark, d), "doc_id").select("doc_id", "clean_combined")


@query(f"""WITH d AS ({DERIVED}) SELECT doc_id, raw_combined FROM d""")
def raw_combined(spark, d):
    return s.articles(spark, d).select("doc_id", tx.raw_combined().alias("raw_combined"))


@query(f"WITH {q.ARTICLES} SELECT doc_id, left(section || ' | ' || title || ' | ' || text, 1500) AS section_title_text FROM articles")
def section_title_text(spark, d):
    return s.articles(spark, d).select("doc_id", tx.section_title_text().alias("section_title_text"))


@query(DERIVED)
def preprocess_articles(spark, d):
    return ar.preprocess_articles(s.articles(spark, d), "doc_id").select("doc_id", *cfg.DERIVED_TEXT_COLUMNS)


@query(f"""WITH {q.ARTICLES}, {q.tokens("articles", {0: "title", 1: "text", 2: "left(text, 500)"})},
{q.joined(0, "a")}, {q.joined(1, "b")}, {q.joined(2, "c")},
v AS (SELECT length(coalesce(a.s,'') || ' ' || coalesce(b.s,'')) AS x, length(coalesce(a.s,'') || ' ' || coalesce(c.s,'')) AS y,
  3 * length(coalesce(a.s,'')) + 3 + length(coalesce(b.s,'')) AS z
  FROM articles LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT round(avg(x), 4) AS combined, round(avg(y), 4) AS combined_short, round(avg(z), 4) AS upweighted FROM v""")
def combine_variants(spark, d):
    v = ar.combine_variants(s.articles(spark, d), "doc_id")
    return v.agg(*[F.round(F.avg(F.length(c)), 4).alias(c) for c in ("combined", "combined_short", "upweighted")])


LENGTHS = """lens AS (SELECT doc_id, label, length(text) AS chars,
  len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS words,
  len(list_filter(string_split_regex(title, '\\s+'), lambda w: w <> '')) AS twords, label <> 'none' AS is_labeled FROM articles)"""


@query(f"""WITH {q.ARTICLES}, {LENGTHS} SELECT doc_id, chars::INTEGER AS text_len_chars, words::INTEGER AS text_len_words,
  twords::INTEGER AS title_len_words, (words + twords)::INTEGER AS total_len_words, is_labeled FROM lens""")
def text_lengths(spark, d):
    return ar.text_lengths(s.articles(spark, d)).select(
        "doc_id", "text_len_chars", "text_len_words", "title_len_words", "total_len_words", "is_labeled"
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN date_trunc('minute', o_orderdate) END AS publish_date FROM orders""")
def parse_publish_date(spark, d):
    text = F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"))
    rows = s.table(spark, d, "orders").withColumn("Publish date", text)
    out = ar.parse_publish_date(rows, strict=False)
    return out.select("o_orderkey", F.col("Publish_date").cast("timestamp_ntz").alias("publish_date"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%Y-%m') AS month,
strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def date_parts(spark, d):
    return ar.date_parts(s.publications(spark, d)).select("o_orderkey", "year", "month", "day")


@query("""SELECT doc_id, 'title: {title | ""} | task: clustering | text: {' || text || '}' AS prompt FROM documents""")
def embedding_prompt(spark, d):
    return s.table(spark, d, "documents").select("doc_id", tx.embedding_prompt(task="clustering").alias("prompt"))


@query(f"""WITH {q.ARTICLES} SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS sorted_idx,
(row_number() OVER (ORDER BY first) - 1)::INTEGER AS first_idx FROM (
SELECT label, min(doc_id) AS first FROM articles WHERE label <> 'none' GROUP BY label)""")
def encode_labels(spark, d):
    a, _ = fl.split_labeled_unlabeled(s.articles(spark, d).select("doc_id", "User_Needs"))
    first = ar.encode_labels(a, order_by="doc_id").withColumnRenamed("label_idx", "first_idx")
    out = ar.encode_labels(a).join(first, "User_Needs")
    return out.select(F.col("User_Needs").alias("label"), F.col("label_idx").alias("sorted_idx"), "first_idx")


@query("""SELECT vec_id, ((i - 1) // 8)::INTEGER AS step, ((i - 1) % 8)::INTEGER AS pos, round(x::DOUBLE, 5) AS x FROM
(SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)""")
def reshape_vector(spark, d):
    v = s.vectors(spark, d).select("vec_id", F.posexplode(vx.reshape(F.col("embedding"), 8, 8)).alias("step", "row"))
    out = v.select("vec_id", "step", F.posexplode("row").alias("pos", "x"))
    return out.withColumn("x", F.round(F.col("x").cast("double"), 5))


SOFTMAX = """sm AS (SELECT vec_id, i, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM (
  SELECT vec_id, i, exp(x - max(x) OVER (PARTITION BY vec_id)) AS e FROM (
  SELECT vec_id, unnest(v[1:10]) * 3 AS x, generate_subscripts(v[1:10], 1) - 1 AS i FROM vecs)))"""


def logits(spark, d):
    return s.vectors(spark, d).withColumn(
        "logits", F.transform(F.slice(vx.doubles(F.col("embedding")), 1, 10), lambda x: x * 3)
    )


@query(f"WITH {q.VECTORS}, {SOFTMAX} SELECT vec_id, i::INTEGER AS class, round(p, 6) AS p FROM sm")
def softmax(spark, d):
    out = logits(spark, d).select("vec_id", F.posexplode(vx.softmax(F.col("logits"))).alias("class", "p"))
    return rounded(out, "p", digits=6)


@query(f"WITH {q.ARTICLES} SELECT doc_id, left(title, 80) AS short, left(text, 100) AS preview FROM articles")
def title_preview(spark, d):
    return s.articles(spark, d).select(
        "doc_id", F.left("Title", F.lit(80)).alias("short"), F.left("text", F.lit(100)).alias("preview")
    )


BLOCKS = ("address|article|aside|blockquote|details|dialog|div|dl|fieldset|figcaption|figure|footer|form|h[1-6]|header|"
          "hgroup|hr|main|menu|nav|ol|p|pre|search|section|table|ul")
UNESCAPE = ["replace({}, '&quot;', chr(34))", "replace({}, '&lt;', '<')", "replace({}, '&gt;', '>')", "replace({}, '&amp;', '&')"]


def sql_text(x: str) -> str:
    out = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    for step in UNESCAPE:
        out = step.format(out)
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


PAGES = f"""vis AS (SELECT page_id, url, regexp_replace(html,
  '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g') AS h FROM pages),
art AS (SELECT page_id, url, h, regexp_extract(h, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1) AS body FROM vis),
piece AS (SELECT page_id, unnest(l) AS p, generate_subscripts(l, 1) AS i FROM (SELECT page_id, string_split(
  regexp_replace(body, '(?i)(</?(?:{BLOCKS})[\\s/>])', chr(1) || '\\1', 'g'), chr(1)) AS l FROM art)),
para AS (SELECT page_id, i, {sql_text("p")} AS t FROM piece WHERE regexp_matches(p, '(?i)^<p[\\s/>]')),
good AS (SELECT page_id, t, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n FROM para WHERE t <> '')"""
PAGE_TITLE = sql_text("regexp_extract(h, '(?is)<h1\\b[^>]*>(.*?)</h1', 1)")


@query(f"""WITH {PAGES} SELECT art.page_id, {PAGE_TITLE} AS title, (SELECT count(*) FROM good WHERE good.page_id = art.page_id) AS n_paragraphs,
  (SELECT string_agg(t, chr(10) ORDER BY n) FROM good WHERE good.page_id = art.page_id) AS text FROM art""")
def html_article(spark, d):
    out = ar.extract_pages(s.table(spark, d, "pages"), None)
    return out.select("page_id", "title", F.size("paragraphs").cast("long").alias("n_paragraphs"),
                      F.array_join("paragraphs", "\n").alias("text"))


@query("""SELECT url, ['No <article> tag found.', 'No content container found inside <article>.', 'No <p> text found.'][page_id % 4 + 1] AS error
FROM pages WHERE page_id % 4 < 3""")
def extraction_errors(spark, d):
    """The pages in four states: without article, without container, with an empty and with a full one."""
    kind, box = F.col("page_id") % 4, '<article><div class="entry-content">'
    cut = (
        F.when(kind == 0, F.replace("html", F.lit("article"), F.lit("section")))
        .when(kind == 1, F.col("html"))
        .when(kind == 2, F.replace("html", F.lit("<article>"), F.lit(box + "</div>")))
        .otherwise(F.replace("html", F.lit("<article>"), F.lit(box)))
    )
    return ar.extraction_errors(ar.extract_pages(s.table(spark, d, "pages").withColumn("html", cut)))


@query(f"""WITH {PAGES} SELECT url, {PAGE_TITLE} AS title, n::INTEGER AS paragraph, t AS text FROM good JOIN art USING (page_id)""")
def paragraph_rows(spark, d):
    return ar.paragraph_rows(ar.extract_pages(s.table(spark, d, "pages"), None))


# Joins

@query(f"WITH {q.EXPORT} SELECT apikey, url, text FROM merged")
def merge_article_text(spark, d):
    out = jn.merge_article_text(fl.filter_articles(s.export(spark, d)), s.texts(spark, d))
    return out.select(F.col("Apikey").alias("apikey"), F.col("URL").alias("url"), "text")


@query("""SELECT o.o_orderkey::VARCHAR AS apikey, o_custkey::VARCHAR AS url, nullif(c.c_mktsegment, 'BUILDING') AS text FROM orders o
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey""")
def left_merge_text(spark, d):
    rich = s.table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("url"))
    out = jn.left_merge_text(s.export(spark, d), s.texts(spark, d).join(rich, "url", "left_semi"))
    return out.select(F.col("Apikey").alias("apikey"), F.col("URL").alias("url"), "text")


@query("SELECT DISTINCT o_custkey::VARCHAR AS url FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def remaining_urls(spark, d):
    done = s.table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("url"))
    urls = s.export(spark, d).select(F.col("URL").alias("url"))
    return jn.remaining_urls(urls, done, "url")


@query("""WITH t AS (SELECT doc_id, substr(source, 4)::INTEGER AS topic FROM documents)
SELECT doc_id, topic FROM t WHERE topic IN (SELECT topic FROM t GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 12)""")
def label_topk_topics(spark, d):
    return jn.label_topk_topics(topics(spark, d).select("doc_id", "topic"))


def topics(spark, d):
    """Sources as given topic labels of the documents."""
    return s.articles(spark, d).withColumn("topic", F.substr("Section", F.lit(4)).cast("int"))


TOP_TAGS = """top AS (SELECT vec_id, i, p, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) AS r FROM sm),
wide AS (SELECT vec_id, max(CASE WHEN r = 1 THEN i::VARCHAR END) AS tag_1, round(max(CASE WHEN r = 1 THEN p END), 4) AS confidence_1,
  max(CASE WHEN r = 2 THEN i::VARCHAR END) AS tag_2, round(max(CASE WHEN r = 2 THEN p END), 4) AS confidence_2,
  max(CASE WHEN r = 3 THEN i::VARCHAR END) AS tag_3, round(max(CASE WHEN r = 3 THEN p END), 4) AS confidence_3 FROM top GROUP BY vec_id)"""


def tags(spark, d):
    from ..operators.inference import predict_top_k_logits as top

    return top(logits(spark, d), "vec_id", "logits", s.VECTOR_LABELS)


@query(f"""WITH {q.VECTORS}, {SOFTMAX}, {TOP_TAGS} SELECT vec_id, 'vector ' || vec_id AS title, tag_1, confidence_1, tag_2, confidence_2,
tag_3, confidence_3 FROM wide WHERE vec_id % 5 = 0""")
def attach_predictions(spark, d):
    v = s.vectors(spark, d).where(F.col("User_Needs") == cfg.UNLABELED)
    source = v.select("vec_id", F.concat(F.lit("vector "), "vec_id").alias("title"))
    return jn.attach_predictions(source, tags(spark, d), "vec_id", "title")


SPLIT = f"""ranked AS (SELECT vec_id, need, row_number() OVER (PARTITION BY need ORDER BY md5('42|' || vec_id), vec_id) AS r,
  count(*) OVER (PARTITION BY need) AS n FROM vecs WHERE need <> 'none'),
splits AS (SELECT vec_id, CASE WHEN r <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM ranked
  UNION ALL SELECT vec_id, 'unlabeled' FROM vecs WHERE need = 'none')"""


@query(f"WITH {q.VECTORS}, {SPLIT} SELECT vec_id, split, list_transform(v, lambda x: round(x, 5)) AS v FROM vecs JOIN splits USING (vec_id)")
def split_embeddings(spark, d):
    v = s.vectors(spark, d)
    splits = pr.prepare_supervised(v.select("vec_id", "User_Needs"), "vec_id")
    out = jn.split_embeddings(v.select("vec_id", "embedding"), splits, "vec_id")
    return out.select("vec_id", "split", rounded_vector("embedding", 5).alias("v"))


@query("""SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE, 5)) AS v FROM embeddings WHERE label >= 5""")
def masked_embeddings(spark, d):
    """Rows and vectors of one table, kept by a condition on the rows."""
    v = s.table(spark, d, "embeddings")
    out = jn.masked_embeddings(v.select("vec_id", "label"), v.select("vec_id", "embedding"), "vec_id", F.col("label") >= 5)
    return out.select("vec_id", rounded_vector("embedding", 5).alias("v"))


# Aggregations

@query("""SELECT conv_id AS url, arg_min(role, turn) FILTER (turn > 0) AS title, string_agg(text, ' ' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""")
def combine_paragraphs(spark, d):
    return ag.combine_paragraphs(s.paragraphs(spark, d))


@query(f"""WITH {q.ARTICLES}, {LENGTHS}, w AS (SELECT count(*)::VARCHAR AS total_articles, sum(is_labeled::INT)::VARCHAR AS labeled,
  sum((NOT is_labeled)::INT)::VARCHAR AS unlabeled, printf('%.1f%%', avg((NOT is_labeled)::INT) * 100) AS pct_unlabeled,
  printf('%.4f', avg(chars)) AS text_len_mean, printf('%.4f', median(chars)::DOUBLE) AS text_len_median,
  printf('%.4f', stddev_samp(chars)) AS text_len_std, printf('%.4f', max(chars)::DOUBLE) AS text_len_max,
  printf('%.4f', min(chars)::DOUBLE) AS text_len_min, printf('%.4f', avg(words)) AS word_count_mean,
  printf('%.4f', median(words)::DOUBLE) AS word_count_median, printf('%.4f', max(words)::DOUBLE) AS word_count_max FROM lens)
SELECT metric, value FROM w UNPIVOT (value FOR metric IN (COLUMNS(*)))""")
def corpus_statistics(spark, d):
    return ag.corpus_statistics(ar.text_lengths(s.articles(spark, d)))


@query(f"WITH {q.ARTICLES} SELECT label, count(*) AS n, round(count(*) / (SELECT count(*) FROM articles), 4) AS share FROM articles GROUP BY label")
def label_distribution(spark, d):
    return rounded(ag.label_distribution(s.articles(spark, d)), "share").withColumnRenamed("User_Needs", "label")


@query(f"""WITH {q.ARTICLES}, c AS (SELECT label, count(*) AS n FROM articles WHERE label <> 'none' GROUP BY label)
SELECT label, n, round((SELECT max(n) FROM c) / n, 4) AS ratio, round((SELECT max(n) / min(n) FROM c), 4) AS overall_ratio FROM c""")
def imbalance_ratio(spark, d):
    out = rounded(ag.imbalance_ratio(s.articles(spark, d)), "ratio", "overall_ratio")
    return out.withColumnRenamed("User_Needs", "label")


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) FILTER (o_orderpriority = '1-URGENT') AS p1,
count(*) FILTER (o_orderpriority = '2-HIGH') AS p2, count(*) FILTER (o_orderpriority = '3-MEDIUM') AS p3,
count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS p4, count(*) FILTER (o_orderpriority = '5-LOW') AS p5
FROM orders GROUP BY 1 ORDER BY 1""")
def monthly_volume(spark, d):
    out = ag.monthly_volume(s.publications(spark, d), s.PRIORITIES)
    return out.select("month", *[F.col(f"`{p}`").alias(f"p{i}") for i, p in enumerate(s.PRIORITIES, 1)])


CROSSTAB = f"""{q.ARTICLES}, t AS (SELECT doc_id, substr(section, 4)::INTEGER AS topic, label FROM articles WHERE label <> 'none'),
ct AS (SELECT label, topic, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY label) AS share FROM t GROUP BY label, topic)"""


@query(f"WITH {CROSSTAB} SELECT label, topic, n, round(share, 4) AS share FROM ct")
def label_topic_crosstab(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(topics(spark, d))
    return rounded(ag.label_topic_crosstab(labeled), "share").withColumnRenamed("User_Needs", "label")


@query(f"""WITH {CROSSTAB} SELECT label, topic, round(share, 4) AS share FROM ct
QUALIFY row_number() OVER (PARTITION BY label ORDER BY share DESC, topic) = 1""")
def top_topic_per_class(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(topics(spark, d))
    out = rounded(ag.top_topic_per_class(ag.label_topic_crosstab(labeled)), "share")
    return out.withColumnRenamed("User_Needs", "label")


@query(f"""WITH {q.ARTICLES}, {LENGTHS} SELECT label, count(words) AS n, round(avg(words), 1) AS mean, round(stddev_samp(words), 1) AS std,
min(words)::INTEGER AS min, round(quantile_cont(words, 0.25), 1) AS q25, round(quantile_cont(words, 0.5), 1) AS q50,
round(quantile_cont(words, 0.75), 1) AS q75, max(words)::INTEGER AS max FROM lens WHERE label <> 'none' GROUP BY label""")
def length_describe(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(ar.text_lengths(s.articles(spark, d)))
    return ag.length_describe(labeled, "text_len_words").withColumnRenamed("User_Needs", "label")


def sql_histogram(source: str, value: str, bins: int) -> str:
    return f"""st AS (SELECT min({value})::DOUBLE AS lo, max({value})::DOUBLE AS hi, avg({value}) AS mean, median({value})::DOUBLE AS med FROM {source}),
hb AS (SELECT least(floor(({value} - lo) * {bins} / (hi - lo)), {bins - 1})::INTEGER AS bin, count(*) AS n FROM {source}, st GROUP BY 1)
SELECT b::INTEGER AS bin, round(lo + (hi - lo) / {bins} * b, 4) AS left_edge, round(lo + (hi - lo) / {bins} * (b + 1), 4) AS right_edge,
coalesce(n, 0) AS n, round(mean, 4) AS mean, round(med, 4) AS median FROM range({bins}) r(b), st LEFT JOIN hb ON hb.bin = b"""


@query(f"WITH {q.ARTICLES}, {LENGTHS}, {sql_histogram('lens', 'chars', 80)}")
def text_length_histogram(spark, d):
    out = ag.histogram(ar.text_lengths(s.articles(spark, d)), "text_len_chars", 80)
    return rounded(out, "left_edge", "right_edge", "mean", "median")


@query(f"""WITH {q.ARTICLES}, {LENGTHS}, l AS (SELECT * FROM lens WHERE label <> 'none'),
qs AS (SELECT label, quantile_cont(chars, 0.25) AS q1, quantile_cont(chars, 0.5) AS q2, quantile_cont(chars, 0.75) AS q3, count(*) AS n FROM l GROUP BY label)
SELECT qs.label, any_value(n) AS n, round(any_value(q1), 4) AS q1, round(any_value(q2), 4) AS median, round(any_value(q3), 4) AS q3,
min(chars)::INTEGER AS whisker_low, max(chars)::INTEGER AS whisker_high, row_number() OVER (ORDER BY any_value(q2), qs.label)::INTEGER AS position
FROM l JOIN qs ON l.label = qs.label AND chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY qs.label""")
def length_box_stats(spark, d):
    out = ag.length_box_stats(ar.text_lengths(s.articles(spark, d)))
    return rounded(out, "q1", "median", "q3").withColumnRenamed("User_Needs", "label")


@query(f"""WITH {q.ARTICLES}, {q.LABELED}, {q.tokens("labeled", {0: "title", 1: "text"}, keep="label")}
SELECT label, tok AS token, count(*) AS n, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, tok)::INTEGER AS rank FROM lt
GROUP BY label, tok QUALIFY row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, tok) <= 80""")
def class_word_freq(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(s.articles(spark, d))
    rows = tk.lemmatized_rows(labeled, "doc_id", ["Title", "text"])
    out = ag.class_word_freq(rows.join(labeled.select("doc_id", "User_Needs"), "doc_id"))
    return out.withColumnRenamed("User_Needs", "label")


@query(f"""WITH {q.ARTICLES}, {q.LABELED}, c AS (SELECT label, count(*) AS n FROM labeled GROUP BY label)
SELECT label, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c""")
def class_weights(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(s.articles(spark, d))
    return rounded(ag.class_weights(labeled, "User_Needs"), "weight", digits=6).withColumnRenamed("User_Needs", "label")


CENTROIDS = """parts AS (SELECT vec_id, need, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM vecs),
cent AS (SELECT need, i, avg(x) AS m FROM parts WHERE need <> 'none' GROUP BY need, i)"""


@query(f"WITH {q.VECTORS}, {CENTROIDS} SELECT need AS label, (i - 1)::INTEGER AS pos, round(m, 6) AS x FROM cent")
def class_centroids(spark, d):
    c = ag.class_centroids(s.vectors(spark, d), "User_Needs", "embedding")
    out = c.select(F.col("User_Needs").alias("label"), F.posexplode("centroid").alias("pos", "x"))
    return rounded(out, "x", digits=6)


PREDICTED = f"{q.VECTORS}, {SOFTMAX}, {TOP_TAGS}"


@query(f"WITH {PREDICTED} SELECT tag_1, count(*) AS n FROM wide GROUP BY tag_1")
def prediction_distribution(spark, d):
    return ag.prediction_distribution(tags(spark, d))


@query(f"WITH {PREDICTED}, {sql_histogram('wide', 'confidence_1', 30)}")
def confidence_histogram(spark, d):
    return rounded(ag.histogram(tags(spark, d), "confidence_1", 30), "left_edge", "right_edge", "mean", "median")


@query(f"""WITH {PREDICTED} SELECT round(avg(confidence_1), 4) AS mean, round(median(confidence_1), 4) AS median,
min(confidence_1) AS min, max(confidence_1) AS max FROM wide""")
def confidence_stats(spark, d):
    return rounded(ag.confidence_stats(tags(spark, d)), "mean", "median")


@query(f"""WITH {q.ARTICLES}, w AS (SELECT count(*)::DOUBLE AS "rows", 5.0::DOUBLE AS columns, 0.0::DOUBLE AS title_nulls, 0.0::DOUBLE AS text_nulls,
  round(avg(length(text)), 4) AS text_len_mean, median(length(text))::DOUBLE AS text_len_median, max(length(text))::DOUBLE AS text_len_max FROM articles)
SELECT item, value FROM w UNPIVOT (value FOR item IN (COLUMNS(*)))
UNION ALL SELECT 'label:' || label, count(*)::DOUBLE FROM articles GROUP BY label""")
def data_summary(spark, d):
    return rounded(ag.data_summary(s.articles(spark, d)), "value")


ASSIGNED = """given AS (SELECT vec_id, need, v, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE (vec_id % 4)::INTEGER END AS cluster,
  (vec_id % 6)::INTEGER AS other FROM vecs)"""


def assigned(spark, d):
    """Vectors with two given cluster labellings, one of them with noise."""
    v = s.vectors(spark, d)
    noise = F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("vec_id") % 4).cast("int")
    return v.withColumns({"cluster": noise, "other": (F.col("vec_id") % 6).cast("int")})


@query(f"""WITH {q.VECTORS}, {ASSIGNED} SELECT cluster, count(*) AS n, (SELECT count(DISTINCT cluster) FROM given WHERE cluster <> -1) AS n_clusters,
(SELECT count(*) FROM given WHERE cluster = -1) AS n_noise,
round((SELECT count(*) FROM given WHERE cluster = -1) * 100 / (SELECT count(*) FROM given), 4) AS pct_noise FROM given GROUP BY cluster""")
def cluster_sizes(spark, d):
    return rounded(ag.cluster_sizes(assigned(spark, d)), "pct_noise")


@query("""SELECT round(avg(len(list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9\\s]', '', 'g'), '\\s+'), lambda w: w <> ''))), 4) AS avg_words FROM documents""")
def avg_clean_words(spark, d):
    return rounded(ag.avg_clean_words(s.table(spark, d, "documents")), "avg_words")


# Ranking, sampling, splits

@query(f"""WITH {PREDICTED} SELECT tag_1, vec_id, confidence_1, row_number() OVER w::INTEGER AS rank FROM wide
WINDOW w AS (PARTITION BY tag_1 ORDER BY confidence_1 DESC, vec_id) QUALIFY row_number() OVER w <= 5""")
def topn_per_class(spark, d):
    out = rk.topn_per_class(tags(spark, d), 5, "tag_1", "confidence_1", "vec_id")
    return out.orderBy(F.desc("confidence_1"), "vec_id").select("tag_1", "vec_id", "confidence_1", "rank")


@query(f"WITH {PREDICTED} SELECT * FROM wide")
def top_k_tags(spark, d):
    return rk.top_k_tags(
        logits(spark, d).withColumn("p", vx.softmax(F.col("logits"))), "vec_id", "p", s.VECTOR_LABELS
    )


@query(f"WITH {PREDICTED} SELECT vec_id, i::INTEGER AS class FROM top WHERE r = 1")
def argmax_class(spark, d):
    return logits(spark, d).select("vec_id", vx.argmax(F.col("logits")).alias("class"))


@query(f"""WITH {q.ARTICLES}, t AS (SELECT doc_id, substr(section, 4)::INTEGER AS topic, left(title, 100) AS title FROM articles)
SELECT topic, count(*) OVER (PARTITION BY topic) AS cluster_size, row_number() OVER w::INTEGER AS rank, doc_id, title FROM t
WINDOW w AS (PARTITION BY topic ORDER BY md5('42|' || doc_id), doc_id) QUALIFY row_number() OVER w <= 3""")
def cluster_sample_titles(spark, d):
    return rk.cluster_sample_titles(topics(spark, d), "topic", "doc_id", "Title")


LABEL_RANK = f"""{q.ARTICLES}, {q.LABELED}, lr AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || doc_id), doc_id) AS r,
  count(*) OVER (PARTITION BY label) AS n FROM labeled)"""


def labeled_ids(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(s.articles(spark, d).select("doc_id", "User_Needs"))
    return labeled.withColumnRenamed("User_Needs", "label")


@query(f"WITH {LABEL_RANK} SELECT doc_id, label, CASE WHEN r <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM lr")
def stratified_split(spark, d):
    return rk.stratified_split(labeled_ids(spark, d), "label", "doc_id")


@query(f"WITH {LABEL_RANK} SELECT doc_id, label, ((r - 1) % 5)::INTEGER AS fold FROM lr")
def stratified_kfold(spark, d):
    return rk.stratified_kfold(labeled_ids(spark, d), "label", "doc_id")


@query(f"WITH {LABEL_RANK} SELECT doc_id, label FROM lr WHERE r <= 64")
def few_shot_sample(spark, d):
    return rk.few_shot_sample(labeled_ids(spark, d), "label", "doc_id")


@query(f"""WITH {LABEL_RANK}, m AS (SELECT max(n) AS m FROM lr) SELECT doc_id, label, unnest(range(0, 1 + (m - n) // n + CASE WHEN r <= (m - n) % n THEN 1 ELSE 0 END))::INTEGER AS copy FROM lr, m""")
def oversample(spark, d):
    return rk.oversample(labeled_ids(spark, d), "label", "doc_id")


@query("SELECT doc_id FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 500")
def sample_cap(spark, d):
    return rk.sample_cap(s.table(spark, d, "documents").select("doc_id"), "doc_id", 500)


@query(f"""WITH {LABEL_RANK}, dv AS ({DERIVED}), code AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS c FROM (SELECT DISTINCT label FROM labeled))
SELECT dv.doc_id, CASE WHEN lr.r IS NULL THEN 'unlabeled' WHEN r <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split,
c::INTEGER AS label_idx, md5(combined_text) AS text_md5, md5(combined_short) AS short_md5, md5(clean_combined) AS clean_md5, md5(raw_combined) AS raw_md5
FROM dv LEFT JOIN lr USING (doc_id) LEFT JOIN code USING (label)""")
def prepare_supervised(spark, d):
    out = pr.prepare_supervised(ar.preprocess_articles(s.articles(spark, d), "doc_id"), "doc_id")
    names = {"text_md5": "combined_text", "short_md5": "combined_short", "clean_md5": "clean_combined", "raw_md5": "raw_combined"}
    return out.select("doc_id", "split", "label_idx", *[F.md5(c).alias(n) for n, c in names.items()])


@query("""SELECT event_type AS model, round(avg(value), 4) AS f1_macro FROM events GROUP BY event_type ORDER BY 2 DESC, 1""")
def compare_sort(spark, d):
    from ..operators.learning import compare_sort as ordered

    scores = s.table(spark, d, "events").groupBy(F.col("event_type").alias("model")).agg(F.round(F.avg("value"), 4).alias("f1_macro"))
    return ordered(scores)


# Set operations

@query(f"WITH {q.ARTICLES} SELECT title, text FROM articles")
def union_texts(spark, d):
    tagged, untagged = fl.split_labeled_unlabeled(s.articles(spark, d))
    out = jn.union_texts(tagged, untagged, columns=["Title", "text"])
    return out.withColumnRenamed("Title", "title")


@query(f"""WITH {PREDICTED} SELECT vec_id, tag_1, confidence_1 FROM wide
QUALIFY row_number() OVER (PARTITION BY tag_1 ORDER BY confidence_1 DESC, vec_id) <= 50""")
def union_candidates(spark, d):
    return rk.topn_per_class(tags(spark, d), 50, "tag_1", "confidence_1", "vec_id").select("vec_id", "tag_1", "confidence_1")


@query("SELECT DISTINCT o_custkey::VARCHAR AS url FROM orders")
def distinct_urls(spark, d):
    return jn.distinct_urls(s.export(spark, d).select(F.col("URL").alias("url")), "url")


# Streaming

@query(f"""WITH {PAGES} SELECT url, {PAGE_TITLE} AS title, n::INTEGER AS paragraph, t AS text FROM good JOIN art USING (page_id)""")
def incremental_extract(spark, d):
    either = f"{d}/{{pages.parquet}}"  # a pattern fits the table as one file and as a folder of files
    job = IncrementalExtract(spark, either, scratch_output(spark, "pages"), None)
    return job.run().run().paragraphs()
