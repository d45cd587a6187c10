"""Building blocks of the DuckDB checks, written for DuckDB and not from the Spark plans."""

from __future__ import annotations

from functools import lru_cache

from .. import config as cfg
from ..operators.tokens import NOUN_ENDINGS


@lru_cache(maxsize=None)
def _stop_words() -> list[str]:
    out = set(cfg.CUSTOM_STOP_WORDS)
    for w in cfg.ENGLISH_STOP_WORDS:
        out.update(p for p in w.split("'") if p) if "'" in w else out.add(w)
    return sorted(out)


def stops() -> str:
    return "(" + ",".join(f"'{w}'" for w in _stop_words()) + ")"


ARTICLES = """articles AS (
  SELECT d.doc_id, left(split_part(d.text, chr(10), 1), 80) AS title, d.text, d.source AS section,
         coalesce('q' || l.quality || 't' || l.toxic, 'none') AS label
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

VECTORS = """vecs AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, label,
         CASE WHEN vec_id % 5 = 0 THEN 'none' ELSE label::VARCHAR END AS need FROM embeddings)"""

TAGS = """CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'orders, user_need: other-not-news'
  WHEN o_orderpriority = '5-LOW' THEN 'orders,low'
  ELSE 'orders , user_need: ' || o_orderpriority || ', user_need: second' END"""

EXPORT = f"""export AS (
  SELECT o_orderkey::VARCHAR AS apikey, o_custkey::VARCHAR AS url, 'Order ' || o_orderkey AS title,
    strftime(o_orderdate, '%Y-%m-%d %H:%M') AS pub, nullif(o_orderstatus, 'O') AS authors,
    o_orderpriority AS section, {TAGS} AS tags,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderkey::VARCHAR END AS post_id, o_totalprice AS price,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS tablet FROM orders),
filtered AS (
  SELECT *, pub::TIMESTAMP AS pub_date, coalesce(nullif(regexp_extract(tags,
      '(?:^|,)\\s*user_need: ([^,]*)', 1), ''), 'none') AS need FROM export WHERE post_id IS NOT NULL),
kept AS (SELECT * FROM filtered WHERE need <> 'other-not-news'),
texts AS (SELECT c_custkey::VARCHAR AS curl, c_name, nullif(c_mktsegment, 'BUILDING') AS text FROM customer),
merged AS (SELECT kept.*, texts.text FROM kept JOIN texts ON kept.url = texts.curl)"""


def letters(x: str) -> str:
    out = f"regexp_replace(lower({x}), 'http\\S+|www\\.\\S+', '', 'g')"
    out = f"regexp_replace({out}, '<[^>]+>', '', 'g')"
    out = f"regexp_replace({out}, '[^a-z\\s]', ' ', 'g')"
    return (
        f"regexp_replace({out}, '\\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\\b',"
        f" '\\1\\3\\5\\7 \\2\\4\\6\\8', 'g')"
    )


def tokens(source: str, parts: dict[int, str], key: str = "doc_id", keep: str = "") -> str:
    """CTEs ``toks`` (content words) and ``lt`` (lemmatised) of ``(key, part, pos, tok)``."""
    keep_in, keep_out = (f", {keep}", f", {keep}") if keep else ("", "")
    split = " UNION ALL ".join(
        f"SELECT {key}{keep_in}, {i} AS part, string_split_regex({letters(c)}, '\\s+') AS l FROM {source}"
        for i, c in parts.items()
    )
    rules = ",".join(f"({i},'{a}','{b}')" for i, (a, b) in enumerate(NOUN_ENDINGS))
    return f"""split AS ({split}),
pos AS (SELECT {key}{keep_out}, part, unnest(l) AS tok, generate_subscripts(l, 1) AS pos FROM split),
toks AS (SELECT * FROM pos WHERE length(tok) > 2 AND tok NOT IN {stops()}),
voc AS (SELECT DISTINCT tok FROM toks),
cand AS (SELECT tok, ord, left(tok, length(tok) - length(suf)) || rep AS lemma
         FROM voc JOIN (VALUES {rules}) r(ord, suf, rep) ON ends_with(tok, suf)),
lem AS (SELECT tok, lemma FROM cand WHERE lemma IN (SELECT tok FROM voc)
        QUALIFY row_number() OVER (PARTITION BY tok ORDER BY length(lemma), ord) = 1),
lt AS (SELECT {key}{keep_out}, part, pos, coalesce(lemma, tok) AS tok FROM toks LEFT JOIN lem USING (tok))"""


def joined(part: int, name: str, key: str = "doc_id") -> str:
    return f"""{name} AS (SELECT {key}, string_agg(tok, ' ' ORDER BY pos) AS s FROM lt WHERE part = {part} GROUP BY {key})"""


def counts(source: str = "articles", lo: int = 1, hi: int = 2) -> str:
    """CTE ``counts`` (doc_id, label, term, tf) of the combined clean text."""
    grams = []
    if lo == 1:
        grams.append("SELECT doc_id, label, tok AS term FROM seq")
    if hi == 2:
        grams.append(
            "SELECT doc_id, label, tok || ' ' || nxt AS term FROM (SELECT *, lead(tok) OVER"
            " (PARTITION BY doc_id ORDER BY i) AS nxt FROM seq) WHERE nxt IS NOT NULL"
        )
    return f"""{tokens(source, {0: "title", 1: "text"}, keep="label")},
seq AS (SELECT doc_id, label, tok, row_number() OVER (PARTITION BY doc_id ORDER BY part, rep, pos) AS i
        FROM lt JOIN (VALUES (0,0),(0,1),(0,2),(1,0)) w(part, rep) USING (part)
        WHERE length(tok) > 2 AND tok NOT IN {stops()}),
grams AS ({" UNION ALL ".join(grams)}),
counts AS (SELECT doc_id, label, term, count(*) AS tf FROM grams GROUP BY ALL)"""


def vocab(n_docs: str, min_df: int = 3, max_df: float = 0.95, limit: int = 10000, source: str = "counts") -> str:
    return f"""vocab AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf,
    ln((1 + ({n_docs})) / (1.0 + count(*))) + 1 AS idf FROM {source} GROUP BY term
    HAVING count(*) >= {min_df} AND count(*) <= {max_df} * ({n_docs})
    ORDER BY tf DESC, term LIMIT {limit})"""


def tfidf(source: str = "counts", name: str = "tfidf") -> str:
    return f"""{name} AS (SELECT doc_id, label, term, df, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
  FROM (SELECT c.doc_id, c.label, c.term, v.df, c.tf, (1 + ln(c.tf)) * v.idf AS w
        FROM {source} c JOIN vocab v USING (term)))"""


LABELED = "labeled AS (SELECT * FROM articles WHERE label <> 'none')"


def corpus_tfidf(min_df: int = 3) -> str:
    return f"""{ARTICLES}, {counts()}, {vocab("SELECT count(*) FROM documents", min_df)}, {tfidf()}"""
