import pytest
from pyspark.sql import functions as F

from tagloom.functions import text as tx
from tagloom.functions import vectors as vx
from tagloom.operators import articles as ar
from tagloom.operators import filters as fl
from tagloom.operators import joins as jn
from tagloom.operators import tokens as tk
from tagloom.operators.aggregates import combine_paragraphs, histogram, length_box_stats


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression).first()[0]


@pytest.mark.parametrize("tags,label", [
    (None, "none"), ("", "none"), ("news", "none"), ("a, user_need: help-me", "help-me"),
    ("user_need: x, user_need: y", "x"), ("user_need:x", "none"), ("\tuser_need: z \n,b", "z"),
])
def test_user_need(spark, tags, label):
    assert one(spark, tags, tx.extract_user_need("x")) == label


@pytest.mark.parametrize("text,tokens", [
    ("Big http://a.b/c?d half<b>way</b>", ["big", "halfway"]), ("Ab 12 abc3def MAINE The <i>xyz</i>", ["abc", "def", "xyz"]),
    (None, []), ("cannot wanna gonna", ["wan", "gon"]), ("don't didn't stop", ["stop"]),
    ("link http://x.y\u00a0table", ["link", "table"]),
])
def test_clean_tokens(spark, text, tokens):
    assert one(spark, text, tx.clean_tokens("x")) == tokens


def test_alnum_deletes_instead_of_spacing(spark):
    assert one(spark, " A-b  c\t1! ", tx.clean_alnum("x")) == "ab c 1"


@pytest.mark.parametrize("n", [511, 512, 513])
def test_raw_combined_caps_words(spark, n):
    body = "  ".join(["w"] * n)
    got = one(spark, body, tx.raw_combined(F.lit(" t "), "x"))
    assert got.startswith("t [SEP] ") and got.count("w") == min(n, 512)


def test_section_title_text(spark):
    df = spark.createDataFrame([(None, "t", "b" * 2000)], "Section string, Title string, text string")
    got = df.select(tx.section_title_text()).first()[0]
    assert got.startswith(" | t | bbb") and len(got) == 1500


def test_prompt_rejects_unknown_task():
    with pytest.raises(ValueError):
        tx.embedding_prompt(task="translate")


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(tx.ngrams(F.col("t"))).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]


def test_lemma_map_uses_lexicon(spark, rows):
    t = spark.createDataFrame([(w,) for w in "city cities church churches bus buses women woman glass".split()], "token string")
    assert dict(tk.lemma_map(t).collect()) == {"cities": "city", "churches": "church", "buses": "bus", "women": "woman"}
    lexicon = spark.createDataFrame([("city",)], "w string")
    assert dict(tk.lemma_map(t, lexicon).collect()) == {"cities": "city"}


def test_token_arrays_keep_order_and_empty(spark):
    df = spark.createDataFrame([(1, "Cities city", "walk talks talk"), (2, None, "")], "id long, a string, b string")
    got = {r["id"]: (r["a_tokens"], r["b_tokens"]) for r in tk.token_arrays(df, "id", ["a", "b"]).collect()}
    assert got == {1: (["city", "city"], ["walk", "talk", "talk"]), 2: ([], [])}


def test_preprocess_keeps_existing_columns(spark):
    df = spark.createDataFrame([(1, "Town hall", None)], "id long, Title string, text string")
    out = ar.preprocess_articles(df, "id").first()
    assert out["combined_text"] == "Town hall. " and out["clean_combined"] == "town hall town hall town hall "
    assert ar.with_derived_text(ar.preprocess_articles(df, "id"), "id").columns.count("raw_combined") == 1


PAGES = [
    ("u1", "<h1>T &amp; U</h1><article><div class='x entry-content'><div>n</div><p>a <b>b</b><p> &#8217;q&#x41; </div><p>out</p></article>"),
    ("u2", "<p>x</p>"), ("u3", "<article><div class='entry-contents'><p>x</p></div></article>"),
    ("u4", "<article><div class=entry-content><p> </p><p><i></i></p></div></article>"),
    ("u5", "<script>var a='</p><article>'</script><article><div class=\"entry-content\"><p>k<!-- <p>z --> l</p></div></article>"),
]


def test_pages(spark):
    df = spark.createDataFrame(PAGES, "url string, html string")
    got = {r["url"]: r for r in ar.extract_pages(df).collect()}
    assert got["u1"]["title"] == "T & U" and got["u1"]["paragraphs"] == ["a b", "’qA"] and got["u1"]["error"] is None
    assert got["u2"]["error"].startswith("No <article>") and got["u3"]["error"].startswith("No content")
    assert got["u4"]["error"].startswith("No <p>") and got["u5"]["paragraphs"] == ["k l"] and got["u5"]["title"] == ""
    out = ar.extract_pages(df)
    assert [(r["url"], r["paragraph"]) for r in ar.paragraph_rows(out).orderBy("url", "paragraph").collect()] == [
        ("u1", 1), ("u1", 2), ("u5", 1)]
    assert ar.extraction_errors(out).count() == 3


def test_combine_paragraphs(spark):
    data = [("u", None, 1, "a"), ("u", "T", 2, None), ("u", "S", 300, "c"), ("u", "Q", 3, "b"), (None, "x", 1, "y"), ("v", None, 1, None)]
    df = spark.createDataFrame(data, "url string, title string, paragraph int, text string")
    assert sorted(tuple(r) for r in combine_paragraphs(df).collect()) == [("u", "T", "a b c"), ("v", None, "")]


def test_filter_articles_bounds(spark):
    data = [("1", d, None) for d in ("2025-02-01 00:00", "2025-01-31 23:59", "2025-03-01 00:00")] + [(None, "2025-02-02 00:00", None)]
    data += [("2", "2025-02-03 00:00", "user_need: other-not-news")]
    df = spark.createDataFrame(data, ["Post id", "Publish date", "Tags"])
    assert [r["Publish date"] for r in fl.filter_articles(df, "2025-02-01", "2025-03-01").collect()] == ["2025-02-01 00:00"]


def test_min_words_counts_empty_pieces(spark):
    df = spark.createDataFrame([(" ".join(["w"] * n),) for n in (50, 51)] + [("a" + " " * 50,)], "text string")
    assert fl.min_word_count(df).count() == 2


def test_merge_multiplies_repeated_urls(spark):
    a = spark.createDataFrame([("u", "A"), ("w", "B")], ["URL", "Title"])
    t = spark.createDataFrame([("u", "x", "1"), ("u", "y", "2")], ["url", "title", "text"])
    assert jn.merge_article_text(a, t).count() == 2 and jn.merge_article_text(a, t).columns == ["URL", "Title", "text"]
    assert jn.left_merge_text(a, t).count() == 3


def test_reshape_checks_length(spark):
    good, bad = [float(i) for i in range(768)], [0.0] * 767
    df = spark.createDataFrame([(good,)], "v array<double>").select(vx.reshape(F.col("v"), 12, 64).alias("r"))
    assert df.first()[0][1][0] == 64.0
    with pytest.raises(Exception, match="expected 768"):
        spark.createDataFrame([(bad,)], "v array<double>").select(vx.reshape(F.col("v"), 12, 64)).collect()


def test_cosine_zero_vector_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 1.0], [-1.0, -1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(vx.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] is None and abs(got[1] + 1) < 1e-12


def test_histogram_constant_and_box(spark):
    df = spark.createDataFrame([(5, "a")] * 3, "v int, User_Needs string")
    assert sum(r["n"] for r in histogram(df, "v", 4).collect()) == 3
    box = spark.createDataFrame([(v, "a") for v in (1, 2, 3, 4, 100)], "v int, User_Needs string")
    r = length_box_stats(box, "v").first()
    assert (r["whisker_low"], r["median"], r["whisker_high"]) == (1, 3.0, 4)


def test_lemmas_are_set_in_place_or_joined_alike(spark, rows, monkeypatch):
    given = [(1, "bus buses boxes men", "wolves wolf"), (1, "box man", None), (None, "buses churches", ""), (2, None, "church ladies lady glass")]
    df = spark.createDataFrame(given, "id long, Title string, text string")
    out = tk.token_arrays(df, "id", ["Title", "text"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    here = rows(out)
    assert ("church" in here[-1][1] or any("church" in r[1] for r in here)) and any("wolf" in r[2] and "wolves" not in r[2] for r in here)
    monkeypatch.setattr(tk, "MAP_TOKENS", 0)
    assert rows(tk.token_arrays(df, "id", ["Title", "text"])) == here
