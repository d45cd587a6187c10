"""HTML extraction on pages whose article is known."""

import random
import re
from html import escape, unescape

import pytest

from tagloom.llm.html import extracted, main_text, op9_html_text

PROSE = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore."


def page(main, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body>{before}{main}{after}</body></html>"


NAV = "<nav><ul><li><a href='/a'>Alpha</a></li><li><a href='/b'>Beta</a></li></ul></nav>"
MENU = "<div><ul>" + "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(9)) + "</ul></div>"
FOOT = "<footer>&copy; 2020 All rights reserved, Someone</footer>"
COMMENTS = f"<section id='comments'><article class='comment'><p>{PROSE} {PROSE}</p></article></section>"


@pytest.mark.parametrize("html,text", [
    (page(f"<article><h1>A &amp; B</h1><p>{PROSE}</p><p>Of.</p></article>", NAV, FOOT), f"A & B\n\n{PROSE}\n\nOf."),
    (page(f"<article><p><b>One<br>two</b> three<p>{PROSE}<ul><li>x<li>y</ul></article>", NAV, COMMENTS), f"One two three\n\n{PROSE}\n\nx\n\ny"),
    (page(f"<div><p>{PROSE}</p><p>{PROSE} Two.</p></div>", MENU, "<div class='cookie-notice'>We use cookies</div>"), f"{PROSE}\n\n{PROSE} Two."),
    (page(f"<main><p>{PROSE}</p><aside>{PROSE}</aside><form>Mail <input></form></main>", "<header><h1>Site</h1></header>"), PROSE),
    (f"<p>{PROSE}", PROSE), ("plain &lt;b&gt; text", "plain <b> text"), ("", ""), (None, ""), ("<nav>only</nav>", ""), ("<p", ""),
    (page(f"<article><!-- c > d --><p title='a > b'>x&nbsp;\n y &eacute;&#8364;&#x41;</p><style>p{{}}</style><p hidden>no</p></article>"), "x y é€A"),
    (page(f"<div id=c><h2>Head</h2><div><p>{PROSE}</p></div><div><p>{PROSE} {PROSE}</p><p>Short.</p></div></div>", MENU, FOOT),
     f"Head\n\n{PROSE}\n\n{PROSE} {PROSE}\n\nShort."),
    (page(f"<div class='page-widget'><p>{PROSE}</p><p>{PROSE}</p></div>", NAV, "<div class='related'>Read this too</div>"), f"{PROSE}\n\n{PROSE}"),
    (page(f"<p>{PROSE}</p>", "", f"<div class='comments'><p>{PROSE} {PROSE}</p></div><div id='sidebar'>About us</div>"), PROSE),
    (page(f"<form><article><p>{PROSE}</p></article></form>"), PROSE),
    # classes and ids inside an article name its own parts
    (page(f"<article><h2 id='related-work'>Related work</h2><p class='notice-period'>{PROSE}</p>"
          f"<section id='skip-lists'><h3>Skip lists</h3><p>{PROSE}</p></section><ul><li class='menu'>x</li></ul></article>", NAV),
     f"Related work\n\n{PROSE}\n\nSkip lists\n\n{PROSE}\n\nx"),
    (page(f"<article><p>{PROSE}</p><div class='share'><a href=a>Tell</a> friends</div><div class='newsletter'><p>Join us now.</p></div></article>"), PROSE),
    (page(f"<article><p>{PROSE}</p><div class='related-posts'><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></div></article>"), PROSE),
    (page(f"<form action='/'><div><h1>Head</h1><p>{PROSE}</p><p>{PROSE} {PROSE}</p></div></form>", NAV, FOOT), f"Head\n\n{PROSE}\n\n{PROSE} {PROSE}"),
    (page(f"<div><p>{PROSE}</p><p>{PROSE} {PROSE}</p></div>", "<form><label>Mail us here</label> <input></form>", FOOT), f"{PROSE}\n\n{PROSE} {PROSE}"),
    (page(f"<main><article><p>{PROSE}</p></article><article><p>{PROSE} Two.</p></article></main>", NAV, FOOT), f"{PROSE}\n\n{PROSE} Two."),
    (page(f"<article><p>{PROSE}</p></article><article><p>{PROSE} {PROSE}</p></article>", NAV, FOOT), f"{PROSE}\n\n{PROSE} {PROSE}"),
    (page(f"<article><p>{PROSE}</p><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>"), f"{PROSE}\n\nSo x=2 holds."),
])
def test_pages(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("sizes", [((300, 10), (280, 10)), ((300, 10), (120, 1)), ((90, 2), (300, 12), (150, 3)), ((200, 6), (200, 6))])
def test_articles_split_over_unequal_siblings(sizes):
    divs = [[(f"{k}{i} " + PROSE * 4)[:n].strip() for i in range(m)] for k, (n, m) in enumerate(sizes)]
    marked = "".join("<div>" + "".join(f"<p>{p}</p>" for p in d) + "</div>" for d in divs)
    text = "\n\n".join(p for d in divs for p in d)
    assert main_text(page(marked, NAV + MENU, FOOT)) == text
    assert main_text(page(f"<div id=wrap>{marked}</div>", MENU, MENU + FOOT)) == text


def test_generated_articles():
    rng = random.Random(8)
    words = "alpha beta gamma & < > \" delta é 日本 epsilon".split()
    for _ in range(60):
        blocks = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 8, 60, 200]))) for _ in range(rng.randrange(1, 12))]
        marked = "".join(f"<p>{escape(b)}</p>\n" for b in blocks)
        before = rng.choice(["", NAV, MENU, "<div class='ad'>Buy now, buy here, buy this</div>"])
        assert main_text(page(f"<article>{marked}</article>", before, rng.choice(["", FOOT, COMMENTS]))) == "\n\n".join(blocks)
        if sum(map(len, blocks)) > 600:  # density alone: nothing names the article, nothing else is named at all
            plain = rng.choice(["", MENU, "<div>Buy now</div>"])
            assert main_text(page(f"<div>{marked}</div>", plain, MENU)) == "\n\n".join(blocks)


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + PROSE + "</div>" * 20_000
    assert main_text(deep) == PROSE
    assert len(main_text("<article>" + f"<p>{PROSE}</p>" * 5000 + "</article>")) == 5000 * (len(PROSE) + 2) - 2


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op9_html_text(spark, sf).collect()
    assert len(got) == len(raw)
    for r in got:
        inner = re.search("<article>(.*?)</article>", raw[r.page_id], re.S)[1]
        parts = (" ".join(unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "<p>a</p>", "old"), (1, "<p>a</p>", "old"), (None, None, "old")], "page_id long, html string, text string")
    assert sorted((r.text, r.n_chars) for r in extracted(df).collect()) == [("", 0), ("a", 1), ("a", 1)]
    assert extracted(df.limit(0)).collect() == []
