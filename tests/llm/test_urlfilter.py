"""URL filters against every rule tried on every URL."""

import random
import re

import pytest

from tagloom.llm import urlfilter as uf

URLS = [
    None, "", "no scheme/fr/", "http://EXAMPLE.org", "http://Example.Org/es/1", "https://a.example.org/en/1?x=/es/", "http://org/",
    "http://notexample.org/es/", "http://example.org/es", "http://x.com/fr/", "http://x.com/FR/", "http://com/de/a#b", "http://x.com?/fr/",
    "http://x.com:80/fr/", "x://y/z://w.org/", "http://casino.net/", "http://the-casino-9.net/x", "http://casinos.net/", "http://a.net/casino",
    "http://x.com/a.org/", "http://b.net\n/c", "http://ads.example.org/es/x", "http://é.org/",
]


def by_hand(url, rules, words):
    _, found, rest = (url or "").partition("://")
    host = re.match(r"[^/?#]*", rest)[0].translate(str.maketrans(uf.UPPER, uf.LOWER)) if found else ""
    path = re.match(r"[^?#]*", re.sub(r"^[^/?#]*", "", rest))[0] if found else ""
    fit = [(h, p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        h, p, a = max(fit, key=lambda r: len(r[0] + r[1]))
        return host, path, h + p, a
    blocked = any(w in re.split("[^a-z0-9]", host) for w in words)
    return host, path, None, "block" if blocked else "allow"


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def test_every_rule_on_every_url(spark):
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    words = [r.name for r in uf.WORDS]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.judged(df).collect()}
    for i, u in enumerate(URLS):
        assert got[i] == by_hand(u, RULES, words), u


def test_many_rules(spark):
    rng = random.Random(3)
    rules = list({(f"{rng.choice('abc')}{rng.randrange(9)}.x{rng.randrange(40)}", f"/{rng.choice('pq')}/{rng.randrange(5)}", rng.choice(["allow", "block"])) for _ in range(300)})
    rules = list({r[:2]: r for r in rules}.values())
    urls = [f"http://{rng.choice(['', 'www.'])}{rng.choice('abc')}{rng.randrange(9)}.x{rng.randrange(40)}/{rng.choice('pq')}/{rng.randrange(50)}" for _ in range(800)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = uf.judged(df, tuple(uf.Rule.address(*r) for r in rules), ()).collect()
    assert len(got) == len(urls) and sum(r.rule is not None for r in got) > 20
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == by_hand(r.url, rules, [])


def test_rarest_token_and_limits(spark):
    df = spark.createDataFrame([("http://a.b/c/",)] * 3 + [("http://a.d/",)], "url string")
    rules = (uf.Rule.address("a.b", "/c/", "block"), uf.Rule.address("a.zzz", "/", "block"))
    assert uf.rarest_tokens(df, rules) == ["b", "zzz"]
    assert uf.judged(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        uf.Index((uf.Rule("none", "x", (), "block", 1),), [""])


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame([("http://a.b/c/",)], "url string")
    plan = uf.judged(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
