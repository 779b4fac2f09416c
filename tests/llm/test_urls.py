"""URL filters against a plain loop over rules and listed URLs."""

import random

import pytest

from corpusq.llm import url_filter
from corpusq.llm.queries import LISTED_SITES, QUERIES, URL_RULES
from corpusq.llm.texts import read_table
from corpusq.llm.url_filter import canonical, judge_urls

SF = "/root/testdata/sf0.001"
RULES = "host string, path string, verdict string"


def split(url):
    rest = (url or "").partition("://")[2]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return host, rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]


def brute(urls, rules, blocked):
    """(host, path, rule, verdict) of each; ``blocked`` holds canonical URLs, given as a function's results."""
    out = []
    for url, whole in urls:
        host, path = split(url)
        fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if host and f".{host}".endswith(f".{h}") and path.startswith(p)]
        best = max(fits) if fits else None
        verdict = best[2] if best else "block" if whole is not None and whole in blocked else "allow"
        out.append((url, host, path, best and best[3], verdict))
    return sorted(out, key=str)


def wholes(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    return [tuple(r) for r in df.select("url", canonical(df.url)).collect()]


def test_canonical(spark):
    same = [
        ["https://Example.ORG/a/b/", "http://www.example.org/a/b#x", "http://example.org:80/a/b?utm_source=q&ref=x", "x://example.org/a/b/index.html"],
        ["http://example.org/a?b=2&a=1", "http://example.org/a/?a=1&&b=2&fbclid=9"],
        ["http://example.org", "http://example.org/", "http://example.org/?#"],
    ]
    forms = [{w for _, w in wholes(spark, urls)} for urls in same]
    assert forms == [{"example.org/a/b"}, {"example.org/a?a=1&b=2"}, {"example.org"}]
    assert {w for _, w in wholes(spark, [None, "", "no host", "http:///x", "http://?q"])} == {None}


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("blocks", [2**20, 1])
def test_verdicts(spark, monkeypatch, fits, blocks):
    """A filter of one block lets nearly everything through, and the join by a shuffle removes it again."""
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", blocks)
    if not fits:
        monkeypatch.setattr(url_filter, "fits_broadcast", lambda df: False)
    rng = random.Random(3)
    hosts = ["example.org", "a.Example.org", "xexample.org", "org", "b.a.example.org", "c.com", "example.com.", ".com", "d.net:80"]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12/x", "/fr/", "/de/é", "//", "/es/\n2"]
    tails = ["", "?q=://example.org/es/", "#top", "?utm_source=f", "?", "?page=2&ref=x"]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}" for _ in range(400)]
    urls += ["http://hot.net/x"] * 300 + [None, "", "example.org/es/", "://", "mailto:x", "a://b://example.org/es/"]
    listed = ["http://hot.net/x/", "https://www.d.net:80/es/1?ref=y", "http://c.com/", None, "nothing", "http://c.com"] + urls[:60]
    rules = [*URL_RULES, ("com", "/de/", "allow"), ("a.example.org", "/", "allow"), ("b.a.example.org", "", "block"), ("org", "/en/1", "allow"), ("", "/", "block"), (None, None, "block")]
    known = wholes(spark, urls)
    blocked = {w for _, w in wholes(spark, listed)} - {None}
    want = brute(known, [(h, p, v) for h, p, v in rules if h], blocked)
    pages = spark.createDataFrame([(u, "clash", "clash", "clash") for u in urls], "url string, host string, rule string, key string").repartition(4)
    got = judge_urls(pages, spark.createDataFrame(rules, RULES), spark.createDataFrame([(u,) for u in listed], "url string"), ["url", "host", "rule", "key"])
    assert got.columns == ["url", "key", "host", "path", "rule", "verdict"]
    assert sorted(((r.url, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=str) == want
    assert {r.verdict for r in got.collect()} == {"allow", "block"}


def test_empty_tables(spark):
    pages = spark.createDataFrame([("http://a.org/x",), (None,)], "url string")
    rules, listed = spark.createDataFrame([("org", "/", "block")], RULES), spark.createDataFrame([("http://a.org/x",)], "url string")
    assert judge_urls(pages.limit(0), rules, listed, ["url"]).count() == 0
    verdicts = lambda r, u: [x.verdict for x in judge_urls(pages, r, u, ["url"]).orderBy("url").collect()]
    assert verdicts(rules.limit(0), listed.limit(0)) == ["allow", "allow"]
    assert verdicts(rules.limit(0), listed) == ["allow", "block"]
    assert verdicts(rules, listed.limit(0)) == ["allow", "block"]


def test_registered_query(spark):
    pages = read_table(spark, SF, "pages").select("page_id", "url").collect()
    known = wholes(spark, [p.url for p in pages])
    sites = {w for u, w in known if len(split(u)[0].split(".")) >= 3 and split(u)[0].split(".")[-3] in LISTED_SITES}
    got = sorted(((r.host, r.path, r.rule, r.verdict) for r in QUERIES["op12_blocked_bloom"](spark, SF).collect()), key=str)
    assert got == sorted((r[1:] for r in brute(known, URL_RULES, sites)), key=str)
