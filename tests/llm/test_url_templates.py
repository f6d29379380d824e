"""Host, path and rule against plain Python; templates and purity on planted trees."""

import re

import pytest

from corvane.llm.queries import URL_RULES
from corvane.llm.url_templates import judge_urls, path_templates


def plain(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    best = None
    for rule, verdict in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return host, path, *(best or (None, None))


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.ORG", "x://example.org/en/12?a#b", "x://example.org/es/", "x://notexample.org/es/", "x://org/a",
    "http://b.com/de/1", "http://b.com/fr/1", "http://com/de/", "http://é.Com/fr/?", "a://b://c/d", "http://h\n.com/x\ny", "x://h/a//b/", "x://h?x/y", "x://h#://z",
    "x://example.org/en/2", "x://sub.example.org/en/1", "x://user@h.com:80/de/7",
]


def test_rules(spark):
    rows = [(i, u, "h", 1) for i, u in enumerate(URLS)] + [(3, "x://example.org/en/12", "h", 1), (None, None, "h", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, bad int")
    labels = spark.createDataFrame([], "page_id bigint, bad int")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, labels, URL_RULES).collect()), key=str)
    want = sorted(((i, *plain(u)[:3], plain(u)[3] or "allow") for i, u, _, _ in rows), key=str)
    assert got == want
    assert judge_urls(pages.limit(0), labels, URL_RULES).count() == 0


@pytest.fixture(scope="module")
def tree(spark):
    rows, bad = [], []
    for i in range(400):
        rows.append((len(rows), f"http://big.net/{('en', 'fr', 'de')[i % 3]}/{i * 7919}.html"))
        bad.append(i % 20 == 0)
        rows.append((len(rows), f"http://big.net/tag/buy{i}"))
        bad.append(i % 10 != 0)
    rows.append((len(rows), "http://small.net/only/page"))
    bad.append(False)
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(b)) for i, b in enumerate(bad) if i % 2 or i % 3 == 0], "page_id bigint, bad int")
    return pages, labels


def test_templates(tree):
    templates = {r.key: r.template for r in path_templates(*tree, "page_id", "url").collect()}
    assert set(templates.values()) == {"/{*}/{#}.html", "/tag/buy{#}", "/only/page"}


def test_purity(tree):
    rows = judge_urls(*tree).collect()
    assert len(rows) == tree[0].count()
    assert {(r.template, r.verdict) for r in rows} == {("/{*}/{#}.html", "allow"), ("/tag/buy{#}", "block"), ("/only/page", "allow")}


def test_small_share_and_deep_paths(spark):
    """A directory keeps its template at any share of its node, and paths differ at any depth."""
    deep = "/".join(f"s{i}" for i in range(8))
    urls = [(f"http://dirs.net/d{i % 60}/{i * 7919}.html", i % 60 == 7) for i in range(1200)]
    urls += [(f"http://deep.net/{deep}/{('good', 'bad')[i % 2]}/{i * 7919}", bool(i % 2)) for i in range(60)]
    stretch = "/".join(["t"] * 300)
    urls += [(f"http://long.net/{stretch}/{('good', 'bad')[i % 2]}/{stretch}", bool(i % 2)) for i in range(60)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(b)) for i, (_, b) in enumerate(urls)], "page_id bigint, bad int")
    got = {(r.host, r.template, r.verdict) for r in judge_urls(pages, labels).collect()}
    assert got == {
        ("dirs.net", "/{*}/{#}.html", "allow"), ("dirs.net", "/d7/{#}.html", "block"),
        ("deep.net", f"/{deep}/good/{{#}}", "allow"), ("deep.net", f"/{deep}/bad/{{#}}", "block"),
        ("long.net", f"/{stretch}/good/{stretch}", "allow"), ("long.net", f"/{stretch}/bad/{stretch}", "block"),
    }
