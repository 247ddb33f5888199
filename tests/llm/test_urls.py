import re
from collections import Counter

import pytest

from tickframe.llm import urlfilter
from tickframe.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"


def judge(url, rules, default="allow"):
    head, mark, rest = (url or "").partition("://")
    host, path = "", ""
    if mark:
        cut = re.match(r"([^/?#]*)([^?#]*)", rest)
        host, path = re.sub("[A-Z]", lambda m: m.group().lower(), cut[1]), cut[2]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


URLS = [
    None, "", "no scheme", "http://", "HTTP://ORG", "http://ORG/", "http://example.org/es/", "http://a.example.org/es", "http://example.org/en/1", "http://x.example.org/en/123?y", "http://notexample.org/es/", "http://org./x",
    "https://.org/", "ftp://user@shop.com/fr/x", "http://shop.com:80/de/", "x://shop.com/de/?a", "http://com/de/x#y", "http://a.b.c.d.e.f.org/en/1", "http://É.com/fr/", "a://b://c.org/", "http://shop.com/de/" + "x" * 5000, "http://line\nbreak.org/\n", "http://shop.com/fr/",
]


@pytest.mark.parametrize("most", [100_000, 0])
def test_url_rules(spark, most):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (0, None), (None, "http://x.org/")]
    rules = [*URL_RULES, ("", "/", "block"), ("com", "/de/", "allow"), ("shop.com", None, "allow"), ("É.com", "/fr/", "block")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'clash' AS host", "'clash' AS rule", "'clash' AS prefix")
    found = urlfilter.apply_rules(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), broadcast_rules=most)
    wanted = [(h, p or "", v) for h, p, v in rules if (h, p, v) != ("com", "/de/", "allow")]
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "url"]
    assert Counter(map(tuple, found.collect())) == Counter((i, *judge(u, wanted), u) for i, u in rows)


def test_url_empty(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert urlfilter.apply_rules(pages, none).collect()[0]["verdict"] == "allow"
    assert urlfilter.apply_rules(pages.where("false"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string")).count() == 0


def test_queries_are_registered():
    assert {re.match(r"op(\d+)_", q)[1] for q in QUERIES} == {str(n) for n in range(1, 14)}
