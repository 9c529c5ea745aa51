import re

import pytest

from tabreg.llm import queries, url_filter


def brute(url, rules, default="allow"):
    m = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = m.group(1).translate(str.maketrans(url_filter.UPPER, url_filter.LOWER)) if m else ""
    path = m.group(2) if m else ""
    fit = [(len(h), len(p), v == "block", h + p, v) for h, p, v in rules
           if ("." + host).endswith("." + h) and path.startswith(p)]
    best = max(fit) if fit else None
    return host, path, best and best[3], best[4] if best else default


URLS = [None, "", "no scheme", "http://", "://x.net/", "http://net/", "https://NET", "http://a.b.Example.NET/en/1?x=/fr/", "http://example.net/en",
        "http://myexample.net/en/1", "http://example-x.net/q", "http://x.example.com/de/#a", "http://example.com.de/de/", "http://x.org/fr/a",
        "http://x.org/en/", "http://x.net./", "http://user@x.net:80/", "http://..net/a", "a://b://c.net/d", "http://é.net/en/", "http://org?/fr/",
        "http://x.example.net/en/" + "y" * 100000, "http://exAMPLE.net/en/\nz"]
MORE = queries.URL_RULES + [("a.b.example.net", "/", "block"), ("b.example.net", "/en/", "allow"), ("example.net", "/en/1", "block"),
                            ("example.net", "/", "allow"), ("x.org", "/fr", "block"), ("é.net", "/en/", "allow"), ("org", "/fr/", "block")]


@pytest.mark.parametrize("rules", [queries.URL_RULES, MORE, []])
@pytest.mark.parametrize("block", [200_000, 2])
def test_against_brute_force(spark, rules, block):
    rows = [(i, u, "<p>", "h") for i, u in enumerate(URLS)] + [(None, "http://a.net/", None, None), (3, "http://a.net/", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    got = sorted(str(tuple(r)) for r in url_filter.judge(pages, rules, block=block).collect())
    assert got == sorted(str((i, *brute(u, rules))) for i, u, _, _ in rows)


def test_empty_table(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), MORE).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op7_url_filter"](spark, sf).collect()}
    assert got == {p["page_id"]: brute(p["url"], queries.URL_RULES) for p in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len({v[2] for v in got.values()}) > 2
