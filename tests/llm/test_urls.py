import re

import pytest
from llm.odd import table

from carelake.llm import url_reputation as U
from carelake.llm.queries import URL_RULES


def parts(url):
    """Host and path from the words of the contract."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return host, rest[:cut]


def rule(host, path):
    best = None
    for verdict, text in URL_RULES:
        name, slash, start = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start) and (best is None or len(text) > len(best[1])):
            best = verdict, text
    return best


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.ORG/x", "http://a.org", "http://a.org?x=/y", "http://a.org#/z", "http://org/", "http://forg/", "http://example.org/en/1?x",
    "http://WWW.Example.ORG/en/12", "http://example.org/es/a", "http://example.org/es", "http://x.com/fr/1", "http://com/de/", "http://xcom/de/", "http://x.com/DE/",
    "http://u:p@x.com:80/de/1", "a://b://c/d", "http://a.org/\nx?y", "http://ÄB.org/ü#f", "http://x.net/a/b/c", "https://[::1]:80/de/",
]


def judged(spark, urls, outcomes=()):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return U.judge_urls(pages, spark.createDataFrame(list(outcomes), "host string, good int, bad int"), URL_RULES).orderBy("page_id").collect()


def test_hosts_paths_and_rules(spark):
    for url, row in zip(URLS, judged(spark, URLS), strict=True):
        assert (row.host, row.path) == parts(url)
        best = rule(row.host, row.path)
        assert row.rule == (best and best[1])
        assert row.verdict == (best[0] if best else "allow")  # nothing is known against any host


def test_reputation_shrinks(spark):
    outcomes = [("bad.site.net", 0, 1)] * 200 + [("good.site.net", 1, 0)] * 200 + [("once.other.net", 0, 1), ("fine.net", 40, 2), ("b.awful.net", 1, 60), ("c.awful.net", 0, 50)]
    names = ["bad.site.net", "good.site.net", "once.other.net", "new.site.net", "new.awful.net", "fine.net", "x.unseen"]
    rows = judged(spark, [f"http://{n}/" for n in names], outcomes)
    by = {r.host: r for r in rows}
    assert by["bad.site.net"].verdict == "block"
    assert all(by[n].verdict == "allow" for n in ("good.site.net", "once.other.net", "new.site.net", "fine.net", "x.unseen"))
    assert by["bad.site.net"].mean < by["new.site.net"].mean < by["good.site.net"].mean
    assert by["new.awful.net"].mean < by["new.site.net"].mean
    assert 0 < by["bad.site.net"].mean and by["good.site.net"].mean < 1  # never the raw rate
    assert by["once.other.net"].bound > 0.5 > by["bad.site.net"].bound  # one page says little


def test_domains(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "w.x.co.uk": ("x.co.uk", "co.uk"), "localhost": ("localhost", "localhost"),
             "1.2.3.4": ("1.2.3.4", "1.2.3.4"), "u@h.net:8080": ("h.net", "net"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = U.domain_and_suffix(df["host"])
    assert {r[0]: (r[1], r[2]) for r in df.select("host", domain, suffix).collect()} == hosts


def test_outcomes_come_from_labels(spark):
    docs = spark.createDataFrame([(1, "Some text\nof a page."), (2, "Other  text"), (3, None), (None, "Other text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 0), (1, 0, 0), (2, 1, 0), (9, 1, 0), (None, 0, 0), (2, None, 1)], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame(
        [(1, "http://A.net/x", "<article><h1>Some</h1><p>Some text<p>of a page.</article>"), (2, "http://b.net/", "<article>Other text</article>"),
         (3, "http://c.net/", "<article>unknown</article>"), (4, None, None), (5, None, "<article>Other text</article>")], "page_id long, url string, html string",
    )
    got = sorted(map(tuple, U.page_outcomes(pages, docs, labels).collect()))
    assert got == [("", 1, 0), ("a.net", 0, 1), ("b.net", 1, 0)]


def test_table_and_empty(spark):
    pages = table(spark, "pages")
    outcomes = U.page_outcomes(pages, table(spark, "documents"), table(spark, "labels"))
    assert outcomes.count() > 0
    rows = U.judge_urls(pages, outcomes, URL_RULES).collect()
    assert len(rows) == pages.count()
    none = U.judge_urls(pages.limit(0), outcomes.limit(0), URL_RULES)
    assert none.count() == 0
    assert re.sub(U.FOLDED, "", "a \t\xa0\u3000b") == "ab"
    assert rows[0].mean == pytest.approx(0.8, abs=0.2)
