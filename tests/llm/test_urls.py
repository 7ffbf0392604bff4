import pytest
from roadflow.llm import url_filter

URLS = {
    "https://shop.example.com/en/a?x#y": ("shop.example.com", "/en/a", "example.com/en/", "block"),
    "https://WWW.Example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://a.www.example.com/en/porn": ("a.www.example.com", "/en/porn", "www.example.com/en/", "allow"),
    "http://example.com/de/": ("example.com", "/de/", "com/", "allow"),
    "http://notexample.com": ("notexample.com", "", None, "allow"),
    "http://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
    "http://x.net/es": ("x.net", "/es", None, "allow"),
    "http://best-casino.org/": ("best-casino.org", "/", None, "block"),
    "http://casinos.org/": ("casinos.org", "/", None, "allow"),
    "http://free.org/free": ("free.org", "/free", None, "allow"),
    "http://free.org/cheap": ("free.org", "/cheap", None, "block"),
    "http://ads2.org/track_win": ("ads2.org", "/track_win", None, "block"),
    "no scheme casino": ("", "", None, "block"),
    "a://b://c.com/d": ("b:", "//c.com/d", None, "allow"),
    "http://": ("", "", None, "allow"),
    "http://éads.org/é-bet": ("éads.org", "/é-bet", None, "block"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, u, "<p>", "host", "path") for k, u in enumerate(URLS)] + [(0, next(iter(URLS)), None, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string")


def test_verdicts(pages):
    got = url_filter.judged(pages).collect()
    assert len(got) == len(URLS) + 1
    urls = list(URLS)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == URLS[urls[r.page_id]], urls[r.page_id]


def test_very_long_and_empty(spark, pages):
    long = spark.createDataFrame([(None, "http://a.org/" + "casino" * 20_000)], "page_id long, url string")
    assert url_filter.judged(long).first().verdict == "allow"
    assert url_filter.judged(pages.limit(0)).count() == 0
