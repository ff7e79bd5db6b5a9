import pytest

from sendgate.llm.url_filter import judge_urls

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.Example.com", "/en/", "allow"),
    ("example.com", "/en/a", "allow"),
    ("net", "/es/", "block"),
    ("net", "/es/", "allow"),
    ("org", "", "block"),
    (None, "/", "block"),
    ("x.org", None, "block"),
]
URLS = [
    None,
    "",
    "no scheme.com/en/",
    "http://",
    "http://com/",
    "http://example.com",
    "HTTP://EXAMPLE.COM/en/x",
    "http://Example.com/EN/x",
    "http://a.example.com/en/",
    "http://a.example.com/en/abc/../d",
    "http://a.example.com/en/é\U0010ffffz",
    "http://www.example.com/en/q?x=/en/",
    "http://b.www.example.com/en/a",
    "http://notexample.com/en/",
    "http://n.net/es/1",
    "http://n.net/es",
    "http://n.net#/es/",
    "http://n.org",
    "http://n.org?/",
    "http://u:p@n.org:80/",
    "http://org./",
    "a://b://c.com/",
    "http://.../x",
    "http://" + "a." * 300 + "com/" + "p" * 5000,
]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
        rest = rest[:cut]
        host, slash, tail = rest.partition("/")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = slash + tail
    fits = [
        (len(h) + len(p), len(h), h.lower() + p, v)
        for h, p, v in RULES
        if h is not None
        and p is not None
        and (host == h.lower() or host.endswith("." + h.lower()))
        and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("spread", [1, 7, None])
def test_against_brute_force(spark, spread):
    rows = [(i, url, "kept", i % 3) for i, url in enumerate(URLS + URLS[5:9])]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, _extra int")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = judge_urls(pages, rules, spread=spread)
    assert found.columns == ["page_id", "url", "_extra", "host", "path", "rule", "verdict"]
    got = {row.page_id: tuple(row)[3:] for row in found.collect()}
    assert got == {i: expected(url) for i, url, *_ in rows}


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert judge_urls(pages, rules).count() == 0
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/")], pages.schema)
    found = judge_urls(pages, rules.limit(0), default="block").collect()
    assert [tuple(row)[2:] for row in found] == [("a.com", "/", None, "block")] * 2


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    plan = judge_urls(pages, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
