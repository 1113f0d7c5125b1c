from opinio.llm.url_filter import judge_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.net", "/x", "allow"), ("a.net", "/x", "block"), ("p.org", "", "block"), (None, "/", "block")]


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


URLS = [
    "http://example.net/en/1?x", "https://EXAMPLE.net/de/", "http://www.example.net/en", "http://net/", "http://net", "http://net?a=/b",
    "http://planet/x", "http://a.net/xyz", "ftp://b.a.net/x#f", "http://www.example.com/de/1", "http://example.com/den/", "http://q.org/fr/",
    "http://p.org", "http://p.org/fr/", "no scheme/net/", "", None, "http://", "http://ÄB.net/", "x\ny://n\net/a", "http://..net//", "a://b://c.net/",
]


def test_equals_the_plain_rules(spark):
    urls = URLS + ["http://" + "a." * 3000 + "net/" + "x/" * 5000, URLS[0]]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, "http://a.net/x")], "page_id long, url string")
    pages = pages.selectExpr("*", "1 as host", "2 as rule", "3 as row")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert got == {**{i: plain(u, RULES) for i, u in enumerate(urls)}, None: plain("http://a.net/x", RULES)}


def test_no_rules_no_pages_and_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "http://net/")] * 3, "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert [r.verdict for r in judge_urls(pages, rules).collect()] == ["block"] * 3
    assert {r.verdict for r in judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert judge_urls(pages.limit(0), rules).count() == 0
