import random

from stpanel.llm import urls
from stpanel.llm.queries import URL_RULES


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h) + len(p), h + p, v) for h, p, v in rules if f".{host}".endswith(f".{h}") and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "block" if host == "" else default


ODD = [
    None, "", "no scheme", "://", "http://", "http://COM", "http://com/", "https://Example.COM/en/x?y#z", "http://a.b.example.com/en/",
    "http://notexample.com/en/", "http://www.example.com/en/1", "http://www.example.com/en", "http://x.net/es/..", "http://net/fr/",
    "http://example.com?x=/en/", "http://example.com#/en/", "http://a://b.com/", "http://a\0com/", "http://.com/", "http://com./",
    "http://\u00e9.net/es/\u4f60", "http://x.netx/es/", "http://" + "a." * 3000 + "net/fr/" + "p" * 5000,
]


def check(spark, texts, rules):
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(texts)], "page_id long, url string, host string, key string")
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judge(pages, urls.rule_table(spark, rules)).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(texts)}


def test_odd_urls(spark):
    check(spark, ODD, URL_RULES)


def test_nested_rules(spark):
    r = random.Random(1)
    labels = ["com", "net", "a", "b", "www"]
    paths = ["/", "/en/", "/en/x", "/es/", ""]
    host = lambda: ".".join(r.choice(labels) for _ in range(r.randint(1, 4)))
    rules = list({(host(), r.choice(paths)): None for _ in range(40)})
    rules = [(h, p, r.choice(["allow", "block"])) for h, p in rules]
    texts = [f"http://{host()}{r.choice([*paths, '/en/x/y', '/z'])}{r.choice(['', '?q', '#f'])}" for _ in range(800)]
    check(spark, texts + ["http://a.com/en/"] * 300, rules)


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none, urls.rule_table(spark, URL_RULES)).count() == 0
    twice = spark.createDataFrame([(None, "http://x.com/")] * 2, "page_id long, url string")
    assert [r["rule"] for r in urls.judge(twice, urls.rule_table(spark, URL_RULES)).collect()] == ["com/"] * 2
