import random

from ledgerloom.llm import url_filter
from ledgerloom.llm.queries import URL_RULES


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, 1, "x") for i, u in enumerate(urls)], "page_id long, url string, key int, host string")
    rows = url_filter.apply_rules(pages, rules).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], rules), urls[r.page_id]


def test_edges(spark):
    urls = [None, "", "no scheme", "http://", "http://COM", "http://com/", "https://Example.com/en/1?x=/en/", "http://www.example.com/en/#a", "http://a.www.example.com/en/",
            "http://notexample.com/en/", "ftp://x.net/fr/", "http://net/es/", "http://net/es", "http://x.net?/es/", "http://..com/", "http://com./", "http://éx.com/ñ/", "a://b://c.com/", "http://com/"]
    check(spark, urls, URL_RULES)


def test_random_nested_rules_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "ROWS_PER_RANGE", 20)
    dice = random.Random(0)
    host = lambda: ".".join(dice.choice(["a", "b", "c", "x-1"]) for _ in range(dice.randint(1, 4)))
    path = lambda: "/" + "".join(dice.choice("pq/") for _ in range(dice.randint(0, 4)))
    rules = {(h, p): (dice.choice(["allow", "block"]), h, p) for h, p in ((host(), path()) for _ in range(60))}
    urls = [f"http://{host()}{path()}" for _ in range(400)] + ["http://a.b/p"] * 300  # a hot host
    check(spark, urls, list(rules.values()))


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_filter.apply_rules(pages.limit(0), URL_RULES).collect() == []
    (r,) = url_filter.apply_rules(pages, []).collect()
    assert r.rule is None and r.verdict == "allow"
    (r,) = url_filter.apply_rules(pages, [("allow", "com", "/"), ("block", "com", "/")]).collect()
    assert r.verdict == "block"
