import random

from mentionkit.llm import url_filters as u


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/x", "http://a.example.NET/en/x?y", "http://a.example.net/de/", "http://example.com/de/1",
    "http://notexample.com/de/", "http://x.org/fr/", "http://org/fr/a#b", "http://É.org/fr/", "a://b://c/d", "http://u@example.net:80/en/", "http://a..net/", "//x.net/",
    "http://x.net?/q", "http://x.net#/f", "x\ny://a.net/\nb", "http://" + "a." * 3000 + "net/" + "p/" * 3000, "http://example.net/en", "http://.net/",
]


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, x, "h") for i, x in enumerate(urls)], "page_id long, url string, host string")
    got = u.judge(pages, u.rules_frame(spark, rules)).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == [plain(x, rules) for x in urls]


def test_contract_rules(spark):
    check(spark, URLS, u.RULES)


def test_many_rules_against_plain_version(spark):
    random.seed(4)
    label = lambda: random.choice(["a", "b", "c", "example", "net"])
    hosts = [".".join(label() for _ in range(random.randrange(1, 4))) for _ in range(60)]
    rules = [(random.choice(["allow", "block"]), random.choice(hosts), random.choice(["", "/", "/en", "/en/", "/en/a"])) for _ in range(40)]
    rules = list({(h, p): (a, h, p) for a, h, p in rules}.values())
    urls = [f"http://{label()}.{random.choice(hosts)}{random.choice(['', '/', '/en', '/en/a/b', '/e', '?x'])}" for _ in range(400)]
    check(spark, urls + urls[:50], rules)


def test_block_wins_a_tie(spark):
    check(spark, ["http://a/x"], [("allow", "a", "/"), ("block", "a", "/")])


def test_no_rules_and_no_pages(spark):
    check(spark, URLS, [])
    pages = spark.createDataFrame([], "page_id long, url string")
    assert u.judge(pages, u.rules_frame(spark)).count() == 0


def test_repeated_pages_stay(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")] * 3 + [(None, None)], "page_id long, url string")
    assert u.judge(pages, u.rules_frame(spark)).count() == 4


def test_a_colliding_short_hash_is_no_hit(spark, monkeypatch):
    monkeypatch.setattr(u, "PREFIX_HEX", 0)  # all short hashes agree
    check(spark, URLS[:12], u.RULES)
