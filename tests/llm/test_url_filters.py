import random
import re

from tessera.llm.url_filters import RULES, op5, url_filter

KIND = "page_id long, url string, html string, host string, key string, range int, rule int"


def pages(spark, urls, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], u, "h", "x", "k", 1, 2) for i, u in enumerate(urls)], KIND).repartition(3)


def brute(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0]), len(r[1]), r[2] == "block"), default=None)
    return (host, path, best and best[0] + best[1], best[2] if best else default)


def test_against_brute_force(spark):
    r = random.Random(2)
    labels = ["net", "example", "org", "com", "a", "www", "Exa", "", "é", "-"]
    rules = sorted({(".".join(r.choices(labels, k=r.randrange(1, 4))), r.choice(["", "/", "/a", "/a/b/", "/en/"]), r.choice(["allow", "block"])) for _ in range(40)})
    urls = [r.choice(["http://", "https://", "x", "HTTP://", "a://b://"]) + ".".join(r.choices(labels, k=r.randrange(1, 5))) + r.choice(["", "/", "/a", "/a/b/c", "/en/", "?q=/a", "#x", "/a?b#c", "/é\n"]) for _ in range(600)]
    urls += [None, "", "://", "no scheme", "http://net/"] + ["http://www.example.net/en/1"] * 300
    given = spark.createDataFrame(rules, "host string, path string, action string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filter(pages(spark, urls), given).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in op5(spark, pages(spark, urls)).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_defined_cases(spark):
    none = spark.createDataFrame([], "host string, path string, action string")
    twice = spark.createDataFrame([("net", "/", "block"), ("net", "/", "allow"), ("net", "/", "block"), (None, None, "block")], "host string, path string, action string")
    assert url_filter(pages(spark, []), twice).count() == 0
    assert [r.verdict for r in url_filter(pages(spark, ["http://net/", None], [None, None]), none, "block").collect()] == ["block"] * 2
    assert sorted((r.rule, r.verdict) for r in url_filter(pages(spark, ["http://a.net/x"] * 2, [4, 4]), twice).collect()) == [("net/", "block")] * 2
    long = "http://" + "a." * 5000 + "net/" + "x" * 50_000
    assert [r.rule for r in url_filter(pages(spark, [long]), twice).collect()] == ["net/"]


def test_very_long_urls(make, spark):
    """A path and a host of a million characters."""
    long = "a" * 1_000_000
    urls = [f"http://x.example.net/en/{long}", f"http://{long}.net/{long}?{long}", f"http://{'a.' * 100_000}org/fr/", long]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = {r.page_id: r for r in op5(spark, pages).collect()}
    assert [(rows[i].rule, rows[i].verdict) for i in range(4)] == [("example.net/en/", "allow"), ("net/", "block"), ("org/fr/", "allow"), (None, "allow")]
    assert rows[1].path == "/" + long and rows[3].host == ""
