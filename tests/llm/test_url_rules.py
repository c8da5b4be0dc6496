import random

from footfall.llm import url_rules
from footfall.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    end = min((path.find(c) for c in "?#" if c in path), default=len(path))
    from tests.llm.helpers import ASCII_LOWER
    return rest[:cut].translate(ASCII_LOWER), path[:end]


def plain(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def check(spark, urls, rules, ranges=None):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], PAGES)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in url_rules.judge(pages, table, ranges=ranges).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


ODD = [None, "", "no scheme", "http://", "http:///de/", "HTTP://WWW.Example.ORG/es/1?x#y", "x://com", "x://com/fr/",
       "x://com?/fr/", "x://a.com#/de/", "x://.com/de/", "x://com./de/", "x://example.com:80/de/", "x://a..com/de/1",
       "x://\u00c9.org/", "x://notexample.org/es/", "x://y://org/", "x://org\n/a\nb", "x://b.example.org/en/1" * 2]


def test_stated_rules(spark):
    check(spark, ODD + ODD, URL_RULES)


def test_random_nested_rules_in_many_ranges(spark):
    rnd = random.Random(5)
    labels, segments = ["a", "b", "com", "org"], ["/", "/x", "/x/", "/x/y", "/z", "", "/xa"]
    hosts = [".".join(rnd.choices(labels, k=rnd.randrange(1, 5))) for _ in range(60)]
    rules = {(rnd.choice(hosts), rnd.choice(segments)): rnd.choice(["allow", "block"]) for _ in range(80)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"http://{rnd.choice(hosts)}{''.join(rnd.choices(segments, k=2))}" for _ in range(1500)]
    check(spark, urls + ["http://com/x"] * 700, rules, ranges=13)


def test_empty_tables(spark):
    check(spark, [], URL_RULES)
    check(spark, ODD, [("com", "/never", "block")])
    pages = spark.createDataFrame([(1, "x://com/a")], "page_id long, url string").selectExpr("*", "1 as host", "2 as part")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in url_rules.judge(pages, none).collect()] == [(1, "com", "/a", None, "allow")]
