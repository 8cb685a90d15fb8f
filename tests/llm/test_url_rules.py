import random

from helpers import with_clashes

from quayside.llm import url_rules as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def brute(url, rules):
    host, path = parts(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[2], best[3]) if best else (host, path, None, None)


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
         ("block", "a.example.org", "/en/1/2"), ("allow", "a.example.org", ""), ("block", "x", "/"), ("allow", "x", "/"), ("block", "example.org", "/en/1/2/3")]


def urls():
    rng = random.Random(6)
    hosts = ["example.org", "A.Example.ORG", "b.a.example.org", "notexample.org", "x", "y.x", ".x", "fr.com", "com", "org", "ünï.org", "", "a..example.org"]
    paths = ["", "/", "/en/1", "/en/1/2", "/en/1/2/3/4", "/en/2", "/es/", "/ES/", "/fr/", "/de/x", "/é/"]
    out = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/es/', '#f', '?a#b'])}" for _ in range(400)]
    return out + [None, "", "no scheme/x", "://", "https://example.org/es/ " + "x" * 50_000, "a://b://example.org/es/", "http:///es/"] + ["https://example.org/es/hot"] * 200


def test_matches_brute_force(spark):
    data = list(enumerate(urls())) + [(None, "http://x/")]
    pages = with_clashes(spark.createDataFrame(data, "page_id long, url string")).repartition(3)
    got = U.judge_urls(pages, U.rules_table(spark, RULES)).collect()
    assert len(got) == len(data)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], RULES), r["url"]
    assert next(r for r in got if r["url"] == "http://x/")["verdict"] == "block"


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, None)], "page_id long, url string")
    assert [r["rule"] for r in U.judge_urls(pages, U.rules_table(spark, [])).collect()] == [None, None]
    assert U.judge_urls(pages.limit(0), U.rules_table(spark, RULES)).collect() == []


def test_a_third_of_all_rows_on_one_key_or_pair(spark):
    home = [f"http://h{i}.example.org/" for i in range(300)]      # their keys for org and example.org are equal
    data = list(enumerate(home + ["http://one.com/fr/x"] * 300 + [None] * 300 + urls()))
    pages = spark.createDataFrame(data, "page_id long, url string").repartition(4)
    rules = RULES + [("block", "example.org", "/"), ("block", "h7.example.org", "/")]
    got = U.judge_urls(pages, U.rules_table(spark, rules), partitions=3).collect()
    assert len(got) == len(data)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], rules), r["url"]


def test_hot_groups_are_few(spark):
    rows = spark.createDataFrame([("a",)] * 50 + [(f"k{i}",) for i in range(100)], "key string")
    counted, n = U._counted(rows, ["key"], 8, "test-keys")
    assert n == 101 and [r["key"] for r in counted.filter("hot").collect()] == ["a"]
