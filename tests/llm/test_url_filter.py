import pytest
from pyspark.sql import functions as F

from corpusmill.llm import queries, url_filter
from tests.compare import differences, duck

RULES = [
    ("net/", "block"), ("example.net/en/", "allow"), ("a.b.example.net/en/x", "block"), ("org", "block"),
    ("good.org", "allow"), ("both.com/", "allow"), ("both.com/", "block"), (None, "block"), ("x.y/", "other"),
]
URLS = [
    "http://Example.NET/en/1?x", "https://a.b.example.net/en/xy", "https://example.net", "http://example.net/",
    "ftp://notexample.net/en/", "http://org", "http://good.org/p#q", "http://verygood.org/", "http://both.com/a",
    "http://www.both.com?x", "x.y/", None, "", "no scheme", "http://", "a://b://net/", "HTTP://ORG/", "http://net/",
    "http://example.net/en/1?x", "http://" + "s." * 50 + "net/" + "p" * 5000, "http://ünï.net/\n/x", "http://.net/",
]


def by_hand(url, rules, default="allow"):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
        path = rest[n:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for rule, action in rules:
        if rule is None or action not in ("block", "allow"):
            continue
        own, slash, tail = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + tail):
            rank = (len(rule), own.count("."), action == "block")
            best = max(best or (rank, rule, action), (rank, rule, action))
    return host, path, best and best[1], best[2] if best else default


@pytest.mark.parametrize(("bits", "max_keys"), [(16, 1 << 22), (4, 4)])
def test_rules_by_hand(spark, monkeypatch, bits, max_keys):
    # Four bits a key make many false positives, so several levels are needed.
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", bits)
    urls = URLS + [f"http://h{i}.example.{t}/{l}/{i}" for i in range(60) for t in ("net", "org", "com") for l in ("en", "x")]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    judged = url_filter.filter_urls(pages, url_filter.rule_table(spark, RULES), max_keys=max_keys)
    assert judged.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    for row in judged.collect():
        assert (row.host, row.path, row.rule, row.verdict) == by_hand(row.url, RULES), row.url


def test_levels_are_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 4)
    universe = spark.range(3000).selectExpr("cast(id % 2000 as string) as __key")
    listed = spark.range(300).selectExpr("cast(id * 9 as string) as __key")
    cascade = url_filter.Cascade(universe, listed)
    assert len(cascade.levels) > 1
    answer = universe.distinct().select("__key", cascade.contains(universe["__key"]).alias("hit")).collect()
    assert all(row.hit == (int(row["__key"]) % 9 == 0) for row in answer)


def test_a_level_of_a_million_keys(spark):
    keys = spark.range(1_000_000).selectExpr("cast(id as string) as __key")
    level = url_filter.Level(keys, 1_000_000, 0)
    known = keys.filter("__key % 997 = 0")
    assert known.filter(level.holds(F.col("__key"))).count() == known.count()
    others = spark.range(2_000_000, 2_020_000).selectExpr("cast(id as string) as __key")
    assert others.filter(level.holds(F.col("__key"))).count() < 200


def test_clashing_columns(spark):
    pages = spark.createDataFrame([("http://a.net/", "k", "b", "H")], "url string, __key0 string, __Best string, HOST string")
    judged = url_filter.filter_urls(pages, url_filter.rule_table(spark, [("net/", "block")]))
    assert judged.columns == ["url", "__key0", "__Best", "host", "path", "rule", "verdict"]
    assert tuple(judged.first())[1:] == ("k", "b", "a.net", "/", "net/", "block")


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    none = url_filter.rule_table(spark, RULES).limit(0)
    assert url_filter.filter_urls(pages, none, default="block").collect()[0].verdict == "block"
    assert url_filter.filter_urls(pages.limit(0), url_filter.rule_table(spark, RULES)).collect() == []


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.queries()["op2_url_filter"](spark, folder)
    assert differences(found, duck(folder), queries.oracle_sql()["op2_url_filter"]) is None


def test_native(spark):
    judged = queries.queries()["op2_url_filter"](spark, "/root/testdata/sf0.001")
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
