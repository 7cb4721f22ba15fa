import random

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import url_filter as U
from shelfcast.llm.queries import RULES


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.key), default=None)
    return host, path, best.key if best else None, best.verdict if best else default


URLS = [
    None, "", "no scheme", "http://", "http:///x", "http://NET/", "http://net", "http://a.net?x", "https://a.Example.NET/en/x?y#z", "http://example.net/en",
    "http://xexample.com/de/1", "http://example.com/de/", "ftp://w.org/fr/://q", "http://org/fr/", "http://net./en/", "http://.net/", "http://a b.net/\n/x",
    "http://example.com/de/", "x://example.net/en/#/de/", "http://ünet.net/é/", "http://" + "a." * 400 + "net/" + "p/" * 3000,
]


def judged(spark, urls, rules, **kw):
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule int")
    return [tuple(r) for r in U.judge(df, rules, **kw).orderBy("page_id").select("host", "path", "rule", "verdict").collect()]


def test_awkward_urls(spark):
    assert judged(spark, URLS, RULES) == [plain(u, RULES) for u in URLS]


def test_pages_equal_brute_force(spark, tables):
    urls = [r["url"] for r in spark.read.parquet(f"{tables}/pages.parquet").orderBy("page_id").collect()]
    assert judged(spark, urls, RULES) == [plain(u, RULES) for u in urls]


def test_cascade_is_exact_over_several_levels(spark):
    rng = random.Random(0)
    rules = [U.Rule(rng.choice(["allow", "block"]), f"h{i}.com", rng.choice(["/", "/a/", "/ab/c"])) for i in rng.sample(range(3000), 150)]
    urls = [f"http://{rng.choice(['', 'w.'])}h{rng.randrange(3000)}.com{rng.choice(['/', '/a/', '/ab/c', '/ab/cd', ''])}x" for _ in range(4000)]
    assert judged(spark, urls, rules, min_bits=8) == [plain(u, rules) for u in urls]
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.filter("xxhash64(key) % 10 = 0")
    cascade = U.build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    wrong = universe.join(listed.withColumn("in", F.lit(True)), "key", "left").filter(cascade.contains(F.col("key")) != F.coalesce("in", F.lit(False)))
    assert wrong.count() == 0


def test_no_rules_and_no_rows(spark):
    assert judged(spark, URLS[:3], [])[0] == ("", "", None, "allow")
    assert judged(spark, [], RULES) == []
    assert judged(spark, ["http://a.net/"], RULES, default="block") == [("a.net", "/", "net/", "block")]


def test_too_long_a_list_is_refused(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_BITS", 100)
    with pytest.raises(ValueError):
        judged(spark, URLS, [U.Rule("block", f"h{i}.com", "/") for i in range(200)])


def test_no_python_in_the_plan(spark, tables):
    df = U.judge(spark.read.parquet(f"{tables}/pages.parquet"), RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
