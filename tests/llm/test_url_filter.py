"""Operator 7 against brute force, and its cascade against plain membership."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sparkmine.llm import url_filter
from sparkmine.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme/en/", "://", "http://", "http://net", "http://net/", "HTTP://A.Example.NET/en/x?y", "x://example.net/en",
    "http://example.net/en/", "http://example.net/EN/1", "http://b.example.com/de/1#f", "http://example.com.evil/de/",
    "http://org/fr/", "http://a.org?/fr/", "http://org/fr", "http://notorg/fr/", "http://x.fakenet/", "http://net./",
    "http://é.example.net/en/ü", "a://b://example.net/en/", "http://u@example.net:80/en/", "http://.net/x", "http://example.net//en/",
    "http://example.net\n/en/", "http://" + "a." * 3000 + "net/" + "p/" * 3000,
]


def brute(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [
        r for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.key), r.host.count(".")), default=None)
    return host, path, best.key if best else None, best.verdict if best else default


def found(spark, urls, rules):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    frame = frame.withColumns({c: F.lit("x") for c in ("key", "rule", "host", "path", "verdict", "slot")})
    result = url_filter.judge(frame, rules)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in result.collect()}


def test_given_rules(spark):
    urls = URLS + URLS
    assert found(spark, urls, URL_RULES) == {i: brute(u, URL_RULES) for i, u in enumerate(urls)}


@pytest.mark.parametrize("most", [url_filter.MAX_KEYS, 50])
def test_many_rules(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MAX_KEYS", most)  # above it, rules are joined
    rng = random.Random(4)
    name = lambda: rng.choice("abcdefgh") + rng.choice("xyz")
    rules = {}
    for _ in range(200):
        rule = url_filter.Rule(rng.choice(["allow", "block"]), ".".join(name() for _ in range(rng.randrange(1, 4))), f"/{name()}/" * rng.randrange(3))
        rules.setdefault(rule.key, rule)
    urls = [f"http://{'.'.join(name() for _ in range(rng.randrange(1, 5)))}" + f"/{name()}" * rng.randrange(4) + rng.choice(["", "/"]) for _ in range(2000)]
    rules = list(rules.values())
    assert found(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    assert found(spark, URLS[:8], []) == {i: brute(u, []) for i, u in enumerate(URLS[:8])}
    assert found(spark, [], URL_RULES) == {}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("key"), "id").alias("key"))
    listed = [f"key{i}" for i in range(0, 20_000, 37)] + ["elsewhere"]
    made = url_filter.cascade(universe, listed)
    assert len(made.levels) > 1
    got = universe.filter(made.lists(F.col("key"))).collect()
    assert {r.key for r in got} == set(listed) - {"elsewhere"}


def test_rules_that_disagree(spark):
    rules = [url_filter.Rule("allow", "a", "/"), url_filter.Rule("block", "a", "/")]
    with pytest.raises(ValueError):
        found(spark, [], rules)
