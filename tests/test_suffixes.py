"""Public suffixes against a plain reading of the rules."""

import random

import pytest

from lakemill.functions.suffixes import COMMON_RULES, SuffixRules
from lakemill.functions.urls import with_url


def plain(host, rules):
    """Labels of the public suffix of a host."""
    labels = host.split(".")
    best, excepted = 1, None
    for rule in rules:
        want = rule.lstrip("!").split(".")
        tail = labels[-len(want) :]
        if len(tail) == len(want) and all(w in ("*", x) for w, x in zip(want, tail)):
            if rule.startswith("!"):
                excepted = len(want) - 1
            best = max(best, len(want))
    return best if excepted is None else excepted


def parts(spark, hosts, rules):
    df = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "i int, u string")
    rows = with_url(df, "u", rules=rules).select("i", "url_features.suffix", "url_features.registered_domain", "url_features.subdomain", "url_features.num_subdomains").orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def want(host, rules):
    labels, k = host.split("."), plain(host, rules)
    if len(labels) < 2:
        return None, host, None, 0
    n = len(labels)
    return ".".join(labels[max(n - k, 0) :]), ".".join(labels[max(n - k - 1, 0) :]), ".".join(labels[: n - k - 1]) or None if n > k + 1 else None, max(n - k - 1, 0)


def test_common_rules(spark):
    hosts = ["example.co.uk", "a.b.example.co.uk", "co.uk", "localhost", "x.kobe.jp", "y.x.kobe.jp", "city.kobe.jp", "a.city.kobe.jp", "www.ck", "b.www.ck", "a.ck", "b.a.ck", "ck", "d.e.sch.uk", "c.d.e.sch.uk", "example.com", "example.unlisted"]
    assert parts(spark, hosts, SuffixRules()) == [want(h, COMMON_RULES) for h in hosts]
    assert parts(spark, ["10.0.0.1"], SuffixRules()) == [(None, "10.0.0.1", None, 0)]


def test_random_rules_and_hosts(spark):
    rng = random.Random(8)
    for _ in range(4):
        name = lambda n: ".".join(rng.choice("abc") for _ in range(n))
        rules = list(dict.fromkeys([name(rng.randint(1, 3)) for _ in range(6)] + ["*." + name(rng.randint(1, 2)) for _ in range(3)] + ["!" + name(3)]))
        rules = [r for r in rules if r.lstrip("!") not in [x for x in rules if x != r]]
        hosts = [name(rng.randint(1, 5)) for _ in range(120)]
        assert parts(spark, hosts, SuffixRules(rules)) == [want(h, rules) for h in hosts], rules


def test_list_format_and_names_beyond_ascii(spark):
    lines = ["// a comment", "", "com // not the rule", "*.foo", "!bar.foo", "公司.cn", "// ===BEGIN PRIVATE DOMAINS===", "github.io", "// ===END PRIVATE DOMAINS==="]
    assert SuffixRules.parse(lines).levels == SuffixRules(["com", "*.foo", "!bar.foo", "公司.cn"]).levels
    assert parts(spark, ["a.b.github.io", "x.公司.cn", "x.xn--55qx5d.cn"], SuffixRules.parse(lines, private=True)) == [("github.io", "b.github.io", "a", 1), ("公司.cn", "x.公司.cn", None, 0), ("xn--55qx5d.cn", "x.xn--55qx5d.cn", None, 0)]
    assert parts(spark, ["a.b.github.io"], SuffixRules.parse(lines)) == [("io", "github.io", "a.b", 2)]
    assert parts(spark, ["a.co.uk"], SuffixRules([])) == [("uk", "co.uk", "a", 1)]
    with pytest.raises(ValueError):
        SuffixRules(f"x{k}" for k in range(50_001))
