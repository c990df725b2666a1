"""Operators against hand-made results and plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from lakemill.functions import scalars, text, urls
from lakemill.operators import adaptive, balance, dedup, fusion, metrics


def greedy(rows):
    kept, used = set(), set()
    for seq, keys in rows:
        if not used & keys:
            kept.add(seq)
            used |= keys
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_first_seen_equals_a_sequential_pass(spark, seed):
    rng = random.Random(seed)
    rows = [(i, {f"{t}{rng.randrange(25)}" for t in "abc" if rng.random() < 0.8}) for i in range(80)]
    if seed == 0:
        rows = [(1, {"a"}), (2, {"a", "b"}), (3, {"b"}), (4, {"c"}), (5, {"b", "c"})]
        assert greedy(rows) == {1, 3, 4}
    keys = spark.createDataFrame([(s, k) for s, ks in rows for k in ks], "seq long, key string")
    got = {r["seq"]: r["kept"] for r in dedup.first_seen(keys).collect()}
    want = greedy(rows)
    assert got == {s: s in want for s, ks in rows if ks}


def test_dedup_events_name_the_least_matching_id(spark):
    keys = spark.createDataFrame([(1, "s|x|a"), (2, "s|x|a"), (2, "s|y|b"), (3, "s|y|b"), (4, "s|z|c"), (5, "s|y|b"), (5, "s|z|c")], "seq long, key string")
    ids = spark.createDataFrame([(1, "i9"), (2, "i2"), (3, "i7"), (4, "i3"), (5, "i5")], "seq long, sample_id string")
    got = {r["removed_sample_id"]: (r["kept_sample_id"], r["matched_on"]) for r in dedup.events(keys, dedup.first_seen(keys), ids).collect()}
    assert got == {"i2": ("i9", ["x"]), "i5": ("i3", ["y", "z"])}


def test_metrics_with_ties(spark):
    rows = list(zip([1, 0, 1, 1, 0, 0], [0.9, 0.8, 0.8, 0.4, 0.4, 0.1]))
    df = spark.createDataFrame(rows, "label int, score double")
    r = metrics.curve_areas(df).first()
    assert (round(r["pr_auc"], 6), round(r["roc_auc"], 6)) == (0.755556, 0.777778)
    assert metrics.curve_areas(df.where("label = 1")).first()["roc_auc"] is None
    table = {r["threshold"]: r for r in metrics.threshold_table(df).collect()}
    assert set(table) == {0, 0.1, 0.4, 0.5, 0.8, 0.9, 1} and table[0.5]["tp"] == 2 and table[0.5]["fp"] == 1
    assert len(metrics.threshold_table(df, most=3).collect()) == 3
    assert metrics.calibrate(df)["binary_threshold"] == 0.4
    with pytest.raises(ValueError):
        metrics.calibrate(df.limit(0))


def test_zero_false_positive_rate_counts_as_unknown(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.85), (0, 0.1)], "label int, score double")
    table = metrics.threshold_table(df)
    loose = metrics.pick_threshold(table, "min_false_positives_under_recall", 0.5).first()
    strict = metrics.pick_threshold(table, "min_false_positives_under_recall", 0.5, strict_zero_fpr=True).first()
    assert loose["false_positive_rate"] == 0.5 and strict["false_positive_rate"] == 0


def test_divergence(spark):
    hist = [("d", "en", 3, 1), ("d", "fr", 1, 1), ("d", "ar", 0, 2), ("x", "a", 2, 0), ("x", "b", 0, 2), ("e", "y", 0, 1)]
    got = {r["dim"]: round(r["js_divergence"], 6) for r in adaptive.divergence(spark.createDataFrame(hist, "dim string, value string, reference long, current long")).collect()}
    assert got == {"d": 0.344361, "x": 1.0, "e": 0.5}


def test_allocation_and_cap():
    assert balance.allocate({"phishing": 7, "benign": 5, "null": 3}, 10) == {"phishing": 5, "benign": 3, "null": 2}
    assert balance.allocate({"a": 1, "b": 1, "c": 1}, 2) == {"a": 0, "b": 1, "c": 1}
    assert balance.allocate({}, 5) == {} and balance.english_cap(10, 0) == 10 and balance.english_cap(100, 20, 0.6, 5) == 30


def test_urls_never_fail(spark):
    odd = [None, "", " ", "http://[bad", "a b", "://", "http://", "HTTP://X", "http://a:b:c/", "http://user@:80", "ftp://é.com/ü?q#", "x" * 5000, "http://1.2.3.4.5/", "http://::1/", "http://[::1]"]
    got = urls.with_url(spark.createDataFrame([(i, u) for i, u in enumerate(odd)], "i int, u string"), "u").orderBy("i").collect()
    assert got[0]["url_features"] is None and got[0]["url_warnings"] == ["missing_url"]
    assert got[6]["url_features"]["hostname"] is None and "hostname_missing" in got[6]["url_warnings"]
    assert got[14]["url_features"]["is_ip_address"] and not got[12]["url_features"]["is_ip_address"]


def test_text_normalisation(spark):
    df = spark.createDataFrame([("  ﬁ① Ａ\x01b  c ",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(text.normalize_text("s")).collect()]
    assert got == ["fi1 A b c", None, None]
    rows = df.select(text.text_features(F.lit("mail a.b@c.de or https://x.y now"), F.lit("verify your login")).alias("f")).first()["f"]
    assert (rows["email_count"], rows["url_count"], rows["token_count"], rows["urgency_terms"]) == (1, 1, 3, ["verify", "login"])


def test_pick_first_goes_by_name_not_by_value(spark):
    df = spark.createDataFrame([(None, "b")], "URI string, link string")
    assert df.select(scalars.pick_first(df.columns, scalars.CANDIDATES["url"])).first()[0] is None


def test_selection_ignores_missing_metrics(spark):
    runs = spark.createDataFrame([("a", "t", 0.5, None), ("b", "t", 0.7, 0.2), ("c", "t", 0.6, 0.1)], "run string, track string, f1 double, fpr double")
    got = {r["run"]: round(r["selection_score"], 6) for r in fusion.selection_score(runs, {"f1": 0.6, "fpr": -0.4}).collect()}
    assert got == {"a": 0.0, "b": 0.6, "c": 0.7}
    with pytest.raises(ValueError):
        fusion.align(runs, runs)


def test_first_seen_settles_long_chains(spark):
    """Row i has keys i and i + 1, so every other row stays; a second chain has gaps."""
    from lakemill.operators import dedup

    rows = [(i, f"k{j}") for i in range(10_000) for j in (i, i + 1)] + [(20_000 + i, f"g{j}") for i in range(500) if i % 7 for j in (i, i + 1)]
    got = {r["seq"]: r["kept"] for r in dedup.first_seen(spark.createDataFrame(rows, "seq long, key string")).collect()}
    used, want = set(), {}
    by_seq = {}
    for seq, key in rows:
        by_seq.setdefault(seq, []).append(key)
    for seq in sorted(by_seq):
        want[seq] = used.isdisjoint(by_seq[seq])
        if want[seq]:
            used.update(by_seq[seq])
    assert got == want


def test_running_sums_equal_a_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from lakemill.operators.ranks import ranked, running, score_bucket

    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), ((F.col("id") * 7919 % 3001 - 900) / 1000.0).alias("x"))
    w = Window.partitionBy("g").orderBy(F.desc("x"))
    got = running(df, ["g"], score_bucket(F.col("x")), [F.desc("x")], {"s": "id"}, {"t": "id"}, descending=True)
    want = df.withColumns({"s": F.sum("id").over(w), "t": F.sum("id").over(Window.partitionBy("g"))})
    assert sorted(map(str, got.select("id", "s", "t").collect())) == sorted(map(str, want.select("id", "s", "t").collect()))
    digest = F.sha2(F.col("id").cast("string"), 256)
    got = ranked(df, ["g"], digest, ["id"], "r", "n")
    want = df.withColumns({"r": F.row_number().over(Window.partitionBy("g").orderBy(digest)), "n": F.count(F.lit(1)).over(Window.partitionBy("g"))})
    assert sorted(map(str, got.select("id", "r", "n").collect())) == sorted(map(str, want.select("id", "r", "n").collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chains_are_followed_as_a_sequential_pass_would(spark, monkeypatch, seed):
    """Chains, trees that hang from chains, and rows that wait for several; no row is left for a pass in order."""
    rng = random.Random(seed)
    keys = [(i, f"c{i // 500}-{i}") for i in range(3000)] + [(i + 1, f"c{i // 500}-{i}") for i in range(3000) if (i + 1) % 500]
    keys += [(5000 + i, f"c{i % 6}-{rng.randint(0, 2999)}") for i in range(600)] + [(5000 + i, f"t{i // 2}") for i in range(600)]
    keys += [(rng.randint(0, 6000), f"r{rng.randint(0, 900)}") for _ in range(400)]
    used, want = set(), {}
    by_row = {}
    for s, k in keys:
        by_row.setdefault(s, set()).add(k)
    for s in sorted(by_row):
        want[s] = used.isdisjoint(by_row[s])
        if want[s]:
            used |= by_row[s]
    df = spark.createDataFrame(keys, "seq long, key string").repartition(3)
    monkeypatch.setattr(dedup, "PLAIN_ROUNDS", 1)
    assert {r["seq"]: r["kept"] for r in dedup.first_seen(df).collect()} == want


def test_one_long_chain_needs_no_pass_in_order(spark, monkeypatch):
    def fail(rows):
        raise AssertionError("passed in order")

    monkeypatch.setattr(dedup, "_in_order", fail)
    n = 20_000
    df = spark.range(n).select(F.col("id").alias("seq"), F.explode(F.array(F.col("id").cast("string"), (F.col("id") + 1).cast("string"))).alias("key"))
    got = dedup.first_seen(df)
    assert got.where("kept <> (seq % 2 = 0)").count() == 0 and got.count() == n
