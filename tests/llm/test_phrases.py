"""Phrases against a plain count of all of them."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakemill.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(docs):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f, n


def plain(docs, least=30, top=2000):
    f, n = counts(docs)
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            if any(100 * b >= 80 * a for q, b in cands.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            s, _, l, r = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((s, a, " ".join(p), l, r))
        rows.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, k, p, a, l, r, n[lang], s) for k, (s, a, p, l, r) in enumerate(rows[:top], 1)]
    return sorted(out)


def made(seed, n=120):
    rng = random.Random(seed)
    vocab = "New york City of the The a über straße x1 don't ½ - z".split()
    rows = []
    for _ in range(n):
        t = "".join((rng.choice(["new York city", "in the city of", rng.choice(vocab), rng.choice(vocab)])) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!\r"]) for _ in range(rng.randint(0, 120)))
        rows.append((rng.choice(["en", "de", None, "und", "fr"]), t))
    return rows + [("en", None), (None, None), ("xx", "rare words here"), ("en", "hot hot hot " * 200)]


@pytest.mark.parametrize("shard,range_bytes", [(2_000_000, 1 << 20), (50, 500), (1, 4000)])
def test_made_texts_equal_plain_counts(spark, monkeypatch, shard, range_bytes):
    monkeypatch.setattr(phrases, "SHARD", shard)
    docs = made(shard, 120 if shard > 1 else 25)
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 AS f", "'w' AS word").repartition(3)
    least = 30 if shard > 1 else 5
    got = sorted(tuple(r) for r in phrases.mine(df, least, 20, range_bytes).collect())
    assert got == plain(docs, least, 20) and len(got) > 20


def test_counts_of_all_phrases(spark):
    docs = made(5, 40)
    rows = phrases.frequent(spark.createDataFrame(docs, "lang string, text string").repartition(4), 1, 800).collect()
    f, n = counts(docs)
    words = {r["u1"]: (r["lang"], r["word"]) for r in rows if r["depth"] == 1}
    got = {}
    for r in rows:
        if r["depth"]:
            path = [words[r[f"u{k}"]] for k in range(1, r["depth"] + 1)]
            key = path[0][0], tuple(w for _, w in path)
            assert key not in got
            got[key] = r["f"]
    assert got == {(lang, p): a for lang, c in f.items() for p, a in c.items()}
    totals = Counter()
    for r in rows:
        totals[r["lang"]] += r["f"] if r["depth"] == 0 else 0
    assert +totals == +n


def test_cuts_keep_order():
    rng = np.random.default_rng(2)
    words, piece = rng.integers(1, 6, 300, dtype=np.uint64) * np.uint64(10), np.repeat(np.arange(30), 10)
    symbols, _, levels = phrases.count_trie(words, piece)
    paths, prefix = [], []
    for d, level in enumerate(levels):
        prefix = [p[level.parent] for p in prefix] + [symbols[level.symbol]]
        paths.append([tuple(int(x) for x in r) + (0,) * (3 - d) for r in zip(*prefix)])
    borders = [tuple(int(x) for x in b[:k]) + (0,) * (4 - k) for k in (1, 2, 3, 4) for b in rng.integers(0, 70, (40, 4))]
    borders += rng.permutation(sum(paths, []))[:100].tolist()
    cuts = phrases._cuts(symbols, levels, np.array(borders, np.uint64))
    for border, cut in zip(borders, cuts.tolist()):
        assert cut == [sum(p < tuple(border) for p in level) for level in paths], border


def test_tables_equal_plain_counts(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    got = sorted(tuple(r) for r in queries.op13_phrases(spark, sf).collect())
    f, _ = counts(rows)
    assert got and {r[0] for r in got} <= set(f)
    for lang, _, phrase, a, l, r, _, score in got:
        p = tuple(phrase.split(" "))
        assert f[lang][p] == a and score == min(2_000_000 * a // (f[lang][p[:k]] + f[lang][p[k:]]) for k in range(1, len(p)))


def test_exact_arithmetic_and_thresholds(spark):
    big = 2**60
    rows = [(1, f, u, None, None, None, f"w{u}", "en") for u, f in ((1, big + 1), (2, big + 2), (3, big // 2))]
    rows += [(2, big, 1, 2, None, None, None, None), (2, big // 2, 2, 3, None, None, None, None), (3, big // 10 * 4, 1, 2, 3, None, None, None)]
    got = {r["phrase"]: r for r in phrases.scored(spark.createDataFrame(rows, phrases.NODES)).collect()}
    assert got["w1 w2"]["score"] == 2_000_000 * big // (2 * big + 3) and not got["w1 w2"]["inside"]
    a = big // 10 * 4
    assert got["w1 w2 w3"]["score"] == min(2_000_000 * a // (big + 1 + big // 2), 2_000_000 * a // (big + big // 2))
    assert got["w2 w3"]["inside"] == (100 * a >= 80 * (big // 2))


def test_odd_and_empty_tables(spark, odd_dir, empty_dir):
    assert queries.op13_phrases(spark, empty_dir).count() == 0
    got = queries.op13_phrases(spark, odd_dir).collect()
    assert [(r["lang"], r["phrase"], r["a"], r["l"], r["r"]) for r in got] == [("und", "x x x x", 4997, 5000, 4998)]
