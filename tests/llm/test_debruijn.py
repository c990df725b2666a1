"""Removal of repeated word windows against a plain version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import debruijn, queries
from lakemill.llm.words import split


def plain(docs):
    """(n_words, n_removed, digest) of each distinct (key, text), in order of keys; a key is a document."""
    first, out = {}, {}
    docs = sorted(set(docs), key=lambda d: d[0])
    for key, text in docs:
        words = text.split()
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i : i + 13]), (key, text))
    for key, text in docs:
        words = text.split()
        gone = [False] * len(words)
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] != (key, text):
                gone[i : i + 13] = [True] * 13
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[key, text] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def run(df, docs):
    got = Counter(tuple(r) for r in debruijn.remove_repeats(df).drop("kept").collect())
    want = plain(docs)
    assert got == Counter((k, *want[k, t]) for k, t in docs)
    return got


def test_grams_join_all_words():
    h = np.random.default_rng(1).integers(0, 2**63, 40, dtype=np.uint64)
    b = int(debruijn._B)
    for n in range(1, 25):
        want = [sum(int(h[i + k]) * pow(b, n - 1 - k) for k in range(n)) % 2**64 for i in range(len(h) - n + 1)]
        assert debruijn.grams(h, n).tolist() == want


def test_pieces_hold_every_window_once():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 80))).encode() for _ in range(50)] + [b"", b"x " * 300]
    text, at, n, h, c, _, _ = debruijn.pieces(split(texts))
    seen = Counter((int(t), int(a) + k) for t, a, m in zip(text, at, n) for k in range(m - 12))
    assert seen == Counter((t, i) for t, x in enumerate(texts) for i in range(len(x.split()) - 12))
    by_words = {}
    for t, a, m, x, y in zip(text, at, n, h, c):
        assert by_words.setdefault(tuple(texts[t].split()[a : a + m]), (x, y)) == (x, y)
    assert len(set(by_words.values())) == len(by_words)


def test_tables_equal_plain_removal(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = run(df, [(r[0], (r[1] or "").encode()) for r in df.select("doc_id", "text").collect()])
    assert sum(r[2] > 0 for r in got) > 5


@pytest.mark.parametrize("met", [1, 40, 250_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_made_repeats(spark, monkeypatch, met, seed):
    monkeypatch.setattr(debruijn, "MET_TOGETHER", met)
    rng = random.Random(seed)
    words = lambda n: [rng.choice("a b c d e f g é ß".split()) + str(rng.randint(0, 9)) for _ in range(n)]
    parts = [words(n) for n in (12, 13, 14, 20, 25, 60, 200)] + [["x"] * 40, ["x", "y"] * 15]
    docs = []
    for i in range(80):
        t = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(parts)
            cut = rng.randint(0, len(p)) if rng.random() < 0.4 else 0
            t += p[cut:] if rng.random() < 0.6 else words(rng.randint(1, 25))
        docs.append((i * 3, "".join(w + rng.choice([" ", "\n", "\t ", "\x0b"]) for w in t)))
    docs += [(500, "q " * 700), (501, "q " * 300 + "z " + "q " * 300), (502, docs[5][1]), (503, docs[7][1] + docs[9][1]), (1, docs[9][1] + " tail"), (504, "ein Wort  " * 30)]
    rng.shuffle(docs)
    run(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), [(i, t.encode()) for i, t in docs])


def test_wrong_digest_removes_nothing():
    words = [b"w%d" % k for k in range(30)]
    span = {"at": 3, "n": 15, "digest": debruijn._digest(words, 3, 15), "name": None, "edge": None}
    assert debruijn.gone(b" ".join(words), words, [span]).sum() == 15
    assert debruijn.gone(b" ".join(words), words, [span | {"digest": b"no"}]).sum() == 0


def test_paths_are_compacted(spark):
    text = " ".join(f"w{k}" for k in range(2000))
    docs = spark.createDataFrame([(k, f"d{k} {text} e{k}") for k in range(3)], "rid long, text string").repartition(3, "rid")
    old = debruijn.MET_TOGETHER
    try:
        debruijn.MET_TOGETHER = 1
        rows = debruijn.met(docs).where("not again")
        heads = debruijn.compacted(debruijn.names(rows))
        # the pieces inside the shared text are one path; its ends belong to pieces that differ
        assert rows.count() > 700 and heads.count() == 1
        assert 1950 <= heads.first()["n"] <= 2000
        assert debruijn.repeated_spans(docs).agg(F.sum(F.size("spans"))).first()[0] <= 6
    finally:
        debruijn.MET_TOGETHER = old


def test_odd_and_empty_tables(spark, odd_dir, empty_dir):
    assert queries.op11_debruijn(spark, empty_dir).count() == 0
    rows = queries.op11_debruijn(spark, odd_dir).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 13 and by[0]["n_words"] == 0 and by[6]["n_words"] == 5000 and by[6]["n_removed"] == 0 and by[50]["n_removed"] == 0
    w = " ".join(map(str, range(20)))
    two = [(1, w), (1, "more " + w), (1, "more " + w), (None, w + " end")]
    got = debruijn.remove_repeats(spark.createDataFrame(two, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (1, 20), (1, 20), (1, 20)]
