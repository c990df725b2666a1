"""Suffix arrays and removal of repeated strings against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lakemill.llm import queries, substrings
from lakemill.llm.gsaca import suffix_arrays


def test_suffix_arrays_equal_sorting():
    rng = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            k = rng.choice([1, 2, 3, 26])
            t = [rng.randint(1, k) for _ in range(rng.randint(0, 40))]
            texts.append((t[:5] * 6 if rng.random() < 0.3 else t) + [0])
        sa, o = suffix_arrays(np.array(sum(texts, [])), np.array([len(t) for t in texts])), 0
        for t in texts:
            assert [x - o for x in sa[o : o + len(t)]] == sorted(range(len(t)), key=lambda i: t[i:])
            o += len(t)
    assert len(suffix_arrays(np.zeros(0, int), np.zeros(0, int))) == 0


def plain(docs):
    """(n_bytes, n_removed, n_spans, digest) of each (key, text), in order of keys; equal rows are one text."""
    seen, out = set(), {}
    for key, text in sorted(set(docs), key=lambda d: d[0]):
        gone = bytearray(len(text))
        for i in range(len(text) - 99):
            w = text[i : i + 100]
            if w in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, bytes([0]) + gone))
        out[key, text] = (len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(spark, df, docs):
    got = Counter(tuple(r) for r in substrings.remove_repeats(df).drop("kept").collect())
    want = plain(docs)
    assert got == Counter((k[0] if isinstance(k, tuple) else k, *want[k, t]) for k, t in docs)
    return got


def test_tables_equal_plain_removal(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = run(spark, df, [(r[0], (r[1] or "").encode()) for r in df.select("doc_id", "text").collect()])
    assert sum(r[2] > 0 for r in got) > 5


@pytest.mark.parametrize("unit", [2, 16])
def test_made_repeats(spark, monkeypatch, unit):
    monkeypatch.setattr(substrings, "UNIT", unit)
    monkeypatch.setattr(substrings, "PIECE", 5000)
    rng = random.Random(unit)
    letters = "abcdefgh é"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    parts = [word(n) for n in (99, 100, 101, 130, 180, 260, 700)]
    docs = []
    for i in range(60):
        t = "".join(rng.choice(parts) if rng.random() < 0.5 else word(rng.randint(1, 60)) for _ in range(rng.randint(0, 7)))
        docs.append((i * 3, t))
    docs += [(500, "ab" * 300), (501, "q" * 12_000), (502, "q" * 150 + word(20) + "q" * 150), (503, parts[-1] * 5), (504, word(16_000) + parts[4] + parts[5])]
    docs += [(505, docs[-1][1][200:]), (7, "é" * 200), (8, "x" + "é" * 200)]
    rng.shuffle(docs)
    run(spark, spark.createDataFrame(docs, "doc_id long, text string"), [(i, t.encode()) for i, t in docs])


def test_odd_and_empty_tables(spark, odd_dir, empty_dir):
    assert queries.op8_substrings(spark, empty_dir).count() == 0
    rows = queries.op8_substrings(spark, odd_dir).collect()
    assert len(rows) == 13
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["n_bytes"] == 0 and by[9]["n_removed"] == 119_999 and by[6]["n_removed"] == 9_998
    assert by[50]["n_removed"] == 0
    two = [(1, "z" * 99 + "y" * 60), (1, "w" + "z" * 99 + "y" * 60), (1, "w" + "z" * 99 + "y" * 60)]
    got = substrings.remove_repeats(spark.createDataFrame(two, "doc_id long, text string")).collect()
    assert len(got) == 3 and sorted({r["n_removed"] for r in got}) == [0, 159]
