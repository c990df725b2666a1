"""Brown class n-grams: the unigram base against plain counts, the class model against its definition."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakemill.llm import brown, queries
from lakemill.llm.common import materialize

WORD = re.compile("[^\x20\x09-\x0d]+")


def words_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")] + [""]


@pytest.mark.parametrize("chunk_bytes", [brown.CHUNK_BYTES, 20_000])
def test_base_equals_plain_counts(spark, sf, odd_dir, chunk_bytes):
    for d in (sf, odd_dir):
        table = spark.read.parquet(f"{d}/documents.parquet")
        docs = [(r[0], r[1]) for r in table.select("doc_id", "text").collect()]
        held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        counts = Counter(w for i, t in docs if not held(i) for w in words_of(t))
        total, v = counts.total(), len(counts)
        want = Counter()
        for i, t in docs:
            ws = words_of(t)
            want[i, held(i), len(ws), sum(counts[w] > 0 for w in ws), total, round(sum(math.log10((counts[w] + 1) / (total + v + 1)) for w in ws), 6)] += 1
        got = brown.score_corpus(table, chunk_bytes).collect()
        assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == want
        assert all(r["score"] < 0 for r in got)


def test_score_equals_its_definition(spark, sf):
    """Classes are taken from the model; masses, transitions and scores are counted anew."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    model, classed, encoded = brown.train(table)
    docs = [(r[0], (r[1] or "").encode()) for r in table.select("doc_id", "text").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    of = {bytes(r["word"]): r["class"] for r in classed.collect()}.__getitem__
    start = lambda w: int(model.of[model.type_of(w)])
    tokens = {i: [*(w.encode() for w in words_of(t.decode())[:-1]), b""] for i, t in docs}
    counts = Counter(w for i, _ in docs if not held(i) for w in tokens[i])
    k = len(model.mass)
    mass = [1 + sum(c + 1 for w, c in counts.items() if of(w) == j) for j in range(k)]
    pairs = Counter((of(a), of(b)) for i, _ in docs if not held(i) for a, b in zip([b"", *tokens[i]], tokens[i]))
    after, to = Counter(), Counter()
    for (a, b), n in pairs.items():
        after[a] += n
        to[b] += n
    total, v = counts.total(), len(counts)
    assert {bytes(r["word"]): r["c"] for r in classed.where("c > 0").collect()} == counts and any(of(w) != start(w) for w in counts)
    assert all(of(w) == start(w) for w in model.types)

    def probability(before, w):
        a, b = of(before), of(w)
        prior = (to[b] + 1) / (sum(to.values()) + k)
        return 0.9 * (pairs[a, b] + 5 * prior) / (after[a] + 5) * (counts[w] + 1) / mass[b] + 0.1 * (counts[w] + 1) / (total + v + 1)

    got = {r["doc_id"]: r["score"] for r in brown.score(encoded, model).collect()}
    for i, ts in tokens.items():
        want = sum(math.log10(probability(a, w)) for a, w in zip([b"", *ts], ts))
        assert abs(got[i] - want) < 1e-6 * max(1, abs(want)), i


def test_held_out_text_is_less_perplexing_than_under_the_base(spark):
    rows = queries.op4_brown(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 100


def test_empty_table(spark, empty_dir):
    assert queries.op4_brown(spark, empty_dir).count() == 0


def likelihood(bigrams, of):
    k = of.max() + 1
    onehot = np.eye(k)[of]
    t = onehot.T @ bigrams @ onehot
    f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0).sum()
    return f(t) - f(t.sum(0)) - f(t.sum(1))


def test_exchange_finds_planted_classes_and_never_loses_likelihood():
    rng = np.random.default_rng(0)
    true = np.arange(40) % 4
    bigrams = rng.poisson(np.where((true[:, None] + 1) % 4 == true[None, :], 30, 0.5)).astype(float)
    of = brown.exchange(bigrams, 4, 10)
    assert likelihood(bigrams, of) >= likelihood(bigrams, true) - 1e-6
    assert len({(a, b) for a, b in zip(true, of)}) == 4


def test_probabilities_of_all_words_sum_to_one():
    counts = {b"a": 5, b"b": 3, b"": 2, b"zz": 1}
    bigrams = np.ones((brown.COMMON + brown.SHARED,) * 2)
    types = {b"a": 0, b"b": 1, b"": 2}
    of = np.arange(len(bigrams)) % 3
    onehot = np.eye(3)[of]
    ts = [types.get(w, brown.shared_type(w)) for w in counts]
    n, m = np.zeros(len(bigrams)), np.zeros(len(bigrams))
    np.add.at(n, ts, list(counts.values()))
    np.add.at(m, ts, 1)
    transitions = np.full((3, 3), 1 / 3)
    model = brown.Model(11, 4, types, of, transitions, onehot.T @ (n + m) + 1)
    known = sum(10 ** brown.score_text([w], counts, model, {})[3] for w in counts)
    unknown = sum((0.9 / 3) / model.mass[k] for k in range(3)) + 0.1 / 16
    assert abs(known + unknown - 1) < 1e-9


def test_rarer_words_go_to_the_class_of_their_own_neighbours():
    rng = np.random.default_rng(1)
    of = np.arange(12) % 3
    bigrams = rng.poisson(np.where((of[:, None] + 1) % 3 == of[None, :], 30, 2)).astype(float)
    np.fill_diagonal(bigrams, 0)
    bigrams[10, 11] = bigrams[11, 10] = 0
    table = np.eye(3)[of].T @ bigrams @ np.eye(3)[of]
    for w in (10, 11):
        counts = np.concatenate([bigrams[w] @ np.eye(3)[of], bigrams[:, w] @ np.eye(3)[of]])
        key = np.flatnonzero(counts)
        got = brown.place(np.array([of[w]]), np.zeros(len(key), np.int64), key, counts[key], table)[0]
        best = max(range(3), key=lambda c: likelihood(bigrams, np.where(np.arange(12) == w, c, of)))
        assert got == best
        wrong = np.where(np.arange(12) == w, (best + 1) % 3, of)
        moved = np.eye(3)[wrong].T @ bigrams @ np.eye(3)[wrong]
        assert brown.place(np.array([wrong[w]]), np.zeros(len(key), np.int64), key, counts[key], moved)[0] == best


def test_rarer_words_of_one_shared_type_get_classes_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(brown, "COMMON", 5)
    monkeypatch.setattr(brown, "shared_types", lambda words: np.full(len(words), 5))
    rows = [(i, " ".join(["a b"] * 20 + ["a rare1 a rare1 a", "c d " * 20, "c rare2 c rare2 c"])) for i in range(40)]
    segs = materialize(brown.segments(spark.createDataFrame(rows, "doc_id long, text string"), 2000), "test-segments")
    of = np.array([0, 1, 2, 3, 4, 1] + [1] * (brown.SHARED - 1))
    types = {b"a": 0, b"b": 1, b"c": 2, b"d": 3, b"": 4}
    big = brown.count_bigrams(segs, types)
    table = np.eye(5)[of].T @ big @ np.eye(5)[of]
    for merged in (2, 4096):  # rows of a word merged by twos, in several rounds, or all at once
        contexts = brown.count_contexts(segs, types, of, merged)
        got = {bytes(r[0]): r[1] for r in brown.place_words(contexts, of, table).collect()}
        assert got.get(b"rare1", 1) == 1 and got[b"rare2"] == 3
