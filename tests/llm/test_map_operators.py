"""Language ID, quality rules, decontamination and packing against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakemill.llm import decontaminate, language, packing, queries
from lakemill.llm.quality import repeated_words

ODD_IDS = {*range(10), 50, None}


@pytest.mark.parametrize("name", ["op6_quality", "op7_decontaminate", "op9_packing", "op10_language"])
def test_empty_and_odd_tables(spark, empty_dir, odd_dir, name):
    assert queries.QUERIES[name](spark, empty_dir).count() == 0
    got = queries.QUERIES[name](spark, odd_dir).select("doc_id").collect()
    assert Counter(r[0] for r in got).keys() == ODD_IDS
    assert Counter(r[0] for r in got)[50] == 2


def docs_of(spark, d):
    return [(r[0], r[1] or "") for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]


WORD7 = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def plain_decontamination(text, items):
    windows = {}
    for item, t in items:
        w = WORD7.findall(lower(t or ""))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    words, hit, found = WORD7.findall(lower(text)), set(), set()
    for size in {len(k) for k in windows}:
        for i in range(len(words) - size + 1):
            if (k := tuple(words[i : i + size])) in windows:
                hit.update(range(i, i + size))
                found |= windows[k]
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 1500])
def test_decontamination_equals_plain_search(spark, sf, odd_dir, block_bytes):
    for d in (sf, odd_dir):
        items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
        docs = spark.read.parquet(f"{d}/documents.parquet")
        got = decontaminate.find_contamination(docs, spark.read.parquet(f"{d}/benchmark.parquet"), block_bytes=block_bytes)
        got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got.collect())
        assert got == sorted((i if i is not None else -1, *plain_decontamination(t, items)) for i, t in docs_of(spark, d))
        assert any(r[-1] for r in got)


def test_decontamination_by_many_blocks_and_with_items_without_an_id(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text", "1 AS rid", "2 AS ranges")
    texts = docs_of(spark, sf)
    items = [(k, " ".join(WORD7.findall(t)[5:18])) for k, (_, t) in enumerate(texts[:60])] + [(None, texts[70][1]), (None, texts[71][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench, block_bytes=sum(len(t.encode()) for _, t in items) // 50)
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got.collect())
    assert got == sorted((i, *plain_decontamination(t, [("" if k is None else k, x) for k, x in items])) for i, t in texts)
    assert next(r for r in got if r[0] == texts[70][0])[-1]


WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_quality(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


def test_quality_counts_equal_plain_counts(spark, sf, odd_dir):
    for d in (sf, odd_dir):
        got = queries.op6_quality(spark, d).collect()
        assert Counter(tuple(r)[:7] for r in got) == Counter((i, *plain_quality(t)) for i, t in docs_of(spark, d))
        assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_keeps_prose_and_drops_junk(spark, sf):
    texts = dict(docs_of(spark, sf))
    for r in queries.op6_quality(spark, sf).collect():
        junk = len(re.findall(r"[#*$%&]{3}|!!", texts[r["doc_id"]])) * 4 > r["n_words"]
        if r["n_words"] >= 50 and not r["base_failed"] and " | " not in texts[r["doc_id"]]:
            assert r["kept"] != junk, (r, texts[r["doc_id"]][:200])


def test_repeated_words_of_overlapping_windows():
    assert repeated_words([b"a"] * 9) == 9
    assert repeated_words([b"a"] * 8) == 0
    assert repeated_words([b"%d" % (i % 10) for i in range(20)]) == 20


def test_packing_cuts_all_ids_gaplessly(spark, sf, odd_dir):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.default_vocabulary())
    for d in (sf, odd_dir):
        rows = queries.op9_packing(spark, d).collect()
        want = Counter()
        for i, t in docs_of(spark, d):
            ids = [*coder.encode(t, add_special_tokens=False).ids, 2]
            first = (len(ids) - 1) % 1024 + 1
            for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], range(first, len(ids) + 1, 1024))):
                want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
        assert Counter(tuple(r)[:5] for r in rows) == want
        bins = {}
        for r in rows:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for held in bins.values():
            end = 0
            for offset, length in sorted(held):
                assert offset == end
                end += length
            assert end <= 1024
        assert len(bins) <= 1.1 * sum(r["length"] for r in rows) / 1024 + 1


@pytest.mark.parametrize("text", ["a\n \nb", "a  b", " \n x", "a \n\n  b ", "end \n ", "x<|endoftext|> y", "it's  o'clock  now", "\t a\r\n \r\nb", " ", ""])
def test_encoder_equals_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = packing.Encoder(packing.default_vocabulary(), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = Tokenizer.from_file(packing.default_vocabulary()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == want


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert bins.put(6) == (0, 0) and bins.put(7) == (1, 0)
    assert bins.put(3) == (1, 7)  # free 3 before free 4
    assert bins.put(5) == (2, 0)
    assert bins.put(9) == (3, 0)  # all open: bin 0, with 4 free, closes
    assert bins.put(5) == (2, 5)
    assert bins.put(4) == (4, 0)


def test_language_accuracy_and_null_rules(spark, odd_dir):
    rows = queries.op10_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r[0]: r[1] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert len(held) > 100 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    odd = {r["doc_id"]: r for r in queries.op10_language(spark, odd_dir).collect()}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 for i in (0, 1, 2, 3, 5))
    assert odd[4]["lang_pred"] == "en"


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 40])
def test_codewords_are_apart(n):
    code = language.codewords(n).astype(int)
    gap = (code.shape[1] - code @ code.T) // 2
    assert gap[~np.eye(n, dtype=bool)].min() >= max(1, code.shape[1] // 4)


def test_language_equals_a_plain_version(spark, sf):
    """Counts, weights, losses and the nearest codeword, document by document."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    counts = {}
    for i, t, lang in rows:
        if not held(i) and lang is not None and t and language.has_letter(t):
            counts.setdefault(lang, np.zeros(language.SLOTS))
            np.add.at(counts[lang], language.grams([t])[0].ravel(), 1)
    langs = sorted(counts)
    code = language.codewords(len(langs)).astype(float)
    freq = []
    for lang in langs:
        of_order = (counts[lang] + 0.1).reshape(len(language.ORDERS), -1)
        freq.append(np.concatenate([x / x.sum() for x in of_order]))
    yes = [np.mean([f for f, c in zip(freq, code[:, b]) if c > 0], axis=0) for b in range(code.shape[1])]
    no = [np.mean([f for f, c in zip(freq, code[:, b]) if c < 0], axis=0) for b in range(code.shape[1])]
    rely = np.array([((y - n) * np.log(y / n)).sum() for y, n in zip(yes, no)])
    rely /= rely.mean()
    got = {r["doc_id"]: r for r in queries.op10_language(spark, sf).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        if not t or not language.has_letter(t):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
            continue
        slots = language.grams([t])[0].ravel()
        margins = np.clip([np.log(y / n)[slots].sum() / language.TEMPERATURE for y, n in zip(yes, no)], -20, 20)
        loss = [(np.log1p(np.exp(-margins * c)) * rely).sum() for c in code]
        share = np.exp(-np.array(loss) + min(loss))
        share /= share.sum()
        assert got[i]["lang_pred"] == langs[int(share.argmax())] and abs(got[i]["score"] - share.max()) < 2e-3, i


def test_quality_verdict_equals_its_definition(spark, sf):
    """Distances to reference histograms that are counted anew, and the verdict from them."""
    from lakemill.llm import quality

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    classes, words = {}, {}
    for _, t, lang in rows:
        if t is not None and lang is not None:
            classes[lang] = classes.get(lang, 0) + quality.class_counts(t.encode()).astype(float)
            words.setdefault(lang, Counter()).update(quality.plain_words(t.encode()))
    common = {lang: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: quality.COMMON_WORDS]] for lang, c in words.items()}

    def js(p, q):
        p, q = np.array(p, float), np.array(q, float)
        p, q = p / max(p.sum(), 1), q / max(q.sum(), 1)
        m, d = (p + q) / 2, 0.0
        for x in (p, q):
            d += sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
        return math.sqrt(max(0.0, d / 2))

    got = {r["doc_id"]: r for r in queries.op6_quality(spark, sf).collect()}
    for i, t, _ in rows:
        r, text = got[i], (t or "").encode()
        n = Counter(quality.plain_words(text))
        hist = lambda c, lang: [*(c[w] for w in common[lang]), sum(c.values()) - sum(c[w] for w in common[lang])]
        by_class = min(js(quality.class_counts(text), classes[x]) for x in classes)
        by_word = min(js(hist(n, x), hist(words[x], x)) for x in words)
        fits = (r["n_words"] < quality.LEAST_WORDS_FOR_CLASSES or by_class <= quality.MOST_CLASS_DISTANCE) and (r["n_words"] < quality.LEAST_WORDS_FOR_COMMON or by_word <= quality.MOST_WORD_DISTANCE)
        assert r["kept"] == (fits and not r["base_failed"]), i
        assert r["class_distance"] is None or abs(r["class_distance"] - by_class) < 1e-9
        assert r["word_distance"] is None or abs(r["word_distance"] - by_word) < 1e-9


def test_language_memory_does_not_grow_with_the_batch():
    import tracemalloc

    langs = ["da", "de", "en", "fr"]
    code = language.codewords(4)
    rng = np.random.default_rng(1)
    model = language.Model(langs, code, rng.normal(size=(language.SLOTS, code.shape[1])).astype(np.float32), np.ones(code.shape[1]))
    texts = ["".join(x) for x in rng.choice(list("abcdefg ß"), (2000, 1000))]
    tracemalloc.start()
    got = model.decode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6, peak
    alone = [model.decode([t]) for t in texts[:50]]
    assert [x[:50] for x in got] == [[r[k][0] for r in alone] for k in range(3)]
    whole, pieces = "".join(texts), model._sums
    model._sums = lambda row, starts: np.add.reduceat(model.weights[row].astype(float), starts, axis=0)
    expected = model.decode([whole])
    model._sums = pieces
    assert model.decode([whole])[0] == expected[0] and abs(model.decode([whole])[1][0] - expected[1][0]) < 1e-9
