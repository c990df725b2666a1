"""The pipeline, stage by stage, against plain versions of the stages."""

import re
from collections import Counter

from test_map_operators import plain_decontamination
from test_pair_operators import groups_of, plain_fingerprint, plain_lines

import corpus_pipeline


def test_stages_equal_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    before = texts(docs)
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == corpus_pipeline.COLUMNS
        after = texts(docs)
        if name == "language ID":
            want = {i: t for i, t in before.items() if i in after}
            assert len(want) >= len(before) - 3 and all(re.search("[^\\W\\d_]", t) for t in want.values())
        elif name == "line dedup":
            want = {i: t for i, t in plain_lines(sorted(before.items()))[0].items() if t.strip()}
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        elif name == "SimHash near-dedup":
            ids = sorted(before)
            fps = {i: plain_fingerprint(before[i]) for i in ids}
            root = groups_of(ids, [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 4])
            want = {i: before[i] for i in ids if root[i] == i}
        else:
            want = {i: t for i, t in before.items() if not plain_decontamination(t, items)[-1]}
        assert after == want, name
        assert name != "line dedup" or after != before
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in packed} == set(after)
    assert Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, sf).collect()) == Counter(tuple(r)[:5] for r in packed)


def test_odd_and_empty_tables_pass(spark, odd_dir, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, odd_dir).collect()}
    assert got == {None, 4, 6, 7, 8, 9}  # the others have no letter, or (50) hold a benchmark item


def test_documents_without_an_id_of_their_own_stay(spark):
    texts = ["the quick brown fox jumps over the lazy dog near a river", "all of them went home before it rained over the hills", "nobody could say where the old keys had been put away", "seven ships sailed out of the harbour early one morning"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in zip([None, None, None, 7, 7, 7, 8], [*texts, "a letter from abroad was lying on the kitchen table", texts[3], "we counted every star that we could see that night"])], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_documents(spark, docs, "").collect())
    assert got == Counter({(r["doc_id"], r["text"]): 1 for r in docs.collect()})
