"""Evidence of proposals against a plain version, with feedback, ties and missing values."""

import random
from collections import Counter

from pyspark.sql import functions as F

from lakemill.operators import adaptive


def rows(seed=4, n=400):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = " ".join(rng.choice("urgent verify account letter holiday weather invoice payment".split()) for _ in range(rng.randint(0, 12)))
        out.append((k, f"s{k}", rng.choice(["a", "b", "", None]), rng.choice(["en", "de", None, ""]), rng.choice([0, 1, 1, None]), f"http://x/{k}" if k % 3 else None, words if k % 7 else None, [rng.choice([" Log in ", "Verify", "", "Go"]) for _ in range(rng.randint(0, 3))], rng.random() < 0.4, rng.choice([None, None, None, 0, 1, 2])))
    return out


SCHEMA = "seq long, sample_id string, source_dataset string, language string, label int, normalized_url string, normalized_text string, action_texts array<string>, flag boolean, final_reviewed_label int"


def plain(data, patterns, once, whole):
    truth = lambda r: r[9] if r[9] in (0, 1) else r[4]
    count, benign, support, examples = Counter(), Counter(), {}, {}
    for r in data:
        found = patterns(r)
        if truth(r) == 0:
            benign.update(found)
        if truth(r) == 1:
            count.update(found)
            for p in dict.fromkeys(found) if once else found:
                support.setdefault(p, Counter())[r[2] or "unknown"] += 1
                if len(examples.setdefault(p, [])) < 3:
                    examples[p].append(r)
    every = sorted({r[3] for r in data if truth(r) == 1 and r[3]})
    return {p: (n, benign[p], dict(support[p]), [e[1] for e in examples[p]], every if whole else sorted({e[3] for e in examples[p] if e[3]})) for p, n in count.items()}


def got(df):
    return {r["pattern"]: (r["phishing"], r["benign"], r["source_support"], [e["sample_id"] for e in r["examples"]], r["languages"]) for r in df.collect()}


def grams(r):
    t = [w for w in (r[6] or "").lower().split() if len(w) >= 4][:80]
    return [" ".join(t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)]


def test_generators_equal_plain_version(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    want = plain(data, grams, True, False)
    best = sorted((p for p, v in want.items() if v[0] >= 3), key=lambda p: (-want[p][0], p))[:30]
    assert got(adaptive.phrase_proposals(df, 10, floor=0.0, evidence=True)) == {p: want[p] for p in best}
    want = plain(data, lambda r: [t for t in (a.strip().lower() for a in r[7]) if t], False, False)
    assert got(adaptive.cta_proposals(df, 10, floor=0.0, evidence=True)) == want
    want = plain(data, lambda r: ["flag"] if r[8] else [], False, True)
    assert got(adaptive.flag_proposals(df, {"flag": F.col("flag"), "never": F.lit(False)}, "url_style", evidence=True)) == want


def test_records(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    found = adaptive.phrase_proposals(df, 10, floor=0.0, evidence=True)
    out = adaptive.proposal_records(found, "2024-01-01T00:00:00+00:00").collect()
    assert len({r["proposal_id"] for r in out}) == len(out) > 5
    first = max(out, key=lambda r: r["supporting_count"])
    assert first["rule_type"] == "text_phrase" and first["status"] == "proposed" and not first["derived_from_errors"]
    assert len(first["supporting_examples"]) == 3 and set(first["supporting_examples"][0].asDict()) == {"sample_id", "source_dataset", "language", "url", "text_snippet"}
    assert adaptive.phrase_proposals(df.limit(0), evidence=True).count() == 0


def test_first_rows_are_picked_before_they_meet(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    plan = adaptive.cta_proposals(df, evidence=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # within partitions, then in all
