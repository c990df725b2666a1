"""SimHash, line dedup, chat formatting and components against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from lakemill.llm import chat, lines, queries, simhash
from lakemill.llm.components import components


def groups_of(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)], [(i * 7919 % 500, i * 104729 % 500) for i in range(300)], []])
def test_components_of_chains_stars_and_random_graphs(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    linked = [(a, b) for a, b in edges if a != b]
    assert {r["node"]: r["root"] for r in got} == groups_of({x for e in linked for x in e}, linked)
    assert len(got) == len({r["node"] for r in got})


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_equals_all_pairs(spark, sf, odd_dir, empty_dir):
    assert queries.op2_simhash(spark, empty_dir).count() == 0
    for d in (sf, odd_dir):
        docs = [(r[0], r[1] or "") for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
        fps = [plain_fingerprint(t) for _, t in docs]
        root = groups_of(range(len(fps)), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
        least = {}
        for k, r in root.items():
            if docs[k][0] is not None:
                least[r] = min(least.get(r, docs[k][0]), docs[k][0])
        got = Counter(tuple(r) for r in queries.op2_simhash(spark, d).collect())
        assert got == Counter((docs[k][0], f"{fps[k]:016x}", least.get(root[k])) for k in root)


@pytest.mark.parametrize("spare", [0, 1])
def test_trie_join_finds_every_link(spark, monkeypatch, spare):
    rng = random.Random(spare)
    fps = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 25])):
            fps.add(x)
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
    fps |= {0, 2**64 - 1, 2**63, 1, 3}
    fps = sorted(fps)
    want = groups_of(range(len(fps)), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    monkeypatch.setattr(simhash, "spare_blocks", lambda n, bits: spare)
    for cap in (5, 20_000):
        edges = [(signed.index(r["a"]), signed.index(r["b"])) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), cap=cap).collect()]
        assert groups_of(range(len(fps)), edges) == want


def test_trie_alone_over_a_dense_group():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, dtype=np.uint64)
    v = np.unique(np.array([base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, 3, replace=False))) for _ in range(3000)], np.uint64))
    assert (simhash.Trie(v, 0).join(4) != 0).mean() < 0.9
    label = simhash.Trie(v, 1).join(4)
    pairs = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    heads = v >> np.uint64(63)
    want = groups_of(range(len(v)), np.argwhere(np.triu(pairs & (heads[:, None] == heads[None, :]), 1)).tolist())
    assert label.tolist() == [want[i] for i in range(len(v))]


def plain_lines(docs):
    """Text of every document after line dedup, comparing all pairs of lines."""
    where = {}
    for doc, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            if len(line.strip()) >= lines.SHINGLE:
                where.setdefault(line.strip(), []).append((doc, k))
    distinct = list(where)
    sets = [lines.shingles(x) for x in distinct]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if min(len(sets[i]), len(sets[j])) >= 0.8 * max(len(sets[i]), len(sets[j])) and lines.jaccard(sets[i], sets[j]) >= 0.8]
    root = groups_of(range(len(distinct)), near)
    first = {}
    for k, r in root.items():
        first[r] = min(([first[r]] if r in first else []) + where[distinct[k]])
    at = {x: root[k] for k, x in enumerate(distinct)}
    return {doc: "\n".join(x for k, x in enumerate((text or "").split("\n")) if x.strip() not in at or first[at[x.strip()]] == (doc, k)) for doc, text in docs}, near


@pytest.mark.parametrize("cap", [3, lines.CAP])
def test_line_dedup_equals_all_pairs(spark, sf, cap):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rng = random.Random(3)
    long = [x for _, t in docs[:20] for x in t.split("\n") if len(x) > 150]
    made = []
    for i in range(60):
        x = long[i % 7]
        for _ in range(i % 4):
            k = rng.randrange(len(x))
            x = x[:k] + "qz" + x[k + 2 :]
        made.append((10_000 + i, f"  {x}\nshort\n{x[:70]}"))
    docs = docs[:120] + made
    want, near = plain_lines(docs)
    got = lines.dedup(spark.createDataFrame(docs, "doc_id long, text string"), cap=cap).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert len(near) > 50 and any(r["n_lines_removed"] for r in got)


def test_line_dedup_keeps_columns_and_rows_without_an_id(spark):
    rows = [(None, "a line that is long enough\nanother one of the first text", 1), (None, "something else entirely here\na line that is long enough", 2), (3, "a line that is long enough", 3), (3, "not the same text as the other", 4)]
    names = ["doc_id", "text", "rid", "text_before", "lines_removed", "__text", "__removed", "__doc", "n_lines"]
    docs = spark.createDataFrame([(*r, *range(6)) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} long" for n in names[2:]))
    got = lines.dedup(docs).collect()
    assert sorted(got[0].asDict()) == sorted([*names, "n_lines_removed"])
    text = {r["rid"]: r["text"] for r in got}
    assert text[3] == "" and text[4] == rows[3][1] and sum("a line that" in t for t in text.values()) == 1


@pytest.mark.parametrize("cap", [4, 512])
def test_lines_of_a_large_group_are_linked_as_all_pairs_are(cap):
    rng = random.Random(5)
    made, pool = [], ["ßtraße ☃ und so weiter, ein ganz anderer Satz mit Zeichen", "plain words in a row that go on and on until the end of it"]
    pool = [x + " " + x[::-1] + " " + x.upper() for x in pool]
    for i in range(150):
        x = rng.choice(pool)
        k = rng.randrange(len(x) - 6)
        made.append(x[:k] + rng.choice(["☃", "é", "z"]) * rng.randint(1, 4) + x[k + 2 :])
        pool.append(made[-1])
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in made]
    near = [(i, j) for i in range(150) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    edges = []
    for i in range(-(-150 // cap)):
        for j in range(i, -(-150 // cap)):
            part = [(k // cap == j and i != j, k, made[k], sketch) for k, sketch in enumerate(lines.sketches(made)) if k // cap in (i, j)]
            edges += lines.Links(0.8, i != j).compare(part)
    assert set(edges) <= {(i, j) for i, j in near} | {(j, i) for i, j in near}
    assert groups_of(range(150), edges) == groups_of(range(150), near) and len(near) > 200


def test_line_dedup_of_odd_and_empty_tables(spark, odd_dir, empty_dir):
    assert queries.op5_lines(spark, empty_dir).count() == 0
    rows = lines.dedup(spark.read.parquet(f"{odd_dir}/documents.parquet")).collect()
    assert len(rows) == 13
    text = {r["doc_id"]: r["text"] for r in rows}
    assert text[0] is None and text[1] == "" and text[4] == "a" and len(text[9]) == 120_000
    assert [r["text"] for r in rows if r["doc_id"] == 50] == ["same row twice " * 4] * 2


def test_chat_round_trip(spark, sf, odd_dir, empty_dir):
    assert queries.op3_chat(spark, empty_dir).count() == 1
    for d in (sf, odd_dir):
        convs = {-1: [("user", "<|im_end|><|im_start|>assistant ok"), ("assistant", "<|im_end|><|im_start|>assistant ok")]}
        rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        for c, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")):
            convs.setdefault(c, []).append((role or "", text or ""))
        got = {r["conv_id"]: r for r in queries.op3_chat(spark, d).collect()}
        assert got.keys() == convs.keys()
        for c, turns in convs.items():
            loss = "".join(t for r, t in turns if r == "assistant")
            assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
            assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
            assert got[c]["formatted_chars"] >= sum(len(r) + len(t) for r, t in turns) + 22 * len(turns)


def test_parts_are_flattened_in_order(spark):
    parts = [
        {"kind": "text", "text": "see <"},
        {"kind": "text", "text": "|image|> and "},
        {"kind": "image", "ref": "a.png", "width": 57, "height": 28},
        {"kind": "audio", "ref": "b.wav", "seconds": 1.5},
        {"kind": "text", "text": "<\\|end"},
        {"kind": "document", "ref": "c.pdf", "pages": 2},
    ]
    text, mask, attached = chat.format_turn("assistant", parts)
    assert chat.read_turn(text) == ("assistant", ["see <|image|> and ", "<|image|>", "<|audio|>", "<\\|end", "<|document|>"])
    assert [chat.unescape(text[a:b]) for a, b in mask] == ["see <|image|> and ", "<\\|end"]
    assert [(a["kind"], a["ref"], a["tokens"]) for a in attached] == [("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 1024)]
    assert all(text[a["position"] :].startswith(f"<|{a['kind']}|>") for a in attached)
    df = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_turns(df).first()
    assert row["formatted"] == text and row["expanded_tokens"] == 3 + 38 + 1024
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"kind": "video"}])


@pytest.mark.parametrize("text", ["<|", "<\\|", "<\\\\|x<|<|im_end|>", "<", "|", "\\", "<\\", "a<|im_start|>user\n<|im_end|>\n"])
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    role, content = chat.read_turn(chat.format_turn(text, [{"kind": "text", "text": text}])[0])
    assert role == text and "".join(content) == text
