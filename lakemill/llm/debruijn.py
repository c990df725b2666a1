"""Removal of repeated word windows, by compaction of the De Bruijn graph of 13-word edges.

A word goes if a window of ``WINDOW`` words that covers it also starts in a document of a smaller id.

Every window is an edge of the graph, from its first 12 words to its last 12. Edges are never listed one by one:

1. Of the ANCHOR-word strings in a window the least by hash is its anchor, leftmost if tied. Neighbouring windows with
   one anchor make a path piece of 13 to 22 words, about one in five words. Its name is (hash of anchor, hash of words).
   Equal pieces that a task meets close together are one row; the later documents' are repeats whatever other tasks have.
2. Anchors that occur in one document alone are dropped (a join on the anchor). The pieces left meet by name, which gives
   the first document with each, and the only piece that follows it or comes before it, if there is one alone.
3. Repeated pieces that follow each other everywhere are a nonbranching path. They are joined by their coordinates in
   the first document that has them, and only a path's head goes on, with the length of the path.
4. Pieces of one anchor with different words can share windows too. Those that agree in five words on one side of it
   spell out their windows, which meet by hash; repeated ones in a row become a span.
5. Each span, from 3 or 4, names its place in the earlier document. Digests of the words at both places must agree.

Defined results: a null text has no words; texts under WINDOW words stay; a very long text is one row of one task, which
takes some 60 bytes a word; rows with a null doc_id come first, and rows that share an id come in order of a hash of their text
(the later one loses what they share); rows equal in both are one text and share the result, so that a repeat within one
document, or between equal rows, stays. Other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import append_columns, bytes_of, discard, keyed, materialize, slices
from lakemill.llm.words import C, Words, mix, split

WINDOW = 13
ANCHOR = 4
#: A window has at least this many words on one side of its anchor.
SIDE = (WINDOW - ANCHOR + 1) // 2
#: Pieces of a task that meet before they are dealt out.
MET_TOGETHER = 250_000

_B = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 28) - 1)
_SIDE_BITS = 13

# a code is at << 32 | left side << 19 | right side << 6 | number of words << 1 | whether the document has it twice
AT, LEFT, RIGHT, N, TWICE = "p >> 32", f"(p >> {6 + _SIDE_BITS}) & 8191", "(p >> 6) & 8191", "(p >> 1) & 31", "p & 1"


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """An unmixed hash of each n successive words; its parts are joined by doubling."""
    with np.errstate(over="ignore"):
        out, have, g, width = None, 0, h, 1
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                # the part found so far goes behind this one
                out = g if out is None else g[: len(h) - width - have + 1] * np.uint64(pow(int(_B), have, 1 << 64)) + out[width:]
                have += width
            if 2 * width <= n:
                g = g[:-width] * np.uint64(pow(int(_B), width, 1 << 64)) + g[width:]
                width *= 2
    return out


def windows(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers at which a window of one text starts, hash of the window at every word number)."""
    if len(w.hash) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.flatnonzero(w.text[: len(w.text) - WINDOW + 1] == w.text[WINDOW - 1 :]), mix(grams(w.hash, WINDOW))


def pieces(w: Words) -> tuple[np.ndarray, ...]:
    """(text, first word in the text, number of words, hash of the anchor, hash of the words, left and right side) of all path pieces."""
    whole, e = windows(w)
    if not len(whole):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64, np.int64))
    g = mix(grams(w.hash, ANCHOR))
    key = (g & ~_LOW) | np.arange(len(g), dtype=np.uint64)
    width, reach = 1, WINDOW - ANCHOR + 1
    while 2 * width <= reach:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < reach:
        key = np.minimum(key[: len(key) - (reach - width)], key[reach - width :])
    anchor = (key[whole] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    first, last, anchor = whole[new], whole[np.concatenate([new[1:] - 1, [len(whole) - 1]])], anchor[new]
    n = last - first + WINDOW
    side = mix(grams(w.hash, SIDE)) >> np.uint64(64 - _SIDE_BITS)
    side = np.maximum(side.astype(np.int64), 1)
    left = np.where(anchor - first >= SIDE, side[np.maximum(anchor - SIDE, 0)], 0)
    right = np.where(first + n - anchor - ANCHOR >= SIDE, side[np.minimum(anchor + ANCHOR, len(side) - 1)], 0)
    with np.errstate(over="ignore"):
        c = mix(e[first] * _B + e[last] * C + n.astype(np.uint64))
    text = w.text[first]
    base = np.searchsorted(w.text, np.arange(int(w.text[-1]) + 1))
    return text, first - base[text], n, g[anchor], c, left, right


def _rows(docs: DataFrame) -> DataFrame:
    """(h, c, rid, p, again): pieces by name, and spans that are repeats whatever other tasks have (again: c words from word p)."""

    def flush(held):
        h, c, rid, at, n, left, right = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((at, rid, c, h))
        h, c, rid, at, n, left, right = (x[order] for x in (h, c, rid, at, n, left, right))
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]) if len(h) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        least = rid[heads][np.cumsum(new) - 1] if len(h) else rid
        own = rid == least
        twice = np.zeros(len(h), np.int64)
        twice[heads] = np.concatenate([own[1:] & ~new[1:], [False]])[heads] if len(h) else 0
        p = at << 32 | left << (6 + _SIDE_BITS) | right << 6 | n << 1 | twice
        start, end, of = at[~own], (at + n)[~own], rid[~own]
        order = np.lexsort((start, of))
        start, end, of = start[order], end[order], of[order]
        cut = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (start[1:] > end[:-1])])) if len(of) else np.zeros(0, np.int64)
        ends = end[np.concatenate([cut[1:] - 1, [len(end) - 1]])] if len(of) else end
        with np.errstate(over="ignore"):
            spread = mix(of[cut].astype(np.uint64) * _B + start[cut].astype(np.uint64))
        kept = heads
        columns = [np.concatenate([h[kept], spread]).view(np.int64), np.concatenate([c[kept].view(np.int64), ends - start[cut]]), np.concatenate([rid[kept], of[cut]]), np.concatenate([p[kept], start[cut]]), np.arange(len(kept) + len(cut)) >= len(kept)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "c", "rid", "p", "again"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rid = part.column(0).to_numpy()
                text, at, n, h, c, left, right = pieces(split(bytes_of(part, "text")))
                held.append((h, c, rid[text], at, n, left, right))
                size += len(h)
                if size > MET_TOGETHER:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return docs.select("rid", "text").mapInArrow(run, "h long, c long, rid long, p long, again boolean")


def met(docs: DataFrame) -> DataFrame:
    """The rows whose anchor occurs in two documents, and those that are repeats already."""
    rows = _rows(docs)
    several = rows.where("not again").groupBy("h").agg(F.min("rid").alias("lo"), F.max("rid").alias("hi")).where("lo < hi").select(F.col("h").alias("g"))
    return rows.join(several, (F.col("h") == F.col("g")) & ~F.col("again"), "left").where("again or g is not null").drop("g")


def names(rows: DataFrame) -> DataFrame:
    """(h, c, rid, p, last, twice, before, after): each name's first place, and its only neighbours (null: none, or several)."""
    in_text = Window.partitionBy("rid").orderBy("p")
    n_of = lambda p: F.shiftright(p, 1).bitwiseAND(31)
    later, earlier = F.lead("p").over(in_text), F.lag("p").over(in_text)
    at, n = F.expr(AT), F.expr(N)
    after = F.when(F.shiftright(later, 32) == at + n - (WINDOW - 1), F.lead("c").over(in_text))
    before = F.when(F.shiftright(earlier, 32) + n_of(earlier) - (WINDOW - 1) == at, F.lag("c").over(in_text))
    rows = rows.withColumns({"after": F.coalesce(after, F.lit(0)), "before": F.coalesce(before, F.lit(0))})
    found = rows.groupBy("h", "c").agg(
        F.min(F.struct("rid", "p")).alias("first"), F.max("rid").alias("last"), F.max(F.expr(TWICE)).alias("twice"),
        *[f(x).alias(f"{x}_{k}") for x in ("before", "after") for k, f in (("lo", F.min), ("hi", F.max))],
    )
    only = [F.when((F.col(f"{x}_lo") == F.col(f"{x}_hi")) & (F.col(f"{x}_lo") != 0), F.col(f"{x}_lo")).alias(x) for x in ("before", "after")]
    return found.select("h", "c", "first.rid", "first.p", "last", "twice", *only)


def compacted(named: DataFrame) -> DataFrame:
    """(h, c, src, src_at, n, twice): the head of each repeated nonbranching path, and the path's number of words."""
    repeated = named.where("rid < last").select("h", "c", F.col("rid").alias("src"), F.expr(AT).alias("at"), F.expr(N).alias("n"), "twice", "before", "after")
    ends = repeated.where("twice = 0 and after is not null").select(F.col("src").alias("l_src"), (F.col("at") + F.col("n") - (WINDOW - 1)).alias("l_at"), F.col("c").alias("l_c"), F.col("after").alias("l_after"))
    on = [F.col("src") == F.col("l_src"), F.col("at") == F.col("l_at"), F.col("c") == F.col("l_after"), F.col("before") == F.col("l_c"), F.col("twice") == 0]
    linked = repeated.join(ends, on, "left").withColumn("head", F.col("l_c").isNull().cast("long"))
    path = F.sum("head").over(Window.partitionBy("src").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    paths = linked.withColumn("path", path).groupBy("src", "path").agg(F.min(F.struct("at", "h", "c", "twice")).alias("first"), F.max(F.col("at") + F.col("n")).alias("end"))
    return paths.select("first.h", "first.c", "src", F.col("first.at").alias("src_at"), (F.col("end") - F.col("first.at")).alias("n"), "first.twice")


def _spelt(docs: DataFrame, named: DataFrame) -> DataFrame:
    """(e, rid, at, twice): the windows of the first place of all names that may share some with another name."""
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.expr(LEFT).alias("key")), F.struct(F.lit(1).alias("side"), F.expr(RIGHT).alias("key"))))
    rows = named.select("h", "c", "rid", "p", "twice", sides.alias("x")).select("h", "c", "rid", "p", "twice", "x.side", "x.key").where("key <> 0")
    several = rows.groupBy("h", "side", "key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select(F.col("h").alias("g"), F.col("side").alias("s"), F.col("key").alias("k"))
    rows = rows.join(several, (F.col("h") == F.col("g")) & (F.col("side") == F.col("s")) & (F.col("key") == F.col("k")))
    wanted = rows.groupBy("rid").agg(F.collect_set(F.struct("p", "twice")).alias("wanted"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                if not part.num_rows:
                    continue
                w = split(bytes_of(part, "text"))
                _, e = windows(w)
                base = np.searchsorted(w.text, np.arange(part.num_rows))
                places = pa.compute.list_flatten(part.column(2))
                text = pa.compute.list_parent_indices(part.column(2)).to_numpy().astype(np.int64)
                p, twice = (places.field(k).to_numpy() for k in (0, 1))
                at, n = p >> 32, (p >> 1 & 31) - WINDOW + 1
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at, text, twice = np.repeat(at, n) + nth, np.repeat(text, n), np.repeat(twice, n)
                rid = part.column(0).to_numpy()[text]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (e[base[text] + at].view(np.int64), rid, at, twice)], ["e", "rid", "at", "twice"])

    joined = docs.select("rid", "text").join(wanted, "rid").select("rid", "text", "wanted")
    return joined.mapInArrow(run, "e long, rid long, at long, twice long")


SPAN = ["rid", "at", "n", "src", "src_at", "name", "edge"]


def _shared_windows(spelt: DataFrame) -> DataFrame:
    """Spans of windows that an earlier document has under another name. Of those their own document has twice, the edge is named."""
    firsts = spelt.groupBy("e").agg(F.min(F.struct("rid", "at")).alias("first"), F.max("rid").alias("last")).where("first.rid < last")
    firsts = firsts.select(F.col("e").alias("f"), F.col("first.rid").alias("src"), F.col("first.at").alias("src_at"))
    hits = spelt.join(firsts, F.col("e") == F.col("f")).where("rid > src")
    nil = F.lit(None).cast("long")
    apart = hits.where("twice = 1").select("rid", "at", F.lit(WINDOW).cast("long").alias("n"), "src", "src_at", nil.alias("name"), F.col("e").alias("edge"))
    hits = hits.where("twice = 0").withColumn("shift", F.col("at") - F.col("src_at"))
    nth = F.row_number().over(Window.partitionBy("rid", "src", "shift").orderBy("at"))
    runs = hits.withColumn("run", F.col("at") - nth).groupBy("rid", "src", "shift", "run").agg(F.min("at").alias("at"), F.min("src_at").alias("src_at"), (F.count(F.lit(1)) + WINDOW - 1).alias("n"))
    return runs.select("rid", "at", "n", "src", "src_at", nil.alias("name"), nil.alias("edge")).union(apart)


def _digest(words: list[bytes], at: int, n: int) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(b" ".join(words[at : at + n]))


def _sources(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(src, src_at, n, digest) of the words at the earlier places that spans name."""
    asked = spans.select("src", "src_at", "n").distinct().groupBy("src").agg(F.collect_list(F.struct("src_at", "n")).alias("asked"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rows = []
                for rid, text, asked in zip(part.column(0).to_pylist(), bytes_of(part, "text"), part.column(2).to_pylist()):
                    words = text.split()
                    rows += [(rid, a["src_at"], a["n"], _digest(words, a["src_at"], a["n"])) for a in asked]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ((),) * 4, kinds)], ["src", "src_at", "n", "digest"])

    joined = docs.select("rid", "text").join(asked, F.col("rid") == F.col("src")).select("rid", "text", "asked")
    return joined.mapInArrow(run, "src long, src_at long, n long, digest binary")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(rid, spans) of all documents of (rid, text) with repeats; spans (at, n, digest, name, edge) may overlap.

    A null digest needs no check. A name or an edge stands for every place that the document has it at.
    """
    rows = materialize(met(docs), "debruijn-met")
    once = rows.where("not again").drop("again")
    named = materialize(names(once), "debruijn-names")
    heads = compacted(named).withColumnRenamed("h", "g").withColumnRenamed("c", "d")
    whole = once.join(heads, (F.col("h") == F.col("g")) & (F.col("c") == F.col("d"))).where("rid > src")
    whole = whole.select("rid", F.expr(AT).alias("at"), "n", "src", "src_at", F.expr("if(twice = 1, c, null)").alias("name"), F.lit(None).cast("long").alias("edge"))
    whole = materialize(whole, "debruijn-whole")
    spelt = materialize(_spelt(docs, named), "debruijn-spelt")
    spans = materialize(whole.union(_shared_windows(spelt)), "debruijn-spans")
    discard(named, whole, spelt)
    digests = _sources(docs, spans).toDF("s", "s_at", "s_n", "digest")
    spans_ = spans.join(digests, (F.col("src") == F.col("s")) & (F.col("src_at") == F.col("s_at")) & (F.col("n") == F.col("s_n"))).select("rid", "at", "n", "digest", "name", "edge")
    nil = F.lit(None)
    again = rows.where("again").select("rid", F.col("p").alias("at"), F.col("c").alias("n"), nil.cast("binary"), nil.cast("long"), nil.cast("long"))
    found = materialize(spans_.union(again).groupBy("rid").agg(F.collect_list(F.struct("at", "n", "digest", "name", "edge")).alias("spans")), "debruijn-found")
    discard(rows, spans)
    return found


def gone(text: bytes, words: list[bytes], spans: list[dict]) -> np.ndarray:
    """Which words of a text its spans remove; a span whose words are not those of its source removes none."""
    edge = np.zeros(len(words) + 1, np.int64)
    spans = [s for s in spans if s["digest"] is None or s["digest"] == _digest(words, s["at"], s["n"])]
    at, n = (np.array([s[k] for s in spans], np.int64) for k in ("at", "n"))
    named, edges = ([s[k] for s in spans if s[k] is not None] for k in ("name", "edge"))
    if named or edges:
        w = split([text])
        _, first, length, _, c, _, _ = pieces(w)
        on = np.isin(c.view(np.int64), named)
        whole, e = windows(w)
        more = whole[np.isin(e[whole].view(np.int64), edges)]
        at, n = np.concatenate([at, first[on], more]), np.concatenate([n, length[on], np.full(len(more), WINDOW)])
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("kept_sha256", T.StringType())]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256), kept being the remaining words with a space between."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows, distinct = keyed(docs, "rid")
    spans = repeated_spans(distinct).withColumnRenamed("rid", "r")
    joined = rows.join(spans, F.col("rid") == F.col("r"), "left").select("doc_id", "text", "spans")

    def start():
        def f(batch):
            out = []
            for text, spans in zip(bytes_of(batch, "text"), batch.column(2).to_pylist()):
                words, n = text.split(), 0
                if spans:
                    lost = gone(text, words, spans)
                    n = int(lost.sum())
                    kept = b" ".join([x for x, y in zip(words, lost.tolist()) if not y])
                else:
                    kept = b" ".join(words)
                out.append((len(words), n, kept, hashlib.sha256(kept).hexdigest()))
            return [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.string()))][:2] + [pa.array([x[2] for x in out], pa.binary()).cast(pa.string()), pa.array([x[3] for x in out], pa.string())]

        return f

    return append_columns(joined, FIELDS, start).select("doc_id", *[f.name for f in FIELDS])
