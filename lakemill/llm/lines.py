"""Fuzzy line dedup by MinHash.

Lines are stripped and named by a 64-bit hash. A line's signature takes one hash per character
shingle: the hashes fall into bins, the least of a bin counts, and an empty bin borrows from the next
full one. Bands of three bins find candidates with high recall. Of the candidate groups that are
equal in several bands one is kept, and its texts are compared by exact Jaccard similarity of their
shingles, skipping pairs that are linked already. Distributed union-find joins what is linked, and of every
component the line that comes first (by doc_id, then line number) stays.

Groups over ``CAP`` lines are cut into parts, and each pair of parts is compared by itself.

Defined results: lines shorter than a shingle are never removed; a null text stays null and an empty
one empty; a document that loses all its lines and had one is left with an empty text; rows that
repeat a doc_id and text share one fate, and so both keep a line that comes first in them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from lakemill.llm.common import append_columns, discard, fresh, keyed, materialize, slices, texts_of
from lakemill.llm.components import components

SHINGLE = 8  # characters, a power of two
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
#: Lines of a part of a candidate group, and of a group that shares a task with others.
CAP, SMALL = 512, 64
#: Bytes of text whose shingles are hashed at once.
SLICE_BYTES = 1 << 20
#: Shingles that a task holds as sets.
HELD_SHINGLES = 1_000_000
#: Lines that a task remembers as signed already.
REMEMBERED = 500_000
#: Bits of a line's sketch, a power of two.
SKETCH = 4096

_B = np.uint64(0x9E3779B97F4A7C15)
_C = np.uint64(0xC2B2AE3D27D4EB4F)


def line_id(line: str) -> int:
    """Signed 64-bit name of a stripped line."""
    h = xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 0)
    return h - (1 << 64) if h >> 63 else h


def shingles(line: str) -> set[int | str]:
    """Exact character shingles, as numbers where they have only characters up to U+00FF."""
    if len(line) < SHINGLE:
        return set()
    if line.isascii() or max(line) <= "\xff":
        return set(np.ndarray((len(line) - SHINGLE + 1,), "<u8", line.encode("latin-1"), 0, (1,)).tolist())
    parts = (line[i : i + SHINGLE] for i in range(len(line) - SHINGLE + 1))
    return {int.from_bytes(p.encode("latin-1"), "little") if max(p) <= "\xff" else p for p in parts}


def jaccard(a: set[str], b: set[str]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def _hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the shingle at each character of the joined lines, and the characters where none starts."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h, power, width = codes * _C, _B, 1
    while width < SHINGLE:
        wider = h[:-width] * power
        wider += h[width:]
        h, power, width = wider, power * power, 2 * width
    h ^= h >> np.uint64(29)
    h *= _C
    h ^= h >> np.uint64(32)
    ends = np.cumsum([len(x) for x in lines])
    return h, (ends[:-1, None] - np.arange(1, SHINGLE)).ravel()


def signatures(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) of 64-bit band keys; every line has a shingle at least."""
    bins, empty = BANDS * ROWS, np.uint64(2**64 - 1)
    with np.errstate(over="ignore"):
        h, none = _hashes(lines)
        place = h >> np.uint64(32)
        place *= np.uint64(bins)
        place >>= np.uint64(32)
        place += np.repeat(np.arange(len(lines), dtype=np.uint64) * np.uint64(bins), [len(x) for x in lines])[: len(h)]
        h *= _B
        h[none] = empty
        sig = np.full((len(lines), bins), empty)
        np.minimum.at(sig.reshape(-1), place.view(np.int64), h)
        for _ in range(2):
            for j in range(bins - 1, -1, -1):
                lent = sig[:, (j + 1) % bins] + _C
                sig[:, j] = np.where((sig[:, j] == empty) & (sig[:, (j + 1) % bins] != empty), lent, sig[:, j])
        keys = np.zeros((len(lines), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for r in range(ROWS):
            keys = (keys ^ sig[:, r::ROWS][:, :BANDS]) * _B
            keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def sketches(lines: list[str]) -> np.ndarray:
    """(lines, SKETCH / 64): bits, of which each shingle sets one."""
    if len(lines) > 1 and sum(map(len, lines)) > SLICE_BYTES:
        half = len(lines) // 2
        return np.concatenate([sketches(lines[:half]), sketches(lines[half:])])
    bits = np.zeros(len(lines) * SKETCH + 1, bool)
    with np.errstate(over="ignore"):
        h, none = _hashes(lines)
    h >>= np.uint64(64 - SKETCH.bit_length() + 1)
    h += np.repeat(np.arange(len(lines), dtype=np.uint64) * np.uint64(SKETCH), [len(x) for x in lines])[: len(h)]
    h[none] = len(bits) - 1
    bits[h.view(np.int64)] = True
    return np.packbits(bits[:-1]).view(np.uint64).reshape(len(lines), -1)


def _lines(docs: DataFrame) -> DataFrame:
    """(rid, line, more, id, bands): the different lines that have a shingle, with the numbers of the first and of further ones.

    A task gives a line's bands once, as far back as it remembers lines.
    """

    def run(batches):
        known: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rids, nos, more, ids, new, seen = [], [], [], [], [], {}
                for rid, text in zip(part.column(0).to_pylist(), texts_of(part, "text")):
                    own: dict[str, int] = {}
                    for k, line in enumerate(text.split("\n")):
                        line = line.strip()
                        if len(line) < SHINGLE:
                            continue
                        if (at := own.get(line)) is not None:
                            if more[at] is None:
                                more[at] = []
                            more[at].append(k)
                            continue
                        own[line] = len(rids)
                        ident = seen.get(line)
                        if ident is None:
                            ident = seen[line] = line_id(line)
                            first = ident not in known
                            known.add(ident)
                        else:
                            first = False
                        rids.append(rid)
                        nos.append(k)
                        more.append(None)
                        ids.append(ident)
                        new.append(line if first else None)
                if not ids:
                    continue
                lines = [x for x in new if x is not None]
                keys = signatures(lines) if lines else np.zeros((0, BANDS), np.int64)
                none = np.array([x is None for x in new])
                offsets = np.concatenate([[0], np.cumsum(np.where(none, 0, BANDS))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1), pa.int64()), mask=pa.array(none))
                columns = [pa.array(rids, pa.int64()), pa.array(nos, pa.int32()), pa.array(more, pa.list_(pa.int32())), pa.array(ids, pa.int64()), bands]
                yield pa.RecordBatch.from_arrays(columns, ["rid", "line", "more", "id", "bands"])
                if len(known) > REMEMBERED:
                    known.clear()

    return docs.select("rid", "text").mapInArrow(run, "rid long, line int, more array<int>, id long, bands array<long>")


def _candidates(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(band, id) of all groups of two and more lines, and (band, lo, id, n) of them, equal groups once; lo is a group's least id.

    All rows are dealt and sorted by band once, and few have a neighbour of their band. Those are counted
    with partial sums, so that a very common band is no task of its own.
    """

    def shared(batches):
        """Rows with a neighbour of the same band; the last row waits for the next batch."""
        last_band, last_id, last_shared = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            band, ident = (np.asarray(c) for c in batch.columns)
            if last_band is not None:
                band, ident = np.concatenate([[last_band], band]), np.concatenate([[last_id], ident])
            same = band[1:] == band[:-1]
            keep = np.concatenate([[last_shared], same]) | np.concatenate([same, [False]])
            last_band, last_id, last_shared = band[-1], ident[-1], bool(keep[-1])
            keep[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(band[keep]), pa.array(ident[keep])], ["band", "id"])
        if last_shared:
            yield pa.RecordBatch.from_arrays([pa.array([last_band]), pa.array([last_id])], ["band", "id"])

    rows = found.where("bands is not null").select(F.explode("bands").alias("band"), "id")
    rows = rows.repartition("band").sortWithinPartitions("band").mapInArrow(shared, "band long, id long").distinct()
    rows = materialize(rows, "lines-groups")
    x, y = F.bit_xor(F.xxhash64("id")), F.bit_xor(F.xxhash64("id", F.lit(1)))
    groups = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"), x.alias("x"), y.alias("y")).where("n > 1")
    kept = groups.groupBy("n", "lo", "hi", "x", "y").agg(F.min("band").alias("band")).select("band", "lo", "n")
    return rows, rows.join(kept, "band").select("band", "lo", "id", "n")


def _texts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(lo, band, n, id, body) of the candidates (rid, line, id, groups)."""
    wanted = candidates.groupBy("rid").agg(F.collect_list(F.struct("line", "id", "groups")).alias("wanted"))
    joined = docs.select("rid", "text").join(wanted, "rid").select("text", "wanted")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text, wanted in zip(texts_of(part, "text"), part.column(1).to_pylist()):
                    lines = text.split("\n")
                    for w in wanted:
                        rows.append((w["id"], lines[w["line"]].strip(), w["groups"]))
                if rows:
                    ids, bodies, groups = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.string()), pa.array(groups, part.column(1).type.value_type.field("groups").type)], ["id", "body", "groups"])

    found = joined.mapInArrow(run, "id long, body string, groups array<struct<lo:long,band:long,n:long>>")
    return found.select("id", "body", F.inline("groups"))


def _verified(candidates: DataFrame, similarity: float, cap: int) -> DataFrame:
    """From (lo, band, n, id, body) edges (a, b) that connect all lines of a group that are similar enough.

    A line has ``BANDS`` groups and no more, so at most as many share a least id. Those of them that are
    small go to one task and share shingles; every part, or pair of parts, of a large one goes by itself.
    """
    rows = candidates.withColumn("parts", F.ceil(F.col("n") / cap).cast("int")).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("lo", F.when(F.col("n") > SMALL, F.col("band")).alias("alone"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "band", (F.col("own") > F.col("other")).alias("side"), "id", "body")
    rows = rows.repartition("lo", "alone", "i", "j").sortWithinPartitions("lo", "alone", "i", "j", "band", "id")

    def run(batches):
        links, group, now, made = None, [], None, []
        for batch in batches:
            for part in slices(batch, "body", SLICE_BYTES):
                keys = zip(*(c.to_pylist() for c in part.columns[:5]))
                side, ids, bodies = (c.to_pylist() for c in part.columns[5:])
                for key, *row in zip(keys, side, ids, bodies, sketches(bodies)):
                    if key != now:
                        if group:
                            made += links.compare(group)
                        if now is None or key[:4] != now[:4]:
                            links = Links(similarity, key[2] != key[3])
                        group, now = [], key
                    group.append(row)
                if made:
                    yield _edges(made)
                    made = []
        if group:
            made += links.compare(group)
        if made:
            yield _edges(made)

    return rows.mapInArrow(run, "a long, b long")


class Links:
    """Finds the links of candidate groups that share lines; what it holds is bounded by those groups.

    The bits of two sketches differ in no more places than the lines' shingles do, so most pairs are ruled out
    by their sketches. A line's links go to lines of other clusters only. ``across``: only lines of different sides are compared.
    """

    def __init__(self, similarity: float, across: bool):
        self.similarity, self.across = similarity, across
        self.sets: dict[int, set] = {}
        self.held = 0
        self.parent: dict[int, int] = {}
        self.apart: set[tuple[int, int]] = set()

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def shingles(self, ident: int, body: str) -> set:
        found = self.sets.get(ident)
        if found is None:
            if self.held > HELD_SHINGLES:
                self.sets, self.held = {}, 0
            found = self.sets[ident] = shingles(body)
            self.held += len(found)
        return found

    def near(self, bits: list[np.ndarray], sizes: list[float]):
        """For each line those before it whose sketches allow the similarity."""
        if len(bits) <= 16:
            whole = [int.from_bytes(x.tobytes()) for x in bits]
            for k, x in enumerate(whole):
                yield [m for m in range(k) if (x ^ whole[m]).bit_count() <= sizes[k] + sizes[m]]
            return
        bits, sizes = np.array(bits), np.array(sizes)
        for k in range(len(bits)):
            yield np.flatnonzero(np.bitwise_count(bits[:k] ^ bits[k]).sum(1) <= sizes[:k] + sizes[k]).tolist()

    def compare(self, group: list[tuple[bool, int, str, np.ndarray]]) -> list[tuple[int, int]]:
        """New links of a group of (side, id, line, sketch)."""
        # a pair's shingles may differ by this share of both lines' number of them
        share = (1 - self.similarity) / (1 + self.similarity)
        sizes = [share * (len(body) - SHINGLE + 1) + 1e-6 for _, _, body, _ in group]
        edges = []
        for (side, ident, body, _), near in zip(group, self.near([bits for *_, bits in group], sizes)):
            own = self.root(ident)
            for m in near:
                other_side, other, other_body, _ = group[m]
                if self.across and side == other_side or (ident, other) in self.apart or (r := self.root(other)) == own:
                    continue
                if jaccard(self.shingles(ident, body), self.shingles(other, other_body)) >= self.similarity:
                    edges.append((ident, other))
                    self.parent[r] = own
                else:
                    self.apart.add((ident, other))
        return edges


def _edges(rows):
    a, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def removals(docs: DataFrame, similarity: float = SIMILARITY, cap: int = CAP) -> DataFrame:
    """(rid, removed array<int>): numbers of the lines that documents (rid, text) lose; rids are unique."""
    found = materialize(_lines(docs), "lines-found")
    copies = F.count(F.lit(1)) + F.count("more")
    distinct = found.groupBy("id").agg(F.min("rid").alias("rid"), F.min_by("line", "rid").alias("line"), copies.alias("n"))
    distinct = materialize(distinct, "lines-distinct")
    groups, candidates = _candidates(found)
    candidates = candidates.groupBy("id").agg(F.collect_list(F.struct("lo", "band", "n")).alias("groups"))
    candidates = distinct.select("id", "rid", "line").join(candidates, "id")
    edges = materialize(_verified(_texts(docs, candidates), similarity, cap), "lines-links")
    discard(groups)
    linked = components(edges, "lines")
    discard(edges)
    grouped = distinct.join(linked, distinct["id"] == linked["node"], "left").where("n > 1 or root is not null").select("id", "rid", "line", F.coalesce("root", "id").alias("root"))
    grouped = materialize(grouped, "lines-grouped")
    first = grouped.groupBy("root").agg(F.min(F.struct("rid", "line")).alias("keep"))
    keeper = grouped.join(first, "root").select("id", "keep")
    kept_here = F.struct("rid", "line").eqNullSafe(F.col("keep"))
    others = F.coalesce("more", F.array().cast("array<int>"))
    gone = found.select("rid", "line", "more", "id").join(keeper, "id").where(~kept_here | F.col("more").isNotNull())
    gone = gone.groupBy("rid").agg(F.flatten(F.collect_list(F.when(kept_here, others).otherwise(F.concat(F.array("line"), others)))).alias("removed"))
    gone = materialize(gone, "lines-gone")
    discard(found, distinct, grouped)
    return gone


def dedup(docs: DataFrame, similarity: float = SIMILARITY, cap: int = CAP) -> DataFrame:
    """``docs`` with text rewritten and n_lines, n_lines_removed added."""
    rid, before, out_name = (fresh(docs, x) for x in ("rid", "text_before", "lines_removed"))
    rows, distinct = keyed(docs, rid)
    gone = removals(distinct.select(F.col(rid).alias("rid"), "text"), similarity, cap).toDF(rid, out_name)
    joined = rows.join(gone.hint("merge"), rid, "left").drop(rid).withColumnRenamed("text", before)

    def start():
        def f(batch):
            texts, counts, removed = [], [], []
            names = batch.schema.names
            for text, gone in zip(batch.column(names.index(before)).to_pylist(), batch.column(names.index(out_name)).to_pylist()):
                lines, out = (text or "").split("\n"), set(gone or ())
                texts.append(text if not out else "\n".join(x for k, x in enumerate(lines) if k not in out))
                counts.append(len(lines))
                removed.append(len(out))
            return [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]

        return f

    fields = [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_lines_removed", T.LongType())]
    return append_columns(joined, fields, start, before).drop(before, out_name)
