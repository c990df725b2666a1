"""Benchmark decontamination by Wu-Manber multi-pattern search.

Test items become windows of consecutive words. A block shift table over the first bytes of all
windows tells how far a position can be skipped; where the shift is zero, the bucket of the block's
hash names the windows to compare directly. Many places of a batch are scanned in step with numpy,
each with its own pointer, so skipping is kept while Python's cost is shared.

Defined results: a null or wordless text has no words and no hits; a null or wordless item has no
window; an item without an id counts under the empty id; items with equal text all count; repeated rows
are judged each on their own; very long texts are read whole, one to a batch; an empty benchmark leaves every
document clean and an empty table has no rows. Extra columns pass through, columns with the name of an
output are replaced.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import append_columns, bytes_of, fresh, materialize, slices

#: Words of a window.
WINDOW = 10
#: Bytes of item text that one matcher may hold; larger benchmarks are searched block by block.
BLOCK_BYTES = 2 << 20
#: Pattern lengths that get a matcher of their own, so that short patterns do not spoil the shifts of long ones.
LENGTH_CLASSES = (0, 16, 32)

_WORD = bytes(b if chr(b).isalnum() or b >= 0x80 else 32 for b in range(256)).lower()


def normalize(text: bytes) -> list[bytes]:
    """Words: runs of a-z, 0-9 and everything beyond ASCII, A-Z lower-cased."""
    return text.translate(_WORD).split()


class WuManber:
    """Finds all occurrences of byte patterns in a buffer."""

    BITS = 18
    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
    LANE = 4096

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = min(map(len, patterns))
        self.block = min(8, self.m)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        heads = np.frombuffer(b"".join(p[: self.m] for p in patterns) + bytes(8), np.uint8)
        blocks = self.m - self.block + 1
        self.shift = np.full(1 << self.BITS, blocks, np.int32)
        starts = np.arange(len(patterns)) * self.m
        for j in range(blocks):
            np.minimum.at(self.shift, self._hash(heads, starts + j), blocks - 1 - j)
        self.buckets: dict[int, list[int]] = {}
        for k, h in enumerate(self._hash(heads, starts + blocks - 1).tolist()):
            self.buckets.setdefault(h, []).append(k)

    def _hash(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        words = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
        with np.errstate(over="ignore"):
            return ((words[at] & self.mask) * self.MULTIPLIER) >> np.uint64(64 - self.BITS)

    def find(self, text: bytes) -> list[tuple[int, int]]:
        """(start, pattern) of every occurrence; ``text`` must end in 8 spare bytes."""
        n, first = len(text) - 8, self.m - self.block
        if n < self.m:
            return []
        buf = np.frombuffer(text, np.uint8)
        at = np.arange(first, n - self.block + 1, self.LANE)
        end = np.minimum(at + self.LANE, n - self.block + 1)
        found, hashes = [], []
        while len(at):
            h = self._hash(buf, at)
            step = self.shift[h]
            hit = step == 0
            if hit.any():
                found.append(at[hit])
                hashes.append(h[hit])
            at = at + np.maximum(step, 1)
            on = at < end
            at, end = at[on], end[on]
        out = []
        for positions, hs in zip(found, hashes):
            for p, h in zip(positions.tolist(), hs.tolist()):
                start = p - first
                for k in self.buckets.get(h, ()):
                    if text.startswith(self.patterns[k], start):
                        out.append((start, k))
        return out


class Matcher:
    """Windows of test items and the items each stands for."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            words = normalize(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(b" " + b" ".join(words[i : i + window]) + b" ", set()).add(item)
        by_class: dict[int, list[bytes]] = {}
        for p in owners:
            by_class.setdefault(sum(len(p) >= c for c in LENGTH_CLASSES), []).append(p)
        self.owners = owners
        self.searches = [WuManber(ps) for ps in by_class.values()]

    def scan(self, docs: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Per document: its number of words, the hit word ranges, the items that occur."""
        words = [normalize(d) for d in docs]
        text = b"\n".join(b" " + b" ".join(w) + b" " if w else b"" for w in words) + b"\n" + bytes(8)
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        firsts = np.cumsum([0, *(len(w) + 1 if w else 0 for w in words)])
        out = [(len(w), [], set()) for w in words]
        for search in self.searches:
            found = search.find(text)
            if not found:
                continue
            rank = np.searchsorted(spaces, [s for s, _ in found])
            doc = np.searchsorted(firsts, rank, "right") - 1
            for (_, k), r, d in zip(found, rank.tolist(), doc.tolist()):
                p = search.patterns[k]
                w = r - int(firsts[d])
                out[d][1].append((w, w + p.count(b" ") - 1))
                out[d][2].update(self.owners[p])
        return out


def covered(ranges: list[tuple[int, int]]) -> int:
    """Words covered by half-open ranges, each counted once."""
    total = end = 0
    for a, b in sorted(ranges):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256, contaminated.

    The benchmark's size is measured first. Up to ``block_bytes`` it goes to the tasks in one piece. A larger one is
    searched block by block, the driver holding one block at a time; each pass keeps the hits alone, which meet in the end.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("body")).where("body is not null")
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("item", "body"), F.lit(blocks))
    held = (items if blocks == 1 else items.where(block == k) for k in range(blocks))
    rows = ([(r["item"], bytes(r["body"])) for r in mine.toLocalIterator()] for mine in held)
    if blocks == 1:
        return append_columns(docs, RESULT, _scanner(next(rows), window, text_col), text_col)
    rid = fresh(docs, "rid")
    docs = materialize(docs.withColumn(rid, F.monotonically_increasing_id()), "decontaminate-docs")
    texts = docs.select(F.col(rid).alias("rid"), F.col(f"`{text_col}`").alias("text"))
    found = [materialize(_hits(texts, mine, window), "decontaminate-hits").written_to for mine in rows]
    hits = docs.sparkSession.read.schema(HITS).parquet(*found).groupBy("rid").agg(F.collect_list("ranges").alias("ranges"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    ranges, names = fresh(docs, "ranges"), fresh(docs, "items_found")
    joined = docs.join(hits.toDF(rid, ranges, names), rid, "left").drop(rid)

    def start():
        def judge(batch):
            columns = batch.schema.names
            at, ids = (batch.column(columns.index(c)).to_pylist() for c in (ranges, names))
            return _judged([(len(normalize(t)), np.frombuffer(b"".join(a or ()), "<i8").reshape(-1, 2).tolist(), i or ()) for t, a, i in zip(bytes_of(batch, text_col), at, ids)])

        return judge

    return append_columns(joined, RESULT, start, text_col).drop(ranges, names)


HITS = "rid long, ranges binary, items array<string>"


def _hits(texts: DataFrame, items: list[tuple[str, bytes]], window: int) -> DataFrame:
    """(rid, ranges, items) of the documents in which windows of these items occur."""

    def run(batches):
        matcher = Matcher(items, window)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [(rid, np.array(r, "<i8").tobytes(), sorted(i)) for rid, (_, r, i) in zip(part.column(0).to_pylist(), matcher.scan(bytes_of(part, "text"))) if r]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.list_(pa.string())))], ["rid", "ranges", "items"])

    return texts.mapInArrow(run, HITS)


def _judged(got) -> list[pa.Array]:
    """The columns of RESULT from (number of words, hit ranges, items) of each document."""
    hits = [covered(r) for _, r, _ in got]
    digests = [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for _, _, i in got]
    return [pa.array([n for n, _, _ in got], pa.int64()), pa.array(hits, pa.int64()), pa.array([len(i) for _, _, i in got], pa.int64()), pa.array(digests, pa.string()), pa.array([h > 0 for h in hits], pa.bool_())]


def _scanner(items, window, text_col):
    def start():
        matcher = Matcher(items, window)
        return lambda batch: _judged(matcher.scan(bytes_of(batch, text_col)))

    return start
