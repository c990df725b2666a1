"""SimHash near-duplicates by a binary trie self-join.

A text's fingerprint has 64 bits, each the majority over the hashes of its word shingles. Two
fingerprints that differ in at most d bits are equal in at least one of d + 1 blocks of bits, so every
fingerprint goes to one bucket per block, rearranged so that the block comes first (to one per choice
of blocks, where there are so many fingerprints that single blocks would crowd their buckets). A bucket's sorted
fingerprints are a binary trie whose nodes are ranges. Pairs of nodes go down together, the bits in
which they differ add up, and a pair is pruned once it is over the budget. Small budgets come first,
and pairs of nodes that already lie in one component are pruned as well, so a dense group costs far
less than all its pairs. A bucket hands on a star per component, never its pairs, and stars are joined
by distributed connected components.

Buckets over ``CAP`` are cut into parts, and each pair of parts is a task of its own.

Defined results: a null, empty or wordless text has fingerprint zero and links like any other;
fewer words than a shingle make one shingle; a null doc_id takes part, but is never a component's
least id unless no other is there; repeated rows get a row each.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import bytes_of, materialize, slices
from lakemill.llm.components import components

WORDS = 4
SEED = 42
BITS = 4
#: Fingerprints of a bucket that one task joins with each other.
CAP = 20_000
#: Node pairs that a task looks at together, which bounds its memory.
FRONTIER = 50_000
#: Node pairs of at most this many leaf pairs are compared leaf by leaf.
LEAVES = 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Unsigned 64-bit fingerprint of a text, A-Z lower-cased."""
    from xxhash import xxh64_intdigest

    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate([[0], ends[: -words]])
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), (ends[words - 1 :] - 1).tolist())], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                fps = np.array([fingerprint(t, words) for t in bytes_of(part, "text")], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


class Trie:
    """Labels the components of fingerprints that differ in at most ``budget`` bits.

    ``values`` are sorted and distinct. ``sides`` (0 or 1) restricts links to pairs across the two.
    """

    def __init__(self, values: np.ndarray, prefix: int, sides: np.ndarray | None = None):
        self.v, self.prefix, self.sides = values, prefix, sides
        self.label = np.arange(len(values))

    def _split(self, lo: np.ndarray, depth: int) -> np.ndarray:
        """Where the one-child of each node at ``depth`` starts."""
        head = self.v[lo] >> np.uint64(64 - depth) << np.uint64(64 - depth) if depth else np.zeros(len(lo), np.uint64)
        return np.searchsorted(self.v, head | np.uint64(1 << (63 - depth)))

    def _runs(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            on = x != y
            if not on.any():
                return
            a, b, x, y = a[on], b[on], x[on], y[on]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.label[self.label], self.label):
                self.label = up

    def join(self, budget: int) -> np.ndarray:
        heads = self.v >> np.uint64(64 - self.prefix)
        lo = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]]))
        hi = np.concatenate([lo[1:], [len(self.v)]])
        for limit in range(1, budget + 1):
            self._descend([(self.prefix, np.stack([lo, hi, lo, hi, np.zeros(len(lo), np.int64)]))], limit)
        return self.label

    def _descend(self, stack: list[tuple[int, np.ndarray]], limit: int) -> None:
        """Visit node pairs depth by depth; rows of a frontier are a's range, b's range, differing bits."""
        runs = self._runs()
        while stack:
            depth, pairs = stack.pop()
            if pairs.shape[1] > FRONTIER:
                half = pairs.shape[1] // 2
                stack += [(depth, pairs[:, :half]), (depth, pairs[:, half:])]
                continue
            alo, ahi, blo, bhi, diff = pairs
            na, nb = ahi - alo, bhi - blo
            same = (alo == blo) & (ahi == bhi)
            joined = (self.label[alo] == self.label[blo]) & (runs[ahi - 1] == runs[alo]) & (runs[bhi - 1] == runs[blo])
            on = ~(joined | same & (na < 2))
            small = on & (na * nb <= LEAVES)
            if small.any() or depth == 64:
                chosen = pairs[:, on if depth == 64 else small]
                a, b = self._leaf_pairs(chosen, limit)
                if len(a):
                    self._link(a, b)
                    runs = self._runs()
                on &= ~small
            if depth == 64 or not on.any():
                continue
            alo, ahi, blo, bhi, diff = pairs[:, on]
            same = same[on]
            am, bm = self._split(alo, depth), self._split(blo, depth)
            more = ~same
            children = np.concatenate(
                [
                    np.stack([alo, am, blo, bm, diff]),
                    np.stack([am, ahi, bm, bhi, diff]),
                    np.stack([alo, am, bm, bhi, diff + 1]),
                    np.stack([am, ahi, blo, bm, diff + 1])[:, more],
                ],
                axis=1,
            )
            kept = (children[1] > children[0]) & (children[3] > children[2]) & (children[4] <= limit)
            if kept.any():
                stack.append((depth + 1, children[:, kept]))

    def _leaf_pairs(self, pairs: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        alo, ahi, blo, bhi, _ = pairs
        na, nb = ahi - alo, bhi - blo
        at = np.repeat(np.arange(len(alo)), na * nb)
        k = np.arange(len(at)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
        a, b = alo[at] + k // nb[at], blo[at] + k % nb[at]
        near = (a != b) & (np.bitwise_count(self.v[a] ^ self.v[b]) <= limit)
        if self.sides is not None:
            near &= self.sides[a] != self.sides[b]
        return a[near], b[near]


def layouts(bits: int, spare: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Orders of the blocks (start, width), counted from the top bit, and the width of the chosen ones.

    Of bits + 1 + spare blocks, 1 + spare are equal in any two fingerprints within ``bits`` bits, so
    there is a layout for each choice of so many, which come first.
    """
    n = bits + 1 + spare
    edges = [64 * k // n for k in range(n + 1)]
    blocks = [(a, b - a) for a, b in zip(edges, edges[1:])]
    return [([blocks[k] for k in c] + [x for k, x in enumerate(blocks) if k not in c], sum(blocks[k][1] for k in c)) for c in itertools.combinations(range(n), 1 + spare)]


def spare_blocks(n: int, bits: int) -> int:
    """The fewest spare blocks with which buckets of ``n`` unrelated fingerprints hold a thousand or so."""
    return next(s for s in range(64 - bits) if n >> min(w for _, w in layouts(bits, s)) <= 1024)


def _arrange(order: list[tuple[int, int]]) -> Column:
    """The signed long whose bits are the blocks of ``fp`` in this order."""
    at, terms = 0, []
    for start, width in order:
        at += width
        terms.append(f"(((fp >>> {64 - start - width}) & {(1 << width) - 1}L) << {64 - at})")
    return F.expr(" | ".join(terms))


def _restore(v: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    at, out = 0, np.zeros_like(v)
    for start, width in order:
        at += width
        out |= (v >> np.uint64(64 - at) & np.uint64((1 << width) - 1)) << np.uint64(64 - start - width)
    return out


def links(fps: DataFrame, bits: int = BITS, cap: int = CAP) -> DataFrame:
    """Star edges (a, b) between distinct values of ``fp`` that connect all within ``bits`` bits."""
    orders = layouts(bits, spare_blocks(fps.count(), bits))
    turned = [F.struct(F.lit(k).alias("block"), _arrange(order).alias("r")) for k, (order, _) in enumerate(orders)]
    rows = fps.select(F.explode(F.array(*turned)).alias("x")).select("x.block", "x.r")
    width = F.element_at(F.array(*[F.lit(w) for _, w in orders]), F.col("block") + 1)
    rows = rows.withColumn("bucket", F.call_function("shiftrightunsigned", "r", 64 - width))
    sizes = rows.groupBy("block", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, ["block", "bucket"]).withColumn("parts", F.ceil(F.col("n") / cap).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("r"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("block", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "r")
    rows = rows.repartition("block", "bucket", "i", "j").sortWithinPartitions("block", "bucket", "i", "j")

    def stars(block, r, side):
        order, width = orders[block]
        v, first = np.unique(r.view(np.uint64), return_index=True)
        label = Trie(v, width, None if side is None else side[first]).join(bits)
        back = _restore(v, order)
        on = np.flatnonzero(label != np.arange(len(v)))
        return pa.RecordBatch.from_arrays([pa.array(back[on].view(np.int64)), pa.array(back[label[on]].view(np.int64))], ["a", "b"])

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def flush(last):
            """Join the buckets that are complete; what may go on stays."""
            block, bucket, i, j, side, r = (np.concatenate(c) for c in zip(*held))
            new = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
            end = len(r) if last else new[-1]
            held[:] = [] if last else [tuple(c[end:] for c in (block, bucket, i, j, side, r))]
            for b in np.unique(block[:end]):
                whole = (block == b) & (i == j)
                whole[end:] = False
                if whole.any():
                    yield stars(b, r[whole], None)
            for a, z in zip(new, [*new[1:], len(r)]):
                if z <= end and i[a] != j[a]:
                    yield stars(block[a], r[a:z], side[a:z])

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
                if sum(len(h[0]) for h in held) > 200_000:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS, cap: int = CAP) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row."""
    fps = materialize(fingerprints(docs, words), "simhash-fps")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = components(links(distinct, bits, cap), "simhash")
    joined = distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    joined = materialize(joined, "simhash-joined")
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = joined.join(ids, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
