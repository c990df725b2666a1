"""Removal of repeated byte strings, with suffix arrays by linear grouping construction.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document of a smaller
id, or before it in its own.

1. Every string of LENGTH bytes has an anchor, the least by hash of the ANCHOR-byte strings in it,
   leftmost if tied. Equal strings have equal anchors at the same place, so only anchors that occur
   twice matter. An anchor's context is all strings that can have it as theirs.
2. Anchors meet by hash. Of equal contexts all but the first are repeats throughout.
3. Anchors with different contexts go on with the first of each. The contexts of one anchor form a text,
   and its suffix array has equal strings side by side; all but the first of them are repeats. Contexts that
   have too few bytes around the anchor in common with any other are left out.
   Contexts come in order of occurrence and ``UNIT`` at a time; strings seen in earlier ones of the
   anchor are remembered by a 128-bit hash.
4. Each document's repeats are merged and cut out.

What has to move is a row per anchor (about one in 35 bytes), then the few contexts of step 3.

Defined results: a null text is empty; texts shorter than LENGTH are never cut; rows that repeat a doc_id come in
order of a hash of their text, and rows equal in both are one text and share the result; rows with a null id come first.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import append_columns, bytes_of, keyed, materialize, slices
from lakemill.llm.gsaca import suffix_arrays

LENGTH = 100
ANCHOR = 32  # a power of two
REACH = LENGTH - ANCHOR
#: Coarseness of the test whether contexts may share a string.
STEP = REACH // 2
#: Contexts in one suffix array.
UNIT = 16
#: Bytes of contexts whose suffix arrays are built in step.
TOGETHER = 1 << 20
#: Anchors of a task whose contexts meet before they are dealt out.
MET_TOGETHER = 250_000
#: Bytes hashed at once; positions in a piece fit in POSITION_BITS.
PIECE = 4 << 20
POSITION_BITS = 23

_RANDOM = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Inverse of _B modulo 2^64.
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _POWERS:
        _POWERS.clear()
        ones = np.ones(n + 1, np.uint64)
        ones[1:] = _B
        back = np.ones(n + 1, np.uint64)
        back[1:] = _B_INVERSE
        _POWERS[n] = np.cumprod(ones), np.cumprod(back)
    return _POWERS[n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _C
    return h ^ (h >> np.uint64(29))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash, context hash, reach code) of the anchors of all texts.

    The reach code is left * 128 + right, the context's bytes before the anchor and after it.
    """
    parts = list(_pieces(texts))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64))
    text, at, h, c, reach = (np.concatenate(x) for x in zip(*parts))
    if len(parts) > 1:  # pieces overlap, and a piece's border hides part of a context
        order = np.lexsort((-reach, at, text))
        text, at, h, c, reach = (x[order] for x in (text, at, h, c, reach))
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (at[1:] != at[:-1])])
        text, at, h, c, reach = (x[new] for x in (text, at, h, c, reach))
    return text, at, h, c, reach


def _pieces(texts: list[bytes]):
    """Anchors of pieces of the joined texts; a long text's pieces overlap by more than a context."""
    held, size = [], 0
    for k, t in enumerate(texts):
        if len(t) < LENGTH:
            continue
        for s in range(0, max(1, len(t) - 4 * LENGTH), PIECE - 4 * LENGTH):
            part = t[s : s + PIECE]
            if held and size + len(part) > PIECE:
                yield _anchors_of(held)
                held, size = [], 0
            held.append((k, s, len(t), part))
            size += len(part)
    if held:
        yield _anchors_of(held)


def _anchors_of(held):
    joined = np.frombuffer(b"".join(p for *_, p in held), np.uint8)
    lengths = np.array([len(p) for *_, p in held])
    first = np.cumsum(lengths) - lengths
    with np.errstate(over="ignore"):
        v = _RANDOM[joined]
        h, power, width = v, _B, 1
        while width < ANCHOR:
            h = h[:-width] * power + h[width:]
            power, width = power * power, 2 * width
        h = _mix(h)
        low = np.uint64((1 << POSITION_BITS) - 1)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= REACH + 1:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < REACH + 1:
            key = np.minimum(key[: len(key) - (REACH + 1 - width)], key[REACH + 1 - width :])
        # key[i] is now the anchor of the string at i; those across two texts do not count
        counts = lengths - LENGTH + 1
        inside = counts > 0
        ends = np.cumsum(counts[inside])
        starts = np.arange(ends[-1]) + np.repeat(first[inside] - ends + counts[inside], counts[inside])
        at = (key[starts] & low).astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        piece = np.searchsorted(first, at, "right") - 1
        left = np.minimum(at - first[piece], REACH)
        right = np.minimum(first[piece] + lengths[piece] - at - ANCHOR, REACH)
        forth, back = _powers(PIECE)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(v * forth[: len(v)])])
        a, b = at - left, at + ANCHOR + right
        reach = left * 128 + right
        c = _mix((sums[b] - sums[a]) * back[a] + reach.astype(np.uint64) * _C)
    text = np.array([k for k, *_ in held])[piece]
    offset = np.array([s for _, s, *_ in held])[piece]
    # at a piece's inner border the context is cut; the overlapping piece has it whole
    return text, at - first[piece] + offset, h[at], c, reach


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(h, c, rid, p, again): the anchors with their contexts.

    Of equal contexts that a task meets close together the first goes on. The others are repeats whatever other tasks
    have (again), so that a very common context is a few rows a task; their h only deals them out.
    """

    def run(batches):
        held, size = [], 0

        def flush():
            h, c, rid, p = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((p, rid, c, h))
            h, c, rid, p = (x[order] for x in (h, c, rid, p))
            again = np.concatenate([[False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])]) if len(h) else np.zeros(0, bool)
            with np.errstate(over="ignore"):
                spread = _mix((rid.astype(np.uint64) * _B) ^ p.astype(np.uint64))
            h = np.where(again, spread, h)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.where(again, h, c).view(np.int64)), pa.array(rid), pa.array(p), pa.array(again)], ["h", "c", "rid", "p", "again"])

        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rid = part.column(0).to_numpy()
                text, at, h, c, reach = anchors(bytes_of(part, "text"))
                held.append((h, c, rid[text], at << 14 | reach))
                size += len(h)
                if size > MET_TOGETHER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.select("rid", "text").mapInArrow(run, "h long, c long, rid long, p long, again boolean")


def _contexts(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h, rid, at, left, context) of the places that ``firsts`` names."""
    wanted = firsts.groupBy("rid").agg(F.collect_list(F.struct("h", "p")).alias("wanted"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = []
                for rid, text, wanted in zip(part.column(0).to_pylist(), bytes_of(part, "text"), part.column(2).to_pylist()):
                    for w in wanted:
                        at, left, right = w["p"] >> 14, w["p"] >> 7 & 127, w["p"] & 127
                        rows.append((w["h"], rid, at, left, text[at - left : at + ANCHOR + right]))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], ["h", "rid", "at", "left", "context"])

    joined = docs.select("rid", "text").join(wanted, "rid").select("rid", "text", "wanted")
    return joined.mapInArrow(run, "h long, rid long, at long, left int, context binary")


def repeats_in_units(units: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each unit of contexts (context, start, class) of all strings of LENGTH bytes; equal strings have equal classes.

    The classes come from the unit's suffix array, of which equal strings are neighbours.
    """
    sizes = [sum(len(c) + 1 for c in u) for u in units]
    joined = np.frombuffer(b"".join(c + b"\0" for u in units for c in u), np.uint8)
    lengths = np.array(sizes)
    symbols = joined.astype(np.int64) + 2
    context_lengths = np.array([len(c) for u in units for c in u])
    context_first = np.cumsum(context_lengths + 1) - context_lengths - 1
    symbols[context_first + context_lengths] = 1  # the end of a context
    symbols[np.cumsum(lengths) - 1] = 0  # the end of a unit
    sa = suffix_arrays(symbols, lengths)
    context = np.searchsorted(context_first, sa, "right") - 1
    start = sa - context_first[context]
    whole = start + LENGTH <= context_lengths[context]
    sa, context, start = sa[whole], context[whole], start[whole]
    unit = np.searchsorted(np.cumsum(lengths), sa, "right")
    new = np.ones(len(sa), bool)
    if len(sa):
        words = np.ndarray((max(0, len(joined) - 7),), "<u8", joined, 0, (1,))
        a, b = sa[:-1], sa[1:]
        differs = unit[1:] != unit[:-1]
        for k in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
            differs |= words[a + k] != words[b + k]
        new[1:] = differs
    label = np.cumsum(new)
    firsts = np.cumsum([0, *(len(u) for u in units)])
    ends = np.searchsorted(unit, np.arange(len(units) + 1))
    return [(context[x:y] - firsts[k], start[x:y], label[x:y]) for k, (x, y) in enumerate(zip(ends, ends[1:]))]


def sharing(rows: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, bytes]]:
    """The contexts (rid, at, left, context) of an anchor that may share a string of LENGTH bytes with another.

    Such a string reaches a bytes before the anchor and REACH - a after it. Rounded down and up to a multiple of STEP,
    some a is one for which both have the bytes from there to STEP less than REACH - a after the anchor.
    """
    kept = np.zeros(len(rows), bool)
    for a in range(0, REACH + 1, STEP):
        b = max(0, REACH - a - STEP)
        keys = [c[left - a : left + ANCHOR + b] if a <= left and len(c) >= left + ANCHOR + b else None for _, _, left, c in rows]
        n = Counter(keys)
        n[None] = 0
        kept |= [n[k] > 1 for k in keys]
    return [r for r, k in zip(rows, kept) if k]


def _repeats(contexts: DataFrame) -> DataFrame:
    """(rid, start, end) of the repeats among the different contexts of each anchor."""

    def flush(groups):
        """Groups are lists of (rid, at, left, context), in order; all are cut into units."""
        groups = [g for rows in groups if len(g := sharing(rows)) > 1]
        units = [(g, k, rows[k : k + UNIT]) for g, rows in enumerate(groups) for k in range(0, len(rows), UNIT)]
        units.sort(key=lambda u: sum(len(r[3]) for r in u[2]))
        found: dict[tuple[int, int], tuple] = {}
        held, size = [], 0
        for u in units + [None]:
            if held and (u is None or size > TOGETHER):
                for (g, k, _), got in zip(held, repeats_in_units([[r[3] for r in rows] for _, _, rows in held])):
                    found[g, k] = got
                held, size = [], 0
            if u is not None:
                held.append(u)
                size += sum(len(r[3]) for r in u[2])
        out = []
        for g, rows in enumerate(groups):
            # where each string of earlier units starts first; one place can lie in several contexts
            seen: dict[int, tuple[int, int]] = {}
            for k in range(0, len(rows), UNIT):
                context, start, label = found.pop((g, k))
                rids = np.array([r[0] for r in rows[k : k + UNIT]])[context]
                places = np.array([r[1] - r[2] for r in rows[k : k + UNIT]])[context] + start
                order = np.lexsort((places, rids, label))
                context, start, label, rids, places = (x[order] for x in (context, start, label, rids, places))
                head = np.concatenate([[True], label[1:] != label[:-1]]) if len(label) else np.zeros(0, bool)
                heads = np.flatnonzero(head)[np.cumsum(head) - 1]
                again = (rids != rids[heads]) | (places != places[heads])
                if len(rows) > UNIT:
                    from xxhash import xxh3_128_intdigest

                    for n in np.flatnonzero(~again).tolist():
                        s = int(start[n])
                        name, here = xxh3_128_intdigest(rows[k + int(context[n])][3][s : s + LENGTH]), (int(rids[n]), int(places[n]))
                        before = seen.get(name)
                        again[n] = before is not None and before < here
                        if not again[n]:
                            seen[name] = here
                # neighbouring repeats become one span
                order = np.lexsort((start[again], context[again]))
                c, s = context[again][order], start[again][order]
                cut = np.concatenate([[True], (c[1:] != c[:-1]) | (s[1:] > s[:-1] + LENGTH)]) if len(c) else np.zeros(0, bool)
                at = np.flatnonzero(cut)
                for x, y in zip(at.tolist(), [*(at[1:] - 1).tolist(), len(c) - 1]):
                    rid, pos, left, _ = rows[k + int(c[x])]
                    out.append((rid, pos - left + int(s[x]), pos - left + int(s[y]) + LENGTH))
        return out

    def run(batches):
        groups, now, size = [], None, 0
        for batch in batches:
            for part in slices(batch, "context"):
                for h, *row in zip(*(c.to_pylist() for c in part.columns)):
                    if h != now:
                        if size > 2 * TOGETHER:
                            yield _spans(flush(groups))
                            groups, size = [], 0
                        groups.append([])
                        now = h
                    groups[-1].append(row)
                    size += len(row[3])
        if groups:
            yield _spans(flush(groups))

    ordered = contexts.repartition("h").sortWithinPartitions("h", "rid", "at").select("h", "rid", "at", "left", "context")
    return ordered.mapInArrow(run, "rid long, start long, end long")


def _spans(rows):
    rid, start, end = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rid, start, end)], ["rid", "start", "end"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(rid, spans) of all documents of (rid, text) with repeats; spans may overlap."""
    rows = _anchor_rows(docs).repartition("h")
    by_context = Window.partitionBy("h", "c").orderBy("rid", "p")
    rows = rows.withColumn("nth", F.row_number().over(by_context))
    by_anchor = Window.partitionBy("h")
    rows = rows.withColumn("n", F.count(F.lit(1)).over(by_anchor)).withColumn("several", F.min("c").over(by_anchor) != F.max("c").over(by_anchor))
    met = rows.where("again or n > 1 and (nth > 1 or several)").select("h", "rid", "p", F.when(F.col("again"), 2).otherwise(F.col("nth")).alias("nth"))
    met = materialize(met, "substrings-met")
    left, right = F.expr("(p >> 7) & 127"), F.expr("p & 127")
    at = F.expr("p >> 14")
    same = met.where("nth > 1").select("rid", (at - left).alias("start"), (at + ANCHOR + right).alias("end")).where(F.col("end") - F.col("start") >= LENGTH)
    firsts = met.where("nth = 1").select("h", "rid", "p")
    other = materialize(_repeats(_contexts(docs, firsts)), "substrings-other")
    return same.union(other).groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def cut(text: bytes, spans: list[dict]) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    out, n, end = [], 0, 0
    for s in sorted((s["start"], s["end"]) for s in spans):
        if s[0] > end or n == 0:
            out.append(text[end : s[0]])
            n += 1
        end = max(end, s[1])
    return b"".join(out) + text[end:], n


FIELDS = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType())]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256), kept being the remaining bytes."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows, distinct = keyed(docs, "rid")
    spans = materialize(repeated_spans(distinct), "substrings-spans")
    joined = rows.join(spans.withColumnRenamed("rid", "r"), F.col("rid") == F.col("r"), "left").select("doc_id", "text", "spans")

    def start():
        def f(batch):
            texts = bytes_of(batch, "text")
            done = [cut(t, s) if s else (t, 0) for t, s in zip(texts, batch.column(2).to_pylist())]
            return [
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([len(t) - len(k) for t, (k, _) in zip(texts, done)], pa.int64()),
                pa.array([n for _, n in done], pa.int64()),
                pa.array([k for k, _ in done], pa.binary()),
                pa.array([hashlib.sha256(k).hexdigest() for k, _ in done], pa.string()),
            ]

        return f

    return append_columns(joined, FIELDS, start).select("doc_id", *[f.name for f in FIELDS])
