"""Phrases whose words keep together, mined from count tries of bounded depth.

1. Each task counts SHARD words at a time in a trie of depth 4: level by level, a node is a pair of its parent and a word,
   in sorted order, with the number of times its words stand in a row. Nothing is pruned.
2. A trie is serialised in that order, cut at the borders of prefix ranges, one row a range. Borders may lie at any
   depth, so that the phrases of a very common word or pair of words take several ranges; they are quantiles of the trie of a
   bounded sample and have no effect on results. There is a range for every RANGE_BYTES of text.
3. The runs of a range are merged, again level by level: a shard has a phrase once, so a range's size does not depend
   on how often a phrase occurs. Nodes of LEAST occurrences in all go on; parts of a phrase are as frequent as it is.
4. The counts of a phrase's left parts come from its parent and the parent's parents (trie walk), those of its right parts
   from the node of all words but the first and that one's (suffix link), both as joins on the nodes left.

Words are 64-bit hashes of language and bytes, and equal hashes are taken for equal words: v different words have
v * v / 2^65 false pairs, 0.03 for 10^9.

Defined results: a null text has no words and a null language is ``und``, the same as texts marked so; empty tables and
languages without candidates have no rows; every row counts, repeats and rows with null or equal ids too; a text of any
length is counted in bounded parts that overlap by three words. Other columns are left out.
"""

from __future__ import annotations

import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import bytes_of, discard, materialize, slices
from lakemill.llm.words import byte_set, mix, split

DEPTH = 4
#: Occurrences of a candidate, at least.
LEAST = 30
#: A candidate goes if a longer one around it has this share, in hundredths, of its occurrences.
SHARE = 80
TOP = 2000
UNDETERMINED = "und"

BREAKS = byte_set(b".,;:!?\n\x0b\x0c\r")
SPACE = BREAKS | byte_set(b" \t")
#: Words in one trie.
SHARD = 600_000
#: Bytes of text for each prefix range.
RANGE_BYTES = 4 << 20
#: The sample that borders come from: so many texts on average, of each so many characters.
SAMPLE_TEXTS, SAMPLE_CHARS = 500, 4000


class Level(NamedTuple):
    """Nodes in order; parents are numbers in the level before, symbols numbers in the table of symbols."""

    parent: np.ndarray
    symbol: np.ndarray
    count: np.ndarray


def _grouped(code: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct codes in order, the number of each code among them, sums of counts)."""
    if not len(code):
        return code, np.zeros(0, np.int32), np.zeros(0, np.int64)
    order = np.argsort(code, kind="stable")  # merges runs that are in order
    in_order = code[order]
    new = np.concatenate([[True], in_order[1:] != in_order[:-1]])
    starts = np.flatnonzero(new)
    of = np.empty(len(code), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    sums = np.diff(np.append(starts, len(code))) if count is None else np.add.reduceat(count[order], starts)
    return in_order[starts], of, sums.astype(np.int64)


def count_trie(words: np.ndarray, piece: np.ndarray, limit: int | None = None) -> tuple[np.ndarray, np.ndarray, list[Level]]:
    """(symbols in order, first word with each, levels) of the phrases within pieces that start before word ``limit``."""
    limit = len(words) if limit is None else limit
    symbols, first, ids = np.unique(words, return_index=True, return_inverse=True)
    v, first, ids = len(symbols), first.astype(np.int32), ids.astype(np.int32)
    levels = [Level(np.zeros(v, np.int32), np.arange(v, dtype=np.int32), np.bincount(ids[:limit], minlength=v))]
    node = ids
    for n in range(2, DEPTH + 1):
        m = max(0, min(limit, len(words) - n + 1))
        inside = np.flatnonzero(piece[:m] == piece[n - 1 : n - 1 + m])
        code, of, count = _grouped(node[inside] * np.int64(v) + ids[n - 1 :][inside])
        levels.append(Level((code // v).astype(np.int32), (code % v).astype(np.int32), count.astype(np.int32)))
        node = np.zeros(m, np.int32)
        node[inside] = of
    return symbols, first, levels


def _cuts(symbols: np.ndarray, levels: list[Level], borders: np.ndarray) -> np.ndarray:
    """For each border (a row of symbols, zeros behind) the first node of every level that is not before it."""
    out = np.zeros((len(borders), len(levels)), np.int64)
    for k, border in enumerate(borders):
        on, at = True, 0
        for d, level in enumerate(levels):
            if not on:
                at = np.searchsorted(level.parent, at)
            else:
                a, z = (0, len(level.symbol)) if d == 0 else np.searchsorted(level.parent, [node, node + 1])
                s = np.searchsorted(symbols, border[d])
                node = a + np.searchsorted(level.symbol[a:z], s)
                on = bool(s < len(symbols) and symbols[s] == border[d] and node < z and level.symbol[node] == s and border[d])
                deeper = on and d + 1 < len(levels) and border[d + 1] != 0
                at, on = node + deeper, deeper
            out[k, d] = at
    return out


def _small(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def serialised(symbols: np.ndarray, levels: list[Level], borders: np.ndarray, word_of, lang_of: np.ndarray, langs: list):
    """(range, bytes) of every prefix range that has nodes. ``word_of(numbers)``: (lengths, joined bytes) of the words of symbols."""
    from zstandard import compress

    cuts = np.vstack([np.zeros((1, len(levels)), np.int64), _cuts(symbols, levels, borders), [[len(x.symbol) for x in levels]]])
    for k in range(len(cuts) - 1):
        own, z = cuts[k], cuts[k + 1]
        if not (z > own).any():
            continue
        a, parts = own.copy(), []
        for d in range(len(levels) - 1, -1, -1):
            level = levels[d]
            count = level.count[a[d] : z[d]].copy()
            count[: own[d] - a[d]] = 0  # counted in the range before; it is here for what stands below it
            parent = level.parent[a[d] : z[d]]
            if d and len(parent):
                a[d - 1] = min(a[d - 1], parent[0])
            elif d:
                a[d - 1] = min(a[d - 1], z[d - 1])
            parts.append((parent, level.symbol[a[d] : z[d]], count))
        parts.reverse()
        used, local = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
        at, out = 0, []
        for d, (parent, symbol, count) in enumerate(parts):
            children = np.bincount(parent - a[d - 1], minlength=len(parts[d - 1][1])) if d else np.zeros(0, np.int64)
            out.append((_small(children), _small(local[at : at + len(symbol)]), _small(count)))
            at += len(symbol)
        first = levels[0].symbol[a[0] : z[0]]
        yield k, compress(pickle.dumps((symbols[used], out, word_of(first), _small(lang_of[first]), langs)), 1)


def merged(runs: list[bytes], least: int) -> dict[str, list]:
    """Rows of the nodes of ``least`` occurrences, and each language's number of words (depth 0), of one range's runs."""
    from zstandard import decompress

    runs = [pickle.loads(decompress(r)) for r in runs]
    symbols, table = np.unique(np.concatenate([r[0] for r in runs]), return_inverse=True)
    v = len(symbols)
    ends = np.cumsum([0, *(len(r[0]) for r in runs)])
    tables = [table[a:z] for a, z in zip(ends, ends[1:])]
    rows = {c: [] for c in ROWS}
    paths: list[np.ndarray] = []
    of = None
    for d in range(DEPTH):
        symbol = np.concatenate([t[r[1][d][1]] for t, r in zip(tables, runs)])
        count = np.concatenate([r[1][d][2].astype(np.int64) for r in runs])
        if d == 0:
            code = symbol
        else:
            numbers, at = [], 0
            for r in runs:
                children = r[1][d][0]
                numbers.append(np.repeat(of[at : at + len(children)], children))
                at += len(children)
            code = np.concatenate(numbers) * np.int64(v) + symbol
        nodes, of, total = _grouped(code, count)
        paths = [nodes] if d == 0 else [p[nodes // v] for p in paths] + [nodes % v]
        keep = np.flatnonzero(total >= least)
        if d == 0:
            word, lang = _first_words(runs, of, keep, len(nodes))
            _add(rows, *_language_totals(runs, count))
        _add(rows, np.full(len(keep), d + 1), total[keep], [symbols[p[keep]].view(np.int64) for p in paths], word if d == 0 else None, lang if d == 0 else None)
    return rows


def _first_words(runs, of, keep, n):
    """Word and language of the nodes of depth 1 to keep, from the first run that has each."""
    wanted = np.full(n, -1)
    wanted[keep] = np.arange(len(keep))
    words, langs, at = [None] * len(keep), [None] * len(keep), 0
    for symbols, levels, (lengths, joined), lang_of, names in runs:
        m = len(levels[0][1])
        ends = np.cumsum(lengths, dtype=np.int64)
        to = wanted[of[at : at + m]]
        for k in np.flatnonzero(to >= 0).tolist():
            words[to[k]], langs[to[k]] = joined[ends[k] - lengths[k] : ends[k]], names[lang_of[k]]
        wanted[of[at : at + m]] = -1
        at += m
    return words, langs


def _language_totals(runs, count):
    totals: dict = {}
    at = 0
    for _, levels, _, lang_of, names in runs:
        n = np.bincount(lang_of, count[at : at + len(lang_of)], len(names))
        at += len(lang_of)
        for k, name in enumerate(names):
            totals[name] = totals.get(name, 0) + int(n[k])
    totals = {k: n for k, n in totals.items() if n}
    return np.zeros(len(totals), np.int64), list(totals.values()), [], None, list(totals)


ROWS = ["depth", "f", "u1", "u2", "u3", "u4", "word", "lang"]


def _add(rows: dict[str, list], depth, f, path, word, lang) -> None:
    n = len(depth)
    for name, values in zip(ROWS, [depth, f, *path, *[None] * (DEPTH - len(path)), word, lang]):
        rows[name] += [None] * n if values is None else values if isinstance(values, list) else values.tolist()


def _symbols(hashes: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Words of a language; 0 stands for none."""
    return np.maximum(mix(hashes ^ mix(salt)), np.uint64(1))


def borders_of(texts: list[bytes], salts: list[int], n: int) -> np.ndarray:
    """n - 1 rows of four symbols that part the phrases of a sample evenly."""
    w = split(texts, SPACE, True, BREAKS)
    if n < 2 or not len(w.hash):
        return np.zeros((0, DEPTH), np.uint64)
    symbols, _, levels = count_trie(_symbols(w.hash, np.array(salts, np.int64).view(np.uint64)[w.text]), w.breaks)
    paths, rows = [], []
    for d, level in enumerate(levels):
        paths = [p[level.parent] for p in paths] + [symbols[level.symbol]]
        rows.append(np.column_stack([*paths, *[np.zeros(len(level.symbol), np.uint64)] * (DEPTH - d - 1)]))
    rows = np.vstack(rows)
    rows = rows[np.lexsort(rows.T[::-1])]
    found = rows[np.linspace(0, len(rows), n + 1)[1:-1].astype(np.int64)]
    return found[np.concatenate([[True], (found[1:] != found[:-1]).any(1)])]


def _runs(docs: DataFrame, borders: np.ndarray) -> DataFrame:
    """(part, run): the serialised tries of (lang, salt, text), by prefix range."""

    def flush(held, last):
        """Count the words that are held in tries; those of an unfinished one stay."""
        data = np.concatenate([h[0] for h in held])
        base = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
        start, end = (np.concatenate([h[k] + b for h, b in zip(held, base)]) for k in (1, 2))
        words, lang = (np.concatenate([h[k] for h in held]) for k in (3, 4))
        pieces = np.cumsum([0, *(int(h[5][-1]) + 1 for h in held[:-1])])
        piece = np.concatenate([h[5] + p for h, p in zip(held, pieces)])
        for a in range(0, len(words), SHARD):
            z = a + SHARD + DEPTH - 1
            symbols, first, levels = count_trie(words[a:z], piece[a:z], min(SHARD, len(words) - a))
            first = first + a

            def word_of(numbers, first=first):
                s, e = start[first[numbers]], end[first[numbers]]
                lengths = e - s
                at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(s, lengths)
                return _small(lengths), data[at].tobytes()

            names, lang_of = np.unique(lang[first], return_inverse=True)
            yield from serialised(symbols, levels, borders, word_of, lang_of, [last[k] for k in names.tolist()])

    def run(batches):
        held, size, names = [], 0, {}
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                w = split(bytes_of(part, "text"), SPACE, True, BREAKS)
                if not len(w.hash):
                    continue
                numbers = np.array([names.setdefault(x, len(names)) for x in part.column(0).to_pylist()])
                salt = part.column(1).to_numpy().view(np.uint64)
                held.append((w.data, w.start, w.end, _symbols(w.hash, salt[w.text]), numbers[w.text].astype(np.int32), w.breaks))
                size += len(w.hash)
                if size >= SHARD:
                    yield from _packed(flush(held, list(names)))
                    held, size = [], 0
        if held:
            yield from _packed(flush(held, list(names)))

    return docs.select("lang", "salt", "text").mapInArrow(run, "part int, run binary")


def _packed(runs):
    for k, run in runs:
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([run], pa.binary())], ["part", "run"])


NODES = "depth int, f long, u1 long, u2 long, u3 long, u4 long, word string, lang string"


def frequent(docs: DataFrame, least: int = LEAST, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All phrases of up to four words with ``least`` occurrences, and each language's number of words in parts (depth 0)."""
    docs = docs.select(F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).withColumn("salt", F.xxhash64("lang"))
    size, n = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    size = size or 0
    place = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)).cast("int")
    sample = docs.sample(min(1.0, SAMPLE_TEXTS / max(1, n)), seed=13).select("salt", F.substring("text", F.lit(1) + place, F.lit(SAMPLE_CHARS)).alias("text")).collect()
    borders = borders_of([r["text"].encode() for r in sample], [r["salt"] for r in sample], max(1, size // range_bytes))

    def merge(batches):
        now, runs = None, []
        for batch in batches:
            for part, run in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != now and runs:
                    yield _batch(merged(runs, least))
                    runs = []
                now = part
                runs.append(run.as_buffer().to_pybytes())
        if runs:
            yield _batch(merged(runs, least))

    def _batch(rows):
        kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary(), pa.string()]
        columns = [pa.array(rows[c], t) for c, t in zip(ROWS, kinds)]
        return pa.RecordBatch.from_arrays([c.cast(pa.string()) if c.type == pa.binary() else c for c in columns], ROWS)

    runs = _runs(docs, borders).repartitionById(len(borders) + 1, "part").sortWithinPartitions("part")
    return runs.mapInArrow(merge, NODES)


def scored(nodes: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score, longer) of all candidates; longer is the most frequent phrase with one word more around it."""
    u = [f"u{k}" for k in range(1, DEPTH + 1)]
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    # of every level: the phrase, its last word, and the counts of its first 1, 2, ... and last 1, 2, ... words
    level = nodes.where("depth = 1").select("u1", "lang", F.col("word").alias("phrase"), F.col("word").alias("tail"), F.array("f").alias("heads"), F.array("f").alias("tails"))
    out, extended = [], []
    for d in range(2, DEPTH + 1):
        own = nodes.where(F.col("depth") == d).select("f", *u[:d])
        parent = level.select(*[F.col(x).alias(f"p_{x}") for x in u[: d - 1]], "lang", F.col("phrase").alias("p_phrase"), "heads")
        suffix = level.select(*[F.col(x).alias(f"s_{x}") for x in u[: d - 1]], F.col("tail"), "tails")
        walked = own.join(parent, [F.col(x) == F.col(f"p_{x}") for x in u[: d - 1]])
        linked = walked.join(suffix, [F.col(x) == F.col(f"s_{y}") for x, y in zip(u[1:d], u)])
        level = linked.select(*u[:d], "lang", F.concat_ws(" ", "p_phrase", "tail").alias("phrase"), "tail", F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"))
        extended.append(own)
        cuts = [F.struct(F.expr(f"2000000 * cast(a as decimal(38,0)) div (cast(heads[{k - 1}] as decimal(38,0)) + tails[{d - k - 1}])").alias("score"), F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"), F.col("tails")[d - k - 1].alias("r")) for k in range(1, d)]
        out.append(level.withColumn("a", F.element_at("heads", -1)).withColumn("cut", F.array_min(F.array(*cuts))))
    found = []
    for d, candidates in enumerate(out, 2):
        if d < DEPTH:
            longer = extended[d - 1]
            around = longer.select(*u[:d], "f").union(longer.select(*[F.col(x).alias(y) for x, y in zip(u[1 : d + 1], u)], "f"))
            around = around.groupBy(*u[:d]).agg(F.max("f").alias("longer")).withColumnsRenamed({x: f"a_{x}" for x in u[:d]})
            candidates = candidates.join(around, [F.col(x) == F.col(f"a_{x}") for x in u[:d]], "left")
        else:
            candidates = candidates.withColumn("longer", F.lit(None).cast("long"))
        found.append(candidates.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "longer"))
    both = found[0].union(found[1]).union(found[2])
    return both.withColumn("inside", F.coalesce(exact("longer") * 100 >= exact("a") * SHARE, F.lit(False)))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of (lang, text)."""
    nodes = materialize(frequent(docs, least, range_bytes), "phrases-nodes")
    totals = nodes.where("depth = 0").groupBy(F.col("lang").alias("of")).agg(F.sum("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored(nodes).where("not inside").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    best = materialize(best.join(totals, F.col("lang") == F.col("of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases-best")
    discard(nodes)
    return best
