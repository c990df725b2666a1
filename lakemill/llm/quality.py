"""Quality rules by distribution divergence.

A document's histograms over character classes and over its language's common words are compared
with those of all documents of each language by Jensen-Shannon distance. The nearest language
counts, and only for documents long enough to have a distribution; exact counting rules come first.

Defined results: a null text has no words and fails the rule on length; without any labelled
language there is no reference and only the counting rules judge; repeated rows count each time.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import append_columns, bytes_of, slices

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: Words of a language's common-word histogram; all others share one more place.
COMMON_WORDS = 64
#: Shorter documents have no distribution to compare.
LEAST_WORDS_FOR_CLASSES = 20
LEAST_WORDS_FOR_COMMON = 100
#: Largest Jensen-Shannon distances (0 to 1) to the nearest language.
MOST_CLASS_DISTANCE = 0.28
MOST_WORD_DISTANCE = 0.43
#: Words a task counts before it hands its counts on.
COUNTED_WORDS = 200_000

#: Character classes of UTF-8 bytes: 0 none (continuation), 1 lower, 2 upper, 3 digit, 4 space,
#: 5 punctuation, 6 symbol, 7 control, 8 beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        (8 if _b >= 0xC0 else 0) if _b >= 0x80 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit()
        else 4 if _b in SPACE else 5 if _c in ".,;:!?'\"()-" else 7 if _b < 32 or _b == 127 else 6
    )
CLASSES = 9
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 32 for b in range(256)).lower()


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=CLASSES)[1:] if text else np.zeros(CLASSES - 1, np.int64)


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    rank, width = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64), 1
    kinds = len(ids)
    if kinds == len(words):
        return 0
    while width < window:
        # the name of a window is a pair of names of its halves, so equal names mean equal words
        distinct, rank, counts = np.unique(rank[:-width] * kinds + rank[width:], return_inverse=True, return_counts=True)
        kinds, width = len(distinct), width * 2
        if kinds == len(rank):
            return 0
    again = counts[rank] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[window : window + n] -= again
    return int((np.cumsum(edges) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    bare = text.translate(None, SPACE)
    return len(words), len(bare.decode("utf-8", "surrogatepass")), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms."""
    p, q = p / max(p.sum(), 1), q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2)))


@dataclass
class Reference:
    classes: np.ndarray
    words: dict[bytes, int]  # common word to its place
    counts: np.ndarray  # by place, all other words last


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, Reference]:
    """Histograms of each language over all its documents.

    Words are counted in full and only the most common ones of a language reach the driver.
    """

    def run(batches):
        classes: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def rows(kind, lang, keys, ns):
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(ns), pa.string()), pa.array([kind] * len(ns), pa.string()), pa.array(keys, pa.binary()), pa.array(ns, pa.int64())], ["lang", "kind", "key", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text, lang in zip(bytes_of(part, "text"), part.column(1).to_pylist()):
                    classes[lang] = classes.get(lang, 0) + class_counts(text)
                    words.setdefault(lang, Counter()).update(plain_words(text))
                for lang in [x for x, c in words.items() if len(c) > COUNTED_WORDS]:
                    c = words.pop(lang)
                    yield rows("word", lang, list(c), list(c.values()))
                    yield rows("all", lang, [b""], [c.total()])
        for lang, c in words.items():
            yield rows("word", lang, list(c), list(c.values()))
            yield rows("all", lang, [b""], [c.total()])
        for lang, n in classes.items():
            yield rows("class", lang, [b"%d" % i for i in range(len(n))], n)

    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    table = labelled.mapInArrow(run, "lang string, kind string, key binary, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    top = table.withColumn("r", F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))).where(F.col("r") <= COMMON_WORDS)
    out: dict[str, Reference] = {}
    held: dict[str, dict[str, dict[bytes, int]]] = {}
    for r in top.collect():
        held.setdefault(r["lang"], {}).setdefault(r["kind"], {})[bytes(r["key"])] = r["n"]
    for lang, kinds in held.items():
        words = {w: i for i, w in enumerate(sorted(kinds.get("word", {})))}
        counts = [kinds["word"][w] for w in words]
        classes = np.array([kinds["class"][b"%d" % i] for i in range(CLASSES - 1)], float)
        out[lang] = Reference(classes, words, np.array([*counts, kinds["all"][b""] - sum(counts)], float))
    return out


def distances(text: bytes, refs: list[Reference]) -> tuple[float, float]:
    """Least class distance and least common-word distance to any language."""
    classes, words = class_counts(text).astype(float), plain_words(text)
    count, least = Counter(words), 1.0
    for ref in refs:
        own = np.zeros(len(ref.counts))
        for w in ref.words.keys() & count.keys():
            own[ref.words[w]] = count[w]
        own[-1] = len(words) - own.sum()
        least = min(least, distance(own, ref.counts))
    return min((distance(classes, r.classes) for r in refs), default=0.0), least if refs else 0.0


FIELDS = [
    *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("class_distance", T.DoubleType()),
    T.StructField("word_distance", T.DoubleType()),
]


def judge(docs: DataFrame, refs: dict[str, Reference], text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, both distances (null where too short) and the verdict."""
    known = list(refs.values())

    def start():
        def f(batch):
            rows = []
            for text in bytes_of(batch, text_col):
                n, chars, symbols, dups, repeats = base_counts(text)
                failed = n < LEAST_WORDS or 100 * repeats > MOST_REPEATED_PERCENT * n
                by_class, by_word = distances(text, known) if known and n >= LEAST_WORDS_FOR_CLASSES else (None, None)
                by_word = by_word if n >= LEAST_WORDS_FOR_COMMON else None
                fits = (by_class or 0) <= MOST_CLASS_DISTANCE and (by_word or 0) <= MOST_WORD_DISTANCE
                rows.append((n, chars, symbols, dups, repeats, failed, fits and not failed, by_class, by_word))
            kinds = (*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64(), pa.float64())
            return [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]

        return f

    return append_columns(docs, FIELDS, start, text_col)
