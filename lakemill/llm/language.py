"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit a binary classifier over hashed character n-grams is
learned, from the n-gram counts of all training documents of the languages on either side of the
bit. A text is decoded to the codeword of the least loss, each bit weighted by how far the two sides
of its classifier lie apart; a small lead over the runner-up flags the text as ambiguous.

Defined results: a null text or one without a letter is ``und`` with score 0; without training
rows every text is ``und``; rows with a null language are not learned from; repeated rows count each
time. Extra columns pass through, columns with the name of an output are replaced.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import append_columns, slices, texts_of

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
#: Hash slots of each n-gram order, a power of two.
SLOT_BITS = 13
SLOTS = len(ORDERS) << SLOT_BITS
#: Neighbouring n-grams say much the same; their log ratios are divided by this.
TEMPERATURE = 3.0
#: Up to this number of languages every split of them is a bit; beyond it a random code is drawn.
EXHAUSTIVE = 6
#: A lead in score below this is ambiguous.
LEAD = 0.2

#: Characters whose n-grams are held at once; each takes 28 bytes a bit of four languages and 40 more.
MOST_CHARS = 1 << 18

_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of all texts, one row per order, and where each text starts.

    Lower-cased, ASCII other than letters as space; two spaces part the texts, so that no n-gram has
    characters of two.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(t + "  " for t in lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.cumsum([0, *(len(t) + 2 for t in lowered)])[:-1]
    codes = np.where((codes < 97) | (codes > 122) & (codes < 128), np.uint32(32), codes)
    out, h = np.empty((len(ORDERS), len(codes)), np.int32), codes.copy()
    back = codes
    with np.errstate(over="ignore"):
        for k, order in enumerate(ORDERS):
            if order > 1:
                back = np.concatenate([np.full(1, 32, np.uint32), back[:-1]])
                h = h * np.uint32(0x01000193) + back
            out[k] = ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)) + np.uint32(k << SLOT_BITS)
    return out, starts


def groups(texts: list[str], most: int | None = None) -> Iterator[list[str]]:
    """Runs of ``texts`` of about ``most`` characters, one text at least."""
    most, start, held = most or MOST_CHARS, 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield texts[start:]


def codewords(n: int) -> np.ndarray:
    """(n, bits) of -1 and 1 with no two rows, and no two columns, equal or opposite."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= EXHAUSTIVE:
        cols = [(1, *c) for c in itertools.product((1, -1), repeat=n - 1)]
        return np.array([c for c in cols if -1 in c], np.int8).T
    rng, best, far = np.random.default_rng(7), None, -1
    bits = 10 * int(np.ceil(np.log2(n)))
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(1 - 1)) < n]
        near = (code.shape[1] - (code.astype(int) @ code.T.astype(int))) // 2
        d = near[~np.eye(n, dtype=bool)].min()
        if d > far:
            best, far = code, d
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (slots, bits), log ratios
    reliability: np.ndarray  # (bits,)

    def decode(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        if not texts:
            return [], [], []
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
        found = [self._decode(group) for group in groups(texts)]
        return tuple([x for part in column for x in part] for column in zip(*found))

    def _sums(self, row: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The weights of each text's slots; a group of more than ``MOST_CHARS`` is a single text and is added up in pieces."""
        if len(row) <= 2 * MOST_CHARS or len(starts) > 1:
            return np.add.reduceat(self.weights[row], starts, axis=0)
        return sum(self.weights[row[i : i + MOST_CHARS]].sum(0, np.float64) for i in range(0, len(row), MOST_CHARS))[None]

    def _decode(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        slots, starts = grams(texts)
        sums = sum(self._sums(row, starts) for row in slots)
        margins = np.clip(sums / TEMPERATURE, -20, 20)
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code) * self.reliability).sum(-1)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        top = np.sort(p, axis=1)
        lead = top[:, -1] - (top[:, -2] if p.shape[1] > 1 else 0)
        known = [has_letter(t) for t in texts]
        langs = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
        scores = [float(min(1.0, x)) if k else 0.0 for x, k in zip(top[:, -1], known)]
        return langs, scores, [not k or bool(x < LEAD) for x, k in zip(lead, known)]


def count_grams(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, slot, n) over all training rows, summed in each task first."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                texts, langs = texts_of(part, "text"), part.column(1).to_pylist()
                for lang in sorted(set(langs)):
                    mine = [t for t, x in zip(texts, langs) if x == lang and has_letter(t)]
                    for group in groups(mine):
                        n = np.bincount(grams(group)[0].ravel(), minlength=SLOTS)
                        sums[lang] = sums[lang] + n if lang in sums else n
        for lang, n in sums.items():
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int32()), pa.array(n[slot], pa.int64())], ["lang", "slot", "n"])

    rows = train.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    return rows.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from every row of ``train``; what reaches the driver is bounded by languages x slots."""
    table = count_grams(train, text_col, lang_col).toPandas()
    languages = sorted(table["lang"].unique())
    freq = np.zeros((len(languages), SLOTS))
    index = {x: i for i, x in enumerate(languages)}
    freq[table["lang"].map(index).to_numpy(dtype=int), table["slot"].to_numpy(dtype=int)] = table["n"].to_numpy(dtype=float)
    freq = freq.reshape(len(languages), len(ORDERS), 1 << SLOT_BITS) + 0.1
    freq = (freq / freq.sum(-1, keepdims=True)).reshape(len(languages), SLOTS)
    code = codewords(len(languages))
    weights = np.zeros((SLOTS, code.shape[1]), np.float32)
    reliability = np.ones(code.shape[1])
    for b in range(code.shape[1]) if len(languages) > 1 else ():
        yes, no = freq[code[:, b] > 0].mean(0), freq[code[:, b] < 0].mean(0)
        weights[:, b] = np.log(yes / no)
        reliability[b] = ((yes - no) * weights[:, b]).sum()
    return Model(languages, code, weights, reliability / max(reliability.mean(), 1e-9))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, ambiguous."""
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]

    def start():
        def f(batch):
            langs, scores, unsure = model.decode(texts_of(batch, text_col))
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())]

        return f

    return append_columns(docs, fields, start, text_col)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
