"""Language-model scoring by Brown class-based n-grams.

Words are counted over all training documents. The most common ones are word types of their own, all
others start with types shared by ending and length. Exchange clustering moves types between
classes until no move raises the likelihood of class transitions. Then each rarer word goes by itself to the
class that its own counted neighbours make most likely, and the transitions are counted anew over the
classes of all words. Only words that no training text holds keep their shared type's class.
A token's probability is a mixture:
the class's given the class before times the word's given its class, with the add-one unigram model
as the other part. Each text gets the log10 probability of its words and one end token.

How it runs: texts are read once, without a shuffle. Each task cuts its texts into segments of bounded size and
writes every segment as its different words and the numbers of its tokens among them. All later passes work on those numbers.
Counts meet by word, and each segment gets back the counts and classes of the words it holds, so that no table of
all words is ever in one place. Type bigrams are counted over all training text; their number is bounded by the
square of the number of types. A rarer word's neighbours are counted by class: a segment hands on one row a word,
rows of a word are merged in groups of bounded size, and a word has two counts a class at most.

Defined results: a null or empty text is its end token alone; without training documents no word is
known and the model is the uniform one; a null id is a training id; repeated rows are scored and
counted each; common words of equal count come in order of their bytes; a very long text is read whole and
fills a segment of its own; an empty table has no rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import bytes_of, discard, materialize, slices

#: The end token; no word is empty.
END = b""
#: Most common words that are types of their own, and types that all others share.
COMMON, SHARED = 1000, 250
CLASSES = 40
#: Share of the class model in the mixture.
SHARE = 0.9
#: Bytes of text and different words with which a segment ends.
CHUNK_BYTES, HELD_WORDS = 4 << 20, 200_000
#: Rows of a word's neighbours that are merged at once, and rarer words that are placed at once.
MERGED, PLACED_WORDS = 4096, 1000


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def held_out(doc_id: Column | str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def shared_types(words: list[bytes], common: int = COMMON, shared: int = SHARED) -> np.ndarray:
    """Types of words that have none of their own: by first byte, last two bytes and length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths) + 2
    letters = np.frombuffer(b"\0\0" + b"".join(words) + b"\0", np.uint8).astype(np.uint64)
    code = np.where(lengths > 0, letters[ends - lengths], 0) | np.where(lengths > 0, letters[ends - 1], 0) << np.uint64(8) | np.where(lengths > 1, letters[ends - 2], 0) << np.uint64(16)
    code |= (np.minimum(lengths, 24) // 4).astype(np.uint64) << np.uint64(24)
    with np.errstate(over="ignore"):
        return common + ((code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(shared)).astype(np.int64)


def shared_type(word: bytes) -> int:
    return int(shared_types([word])[0])


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, passes: int | None = None) -> np.ndarray:
    """Class of each type: every type in turn moves to the class that gives the highest likelihood.

    Passes go on until no type moves, or for as many as given; a gain within rounding is none. The first ones
    leave the word's own tokens out of its neighbours' sums, which escapes poor starts, until the likelihood
    no longer rises; the others use its exact gain.

    The likelihood of a clustering is, but for constants, the sum of f(n) over class bigrams less the
    sums of f(n) over class counts on either side, with f(n) = n log n.
    """
    n = len(bigrams)
    order = np.argsort(-(bigrams.sum(0) + bigrams.sum(1)), kind="stable")
    of = np.zeros(n, np.int64)
    of[order] = np.arange(n) % min(classes, max(n, 1))
    k = int(of.max(initial=0)) + 1
    f = xlogx
    least = 1e-9 + 1e-14 * float(f(bigrams.sum()))
    onehot = np.eye(k)
    right, left = bigrams @ onehot[of], (onehot[of].T @ bigrams).T  # (types, classes): to, and from, each class
    table = onehot[of].T @ right
    best, exact = -math.inf, False
    for _ in itertools.count() if passes is None else range(passes):
        moved = False
        for w in order:
            self_n, c = bigrams[w, w], of[w]
            out, into = right[w].copy(), left[w].copy()  # counts to and from each class, w itself included in c
            out[c] -= self_n
            into[c] -= self_n
            table[c, :] -= out
            table[:, c] -= into
            table[c, c] -= self_n
            rows, cols = table.sum(1), table.sum(0)
            if exact:  # w's neighbours count it wherever it goes
                rows, cols = rows + into, cols + out
            # the gain in each class d: its row gets out, its column into, its corner both and self_n
            gain = (f(table + out) - f(table)).sum(1) + (f(table + into[:, None]) - f(table)).sum(0)
            corner = np.diag(table)
            gain += f(corner + out + into + self_n) - f(corner + out) - f(corner + into) + f(corner)
            gain -= f(rows + out.sum() + self_n) - f(rows) + f(cols + into.sum() + self_n) - f(cols)
            d = int(gain.argmax())
            if gain[d] <= gain[c] + least:
                d = c
            table[d, :] += out
            table[:, d] += into
            table[d, d] += self_n
            if d != c:
                moved = True
                of[w] = d
                right[:, c] -= bigrams[:, w]
                right[:, d] += bigrams[:, w]
                left[:, c] -= bigrams[w]
                left[:, d] += bigrams[w]
        value = f(table).sum() - f(table.sum(0)).sum() - f(table.sum(1)).sum()
        if exact and not moved:
            break
        exact = exact or value <= best + least
        best = max(best, value)
    return of


@dataclass
class Model:
    total: int  # training tokens, N
    vocabulary: int  # distinct training tokens, V
    types: dict[bytes, int]  # words that are types of their own
    of: np.ndarray  # class of each type
    log_class: np.ndarray  # (classes + 1, classes) probabilities; the last row is for a text's first word
    mass: np.ndarray  # by class: tokens + distinct words + 1

    def type_of(self, word: bytes) -> int:
        t = self.types.get(word)
        return shared_type(word) if t is None else t


SEGMENT = "segment long, words binary, n binary, docs array<long>, held binary, lengths binary, ids binary"


def segments(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Texts cut into segments: the different words (the end token first, left out of ``words``), how often
    training documents have each, and for each document its tokens' numbers among the words.
    """
    names = [c.split()[0] for c in SEGMENT.split(", ")]

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        ids, docs_, held_, size = [], [], [], 0

        def flush():
            lengths = np.array([len(x) for x in ids])
            joined = np.concatenate(ids)
            n = np.bincount(joined[~np.repeat(held_, lengths)], minlength=len(number))
            words = list(number)
            columns = [pa.array([task << 33 | made]), *(pa.array([x], pa.binary()) for x in (b" ".join(words[1:]), _planes(n))), pa.array([docs_], pa.list_(pa.int64()))]
            columns += [pa.array([x], pa.binary()) for x in (bytes(held_), _planes(lengths), _planes(joined))]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for doc, text, held in zip(part.column(0).to_pylist(), bytes_of(part, "text"), part.column(2).to_pylist()):
                    if not ids:
                        number[END]
                    ids.append(np.array(list(map(number.__getitem__, tokens(text))), "<u4"))
                    docs_.append(doc)
                    held_.append(held)
                    size += len(text)
                    if size > chunk_bytes or len(number) > HELD_WORDS:
                        yield flush()
                        made += 1
                        number.clear()
                        ids, docs_, held_, size = [], [], [], 0
        if ids:
            yield flush()

    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(run, SEGMENT)


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers with all first bytes first: most are small, so that the last bytes pack to nothing."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _read(batches, *columns):
    """Segments as tuples of the named columns, one after another."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(_decoded(c, batch.column(batch.schema.get_field_index(c))[i].as_py()) for c in columns)


def _decoded(name, x):
    if name == "words":
        return [END, *x.split()]
    if name in ("n", "lengths", "ids"):
        return np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.frombuffer(x, np.uint8).astype(bool) if name == "held" else x


def count_words(segs: DataFrame) -> DataFrame:
    """(word, c): all words with their count in all training documents."""

    def run(batches):
        for words, n in _read(batches, "words", "n"):
            for at in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[at : at + 50_000], pa.binary()), pa.array(n[at : at + 50_000].astype(np.int64))], ["word", "n"])

    return segs.select("words", "n").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _types(words: list[bytes], types: dict[bytes, int]) -> np.ndarray:
    out = shared_types(words)
    own = [(k, types[w]) for k, w in enumerate(words) if w in types]
    if own:
        k, t = zip(*own)
        out[list(k)] = t
    return out


def _training(ids, lengths, held) -> np.ndarray:
    """The tokens of training documents, each document opened by an end token."""
    last = np.cumsum(lengths)[~held] - 1
    keep = ids[np.repeat(~held, lengths)]
    return np.concatenate([[0], keep]) if len(last) else np.zeros(0, np.int64)


def _sums(codes: DataFrame, size: int) -> np.ndarray:
    """Sums of n by code, as an array on the driver; the number of codes is bounded."""
    out = np.zeros(size)
    for batch in codes.groupBy("code").agg(F.sum("n").alias("n")).toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def _nonzero(total: np.ndarray):
    on = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array(total[on].astype(np.int64))], ["code", "n"])


def count_bigrams(segs: DataFrame, types: dict[bytes, int]) -> np.ndarray:
    """Bigrams of types over all training text, each text opened by its end token's type."""
    n_types = COMMON + SHARED

    def run(batches):
        total = np.zeros(n_types * n_types, np.int64)
        for words, lengths, held, ids in _read(batches, "words", "lengths", "held", "ids"):
            a = _types(words, types)[_training(ids, lengths, held)]
            total += np.bincount(a[:-1] * n_types + a[1:], minlength=len(total))
        yield _nonzero(total)

    return _sums(segs.select("words", "lengths", "held", "ids").mapInArrow(run, "code int, n long"), n_types * n_types).reshape(n_types, n_types)


#: A count of a class before a word (key) or after it (classes + key).
NEIGHBOUR = np.dtype([("key", "u1"), ("n", "<u4")])


def _packed(word: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The different words of rows sorted by word, and the neighbours of each in one binary value."""
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    rows = np.empty(len(word), NEIGHBOUR)
    rows["key"], rows["n"] = key, n
    offsets = (np.concatenate([first, [len(word)]]) * NEIGHBOUR.itemsize).astype("<i4")
    return word[first], pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _unpacked(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, key, n) rows, words by number, of one list of binary values for each word."""
    flat = values.flatten()
    sizes = pa.compute.binary_length(flat).to_numpy() // NEIGHBOUR.itemsize
    word = np.repeat(np.repeat(np.arange(len(values)), values.value_lengths().to_numpy()), sizes)
    rows = np.frombuffer(b"".join(flat.to_pylist()), NEIGHBOUR)
    return word, rows["key"].astype(np.int64), rows["n"].astype(np.int64)


def _merged(word: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with equal word and key as one, sorted."""
    codes, at = np.unique(word << 8 | key, return_inverse=True)
    return codes >> 8, codes & 255, np.bincount(at, n, len(codes)).astype(np.int64)


def count_contexts(segs: DataFrame, types: dict[bytes, int], of: np.ndarray, merged: int = MERGED) -> DataFrame:
    """(word, rows): for each rarer word ``merged`` NEIGHBOUR values at most, which add up to its counts.

    A word beside itself is left out, as its neighbour moves with it.
    """
    k, n_types = int(of.max(initial=0)) + 1, COMMON + SHARED
    if 2 * k > 256:
        raise ValueError("a neighbour's key takes a byte")

    def run(batches):
        for segment, words, lengths, held, ids in _read(batches, "segment", "words", "lengths", "held", "ids"):
            type_of = _types(words, types)
            rare = np.array([w not in types for w in words])
            a, of_ids = _training(ids, lengths, held), of[type_of]
            left, right = a[:-1].astype(np.int64), a[1:].astype(np.int64)
            inside = left != right
            left, right = left[inside], right[inside]
            before, after = rare[left], rare[right]
            codes = np.concatenate([left[before] << 8 | of_ids[right[before]], right[after] << 8 | of_ids[left[after]] + k])
            codes, n = np.unique(codes, return_counts=True)
            word, rows = _packed(codes >> 8, codes & 255, n)
            names = pa.array(words, pa.binary()).take(pa.array(word))
            for i in range(0, len(word), 50_000):
                yield pa.RecordBatch.from_arrays([names[i : i + 50_000], rows[i : i + 50_000], pa.array(np.full(len(word[i : i + 50_000]), segment))], ["word", "rows", "segment"])

    def merge(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, PLACED_WORDS):
                part = batch.slice(i, PLACED_WORDS)
                word, rows = _packed(*_merged(*_unpacked(part.column(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), rows], ["word", "rows"])

    rows = segs.select("segment", "words", "lengths", "held", "ids").mapInArrow(run, "word binary, rows binary, segment long")
    salts = math.ceil(segs.count() / merged)
    while salts > 1:
        salt = F.pmod(F.xxhash64("segment"), F.lit(salts)) if "segment" in rows.columns else F.pmod(F.xxhash64("rows"), F.lit(salts))
        rows = rows.groupBy("word", salt.alias("salt")).agg(F.collect_list("rows").alias("rows")).select("word", "rows").mapInArrow(merge, "word binary, rows binary")
        salts = math.ceil(salts / merged) if salts > merged else 1
    return rows.groupBy("word").agg(F.collect_list("rows").alias("rows"))


def place(now: np.ndarray, word: np.ndarray, key: np.ndarray, n: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The best class of each word, in class ``now`` and counted in ``table`` of class bigrams, from its neighbours.

    ``word``, ``key`` and ``n`` are counts of neighbours, words by number, rows with equal word and key merged and sorted.
    """
    f, k, at = xlogx, len(table), np.arange(len(now))
    dense = np.zeros((len(now), 2 * k))
    dense[word, key] = n
    out, into = dense[:, :k], dense[:, k:]
    gain = np.zeros((len(now), k))
    for side, t, other in ((key < k, table.T, into), (key >= k, table, out)):
        w, j, m = word[side], key[side] % k, n[side].astype(float)
        if not len(w):
            continue
        # what the neighbour's class gains from each class, by number of bigrams, then for each row
        sizes, which = np.unique(m, return_inverse=True)
        pair, row = np.unique(which * k + j, return_inverse=True)
        base = t[pair % k]
        part = (f(base + sizes[pair // k][:, None]) - f(base))[row]
        # the class the word is in: its own bigrams are counted there already
        held = np.maximum(t[j, now[w]] - m, 0)
        own = np.flatnonzero(j == now[w])
        part[np.arange(len(w)), now[w]] = f(held + m) - f(held)
        if len(own):
            rest = t[j[own]]
            rest[np.arange(len(own)), now[w[own]]] -= m[own]
            rest = np.maximum(rest - other[w[own]], 0)
            part[own] = f(rest + m[own][:, None]) - f(rest)
        first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        gain[w[first]] += np.add.reduceat(part, first, axis=0)
    corner = np.tile(np.diag(table), (len(now), 1))
    corner[at, now] -= out[at, now] + into[at, now]
    corner = np.maximum(corner, 0)
    gain += f(corner + out + into) - f(corner + out) - f(corner + into) + f(corner)
    for sums, x in ((table.sum(1), out.sum(1)), (table.sum(0), into.sum(1))):
        size, row = np.unique(x, return_inverse=True)
        part = (f(sums[None, :] + size[:, None]) - f(sums[None, :]))[row]
        rest = np.maximum(sums[now] - x, 0)
        part[at, now] = f(rest + x) - f(rest)
        gain -= part
    best = gain.argmax(1)
    return np.where(gain[at, best] > gain[at, now] + 1e-9, best, now)


def place_words(contexts: DataFrame, of: np.ndarray, table: np.ndarray) -> DataFrame:
    """(word, class) of the rarer words whose class is not their shared type's."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, PLACED_WORDS):
                part = batch.slice(i, PLACED_WORDS)
                words = part.column(0)
                now = of[shared_types(words.to_pylist())]
                best = place(now, *_merged(*_unpacked(part.column(1))), table)
                moved = np.flatnonzero(best != now)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(moved)), pa.array(best[moved], pa.int32())], ["word", "class"])

    return contexts.mapInArrow(run, "word binary, class int")


def fit(segs: DataFrame) -> tuple[Model, DataFrame]:
    """The model but for its transitions, and (word, c, class) of all words, c being their count in all training documents.

    The driver gets the common words, the type bigrams and a row per class, all of bounded size.
    """
    every = materialize(count_words(segs), "brown-words")
    own = every.where("c > 0")
    total, vocabulary = own.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    common = [(bytes(r["word"]), r["c"]) for r in own.orderBy(F.desc("c"), "word").limit(COMMON).collect()]
    types = {w: i for i, (w, _) in enumerate(common)}
    bigrams = count_bigrams(segs, types)
    of = exchange(bigrams)
    k = int(of.max(initial=0)) + 1
    onehot = np.eye(k)[of]
    moved = place_words(count_contexts(segs, types, of), of, onehot.T @ bigrams @ onehot)
    model = Model(int(total), int(vocabulary), types, of, np.full((k, k), 1 / k), np.ones(k))

    def run(batches):
        for batch in batches:
            words, moved_to = batch.column(0).to_pylist(), batch.column(2)
            classes = np.where(np.asarray(moved_to.is_null()), of[_types(words, types)], np.asarray(moved_to.fill_null(0)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(classes, pa.int32())], ["word", "c", "class"])

    classed = every.join(moved, "word", "left").select("word", "c", "class").mapInArrow(run, "word binary, c long, class int")
    classed = materialize(classed, "brown-classed")
    held = classed.where("c > 0").groupBy("class").agg(F.sum(F.col("c") + 1).alias("mass")).toArrow()
    model.mass[held["class"].to_numpy()] += held["mass"].to_numpy()
    discard(every)
    return model, classed


def score_ids(classes: np.ndarray, c: np.ndarray, model: Model) -> tuple[float, float]:
    """Base score and model score of one text from its words' classes and counts."""
    base = (c + 1) / (model.total + model.vocabulary + 1)
    before = np.concatenate([[model.of[model.type_of(END)]], classes[:-1]])
    by_class = model.log_class[before, classes] * (c + 1) / model.mass[classes]
    return float(np.log10(base).sum()), float(np.log10(SHARE * by_class + (1 - SHARE) * base).sum())


def score_text(words: list[bytes], counts: dict[bytes, int], model: Model, cache: dict[bytes, tuple[int, int]]) -> tuple[int, int, float, float]:
    """n_tokens, n_known, base score and model score of one text; ``cache`` holds classes and counts by word."""
    for w in words:
        if w not in cache:
            cache[w] = (int(model.of[model.type_of(w)]), counts.get(w, 0))
    classes, c = np.array([cache[w] for w in words], np.int64).T
    return len(words), int((c > 0).sum()), *score_ids(classes, c, model)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
SCORED_NAMES = [c.split()[0] for c in SCORED.split(", ")]
ENCODED = ["docs", "held", "lengths", "ids", "counts", "classes"]


def encode(segs: DataFrame, classed: DataFrame) -> DataFrame:
    """Segments with the counts and classes of their words in place of the words."""

    def words_of(batches):
        for segment, words in _read(batches, "segment", "words"):
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), segment)), pa.array(np.arange(at, at + len(part)), pa.int32()), pa.array(part, pa.binary())], ["segment", "number", "word"])

    def marks_of(rows):
        number, c, cls = (rows.column(x).to_numpy() for x in ("number", "c", "class"))
        counts, classes = np.zeros(len(number), "<i8"), np.zeros(len(number), np.uint8)
        counts[number], classes[number] = c, cls
        return pa.table([rows.column("segment").slice(0, 1), pa.array([counts.tobytes()], pa.binary()), pa.array([classes.tobytes()], pa.binary())], ["segment", "counts", "classes"])

    words = segs.select("segment", "words").mapInArrow(words_of, "segment long, number int, word binary")
    words = words.join(classed, "word").select("segment", "number", "c", "class")
    # a segment is a task, so that tasks grow in number with the segments
    words = words.repartition(max(1, segs.count()), "segment").groupBy("segment")
    marks = materialize(words.applyInArrow(marks_of, "segment long, counts binary, classes binary"), "brown-marks")
    return segs.drop("words", "n").join(marks, "segment").select(*ENCODED)


def transitions(encoded: DataFrame, model: Model) -> np.ndarray:
    """Probabilities of class bigrams over all training text, with the classes of all words."""
    k = len(model.mass)

    def run(batches):
        total = np.zeros(k * k, np.int64)
        for held, lengths, ids, classes in _read(batches, "held", "lengths", "ids", "classes"):
            a = np.frombuffer(classes, np.uint8).astype(np.int64)[_training(ids, lengths, held)]
            total += np.bincount(a[:-1] * k + a[1:], minlength=k * k)
        yield _nonzero(total)

    table = _sums(encoded.select("held", "lengths", "ids", "classes").mapInArrow(run, "code int, n long"), k * k).reshape(k, k)
    prior = (table.sum(0) + 1) / (table.sum() + k)
    return (table + 5 * prior) / (table.sum(1, keepdims=True) + 5)


def score(encoded: DataFrame, model: Model) -> DataFrame:
    """One row per document."""

    def run(batches):
        for docs, held, lengths, ids, counts, classes in _read(batches, "docs", "held", "lengths", "ids", "counts", "classes"):
            c, cls = np.frombuffer(counts, "<i8"), np.frombuffer(classes, np.uint8).astype(np.int64)
            first = np.cumsum(lengths, dtype=np.int64) - lengths
            base = np.log10((c + 1) / (model.total + model.vocabulary + 1))
            by_word = np.log10((c + 1) / model.mass[cls]), 10**base
            known, sums, own = (np.zeros(len(docs)) for _ in range(3))
            # documents are taken together up to a bounded number of tokens
            for a, b in _runs(lengths):
                tokens_, at = ids[first[a] : first[b - 1] + lengths[b - 1]], first[a:b] - first[a]
                now = cls[tokens_]
                before = np.concatenate([[0], now[:-1]])
                before[at] = cls[0]
                by_class = model.log_class[before, now] * 10 ** by_word[0][tokens_]
                known[a:b] = np.add.reduceat((c > 0)[tokens_].astype(np.int64), at)
                sums[a:b] = np.add.reduceat(base[tokens_], at)
                own[a:b] = np.add.reduceat(np.log10(SHARE * by_class + (1 - SHARE) * by_word[1][tokens_]), at)
            columns = [pa.array(docs, pa.int64()), pa.array(held), pa.array(lengths.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(docs), model.total, np.int64))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums), pa.array(own), pa.array(10 ** (-own / lengths))], SCORED_NAMES)

    return encoded.mapInArrow(run, SCORED)


def _runs(lengths: np.ndarray, most: int = 1 << 20):
    """Ranges of documents of about ``most`` tokens, one document at least."""
    start = held = 0
    for k, n in enumerate(lengths.tolist()):
        if held and held + n > most:
            yield start, k
            start, held = k, 0
        held += n
    if held:
        yield start, len(lengths)


def train(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[Model, DataFrame, DataFrame]:
    """The model, (word, c, class) of all words, and all texts encoded."""
    segs = materialize(segments(docs, chunk_bytes), "brown-segments")
    model, classed = fit(segs)
    encoded = materialize(encode(segs, classed), "brown-encoded")
    model.log_class = transitions(encoded, model)
    discard(segs)
    return model, classed, encoded


def score_corpus(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Train on the documents that are not held out and score all."""
    model, _, encoded = train(docs, chunk_bytes)
    return score(encoded, model)
