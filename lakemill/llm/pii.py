"""Personal data by exact rules and a character-level BiLSTM-CRF.

The rules give the base spans. The model adds what they miss: a bidirectional LSTM over characters
gives each a score for every label, a CRF adds scores for label transitions. It is trained in numpy by
gradient descent on the CRF likelihood, on spans labelled by the rules in a bounded sample of
documents and on made snippets in many more formats, set among the sample's own words.

Texts are cut into windows that overlap by half and each window is decoded. The parts of a span that goes beyond
a window are joined, spans that overlap a base span go, and those left of all windows of a text are reconciled
globally: of overlapping ones the set of the highest total score stays.
Every kind needs a digit or an at sign by definition, so windows without one, and without a neighbour
that has one, decode to nothing and are not run. Added spans must pass their kind's check.

Defined results: a null text is empty and has no spans; equal spans are given once; a table without
digits trains on made snippets among filler words; repeated rows get a row each; very long texts are read whole,
one to a batch, and their windows by hundreds; an empty table has no rows. Columns that have the name of an added one are replaced.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import append_columns, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Documents with a digit or an at sign that lend labelled spans and words to training.
SAMPLE = 300
WINDOW, STRIDE = 96, 48
HIDDEN = 16
STEPS, BATCH = 150, 96
LABELS = 1 + 2 * len(KINDS)  # O, then B and I of each kind

_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL_AT = re.compile(_LOCAL + r"++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL = re.compile(rf"(?<!{_LOCAL}){_EMAIL_AT.pattern}")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; a run of local-part characters is tried once, so long runs cost no more than their length."""
    out, pos = [], 0
    while m := _EMAIL_AT.match(text, pos) or _EMAIL.search(text, pos):
        out.append(m.span())
        pos = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the rules, sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if _TRIGGER.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_AT, _DOT = r"\s?(?:@|\(at\)|\[at\])\s?", r"(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?|\sdot\s)"
_CHECKS = (
    re.compile(rf"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+"),
    re.compile(r"([0-9]{1,3})\s?(?:\.|\[\.\])\s?([0-9]{1,3})\s?(?:\.|\[\.\])\s?([0-9]{1,3})\s?(?:\.|\[\.\])\s?([0-9]{1,3})"),
    re.compile(r"[0-9](?:[ ./-]{0,2}[0-9])+"),
    re.compile(r"[+(]{0,2}[0-9][0-9 ()./-]+[0-9]"),
)


def passes(kind: int, body: str) -> bool:
    """Whether an added span can be of its kind at all."""
    m = _CHECKS[kind].fullmatch(body)
    digits = _NOT_DIGIT.sub("", body)
    if not m:
        return False
    if kind == 1:
        return all(int(g) <= 255 for g in m.groups())
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return 10 <= len(digits) <= 15 and (body[0] in "+(" or bool(re.search(r"[0-9][ ).-][(0-9 ]", body))) and not _CHECKS[1].search(body)
    return True


# --- the model -------------------------------------------------------------------------------

PAD, OTHER = 128, 129
_CODES = np.arange(130)
_CODES[ord("0") : ord("9") + 1] = ord("0")
_CODES[ord("A") : ord("Z") + 1] = ord("A")
_FORBIDDEN = np.zeros((LABELS, LABELS), np.float32)
for _k in range(len(KINDS)):
    _FORBIDDEN[:, 2 + 2 * _k] = -1e4
    _FORBIDDEN[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = 0


def codes(texts: list[str], width: int = WINDOW) -> np.ndarray:
    """(texts, width) of character classes: digits as one, capitals as one, all beyond ASCII as one."""
    out = np.full((len(texts), width), PAD)
    for row, text in zip(out, texts):
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        row[: len(c)] = np.where(c < 128, c, OTHER)
    return _CODES[out]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lse(x, axis):
    m = x.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))


@dataclass
class Tagger:
    """Parameters: input tables X, recurrences U and biases per direction, the output layer, the CRF."""

    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 0) -> Tagger:
        rng, h = np.random.default_rng(seed), HIDDEN
        p = {}
        for d in "fb":
            p["X" + d] = rng.normal(0, 0.3, (130, 4 * h))
            p["U" + d] = rng.normal(0, 0.25, (h, 4 * h))
            p["B" + d] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
            p["W" + d] = rng.normal(0, 0.3, (h, LABELS))
        p |= {"out": np.zeros(LABELS), "trans": np.zeros((LABELS, LABELS)), "start": np.zeros(LABELS)}
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """(time, batch, hidden) of one direction; x is (batch, time)."""
        h_n = HIDDEN
        h = c = np.zeros((len(x), h_n), np.float32)
        table, u = self.p["X" + d] + self.p["B" + d], self.p["U" + d]
        out = np.empty((x.shape[1], len(x), h_n), np.float32)
        for t in range(x.shape[1]) if d == "f" else range(x.shape[1] - 1, -1, -1):
            z = table[x[:, t]] + h @ u
            s, g = _sigmoid(z[:, : 3 * h_n]), np.tanh(z[:, 3 * h_n :])
            i, f, o = s[:, :h_n], s[:, h_n : 2 * h_n], s[:, 2 * h_n :]
            before_h, before_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep is not None:
                keep.append((t, before_h, before_c, i, f, o, g, tc))
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self._run(x, "f") @ self.p["Wf"] + self._run(x, "b") @ self.p["Wb"] + self.p["out"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the labels y (batch, time), and its gradients."""
        p, kept = self.p, {"f": [], "b": []}
        hs = {d: self._run(x, d, kept[d]) for d in "fb"}
        e = hs["f"] @ p["Wf"] + hs["b"] @ p["Wb"] + p["out"]
        steps, n = e.shape[:2]
        trans, rows = p["trans"] + _FORBIDDEN, np.arange(n)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = p["start"] + e[0]
        for t in range(1, steps):
            alpha[t] = e[t] + _lse(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _lse(alpha[-1], 1)
        de = np.exp(alpha + beta - z[:, None])
        pair = np.exp(alpha[:-1, :, :, None] + trans + (e[1:] + beta[1:])[:, :, None, :] - z[:, None, None])
        dtrans = pair.sum((0, 1))
        gold = p["start"][y[:, 0]] + sum(e[t, rows, y[:, t]] for t in range(steps)) + sum(trans[y[:, t], y[:, t + 1]] for t in range(steps - 1))
        for t in range(steps):
            de[t, rows, y[:, t]] -= 1
        np.subtract.at(dtrans, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        de /= n
        grads = {"trans": dtrans / n, "start": de[0].sum(0), "out": de.sum((0, 1))}
        for d in "fb":
            grads["W" + d] = np.einsum("tbh,tbl->hl", hs[d], de)
            gh, gx, gu = de @ p["W" + d].T, np.zeros_like(p["X" + d]), np.zeros_like(p["U" + d])
            dh = dc = np.zeros((n, HIDDEN), np.float32)
            for t, h0, c0, i, f, o, g, tc in reversed(kept[d]):
                dh = dh + gh[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
                np.add.at(gx, x[:, t], dz)
                gu += h0.T @ dz
                dh, dc = dz @ p["U" + d].T, dc * f
            grads["X" + d], grads["U" + d], grads["B" + d] = gx, gu, gx.sum(0)
        return float((z - gold).mean()), grads

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best labels (batch, time) by Viterbi and the emissions."""
        e = self.emissions(x)
        trans, best, back = self.p["trans"] + _FORBIDDEN, self.p["start"] + e[0], []
        for t in range(1, len(e)):
            scores = best[:, :, None] + trans
            back.append(scores.argmax(1))
            best = scores.max(1) + e[t]
        path = [best.argmax(1)]
        for b in reversed(back):
            path.append(b[np.arange(len(b)), path[-1]])
        return np.stack(path[::-1], 1), e


def _made(kind: int, rng: random.Random, words: list[str]) -> str:
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == 0:
        w = lambda: re.sub("[^A-Za-z0-9]", "", rng.choice(words)) or "mail"
        at = rng.choice(["@", "@", " @ ", "(at)", " (at) ", " [at] ", "[at]"])
        dot = rng.choice([".", ".", "(dot)", " [dot] ", " dot "])
        return w() + rng.choice(["", "." + w(), d(2)]) + at + w() + rng.choice(["", d(1)]) + dot + rng.choice(["com", "org", "example.com", "de", "net"])
    if kind == 1:
        dot = rng.choice([".", ".", "[.]", " . "])
        return dot.join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        n = rng.choice([13, 15, 16, 16, 16, 19])
        body = rng.choice("3456") + d(n - 2)
        body += next(c for c in "0123456789" if luhn(body + c))
        return rng.choice([body, rng.choice(" -./").join(body[k : k + 4] for k in range(0, n, 4))])
    area, a, b = d(3), d(3), d(4)
    return rng.choice([f"+1 ({area}) {a}-{b}", f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"{area}.{a}.{b}", f"+{d(2)} {d(3)} {d(3)} {d(4)}", f"0{d(3)} {d(3)} {d(4)}", f"00{d(2)} {d(3)} {d(6)}", f"1-{area}-{a}-{b}"])


def _decoy(rng: random.Random) -> str:
    """Digits that are no personal data."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice(
        [
            'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([32, 40]))) + '"',
            f"{1900 + rng.randrange(130)}-{d(1)}1-2{d(1)}", f"1{d(1)}:{d(2)}", f"{d(2)}/0{d(1)}/20{d(2)}", f"version {d(1)}.{d(1)}", f"v{d(1)}.{d(2)}.{d(1)}", f"${d(2)},{d(3)}.00",
            d(rng.randint(1, 8)), f"20{d(2)}", f"{d(1)}.{d(4)}", f"No. {d(5)}", f"{d(2)}%", f"#{d(6)}", f"@{rng.choice('abc')}{d(2)}", f"{d(3)}-{d(2)}",
        ]
    )


def training_windows(sample: list[str], n: int, seed: int = 5) -> tuple[list[str], np.ndarray]:
    """Windows of text and their labels: half around rule spans of the sample, half made."""
    rng = random.Random(seed)
    words = [w for t in sample for w in t.split() if not _TRIGGER.search(w)] or "the of and to in we are on for with by at it as is that".split()
    found = [(t, spans) for t in sample if (spans := base_spans(t))]
    texts, labels = [], np.zeros((n, WINDOW), np.int64)
    for row in labels:
        if found and rng.random() < 0.4:
            text, spans = rng.choice(found)
            start = max(0, rng.choice(spans)[0] - rng.randrange(WINDOW // 2))
        else:
            text, spans, start = "", [], 0
            while len(text) < WINDOW:
                r = rng.random()
                if r < 0.75:
                    text += rng.choice(words)
                elif r < 0.87:
                    text += _decoy(rng)
                else:
                    k = rng.randrange(len(KINDS))
                    piece = _made(k, rng, words)
                    spans.append((len(text), k, len(text) + len(piece)))
                    text += piece
                text += rng.choice([" ", " ", " ", "\n", ", ", ". ", " | ", "%%% "])
        window = text[start : start + WINDOW]
        texts.append(window)
        for a, k, b in spans:
            a, b = a - start, b - start
            if a < 0 < b:  # cut by the window's edge
                row[0 : min(b, WINDOW)] = 2 + 2 * k
                row[0] = 1 + 2 * k
            elif 0 <= a < WINDOW:
                row[a : min(b, WINDOW)] = 2 + 2 * k
                row[a] = 1 + 2 * k
    return texts, labels


def train(sample: list[str], steps: int = STEPS, seed: int = 0) -> Tagger:
    """Adam on batches of fresh windows, drawn by the seed alone."""
    texts, labels = training_windows(sample, 24 * BATCH)
    x, tagger, rng = codes(texts), Tagger.fresh(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(a) for k, a in tagger.p.items()}
    for step in range(1, steps + 1):
        at = rng.choice(len(x), BATCH, replace=False)
        _, grads = tagger.gradients(x[at], labels[at])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.03 * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = g * min(1, 20 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            tagger.p[k] = (tagger.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return tagger


def window_starts(text: str) -> list[int]:
    """Starts of the windows to run: those with a trigger, and their neighbours."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    near = set()
    for m in _TRIGGER.finditer(text):
        k = m.start() // STRIDE
        near.update(range(max(0, k - 2), min(last, k + 1) + 1))
    return [k * STRIDE for k in sorted(near)]


def reconcile(spans: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (score, start, kind, end) the non-overlapping set of the highest total score."""
    best: dict[tuple[int, int, int], float] = {}
    for score, a, k, b in spans:
        best[a, k, b] = max(score, best.get((a, k, b), 0))
    order = sorted(best, key=lambda s: (s[2], s[0], s[1]))
    ends, total, take = [s[2] for s in order], [0.0], []
    for n, s in enumerate(order):
        free = bisect.bisect_right(ends, s[0], 0, n)
        take.append((total[free] + best[s] > total[n], free))
        total.append(max(total[n], total[free] + best[s]))
    out, n = [], len(order)
    while n:
        taken, free = take[n - 1]
        if taken:
            out.append(order[n - 1])
        n = free if taken else n - 1
    return sorted(out)


def added_spans(texts: list[str], bases: list[list[tuple[int, int, int]]], tagger: Tagger, at_once: int = 512) -> list[list[tuple[int, int, int]]]:
    """What the model adds to the base spans of each text."""
    jobs = [(d, s) for d, text in enumerate(texts) for s in window_starts(text)]
    found: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]
    # (text, window, kind) -> start and gain of a span that goes on beyond the window's end
    going_on: dict[tuple[int, int, int], tuple[int, float]] = {}
    for at in range(0, len(jobs), at_once):
        part = jobs[at : at + at_once]
        labels, e = tagger.decode(codes([texts[d][s : s + WINDOW] for d, s in part]))
        for w in np.flatnonzero(labels.any(1)):
            d, s = part[w]
            row, t = labels[w], 0
            while t < WINDOW:
                if row[t] == 0:
                    t += 1
                    continue
                a, kind = t, int((row[t] - 1) // 2)
                t += 1
                while t < WINDOW and row[t] == 2 + 2 * kind:
                    t += 1
                start, gain = s + a, float((e[np.arange(a, t), w, row[a:t]] - e[a:t, w, 0]).sum())
                if a == 0 and s > 0:
                    # it began before: the window before has its first part, or has it whole
                    before = going_on.pop((d, s - STRIDE, kind), None)
                    if before is None:
                        continue
                    start, gain = before[0], gain + before[1]
                if t == WINDOW and s + WINDOW < len(texts[d]):
                    going_on[d, s, kind] = start, gain
                    continue
                body = texts[d][start : s + t]
                start += len(body) - len(body.lstrip(" .,;:'\""))
                body = body.strip(" .,;:'\"")
                if body and gain > 0 and passes(kind, body):
                    found[d].append((gain, start, kind, start + len(body)))
    return [reconcile([x for x in spans if not any(x[1] < b and a < x[3] for a, _, b in base)]) for spans, base in zip(found, bases)]


FIELDS = [
    *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
    T.StructField("n_added", T.LongType()),
]


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Tagger:
    """Train on ``SAMPLE`` documents that hold a digit or an at sign, chosen by a hash of their id."""
    some = docs.where(F.col(text_col).rlike("[0-9@]")).select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"))
    # hashes alone are ranked first, so that each task sends the driver only texts that are chosen
    last = some.select("h").orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    some = some.where(F.col("h") <= F.lit(last)).orderBy("h", "text").limit(SAMPLE)
    return train([r["text"] for r in some.collect()])


def find(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """``docs`` with the numbers of base spans, their digest, all spans and the number added."""

    def start():
        def f(batch):
            texts = texts_of(batch, text_col)
            bases = [base_spans(t) for t in texts]
            added = added_spans(texts, bases, tagger)
            counts = [pa.array([sum(s[1] == k for s in b) for b in bases], pa.int64()) for k in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in bases], pa.string())
            return [*counts, digests, pa.array([joined(sorted(b + a)) for b, a in zip(bases, added)], pa.string()), pa.array([len(a) for a in added], pa.int64())]

        return f

    return append_columns(docs, FIELDS, start, text_col)
