"""Chat formatting over typed content parts.

A turn is a list of text, image, audio and document parts. A visitor flattens it in order: texts are
escaped and joined, every other part becomes a placeholder with an attachment record and the tokens
it will expand to. Turns are marked by control strings, which all start with ``<|``; inside texts a
backslash is put between ``<`` (and backslashes after it) and ``|``, and one is taken out again on reading,
so any text survives. What a conversation holds is kept as one row per turn, sorted on reading,
so that a very long conversation never needs one task's memory.

Defined results: a null text or null part list is an empty text, a null role an empty role; ties in
(conv_id, turn) are ordered by role and text; rows with a null conv_id form one conversation;
repeated rows are turns of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import slices

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLES = frozenset({"assistant"})
#: Tokens that a part expands to.
IMAGE_PATCH = 28
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 512

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_HIDE, _SHOW = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_PLACEHOLDER = re.compile(r"<\|(image|audio|document)\|>")


def escape(text: str) -> str:
    return _HIDE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHOW.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Flattened:
    """A turn as the visitor leaves it; spans are code points of ``body``."""

    body: str = ""
    texts: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)


class PartVisitor:
    """Flattens typed parts; ``visit`` calls the method named after a part's kind."""

    def __init__(self):
        self.out = Flattened()
        self._held: list[str] = []

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown part kind {kind!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        # neighbouring texts are escaped as one, as a control string could lie across their border
        self._held.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        cells = math.ceil((part.get("width") or 0) / IMAGE_PATCH) * math.ceil((part.get("height") or 0) / IMAGE_PATCH)
        self._attach("image", part, max(1, cells))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS_PER_SECOND)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 0) * DOCUMENT_TOKENS_PER_PAGE)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._settle()
        self.out.attachments.append({"kind": kind, "ref": part.get("ref"), "position": len(self.out.body), "tokens": tokens})
        self.out.body += f"<|{kind}|>"

    def _settle(self) -> None:
        if self._held:
            text, self._held = escape("".join(self._held)), []
            self.out.texts.append((len(self.out.body), len(self.out.body) + len(text)))
            self.out.body += text

    def done(self) -> Flattened:
        self._settle()
        return self.out


def format_turn(role: str, parts: list[dict]) -> tuple[str, list[tuple[int, int]], list[dict]]:
    """A turn's formatted text, its spans under the loss mask and its attachments."""
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    flat = visitor.done()
    head = f"{START}{escape_role(role)}\n"
    mask = [(len(head) + a, len(head) + b) for a, b in flat.texts] if role in TRAINED_ROLES else []
    attached = [a | {"position": len(head) + a["position"]} for a in flat.attachments]
    return f"{head}{flat.body}{END}\n", mask, attached


def read_turn(segment: str) -> tuple[str, list[str]]:
    """Role and content of a formatted turn: texts unescaped, placeholders as they are."""
    if not segment.startswith(START) or not segment.endswith(END + "\n"):
        raise ValueError("not a formatted turn")
    role, _, body = segment[len(START) : -len(END) - 1].partition("\n")
    found, at = [], 0
    for m in _PLACEHOLDER.finditer(body):
        found += [unescape(body[at : m.start()]), m[0]]
        at = m.end()
    return unescape_role(role), [x for x in (*found, unescape(body[at:])) if x]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ATTACHED = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("position", pa.int64()), ("tokens", pa.int64())]))
FORMATTED = "conv_id long, turn long, role string, formatted string, loss array<struct<start:long,end:long>>, attachments array<struct<kind:string,ref:string,position:long,tokens:long>>, expanded_tokens long"


def with_parts(turns: DataFrame) -> DataFrame:
    """Plain turns (conv_id, turn, role, text) as turns of one text part each."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))
    return turns.select("conv_id", "turn", "role", F.array(part).cast(PARTS).alias("parts"))


def format_turns(turns: DataFrame) -> DataFrame:
    """One formatted row per turn of (conv_id, turn, role, parts); a conversation is its rows in order, joined."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, None):
                conv, turn, roles, parts = (c.to_pylist() for c in part.columns)
                made = [format_turn(r or "", p or []) for r, p in zip(roles, parts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(conv, pa.int64()),
                        pa.array(turn, pa.int64()),
                        pa.array(roles, pa.string()),
                        pa.array([m[0] for m in made], pa.string()),
                        pa.array([[{"start": a, "end": b} for a, b in m[1]] for m in made], _SPANS),
                        pa.array([m[2] for m in made], _ATTACHED),
                        pa.array([sum(a["tokens"] for a in m[2]) for m in made], pa.int64()),
                    ],
                    ["conv_id", "turn", "role", "formatted", "loss", "attachments", "expanded_tokens"],
                )

    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "parts").mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, read from its formatted turns one after another."""

    def run(batches):
        conv, state = None, None

        def row():
            n, turns, loss_chars, loss, chars, tokens = state
            return [conv[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, tokens]

        for batch in batches:
            done = []
            for c, text, spans, tokens in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if conv != (c,):
                    if conv is not None:
                        done.append(row())
                    conv, state = (c,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, content = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{''.join(content)}\n".encode("utf-8", "surrogatepass"))
                for s in spans:
                    trained = unescape(text[s["start"] : s["end"]])
                    state[2] += len(trained)
                    state[3].update(trained.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                state[5] += tokens
            if done:
                yield _digests(done)
        if conv is not None:
            yield _digests([row()])

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.select("conv_id", "formatted", "loss", "expanded_tokens").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, expanded_tokens long")


def _digests(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "expanded_tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
