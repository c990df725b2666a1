"""Sequence packing by bounded-space online best-fit.

Every task packs the pieces of its own documents as they come, without a shuffle. It keeps a fixed
number of open bins, found through a bitset whose bit f is set while a bin with f free places is
open: the lowest set bit at or above a piece's length is the best fit. When a new bin is needed and
all are open, the fullest closes first, which is the lowest set bit.

Defined results: a null or empty text is the end token alone; a very long text is cut into whole
sequences with a shorter first piece; repeated rows are packed each; an empty table gives no rows.
Extra columns are ignored by :func:`pack`.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakemill.llm.common import slices, texts_of

LENGTH = 1024
OPEN_BINS = 256
END_ID = 2
#: Words whose ids a task keeps at hand.
CACHED_WORDS = 300_000

#: A space inside or at the end of a run of white space, where the split depends on its neighbours.
_JOINED_SPACE = re.compile(r"\s \s|\s \Z")

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    The split of a byte-level BPE never joins what stands before a space with the space, unless white
    space stands on both of its sides. So texts are cut at spaces, and words are encoded once and
    looked up after that: ``tokenizers`` for texts with special tokens or such runs, the same
    vocabulary's ranks for new words.
    """

    def __init__(self, json_path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.fast = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, i in ranks.items():
                self.sizes[i] = len(token)

    def _slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.fast is None:
            return [self._slow(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        plain = [not _JOINED_SPACE.search(t) and not any(s in t for s in self.special) for t in texts]
        parts = [[h, *(" " + w for w in rest)] if ok else None for (h, *rest), ok in zip((t.split(" ") for t in texts), plain)]
        new = list({w for p in parts if p for w in p if w not in self.known})
        # only words that start with a space and another character may be encoded in one string
        joined = [w for w in new if len(w) > 1 and w[0] == " " and not w[1].isspace() and not w[-1].isspace()]
        if joined:
            ids = np.array(self.fast.encode_ordinary("".join(joined)), "<u4")
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(w.encode()) for w in joined])) + 1
            raw, start = ids.tobytes(), 0
            for w, e in zip(joined, (ends * 4).tolist()):
                self.known[w] = raw[start:e]
                start = e
        for w in new:
            if w not in self.known:
                self.known[w] = np.array(self.fast.encode_ordinary(w), "<u4").tobytes()
        get = self.known.__getitem__
        return [b"".join(map(get, p)) if p else self._slow(t) for t, p in zip(texts, parts)]


class BestFit:
    """Open bins in a bitset keyed by free space. ``put`` returns (bin, offset)."""

    def __init__(self, length: int = LENGTH, most_open: int = OPEN_BINS):
        self.length, self.most = length, most_open
        self.bits = self.open = self.made = 0
        self.at: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        bins = self.at[free]
        chosen = bins.pop()
        if not bins:
            del self.at[free]
            self.bits ^= 1 << free
        self.open -= 1
        return chosen

    def put(self, size: int) -> tuple[int, int]:
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.open == self.most and size < self.length:
                self._take((self.bits & -self.bits).bit_length() - 1)
            chosen, free = self.made, self.length
            self.made += 1
        left = free - size
        if left:
            self.at.setdefault(left, []).append(chosen)
            self.bits |= 1 << left
            self.open += 1
        return chosen, self.length - free


def pieces(total: int, length: int) -> list[tuple[int, int]]:
    """(start, size): whole sequences, but for the first piece that takes the rest."""
    first = (total - 1) % length + 1
    return [(0, first), *((s, length) for s in range(first, total, length))]


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, length: int = LENGTH, open_bins: int = OPEN_BINS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's token ids as array<int>."""

    def run(batches):
        encoder, bins = Encoder(vocabulary, ranks), BestFit(length, open_bins)
        base = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rows, ids = [], []
                for doc, raw in zip(part.column(0).to_pylist(), encoder.encode(texts_of(part, "text"))):
                    raw += end
                    for k, (start, size) in enumerate(pieces(len(raw) // 4, length)):
                        body = raw[4 * start : 4 * (start + size)]
                        chosen, offset = bins.put(size)
                        rows.append((doc, k, start, size, zlib.crc32(body), base + chosen, offset))
                        if with_ids:
                            ids.append(np.frombuffer(body, "<u4").astype(np.int32))
                if rows:
                    kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5)
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
                    if with_ids:
                        cols.append(pa.array(ids, pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
