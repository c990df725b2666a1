"""Words of whole texts as arrays: their places in the joined bytes, and 64-bit hashes of them."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Bytes hashed at once; a longer word is a piece of its own.
PIECE = 1 << 18

_RANDOM = np.random.default_rng(31).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B, C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))
_UPPER = np.arange(256, dtype=np.uint8) + np.uint8(32) * ((np.arange(256) >= 65) & (np.arange(256) <= 90)).astype(np.uint8)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Words(NamedTuple):
    """Word i is data[start[i]:end[i]], in text number text[i]; breaks[i] counts the breaks before it."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    breaks: np.ndarray | None


def byte_set(chars: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[np.frombuffer(chars, np.uint8)] = True
    return found


#: What parts words unless an operator has another set.
SPACE = byte_set(b" \t\n\x0b\x0c\r")


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * C
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _POWERS:
        _POWERS.clear()
        forth, back = np.full(n + 1, _B), np.full(n + 1, _B_INVERSE)
        forth[0] = back[0] = 1
        _POWERS[n] = np.cumprod(forth), np.cumprod(back)
    return _POWERS[n]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by its bytes alone."""
    out = np.empty(len(start), np.uint64)
    a = 0
    with np.errstate(over="ignore"):
        while a < len(start):
            z = max(a + 1, int(np.searchsorted(end, start[a] + PIECE, "right")))
            x, y = int(start[a]), int(end[z - 1])
            forth, back = _powers(max(PIECE, y - x))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_RANDOM[data[x:y]] * forth[: y - x])])
            s, e = start[a:z] - x, end[a:z] - x
            out[a:z] = mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64) * C)
            a = z
    return out


def split(texts: list[bytes], space: np.ndarray = SPACE, lower: bool = False, breaks: np.ndarray | None = None) -> Words:
    """The words of all texts: runs of bytes outside ``space`` (which must hold the line feed); A-Z may be lower-cased."""
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = _UPPER[data]
    inside = ~space[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    firsts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    text = np.searchsorted(firsts, start, "right") - 1
    found = np.cumsum(breaks[data], dtype=np.int64)[start] if breaks is not None else None
    return Words(data, start, end, text, word_hashes(data, start, end), found)
