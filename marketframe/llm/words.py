"""Word arrays of whole Arrow string columns, for the Python side of the text operators.

A batch of texts is cut into pieces of about ``PIECE`` bytes of whole texts (a longer text is a piece
of its own), so the memory of a task does not depend on the batch. All work per byte and per word is
numpy. Words, windows and shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE = 2 << 20
U = np.uint64


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.int64).astype(U) * U(2) + U(1)


@lru_cache(None)
def byte_table(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(byte -> is part of a word, byte -> byte after folding). Kinds: ``space`` (everything but
    0x20 and 0x09-0x0D), ``space_lower`` (the same, A-Z folded), ``alnum_lower`` (0-9, A-Z folded, a-z and
    all of UTF-8's bytes above 0x7F)."""
    b = np.arange(256)
    fold = b.astype(np.uint8)
    if kind == "alnum_lower":
        word = ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x41) & (b <= 0x5A)) | ((b >= 0x61) & (b <= 0x7A)) | (b >= 0x80)
    else:
        word = ~((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))
    if kind.endswith("lower"):
        fold[0x41:0x5B] += 32
    return word, fold


@lru_cache(None)
def _byte_values(kind: str) -> np.ndarray:
    return _random(7, 256)[byte_table(kind)[1]]


@lru_cache(None)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    with np.errstate(over="ignore"):
        np.multiply.accumulate(np.concatenate([[U(1)], np.full(n - 1, U(base), U)]), out=out)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


class Words:
    """Words of consecutive texts. ``doc`` holds for each text the range ``doc[i]:doc[i+1]`` of its words;
    ``start``/``end`` are byte ranges in ``data``; ``hash`` are the words' hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: str):
        word, fold = byte_table(kind)
        self.data, self.offsets = data, offsets
        w = word[data]
        head = w.copy()
        head[1:] &= ~w[:-1]
        cut = offsets[:-1]
        cut = cut[cut < len(data)]
        head[cut] |= w[cut]  # a text's first byte starts a word even where the text before ended in one
        tail = np.zeros(len(data) + 1, bool)
        tail[1:] = w
        tail[1:-1] &= ~w[1:]
        inner = offsets[1:]
        inner = inner[inner > 0]
        tail[inner] |= w[inner - 1]
        self.start, self.end = np.flatnonzero(head), np.flatnonzero(tail)
        self.doc = np.searchsorted(self.start, offsets)
        if len(self.start):
            at = np.flatnonzero(w)
            size = self.end - self.start
            place = np.arange(len(at)) - np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            with np.errstate(over="ignore"):
                v = _byte_values(kind)[data[at]] * _powers(0x9E3779B97F4A7C15, 1 << int(place.max() + 1).bit_length())[place]
            self.hash = mix(np.add.reduceat(v, np.concatenate([[0], np.cumsum(size)[:-1]])))
        else:
            self.hash = np.zeros(0, U)

    def __len__(self) -> int:
        return len(self.start)

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.doc) - 1), np.diff(self.doc))

    def left(self) -> np.ndarray:
        """Number of words from each word (inclusive) to the end of its text."""
        return np.repeat(self.doc[1:], np.diff(self.doc)) - np.arange(len(self))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that would run over the end of the piece are left out
        (``left() >= k`` tells those that stay within their text)."""
        return mix(rolling(self.hash, k))

    def range_hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words a to b-1 of each pair of places, whatever their number."""
        base, size = 0xD6E8FEB86659FD93, 1 << (len(self) + 1).bit_length()
        up, down = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)
        with np.errstate(over="ignore"):
            total = np.concatenate([np.zeros(1, U), np.cumsum(self.hash * up[: len(self)], dtype=U)])
            return mix((total[b] - total[a]) * down[a] + (b - a).astype(U))

    def text(self, i: int, j: int) -> bytes:
        """Words i to j-1, joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[i:j], self.end[i:j], strict=True))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of k consecutive values, by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    p = _powers(0xD6E8FEB86659FD93, 1 << k.bit_length())
    out, done, part, size = np.zeros(n, U), 0, h, 1
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                out = out * p[size] + part[done : done + n]
                done += size
            if 2 * size > k:
                return out
            part = part[: len(part) - size] * p[size] + part[size:]
            size *= 2


def pieces(column: pa.Array | pa.ChunkedArray, kind: str) -> Iterator[tuple[int, Words]]:
    """(index of the first text, words) over pieces of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, at, values = column.buffers()
    offsets = np.frombuffer(at, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
        yield i, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], kind)
        i = j


def spans_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of True as (start, end)."""
    if not len(mask):
        return []
    d = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return list(zip(np.flatnonzero(d == 1).tolist(), np.flatnonzero(d == -1).tolist(), strict=True))
