"""Words and their hashes for whole Arrow batches of texts, by array operations on the UTF-8 bytes.

A word is a run of bytes other than space and 0x09-0x0D. A null text counts as empty. Hashes are
64-bit polynomial hashes of the word's bytes, A-Z lower-cased, finished by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Piece:
    """Some consecutive texts of a batch: their bytes and where each begins."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1


def pieces(texts: pa.Array, most: int = PIECE_BYTES, rows: int = 1 << 16) -> Iterator[Piece]:
    """The texts in pieces of about ``most`` bytes and at most ``rows`` texts: memory follows the longest."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, where, body = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + most, side="left"))
        to = min(max(to, at + 1), at + rows, len(texts))
        yield Piece(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def word_spans(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of its text."""
    data, offsets = piece.data, piece.offsets
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, none
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; kept between calls."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, PIECE_BYTES + 1)
        _powers[:] = [
            np.cumprod(np.where(np.arange(n) == 0, np.uint64(1), np.uint64(b)), dtype=np.uint64)
            for b in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of the bytes."""
    n = len(data)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, A-Z lower-cased, and the index of its text."""
    starts, ends, text = word_spans(piece)
    return span_hashes(LOWER[piece.data], starts, ends), text


def shingle_hashes(
    words: np.ndarray, text: np.ndarray, size: int, whole_if_short: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of one text; a shorter text is one shingle as a whole."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    odd = np.uint64(0xD6E8FEB86659FD93)
    out_hash, out_text = [], []
    if n >= size:
        inside = text[size - 1 :] == text[: n - size + 1]
        total = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            total = total * odd + words[k : n - size + 1 + k]
        out_hash.append(mix(total[inside]))
        out_text.append(text[: n - size + 1][inside])
    if whole_if_short:
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        count = np.diff(np.append(first, n))
        for k in np.unique(count[count < size]):
            short = first[count == k]
            total = np.full(len(short), k, dtype=np.uint64)
            for j in range(k):
                total = total * odd + words[short + j]
            out_hash.append(mix(total ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            out_text.append(text[short])
    if not out_hash:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out_hash), np.concatenate(out_text)
