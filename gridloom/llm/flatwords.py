"""Words of many texts at once, as flat numpy arrays over their UTF-8 bytes.

A word is a maximal run of bytes other than space and 0x09-0x0D. All functions
work on chunks of a few megabytes, so a task's memory does not grow with its
partition; only a single text longer than a chunk makes a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the public murmur3 finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _grow_powers(n: int) -> None:
    global _powers, _inverse_powers
    if len(_powers) < n:
        for name, base in (("_powers", _BASE), ("_inverse_powers", _BASE_INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            globals()[name] = np.multiply.accumulate(factors)


@dataclass
class FlatWords:
    """Texts of one chunk: bytes, text bounds, and bounds and owner of each word."""

    data: np.ndarray  # uint8
    bounds: np.ndarray  # int64, one more than texts
    starts: np.ndarray  # of words, in data
    ends: np.ndarray
    first_word: np.ndarray  # word range of each text, one more than texts

    @property
    def texts(self) -> int:
        return len(self.bounds) - 1

    def n_words(self) -> np.ndarray:
        return np.diff(self.first_word)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), self.n_words())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self, self.starts, self.ends)


def span_hashes(words: FlatWords, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes have equal hashes."""
    n = len(words.data) + 1
    _grow_powers(n)
    sums = np.zeros(n, np.uint64)
    np.cumsum((words.data.astype(np.uint64) + np.uint64(1)) * _powers[: n - 1], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * _inverse_powers[starts])


def split_words(data: np.ndarray, bounds: np.ndarray) -> FlatWords:
    solid = ~SPACE[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    # Texts lie next to each other in the buffer: a bound always separates words.
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    opens[inner] = solid[inner]
    closes[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(opens)
    return FlatWords(data, bounds, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, bounds, "left"))


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of pieces of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
    # A worker outlives its task; what it has read is given back, not kept for the next one.
    pa.default_memory_pool().release_unused()


def word_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, FlatWords]]:
    for row, end, data, bounds in chunks(texts, limit):
        yield row, end, split_words(data, bounds)


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for each text, 0 where there is none."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def window_hashes(words: FlatWords, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``k`` words inside a text, and the window range of each text.

    With ``short`` a text of 1 to k - 1 words has one window, which holds all of them.
    """
    h = words.hashes()
    n = words.n_words()
    count = np.maximum(n - (k - 1), 0)
    size = np.minimum(n, k)
    if short:
        count = np.where((n > 0) & (n < k), 1, count)
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    owner = np.repeat(np.arange(words.texts), count)
    at = words.first_word[owner] + (np.arange(first[-1]) - first[owner])
    out = np.zeros(len(at), np.uint64)
    wide = size[owner]
    for j in range(k):
        inside = np.minimum(at + j, max(len(h) - 1, 0))
        step = mix64(out + (h[inside] if len(h) else out))
        out = np.where(j < wide, step, out) if short else step
    return out, first
