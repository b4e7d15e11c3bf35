"""Words, word shingles and MinHash values of Arrow text columns, on NumPy arrays.

Words are found on UTF-8 bytes, so no Python object is made for a word. A word is a run
of digits, of letters a-z (A-Z are lowered) and of anything that is not ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that are hashed together; the tables of powers are as long.
PIECE = 1 << 18
# Bytes of text that are worked on at once; a longer text makes a slice of its own.
SLICE_BYTES = 8 << 20
_BASE = 0x9E3779B97F4A7C15

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


@lru_cache(maxsize=6)
def powers(length: int, inverse: bool = False) -> np.ndarray:
    """Powers of the base of the rolling hash modulo 2**64, or of its inverse."""
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    out = np.full(length, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    size = PIECE if length <= PIECE else 1 << (length - 1).bit_length()
    return powers(size), powers(size, inverse=True)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Hash of every prefix; of any part it is ``(h[end] - h[start]) * inverse[start]``."""
    ups, _ = _tables(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * ups[: len(data)], out=out[1:])
    return out


def inverse_powers(length: int) -> np.ndarray:
    return _tables(length)[1]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES):
    """Record batches cut so that ``column`` has about ``limit`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD):
    """Starts and ends of all words, and per row the number of words before it."""
    word = is_word[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a text column, and the offsets of its rows."""
    data, offsets = text_bytes(column)
    starts, ends, rows = word_bounds(data, offsets)
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        part = LOWER[data[base : ends[to - 1]]]
        hashed = prefix_hash(part)
        begin, end = starts[at:to] - base, ends[at:to] - base
        value = (hashed[end] - hashed[begin]) * inverse_powers(len(part) + 1)[begin]
        out[at:to] = mix(value + (end - begin).astype(np.uint64))
        at = to
    return out, rows


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words, but not none, make one shingle."""
    width = min(width, len(words))
    if not width:
        return words[:0]
    count = len(words) - width + 1
    value = np.zeros(count, dtype=np.uint64)
    for i in range(width):
        value = value * np.uint64(_BASE) + words[i : i + count]
    return mix(value + np.uint64(width))


@lru_cache(maxsize=8)
def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    flips, factors = random.integers(0, 1 << 32, (2, count), dtype=np.uint32)
    return flips[:, None], factors[:, None] | np.uint32(1)


def minhash(values: np.ndarray, count: int, seed: int) -> np.ndarray:
    """``count`` 32-bit MinHash values of a set that is not empty."""
    flips, factors = permutations(count, seed)
    out = np.full(count, 0xFFFFFFFF, dtype=np.uint32)
    high = (values >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), 2048):
        part = high[None, at : at + 2048] ^ flips
        part *= factors
        np.minimum(out, part.min(axis=1), out=out)
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; for short arrays faster than ``numpy.unique``."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def set_key(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of hashes, whatever their order."""
    low = int(mix(values).sum(dtype=np.uint64))
    high = int(mix(values ^ np.uint64(_BASE)).sum(dtype=np.uint64))
    return low - (1 << 64) * (low >> 63), high - (1 << 64) * (high >> 63)


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for every band of ``rows`` MinHash values, different between bands."""
    bands = values.astype(np.uint64).reshape(-1, rows)
    key = np.arange(len(bands), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(rows):
        key = mix(key * np.uint64(_BASE) + bands[:, i])
    return key.view(np.int64)
