"""Words of whole Arrow columns as 64-bit hashes, computed on the UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Blanks of the word contract, and odd 64-bit factors for hashing.
BLANK_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_FACTOR = 0x9E3779B97F4A7C15
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

SLICE_BYTES = 1 << 21  # bytes that are worked on at once; a longer text is worked on alone

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(BLANK_BYTES)] = False
_BYTE_HASH = np.random.default_rng(20_011).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(
    2
) + np.uint64(1)


class _Powers:
    """Powers of the factor and of its inverse, grown as longer texts come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, SLICE_BYTES + 1)
            inverse = pow(_FACTOR, -1, 1 << 64)
            self.up, self.down = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, f, np.uint64)]),
                           dtype=np.uint64)
                for f in (_FACTOR, inverse)
            )
        return self.up, self.down


_powers = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the hash of data[s:e] is (sums[e] - sums[s]) * inverse[s]."""
    up, down = _powers.upto(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_HASH[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return sums, down


def text_slices(
    texts: pa.Array, rows: int = 1 << 16
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row starts) for runs of `rows` and some SLICE_BYTES; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), first + rows, len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words in ASCII lower case, index of the first word of each row and the end)."""
    begin, end = word_spans(data, starts)
    return span_hashes(LOWER[data], begin, end), np.searchsorted(begin, starts)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return spans_of(prefix_hashes(data), begin, end)


def spans_of(prefix: tuple[np.ndarray, np.ndarray], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """`span_hashes` of data whose `prefix_hashes` are at hand, for several spans of the same data."""
    sums, down = prefix
    return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def word_spans(
    data: np.ndarray, starts: np.ndarray, is_word: np.ndarray = _IS_WORD
) -> tuple[np.ndarray, np.ndarray]:
    """First byte and the byte after the last of every word; no word goes over a row's end."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = is_word[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | fresh[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of `size` words of each text, as hashes.

    A text of fewer words, but not none, has the whole sequence as its one shingle.
    """
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    for _, data, starts in text_slices(texts):
        hashes, at = word_hashes(data, starts)
        full = max(0, len(hashes) - size + 1)
        runs = np.zeros(full, dtype=np.uint64)
        for j in range(size):
            runs = runs + hashes[j : j + full] * factors[j]
        runs = mixed(runs)
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= size:
                yield np.unique(runs[a : b - size + 1])
            elif b > a:
                yield mixed(np.sum(hashes[a:b] * factors[: b - a], keepdims=True, dtype=np.uint64)
                            + np.uint64(size - (b - a)))
            else:
                yield np.empty(0, np.uint64)
