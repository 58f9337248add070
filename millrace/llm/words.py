"""Words, word hashes and windows of words, for whole Arrow batches at a time.

All functions work on flat numpy arrays: the bytes of many texts after one another, the words in them,
and where each text begins. Hashes are 64-bit and depend on nothing but the bytes, so they agree between
tasks, runs and machines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """`n` fixed, unrelated 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * _STEP)


_BYTE = seeds(256, 7)


def separators(words: str) -> np.ndarray:
    """Table of the byte values that are not part of a word.

    `space`: words are runs of anything but ASCII white space. `alnum`: runs of ASCII letters and
    digits and of all bytes beyond ASCII.
    """
    table = np.ones(256, dtype=bool)
    if words == "space":
        table[:] = False
        table[0x09:0x0E] = True
        table[0x20] = True
    else:
        table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = False
        table[0x80:] = False
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """The words of some texts. Text i has the words first[i] to first[i + 1]."""

    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def place(self) -> np.ndarray:
        """Position of each word in its text."""
        return np.arange(len(self.hash)) - np.repeat(self.first[:-1], np.diff(self.first))

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.hash))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text bounds of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer text is a range of its own."""
    lengths = np.diff(flat(texts)[1])
    begin = size = 0
    for i, length in enumerate(lengths):
        if i > begin and size + length > limit:
            yield begin, i
            begin, size = i, 0
        size += int(length)
    if begin < len(lengths):
        yield begin, len(lengths)


def find(texts: pa.Array, words: str = "space", lower: bool = False) -> Words:
    """Words of the texts and their hashes."""
    data, bounds = flat(texts)
    if lower:
        data = LOWER[data]
    inside = ~separators(words)[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    edges = bounds[:-1][np.diff(bounds) > 0]
    before[edges] = False
    after[edges[1:] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    lengths = end - start
    base = np.cumsum(lengths) - lengths
    if len(start):
        letters = _BYTE[data[inside]]
        offset = np.arange(len(letters)) - np.repeat(base, lengths)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(lengths.max()), _STEP | np.uint64(1), np.uint64))
            hashed = mix(np.add.reduceat(letters * powers[offset], base))
    else:
        hashed = np.zeros(0, np.uint64)
    return Words(data, start, end, np.searchsorted(start, bounds), hashed)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a window made of a left and a right part (they may overlap)."""
    with np.errstate(over="ignore"):
        return mix(left * _LEFT + right * _RIGHT)


def windows(hashed: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each word on; without regard to where texts end.

    Windows are built by doubling; the last step lets its two parts overlap. The result is shorter
    than the input by length - 1.
    """
    if len(hashed) < length:
        return np.zeros(0, np.uint64)
    size, out = 1, hashed
    while size * 2 <= length:
        out = joined(out[:-size], out[size:])
        size *= 2
    if size < length:
        rest = length - size
        out = joined(out[:-rest], out[rest:])
    return out


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of `n` places lie in one of the windows of `length` at `starts`."""
    delta = np.bincount(starts, minlength=n + 1)[: n + 1].astype(np.int64)
    ends = np.minimum(starts + length, n)
    delta -= np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(delta[:n]) > 0
