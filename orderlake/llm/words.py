"""Words of many texts at once, as numpy arrays over an Arrow column's own bytes.

A slice of texts is one byte array. A table of 256 flags says which bytes belong to words, so word edges
are two comparisons per byte, and prefix sums of byte powers give every word a 64-bit hash without a loop
over words. Texts never share a word or a window: text borders end words, and callers use ``text_of``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text worked on at a time; one longer text is taken alone.
SLICE_BYTES = 1 << 18

# Odd multipliers of the hashes, and the two steps of a 64-bit finalizer.
BYTE_BASE, WORD_BASE, OTHER_BASE = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def _flags(*ranges: tuple[int, int]) -> np.ndarray:
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


#: Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = ~_flags((0x20, 0x20), (0x09, 0x0D))
#: Digits, lower-case letters and every byte of a character beyond ASCII.
ALPHANUMERIC = _flags((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole value."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x = (x ^ (x >> U64(27))) * MIX_2
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64."""
    out = np.empty(n, U64)
    out[:1] = 1
    done, step = 1, base
    with np.errstate(over="ignore"):
        while done < n:
            out[done : 2 * done] = out[: min(done, n - done)] * step
            step = step * step
            done *= 2
    return out


def inverse(base: np.uint64) -> np.uint64:
    """The multiplicative inverse of an odd number modulo 2 ** 64."""
    return U64(pow(int(base), -1, 1 << 64))


class PrefixHash:
    """Polynomial hashes of ranges of a sequence from its prefix sums; powers are kept between slices."""

    def __init__(self, base: np.uint64):
        self._base, self._up, self._down = base, powers(base, 1), powers(base, 1)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            self._up, self._down = powers(self._base, n), powers(inverse(self._base), n)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums, one more than there are values."""
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self._up[: len(values)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self._down[start]


@dataclass
class Words:
    """Words of the texts ``first .. first + n_texts - 1`` of a batch. Words of text ``i`` are those from
    ``borders[i]`` to ``borders[i + 1]``."""

    first: int
    n_texts: int
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text_of: np.ndarray
    borders: np.ndarray


class Splitter:
    """Cuts texts into words of the bytes flagged in ``member``; ``lower`` maps A-Z to a-z first."""

    def __init__(self, member: np.ndarray, lower: bool):
        self._member, self._lower = member, lower
        self._bytes = PrefixHash(BYTE_BASE)

    def slices(self, column: pa.Array) -> Iterator[Words]:
        """Words of an Arrow column, a bounded volume of text at a time; null texts have none."""
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        buffer = column.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        valid = np.ones(len(column), bool) if not column.null_count else column.is_valid().to_numpy(zero_copy_only=False)
        first = 0
        while first < len(column):
            last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
            last = min(max(last, first + 1), len(column))
            yield self._split(data, offsets[first : last + 1], valid[first:last], first)
            first = last

    def _split(self, data: np.ndarray, offsets: np.ndarray, valid: np.ndarray, first: int) -> Words:
        raw = data[offsets[0] : offsets[-1]]
        if self._lower:
            raw = LOWER[raw]
        borders = offsets - offsets[0]
        inside = self._member[raw]
        for hole in np.flatnonzero(~valid & (borders[1:] > borders[:-1])):
            inside[borders[hole] : borders[hole + 1]] = False
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        # a text border ends a word whatever follows
        edge = borders[1:-1][(borders[1:-1] > 0) & (borders[1:-1] < len(raw))]
        starts[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
        start = np.flatnonzero(starts)
        end = np.flatnonzero(ends) + 1
        sums = self._bytes.sums(raw.astype(U64) + U64(1))
        hashes = mix(self._bytes.ranges(sums, start, end) + (end - start).astype(U64))
        at = np.searchsorted(start, borders)
        text_of = np.repeat(np.arange(len(borders) - 1), np.diff(at))
        return Words(first, len(borders) - 1, start, end, hashes, text_of, at)


def whole(words: Words, width: int) -> np.ndarray:
    """The words at which a run of ``width`` words of one text starts."""
    n = len(words.start) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.text_of[:n] == words.text_of[width - 1 :])


def window_max(values: np.ndarray, width: int) -> np.ndarray:
    """The largest of every ``width`` neighbours, by doubling."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.maximum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.maximum(out[: len(out) - rest], out[rest:]) if rest else out


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Flags of the ``n`` positions inside any range."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0
