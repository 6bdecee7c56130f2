"""Words of whole Arrow text columns, found and hashed with numpy.

A word is a maximal run of bytes that a table of 256 flags marks; texts never
run into each other. Work goes in pieces of whole texts of about ``PIECE_BYTES``,
and of ``PIECE_TEXTS`` texts at most, so that memory is bounded by the piece or by
the longest text.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19
PIECE_TEXTS = 1 << 13

# An odd base and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Words are separated by blanks, tabs, line ends, vertical tabs and form feeds.
PLAIN = np.ones(256, bool)
PLAIN[[0x20, *range(0x09, 0x0E)]] = False

#: Words are ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Bytes with A-Z lowered.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** n`` modulo 2**64, kept for the next call."""
    held = _powers.get(base)
    if held is None or len(held) <= n:
        held = np.full(max(n + 1, 1 << 16), base, np.uint64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        _powers[base] = held
    return held


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each span, whatever its place."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values))[: len(values)], out=sums[1:])
    spread = (sums[ends] - sums[starts]) * powers(INVERSE, len(values))[starts]
    return mixed(spread + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of some texts: ``first[t]:first[t + 1]`` are those of text ``t``,
    which has the bytes ``cuts[t]:cuts[t + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    cuts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all runs of ``size`` words within one text."""
        total = len(self.starts)
        if total < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(self.first) - 1), self.counts)
        at = np.flatnonzero(owner[: total - size + 1] == owner[size - 1 :])
        return at, span_sums(self.hashes, at, at + size)

    def texts(self) -> list[list[bytes]]:
        """The words themselves, by text."""
        raw = self.data.tobytes()
        words = [raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]
        cuts = self.first.tolist()
        return [words[a:b] for a, b in zip(cuts, cuts[1:])]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column's texts and where each begins; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[cuts[0] : cuts[-1]], cuts - cuts[0]


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, past the last, bytes, cuts) of runs of texts of about ``size`` bytes."""
    raw, cuts = text_bytes(column)
    low = 0
    while low < len(cuts) - 1:
        high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + size, "right")) - 1)
        high = min(high, low + PIECE_TEXTS)
        yield low, high, raw[cuts[low] : cuts[high]], cuts[low : high + 1] - cuts[low]
        low = high


def find_words(raw: np.ndarray, cuts: np.ndarray, marks: np.ndarray, lower: bool) -> Words:
    data = LOWER[raw] if lower else raw
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = marks[data]
    begins = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    # Adjoining texts whose bytes touch are two words.
    touch = cuts[1:-1]
    touch = touch[inside[touch] & inside[touch + 1]]
    begins[touch] = True
    ends[touch] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    first = np.searchsorted(starts, cuts)
    return Words(data, starts, ends, first, span_sums(_TABLE[data], starts, ends), cuts)


def word_pieces(
    column: pa.Array, marks: np.ndarray = PLAIN, lower: bool = False, size: int = PIECE_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """(first text, past the last, words) of the column's pieces, in order."""
    for low, high, raw, cuts in pieces(column, size):
        yield low, high, find_words(raw, cuts, marks, lower)


def spans_of(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length, one after the other."""
    lengths = np.asarray(lengths, np.int64)
    if not lengths.sum():
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) - np.repeat(before, lengths)
