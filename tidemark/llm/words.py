"""Words of whole UTF-8 texts, found and hashed with numpy over the Arrow buffers.

A chunk holds the bytes of several documents end to end.  Words are maximal runs of word bytes
that do not cross a document boundary; each gets a 64-bit hash of its bytes (A-Z lower-cased when
the scanner lower-cases).  No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_MULT = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and shift rounds)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xC2B2AE3D27D4EB4F)
    x ^= x >> U64(32)
    return x


def word_bytes(kind: str) -> np.ndarray:
    """Which bytes belong to words: ``spaced`` ([^\\x20\\x09-\\x0D]) or ``alnum`` (0-9 A-Z a-z and all non-ASCII)."""
    inside = np.ones(256, bool)
    if kind == "spaced":
        inside[list(_SPACE)] = False
    elif kind == "alnum":
        inside[:128] = False
        inside[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    else:
        raise ValueError(kind)
    return inside


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U64) * _MULT)
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


class _Powers:
    """Powers of an odd multiplier modulo 2^64, as many as the longest word so far needed."""

    def __init__(self) -> None:
        self.table = np.ones(1, U64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.table):
            size = max(n, 2 * len(self.table), 64)
            steps = np.full(size, U64(0xF1357AEA2E62A9C5))
            steps[0] = 1
            self.table = np.multiply.accumulate(steps)
        return self.table


_POWERS = _Powers()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its rows in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    offsets_type = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, offsets_type)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of rows of about ``most`` bytes; a longer text is a run of its own."""
    data, bounds = text_buffers(column)
    row, n = 0, len(bounds) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1)
        yield row, end, data[bounds[row]:bounds[end]], bounds[row:end + 1] - bounds[row]
        row = end


@dataclass
class Words:
    starts: np.ndarray   # first byte of each word
    ends: np.ndarray     # byte after it
    first: np.ndarray    # index of each document's first word, and the number of words at the end
    hashes: np.ndarray   # 64-bit hash of each word

    def per_doc(self) -> np.ndarray:
        return np.diff(self.first)


class Scanner:
    """Finds the words of a chunk; ``lower`` treats A-Z as a-z."""

    def __init__(self, kind: str, lower: bool) -> None:
        self.inside = word_bytes(kind)
        self.values = _byte_values(lower)

    def bounds(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word."""
        inside = self.inside[data]
        cuts = bounds[(bounds > 0) & (bounds < len(data))]
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[cuts] = inside[cuts]
        finishes[:-1] &= ~inside[1:]
        finishes[cuts - 1] = inside[cuts - 1]
        return np.flatnonzero(begins), np.flatnonzero(finishes) + 1

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> Words:
        starts, ends = self.bounds(data, bounds)
        return Words(starts, ends, np.searchsorted(starts, bounds), self.hash_runs(data[self.inside[data]], ends - starts))

    def hash_runs(self, letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Hashes of consecutive runs of bytes of these lengths."""
        if not len(lengths):
            return np.zeros(0, U64)
        at = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - np.repeat(at, lengths)
        powers = _POWERS.upto(int(lengths.max()))
        return mix(np.add.reduceat(self.values[letters] * powers[place], at) + lengths.astype(U64) * _MULT)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (also across documents: callers drop those)."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    out = np.full(len(hashes) - n + 1, U64(n))
    for k in range(n):
        out = mix(out * _MULT + hashes[k:len(hashes) - n + 1 + k])
    return out


def hash_of(words: list[bytes], scanner: Scanner) -> np.ndarray:
    """Hashes of given words, as the scanner would hash them in a text (each must consist of word bytes)."""
    if not words:
        return np.zeros(0, U64)
    return scanner.hash_runs(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]))
