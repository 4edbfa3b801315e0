"""Vectorised hashing of the words and n-grams of many texts at once.

Texts of an Arrow column lie back to back in one byte buffer. Words are hashed by tables indexed
by place and byte, windows of words or bytes by a polynomial modulo 2**64 over the whole buffer (one
cumulative sum; a window is a difference of two prefix values times the inverse power of its
start), so no Python loop runs over words. The polynomial is for windows of a few hundred symbols
at most: sequences that differ like a Thue-Morse word and its complement agree in it from 1,024
symbols on. Hashes are finished with a 64-bit mixer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, U64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up, self.down


POWERS = Powers()


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values[j] * BASE**j (modulo 2**64) before each position."""
    up, _ = POWERS.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hash of values[start:end], from prefix_sums."""
    _, down = POWERS.upto(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def slices(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive runs of texts holding about ``size`` bytes (one text at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes other than 09-0D and 20), and for each
    text the index of its first word. ``offsets`` count from the start of ``data``."""
    inside = ~SPACES[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


TABLED = 64  # bytes of a word that tables hash; longer words go through a keyed digest


def _table(seed: int) -> np.ndarray:
    """A 64-bit value for every (place in a word, byte)."""
    return mix(mix(np.arange(1, TABLED * 256 + 1).astype(U64) * U64(BASE)) + U64(seed))


TABLES = {seed: _table(seed) for seed in (1, 2)}


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = False, seed: int = 1) -> np.ndarray:
    """64-bit hashes of words, independent for the seeds 1 and 2: the sum of a table's values for
    every (place, byte), or a BLAKE2 digest for words above TABLED bytes. (A polynomial modulo
    2**64 would give some long words of two letters one hash.) Long buffers go piece by piece to
    bound memory."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + (1 << 20), "right")))
        piece = data[at:int(ends[j - 1])]
        if lower:
            piece = LOWER[piece]
        low, high = starts[i:j] - at, ends[i:j] - at
        size = high - low
        long = size > TABLED
        own = np.where(long, 0, size)
        before = np.cumsum(own) - own
        place = np.arange(int(own.sum())) - np.repeat(before, own)
        codes = piece[np.repeat(low, own) + place].astype(np.int64) + (place << 8)
        sums = np.zeros(len(codes) + 1, U64)
        np.cumsum(TABLES[seed][codes], out=sums[1:])
        out[i:j] = mix((sums[before + own] - sums[before]) ^ mix(size.astype(U64)))
        for k in np.flatnonzero(long).tolist():
            digest = hashlib.blake2b(piece[low[k]:high[k]].tobytes(), digest_size=8, key=bytes([seed]))
            out[i + k] = int.from_bytes(digest.digest(), "little")
        i = j
    return out


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive values (empty if there are fewer)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    sums = prefix_sums(hashes)
    starts = np.arange(n)
    return span_hashes(sums, starts, starts + length)
