"""Vectorised words and rolling hashes over the UTF-8 bytes of a batch of texts.

Texts arrive as Arrow string arrays, whose bytes lie one after the other. All functions here
work on slices of such a batch with numpy, so a task holds one slice, never a whole partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once. A longer text is a slice of its own.
SLICE_BYTES = 2 << 20

U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)
_PRIME = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_WORD_PRIME = 0xA0761D6478BD642F


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = h + _GOLDEN
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


BYTE_CODES = mix(np.arange(256, dtype=U64) * _GOLDEN + U64(7))


def byte_class(expression: str) -> np.ndarray:
    """Which of the 256 bytes belong to a set given as ranges, such as ``"20,09-0D"`` in hex."""
    found = np.zeros(256, dtype=bool)
    for part in expression.split(","):
        low, _, high = part.partition("-")
        found[int(low, 16) : int(high or low, 16) + 1] = True
    return found


#: Words end at these; all bytes of a character beyond ASCII are in words.
SPACES = byte_class("20,09-0D")
#: Letters a-z, digits and all beyond ASCII are in words, everything else ends them.
NOT_ITEM_WORD = byte_class("00-2F,3A-60,7B-7F")

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    return tuple(
        np.cumprod(np.concatenate([[U64(1)], np.full(n, U64(b), dtype=U64)]), dtype=U64) for b in (base, inverse)
    )


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse, modulo 2**64."""
    size = SLICE_BYTES
    while size < n:
        size *= 2
    up, down = _powers(base, size)
    return up[: n + 1], down[: n + 1]


def sums(values: np.ndarray, base: int) -> np.ndarray:
    """Running sums of values * base**i; ``span_hash`` takes spans from them."""
    up, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[:-1], out=out[1:])
    return out


def span_hash(running: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Hash of each span [start, stop), the same wherever the span lies."""
    _, down = powers(base, len(running) - 1)
    return mix((running[stop] - running[start]) * down[start])


@dataclass
class Slice:
    """Texts first..last of a batch; ``bounds`` are byte offsets in ``data``."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """A batch in slices of at most ``limit`` bytes, one text at least. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, raw_bounds, raw = texts.buffers()
    bounds = np.frombuffer(raw_bounds, dtype=np.int64, count=n + 1, offset=texts.offset * 8)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield Slice(first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


@dataclass
class Words:
    """Words of a slice: byte spans, hash and text number of each; ``of`` has the words' bounds by text."""

    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    of: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.of)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), self.count)


def words(piece: Slice, separators: np.ndarray = SPACES, lower: bool = True) -> Words:
    """Runs of bytes outside ``separators``; no word crosses from one text to the next."""
    data = LOWER[piece.data] if lower else piece.data
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = piece.bounds[1:-1]
    at = cuts[(cuts > 0) & (cuts < len(data))]
    begins[at] |= inside[1:-1][at]
    ends[at - 1] |= inside[1:-1][at - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    running = sums(BYTE_CODES[data], _PRIME)
    return Words(start, stop, span_hash(running, start, stop, _PRIME), np.searchsorted(start, piece.bounds))


def grams(found: Words, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the n words from each word on; see ``whole`` for which of them lie in one text."""
    values = mix(found.hash ^ U64(seed)) if seed else found.hash
    running = sums(values, _WORD_PRIME)
    start = np.arange(max(0, len(values) - n + 1))
    return span_hash(running, start, start + n, _WORD_PRIME)


def whole(found: Words, n: int) -> np.ndarray:
    """Numbers of the words from which n words lie in the same text."""
    left = np.repeat(found.of[1:], found.count) - np.arange(len(found.start))
    return np.flatnonzero(left >= n)


def sequence_hash(found: Words, seed: int = 0) -> np.ndarray:
    """Hash of all words of each text, in order."""
    values = mix(found.hash ^ U64(seed)) if seed else found.hash
    return span_hash(sums(values, _WORD_PRIME), found.of[:-1], found.of[1:], _WORD_PRIME)


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from each byte on."""
    start = np.arange(max(0, len(data) - n + 1))
    return span_hash(sums(BYTE_CODES[data], _PRIME), start, start + n, _PRIME)


def rightmost_minima(values: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Position of the rightmost smallest value of each window of ``width`` from the given starts, each once."""
    best, at = values[starts], np.zeros(len(starts), dtype=np.int64)
    for j in range(1, width):
        here = values[starts + j]
        lower = here <= best
        best = np.where(lower, here, best)
        at[lower] = j
    return np.unique(starts + at)


def lists(values: np.ndarray, count: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow lists of the given lengths over flat values."""
    bounds = np.zeros(len(count) + 1, dtype=np.int32)
    np.cumsum(count, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, type=kind))
