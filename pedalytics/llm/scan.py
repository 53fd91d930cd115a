"""Vectorised views of a text column: tokens, rolling hashes and winnowed runs, in bounded chunks.

Text is handled as UTF-8 bytes. A token is one byte, or a maximal run of bytes that are not in a
separator class; separators are ASCII, so no code point is ever split. All hashes are polynomials
modulo 2**64 over random token values, so a window's hash is a difference of two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
SLICE_ROWS = 500
_BASES = (0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4F & ~7 | 3, 0xD6E8FEB86659FD93 & ~7 | 5)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)

# Byte classes: 0 separates, any other class is part of a token of that class.
_SPACES = [0x20, *range(0x09, 0x0E)]
WHITE = np.ones(256, np.uint8)
WHITE[_SPACES] = 0
ALNUM = np.zeros(256, np.uint8)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = 1
WORD_OR_MARK = np.where(ALNUM == 1, 1, 2).astype(np.uint8)
WORD_OR_MARK[_SPACES] = 0
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of ``x`` over the whole word (a 64-bit finaliser)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def powers(n: int, lane: int = 0, inverse: bool = False) -> np.ndarray:
    """1, B, B**2 .. modulo 2**64 (B odd), or the powers of its inverse."""
    have = _POWERS.get((lane, inverse))
    if have is None or len(have) < n:
        base = pow(_BASES[lane], -1, 1 << 64) if inverse else _BASES[lane]
        row = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        row[0] = 1
        have = np.cumprod(row, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:
            _POWERS[lane, inverse] = have
    return have[:n]


def prefix_hashes(values: np.ndarray, lane: int = 0) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), lane), out=out[1:])
    return out


def stretch_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Position-free hash of ``values[start:end]`` for many stretches at once."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), lane, True)[start] + (end - start).astype(np.uint64))


@dataclass
class Texts:
    """Some consecutive texts of a column, joined: ``data`` and the bounds of each text in it."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column in chunks of at most ``limit`` bytes or one text; null is empty."""
    if len(column) == 0:
        return
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield Texts(i, data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``rows`` rows, so that what a task derives from one stays small beside it."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


@dataclass
class Tokens:
    """Tokens of a chunk: their byte ranges and hashes; ``bounds`` are the token bounds of each text."""

    start: np.ndarray
    end: np.ndarray
    value: np.ndarray
    bounds: np.ndarray


def byte_tokens(texts: Texts) -> Tokens:
    at = np.arange(len(texts.data))
    return Tokens(at, at + 1, BYTE_VALUES[texts.data], texts.bounds)


def word_tokens(texts: Texts, classes: np.ndarray = WHITE, fold: bool = False) -> Tokens:
    """Maximal runs of bytes of one class, case-folded (A-Z only) for hashing if ``fold``."""
    data = LOWER[texts.data] if fold else texts.data
    kind = classes[data]
    n = len(data)
    new = np.ones(n + 1, bool)
    new[1:n] = kind[1:] != kind[:-1]
    new[texts.bounds] = True
    cut = np.flatnonzero(new)
    start, end = cut[:-1], cut[1:]
    keep = kind[start] != 0 if n else np.zeros(0, bool)
    start, end = start[keep], end[keep]
    value = stretch_hashes(prefix_hashes(BYTE_VALUES[data]), start, end)
    return Tokens(start, end, value, np.searchsorted(start, texts.bounds))


def word_bytes(texts: Texts, tokens: Tokens, i: int) -> list[bytes]:
    """The tokens of text ``i``."""
    lo, hi = tokens.bounds[i], tokens.bounds[i + 1]
    data = texts.data
    return [data[a:b].tobytes() for a, b in zip(tokens.start[lo:hi], tokens.end[lo:hi])]


def grams(tokens: Tokens, k: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every k consecutive tokens that lie in one text."""
    n = len(tokens.value)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.arange(n - k + 1)
    last = np.repeat(tokens.bounds[1:], np.diff(tokens.bounds))
    start = start[start + k <= last[: n - k + 1]]
    return start, stretch_hashes(prefix_hashes(tokens.value, lane), start, start + k, lane)


@dataclass
class Runs:
    """Runs of windows that share their seed; ``start`` is the token where the first window starts."""

    seed: np.ndarray
    span: np.ndarray
    text: np.ndarray
    start: np.ndarray
    count: np.ndarray


def winnow(tokens: Tokens, window: int, k: int) -> Runs:
    """Each window of ``window`` tokens keeps its least k-gram hash (the rightmost of equals).

    Two equal windows keep the same k-gram at the same place, so equal windows meet under one seed
    however far the texts differ around them. Windows next to each other mostly keep the same
    k-gram; such a run is one row. ``span`` hashes all tokens under the run, and the seed's place.
    """
    n = len(tokens.value)
    none = np.zeros(0, np.int64)
    if n < window:
        return Runs(none.astype(np.uint64), none.astype(np.uint64), none, none, none)
    size = n - k + 1
    at = np.arange(size)
    hashes = stretch_hashes(prefix_hashes(tokens.value), at, at + k)
    bits = np.uint64((1 << max(24, size.bit_length())) - 1)
    least = (hashes & ~bits) | (bits - at.astype(np.uint64))
    width, reach = window - k + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    last = np.repeat(tokens.bounds[1:], np.diff(tokens.bounds))
    good = np.flatnonzero(np.arange(len(least)) + window <= last[: len(least)])
    if not len(good):
        return Runs(none.astype(np.uint64), none.astype(np.uint64), none, none, none)
    place = (bits - (least[good] & bits)).astype(np.int64)
    new = np.ones(len(good), bool)
    new[1:] = (place[1:] != place[:-1]) | (good[1:] != good[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(good)))
    start, place = good[first], place[first]
    text = np.searchsorted(tokens.bounds, start, "right") - 1
    prefix = prefix_hashes(tokens.value, 1)
    span = stretch_hashes(prefix, start, start + count - 1 + window, 1)
    span = mix(span + (place - start).astype(np.uint64) * np.uint64(_BASES[2]))
    return Runs(hashes[place], span, text, start - tokens.bounds[text], count)


def covered(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Mask of the places under any of the stretches."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, np.minimum(starts, size), 1)
    np.add.at(step, np.minimum(starts + lengths, size), -1)
    return np.cumsum(step[:size]) > 0
