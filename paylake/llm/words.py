"""Vectorised helpers over a batch of texts, for use inside Arrow functions.

A batch is one byte buffer plus row offsets, as Arrow keeps strings, so words
and windows of thousands of documents are hashed by a handful of numpy calls
and without a Python object per word. A word is a maximal run of bytes outside
space and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

# An odd multiplier has an inverse modulo 2**64, which moves a hash taken from
# prefix sums back to position zero.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(42)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64; grown on demand."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.full(size, np.uint64(base & (2**64 - 1)))
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 23:  # a longer one serves a single huge text and is not kept
            _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (shifts and multiplications)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    bufs = texts.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(table, column: str, budget: int) -> Iterator:
    """Cut a record batch or table into consecutive pieces of about ``budget``
    bytes of ``column`` (one row at least)."""
    col = table.column(column)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if not len(col):
        return
    _, offs = buffer_of(col)
    at = 0
    while at < len(col):
        end = int(np.searchsorted(offs, offs[at] + budget, side="right")) - 1
        end = min(max(end, at + 1), len(col))
        yield table.slice(at, end - at)
        at = end


def word_spans(data: np.ndarray, offs: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and number of words per row, of all rows' words;
    ``between`` tells which bytes lie between words."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs) - 1, np.int64)
    solid = ~between[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    row_starts = offs[:-1][offs[:-1] < n]
    first[row_starts] = solid[row_starts]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    row_ends = offs[1:][offs[1:] > 0] - 1
    last[row_ends] = solid[row_ends]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offs))
    return starts, ends, counts


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, the same wherever the span lies."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(_BASE_INV, n)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(word_hash: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside one row.

    Returns (hash, index of the window's first word, windows per row).
    """
    n = len(word_hash)
    per_row = np.maximum(counts - width + 1, 0)
    if not per_row.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), per_row
    base = _BASE ^ 0x5851F42D4C957F2C | 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hash * powers(base, n), out=sums[1:])
    row_start = np.concatenate(([0], np.cumsum(counts)[:-1]))
    at = ragged(row_start, per_row)
    h = (sums[at + width] - sums[at]) * powers(pow(base, -1, 1 << 64), n)[at]
    return mix(h), at, per_row


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start+1, ..`` of each (start, length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.arange(total, dtype=np.int64)
    shift = np.asarray(starts, np.int64) - np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return out + np.repeat(shift, lengths)


def binary_array(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    """Arrow binary array over one buffer and 64-bit offsets."""
    return pa.Array.from_buffers(pa.large_binary(), len(offs) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offs, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
