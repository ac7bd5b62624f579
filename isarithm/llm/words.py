"""Word and shingle hashing over whole Arrow string columns with flat numpy arrays.

A word is a maximal run of bytes that are not one of the six ASCII blanks
(space, tab, line feed, vertical tab, form feed, carriage return).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Odd 64-bit multipliers, from a fixed seed; they only have to be the same everywhere.
ODD = np.random.default_rng(20240229).integers(1, 2**63, 512, dtype=np.uint64) | U(1)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


class Words(NamedTuple):
    """Words of consecutive documents: start and end byte, and the bounds of each document's words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # n_docs + 1 bounds into starts
    docs: np.ndarray  # n_docs + 1 bounds into data


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column without copying, and n + 1 offsets; a null is empty."""
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out = whole[at[0] : at[-1]]
    at = at - at[0]
    if column.null_count:
        lengths = np.diff(at)
        if lengths[np.asarray(column.is_null())].any():
            return flat(column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b""))
    return out, at


def pieces(batch: pa.RecordBatch, column: int, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about `size` bytes in the column each; one row over that makes a slice of its own."""
    if batch.num_rows == 0:
        return
    _, at = flat(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = j


def split(data: np.ndarray, at: np.ndarray, blank: np.ndarray = BLANK) -> Words:
    """Words of the documents data[at[i]:at[i + 1]]; no word runs from one document into the next."""
    n = len(data)
    if n == 0:
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64), at)
    gap = blank[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], after[-1] = True, True
    before[1:], after[:-1] = gap[:-1], gap[1:]
    before[at[:-1][at[:-1] < n]] = True
    after[at[1:][at[1:] > 0] - 1] = True
    solid = ~gap
    starts, ends = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at), at)


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, read eight at a time."""
    padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    length = w.ends - w.starts
    h = length.astype(np.uint64) * ODD[0]
    live, at = np.arange(len(length)), w.starts
    left = length
    while len(live):
        block = lanes[at] & _MASK[np.minimum(left, 8)]
        h[live] = mix((h[live] ^ block) * ODD[1])
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


def shingles(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's runs of n words, and their bounds.

    A document of 1 to n - 1 words has one shingle, of all its words; one without words has none.
    """
    count = np.diff(first)
    per = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(per)])
    start = np.repeat(first[:-1] - bounds[:-1], per) + np.arange(bounds[-1])
    end = np.repeat(first[1:], per)
    out = np.zeros(bounds[-1], np.uint64)
    padded = np.concatenate([h, np.zeros(n, np.uint64)])
    for j in range(n):
        out += np.where(start + j < end, padded[start + j] * ODD[8 + j], U(0))
    return mix(out), bounds
