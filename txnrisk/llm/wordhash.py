"""Vectorised word hashing of Arrow text columns (numpy inside Spark tasks).

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``; A-Z are folded to a-z.  The hash
of a word is a 64-bit sum over its bytes of a mixed (byte, position) value, so a whole batch is
hashed with a handful of array operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text hashed at a time; bounds the temporary arrays to a few dozen MB
BLOCK = 1 << 20

_U = np.uint64
WORD = np.ones(256, bool)
WORD[[0x20, 9, 10, 11, 12, 13]] = False
#: letters, digits and all non-ASCII bytes
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
FOLD = np.arange(256, dtype=np.uint64)
FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null as empty) and the n + 1 offsets."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def blocks(offs: np.ndarray):
    """Ranges of documents of about BLOCK bytes; one document is never cut."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + BLOCK, "right")) - 1)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray = WORD, heads: tuple[int, ...] = ()):
    """(hash, first byte, byte after the last) of every word, and the n + 1 word offsets of the
    documents.  With ``heads``, the hash has a further row for the first so many bytes of each word."""
    n = len(data)
    none = np.zeros((1 + len(heads), 0) if heads else 0, np.uint64)
    if n == 0:
        e = np.zeros(0, np.int64)
        return none, e, e, np.zeros(len(offs), np.int64)
    isin = inside[data]
    first = isin.copy()
    first[1:] &= ~isin[:-1]
    at = offs[:-1][offs[:-1] < n]
    first[at] = isin[at]
    start = np.flatnonzero(first)
    if len(start) == 0:
        e = np.zeros(0, np.int64)
        return none, e, e, np.zeros(len(offs), np.int64)
    spot = np.arange(n, dtype=np.int64) - start[np.maximum(np.cumsum(first) - 1, 0)]
    val = mix((FOLD[data] + (spot.astype(np.uint64) << _U(8)) + _U(1)) * _U(0x9E3779B97F4A7C15))
    val[~isin] = 0
    length = np.add.reduceat(isin, start, dtype=np.int64)
    h = np.add.reduceat(val, start)
    if heads:
        h = np.stack([h] + [np.add.reduceat(np.where(spot < k, val, _U(0)), start) for k in heads])
    return h, start, start + length, np.searchsorted(start, offs)


def sequence(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (len(h) - k + 1 values)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out = mix(out * _U(0x9E3779B97F4A7C15) + h[i:i + n])
    return out


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles of one document; with fewer words, all of them as one."""
    if len(h) == 0:
        return h
    return np.unique(sequence(h, k)) if len(h) >= k else sequence(h, len(h)) ^ _U(len(h))


def documents(batches, text: str, inside: np.ndarray = WORD):
    """For each row of the Arrow batches: (batch, row, word hashes), block by block."""
    for b in batches:
        data, offs = text_bytes(b.column(b.schema.get_field_index(text)))
        for lo, hi in blocks(offs):
            h, _, _, w = words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], inside)
            for i in range(lo, hi):
                yield b, i, h[w[i - lo]:w[i - lo + 1]]
