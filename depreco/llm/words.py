"""Words and word shingles of whole texts as numpy arrays, for the operators that run in Arrow tasks.

A word is a run of bytes other than the six ASCII white-space characters (``[^\\x20\\x09-\\x0D]+``).
Tasks see Arrow record batches; :func:`blocks` cuts a batch into runs of whole texts of about a
megabyte, so the arrays of a task stay small whatever the batch size (a longer text is a block of
its own). Hashes are 64 bits wide; they stand for the words within one run of the library only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | U64(1)
_BASE = U64(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """``_BASE ** i`` modulo 2**64 for i below ``n`` (kept between calls)."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 4096), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Texts(NamedTuple):
    """Bytes of some whole texts laid end to end; text i is ``data[at[i]:at[i + 1]]``."""

    data: np.ndarray
    at: np.ndarray


class Words(NamedTuple):
    start: np.ndarray  # first byte of each word in Texts.data
    end: np.ndarray  # one past its last byte
    first: np.ndarray  # index of each text's first word; one more entry than texts
    hash: np.ndarray


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, one past the last row, their texts) over the whole column."""
    if not len(column):
        return
    data, at = _raw(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, len(column), lo + 20_000)
        yield lo, hi, Texts(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        lo = hi


def words(texts: Texts, lower: bool = True, breaks: np.ndarray = SPACE) -> Words:
    """Every word of every text, in order: runs of bytes that ``breaks`` doesn't mark. ``lower`` folds A-Z."""
    data, at = texts
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(at), np.int64), np.zeros(0, np.uint64))
    solid = ~breaks[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    cut = ~solid
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= cut[:-1] | edge[1:n]
    ends[:-1] &= cut[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    if not len(start):
        return Words(start, end, first, np.zeros(0, np.uint64))
    size = end - start
    body = data[solid]
    value = _BYTE[LOWER[body] if lower else body]
    where = np.cumsum(size) - size
    place = np.arange(len(body)) - np.repeat(where, size)
    value *= powers(int(size.max()))[place]
    code = np.add.reduceat(value, where)
    return Words(start, end, first, mix(code + size.astype(np.uint64)))


def windows(w: Words, k: int, whole_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's windows of ``k`` consecutive words, text by text, and where each text begins.

    With ``whole_short`` a text of 1 to k-1 words has one window, its whole sequence."""
    count = np.diff(w.first)
    n = len(w.hash)
    full = np.maximum(count - k + 1, 0)
    whole = (count > 0) & (count < k) if whole_short else np.zeros(len(count), bool)
    at = np.zeros(len(count) + 1, np.int64)
    np.cumsum(full + whole, out=at[1:])
    out = np.zeros(at[-1], np.uint64)
    if n >= k:
        code = np.full(n - k + 1, _PLACE[63 - k], np.uint64)
        for j in range(k):
            code += w.hash[j : n - k + 1 + j] * _PLACE[j]
        take = np.repeat(w.first[:-1] - (np.cumsum(full) - full), full) + np.arange(full.sum())
        into = np.repeat(at[:-1] - (np.cumsum(full) - full), full) + np.arange(full.sum())
        out[into] = mix(code[take])
    for i in np.flatnonzero(whole):
        own = w.hash[w.first[i] : w.first[i + 1]]
        code = (own * _PLACE[: len(own)]).sum(dtype=np.uint64, keepdims=True) + _PLACE[63 - len(own)]
        out[at[i]] = mix(code)[0]
    return out, at


def shingle_sets(texts: Texts, k: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles (lower-cased)."""
    code, at = windows(words(texts), k, whole_short=True)
    for i in range(len(at) - 1):
        yield np.unique(code[at[i] : at[i + 1]])
