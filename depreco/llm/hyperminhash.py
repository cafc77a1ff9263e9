"""HyperMinHash registers of a set of 64-bit hashes.

A register keeps, of the smallest hash that falls into its bucket, the position of the leading one
(the count of leading zeros) and the next ``MANTISSA`` bits: 16 bits in place of 64. The packing is
monotone, so the smallest packed value is the packed smallest value, and equal elements always give
equal registers: compression can add candidates, never lose one.

Two ways of dealing elements to buckets:

* ``split``: the range of 64-bit values is cut into equal buckets (one pass over the set). Used from ``SPLIT_MIN``
  elements; empty buckets copy the first filled one of a probing order common to all sets.
* ``every``: each register ranks all elements by its own salted hash. Used up to ``EVERY_MAX``
  elements, where splitting would leave most buckets empty.

Sets in between carry both, so that any two sets of sizes a <= b with a >= 0.75 b share a way.
"""

from __future__ import annotations

import numpy as np

from .words import U64, mix

REGISTERS = 160
ROWS = 4  # registers of a band: a pair of similarity 0.75 shares none of 40 bands once in 4 million
BANDS = REGISTERS // ROWS
MANTISSA = 10
SPLIT_MIN, EVERY_MAX = 192, 256  # 192 = 0.75 * 256
EMPTY = np.uint16(0xFFFF)

_RNG = np.random.default_rng(7)
_SALT = _RNG.integers(1, 2**63, REGISTERS, dtype=np.uint64)
_EDGES = np.array([i * 2**64 // REGISTERS for i in range(REGISTERS)], np.uint64)
_PROBES = [_RNG.integers(0, REGISTERS, REGISTERS) for _ in range(4096)]


def pack(rest: np.ndarray) -> np.ndarray:
    """Leading-one position and mantissa of values below 2**49, in one monotone 16-bit number."""
    fraction, exponent = np.frexp(rest.astype(np.float64))
    mantissa = ((fraction - 0.5) * (2 << MANTISSA)).astype(np.int64)
    return np.where(rest == 0, 0, (exponent.astype(np.int64) << MANTISSA) | mantissa).astype(np.uint16)


def split_registers(ordered: np.ndarray) -> np.ndarray:
    """Registers of a sorted set of at least one element: the smallest offset in each bucket."""
    at = np.searchsorted(ordered, _EDGES)
    end = np.append(at[1:], len(ordered))
    filled = at < end
    smallest = ordered[np.minimum(at, len(ordered) - 1)]
    out = np.where(filled, pack((smallest - _EDGES) >> U64(8)), EMPTY)
    todo = np.flatnonzero(~filled)
    for probe in _PROBES:
        if not len(todo):
            break
        near = probe[todo]
        hit = filled[near]
        out[todo[hit]] = out[near[hit]]
        todo = todo[~hit]
    return out.astype(np.uint16)


def every_registers(elements: np.ndarray) -> np.ndarray:
    """Registers of a small set: each ranks all elements by its own salt."""
    return pack(mix(elements[:, None] ^ _SALT[None, :]).min(axis=0) >> U64(16))


def registers(ordered: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(way, registers) of a sorted distinct set; none for the empty set."""
    n = len(ordered)
    out = []
    if 0 < n <= EVERY_MAX:
        out.append((0, every_registers(ordered)))
    if n >= SPLIT_MIN:
        out.append((1, split_registers(ordered)))
    return out


def bands(regs: np.ndarray) -> np.ndarray:
    """Each band of ROWS registers as one 64-bit value, for registers by row."""
    return np.ascontiguousarray(regs).view(np.uint64)


def band_keys(way: int, regs: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each band, different for each band and way."""
    tag = (np.arange(BANDS, dtype=np.uint64) * U64(2) + U64(way) + U64(1)) * U64(0x9E3779B97F4A7C15)
    return mix(mix(bands(regs)) + tag)


#: Chance that the registers of unrelated sets agree: the smallest of many uniform values lies in
#: about one octave, in which the mantissa has this many values.
CHANCE_EQUAL = 1.0 / (1 << MANTISSA)

#: Lowest estimate that goes on to verification. At similarity 0.75 the share of equal registers has
#: a standard deviation of 0.034; 0.56 lies 5.5 of them below.
LEAST_ESTIMATE = 0.56


def jaccard_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal registers (by row) without the collisions of packed values.

    If sets of similarity j agree in a share s = j + (1 - j) * c of their registers, where c is the
    chance that different smallest elements pack alike, then j = (s - c) / (1 - c)."""
    share = (a == b).mean(axis=-1)
    return np.clip((share - CHANCE_EQUAL) / (1 - CHANCE_EQUAL), 0.0, 1.0)
