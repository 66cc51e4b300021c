"""Vectorised word and line work on UTF-8 buffers.

Words are maximal runs without space and ``\\x09-\\x0D``. Hashes are 64-bit polynomial hashes, mixed afterwards: two
different words share one with a probability of about 2**-64.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_P = U64(0x9E3779B97F4A7C15 | 1)
_P_INV = U64(pow(int(_P), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_P, _P_INV)):
            table = np.full(size, base, U64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=U64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def spans(body: np.ndarray, offsets: np.ndarray, stop: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes outside ``stop``; no run crosses a row."""
    if not len(body):
        return (np.zeros(0, np.int64),) * 3
    inside = ~stop[body]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[heads] = inside[heads]
    tails = heads[heads > 0] - 1
    ends[tails] = inside[tails]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offsets, s, "right") - 1


def run_hashes(body: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run, by its content alone."""
    if not len(s):
        return np.zeros(0, U64)
    power, inverse = _power_tables(len(body) + 1)
    sums = np.zeros(len(body) + 1, U64)
    np.cumsum((body.astype(U64) + U64(1)) * power[: len(body)], dtype=U64, out=sums[1:])
    return mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each row's items, given the ascending row of every item."""
    return np.searchsorted(rows, np.arange(n + 1))


def window_hashes(h: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first item of every window of ``width`` items within one row."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[width - 1 :])
    total = np.zeros(n, U64)
    for k in range(width):
        total += h[k : k + n] * U64((0xA0761D6478BD642F * (2 * k + 1) + 2 * k * k * 0xE7037ED1A0B428DB) & ((1 << 64) - 1) | 1)
    return mix(total[at]), at
