"""The binary Golay code: a perfect covering code of 23 bits, as anchors for fingerprints.

Every 23-bit number is within ``RADIUS`` of exactly one of the 4 096 codewords.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

# Length, covering radius and generator polynomial of the code.
LENGTH, RADIUS = 23, 3
GENERATOR = 0xC75
CHECK_BITS = GENERATOR.bit_length() - 1
MESSAGE_BITS = LENGTH - CHECK_BITS
MASK = (1 << LENGTH) - 1


def _remainders(values: np.ndarray) -> np.ndarray:
    """Remainders of polynomials over two elements by the generator."""
    values = values.copy()
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        values ^= (values >> bit & 1) * (GENERATOR << (bit - CHECK_BITS))
    return values


@functools.cache
def _remainder_tables() -> tuple[np.ndarray, np.ndarray]:
    low = np.arange(1 << CHECK_BITS, dtype=np.int64)
    high = np.arange(1 << MESSAGE_BITS, dtype=np.int64) << CHECK_BITS
    return low, _remainders(high)


def syndromes(values: np.ndarray) -> np.ndarray:
    low, high = _remainder_tables()
    return low[values & ((1 << CHECK_BITS) - 1)] ^ high[values >> CHECK_BITS]


@functools.cache
def patterns(weight: int) -> tuple[np.ndarray, np.ndarray]:
    """All error patterns of so many bits, ordered by syndrome, and where each one's start."""
    chosen = list(combinations(range(LENGTH), weight))
    ones = np.array(chosen, np.int64).reshape(len(chosen), weight)
    errors = (np.int64(1) << ones).sum(axis=1)
    of = syndromes(errors)
    order = np.argsort(of, kind="stable")
    return errors[order], np.searchsorted(of[order], np.arange((1 << CHECK_BITS) + 1))


@functools.cache
def around(excess: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns that lead to the codewords ``excess`` beyond the radius; 0: to the nearest one."""
    if excess:
        return patterns(RADIUS + excess)
    every = [patterns(weight) for weight in range(RADIUS + 1)]
    errors = np.concatenate([e for e, _ in every])
    of = syndromes(errors)
    order = np.argsort(of, kind="stable")
    return errors[order], np.searchsorted(of[order], np.arange((1 << CHECK_BITS) + 1))


def anchors(values: np.ndarray, excess: int) -> tuple[np.ndarray, np.ndarray]:
    """Which value, and the number of the codeword, for all codewords that far away."""
    errors, edge = around(excess)
    of = syndromes(values)
    sizes = edge[of + 1] - edge[of]
    row = np.repeat(np.arange(len(values)), sizes)
    at = np.repeat(edge[of] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    return row, (values[row] ^ errors[at]) >> CHECK_BITS
