"""Exact integer products of matrices from float32 products of their residues.

Each matrix is reduced modulo several small primes. A float32 product of residues is exact as long as
every sum stays below 2^24, so the primes depend on the number of columns that are multiplied at once.
The residues of the products are put together by the Chinese remainder theorem, in balanced mixed radix:
the digits lie around zero, hence the number comes out with its sign.
"""

from __future__ import annotations

import math

import numpy as np

EXACT = 1 << 24  # float32 holds every integer up to here
COLUMNS = 64  # multiplied at once


def primes_for(columns: int, bound: int) -> list[int]:
    """Distinct primes, largest first, whose product exceeds ``2 * bound + 1``, and for which sums of
    ``columns`` products of residues are exact in float32."""
    largest = 2 * math.isqrt((EXACT - 1) // max(1, min(columns, COLUMNS))) + 1
    found: list[int] = []
    product, candidate = 1, largest
    while product <= 2 * bound + 1:
        if candidate < 3:
            raise ValueError("the products are too large")
        if candidate % 2 and all(candidate % d for d in range(3, math.isqrt(candidate) + 1, 2)):
            found.append(candidate)
            product *= candidate
        candidate -= 1
    return found


def centred(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues from -(prime - 1) / 2 to (prime - 1) / 2, for an odd prime."""
    half = prime // 2
    return (values + half) % prime - half


class Residues:
    """An integer matrix as float32 residues modulo each prime."""

    def __init__(self, values: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [centred(values.astype(np.int64), p).astype(np.float32) for p in primes]


def residue_products(a: Residues, b: Residues) -> list[np.ndarray]:
    """The centred residues of ``a`` times the transpose of ``b``, as int64, by prime."""
    found = []
    for prime, x, y in zip(a.primes, a.parts, b.parts):
        total = np.zeros((len(x), len(y)), np.int64)
        for at in range(0, x.shape[1], COLUMNS):
            total += (x[:, at : at + COLUMNS] @ y[:, at : at + COLUMNS].T).astype(np.int64)
        found.append(centred(total, prime))
    return found


def reconstructed(residues: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The integers with these residues that lie around zero.

    Digit after digit: what the digits so far do not explain of the next residue, divided by the
    product of the primes so far. Intermediate numbers stay below the square of a prime, and the sum
    has the size of the result.
    """
    digits: list[np.ndarray] = []
    for i, (residue, prime) in enumerate(zip(residues, primes)):
        rest = residue
        for digit, earlier in zip(digits, primes[:i]):
            rest = centred((rest - digit) * pow(earlier, -1, prime), prime)
        digits.append(rest)
    total = np.zeros_like(residues[0])
    for digit, prime in zip(reversed(digits), reversed(primes)):
        total = total * prime + digit
    return total


def products(a: Residues, b: Residues) -> np.ndarray:
    return reconstructed(residue_products(a, b), a.primes)
