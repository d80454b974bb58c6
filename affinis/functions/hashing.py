"""Linear hash family over 56 bits of md5 as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2**31 - 1
# Values of each of the two halves that a member is hashed to.
HALF = 2**28


def coefficients(num_hashes: int, seed: int) -> list[tuple[int, int, int]]:
    """``(a, b, c)`` of each hash function, a pure function of seed and position."""

    def draw(letter: str, k: int) -> int:
        return int(hashlib.md5(f"{seed}{letter}{k}".encode()).hexdigest()[:8], 16)

    return [
        (1 + draw("a", k) % (PRIME - 1), draw("b", k) % PRIME, 1 + draw("c", k) % (PRIME - 1))
        for k in range(num_hashes)
    ]


def element_hash(element: Column, half: int = 0) -> Column:
    """28 bits of md5, the first or the second, so that ``a * x`` with ``a < 2**31`` fits a BIGINT."""
    digits = F.substring(F.md5(element.cast("string").cast("binary")), 1 + 7 * half, 7)
    return F.conv(digits, 16, 10).cast("bigint")


def linear_hash(first: str, second: str, a: int, b: int, c: int) -> Column:
    """``(a * first + c * second + b) mod PRIME``, and below it ``second``.

    Members that agree modulo the prime still differ by their second half, so
    the minima of very large sets of other members are not alike.
    """
    return F.expr(f"((`{first}` * {a}L + `{second}` * {c}L + {b}L) % {PRIME}L) * {HALF}L + `{second}`")
