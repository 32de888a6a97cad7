"""Reproducible random draws computed from a seed and a row id.

A draw depends on nothing else, so results are the same whatever the partitioning, and a value
drawn for another row can be recomputed instead of joined.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a word, as hexadecimal digits of a digest, and words that one digest gives.
DIGITS, SLOTS = 15, 2
#: Half the bits of a word; products of halves fit a long.
_HALF = 2 * DIGITS


def scaled(word: Column, bound: int | Column) -> Column:
    """A word as a number below `bound` (less than 10^18): the high part of their product.

    Every number is as likely as any other but for one part in 2^60 / bound.
    """
    limit = F.lit(bound).cast("bigint") if isinstance(bound, int) else bound.cast("bigint")
    if isinstance(bound, int) and 0 <= bound < 1 << (63 - 2 * _HALF):
        return F.shiftright(word * limit, 2 * _HALF)
    low = (1 << _HALF) - 1
    above, below = F.shiftright(word, _HALF), word.bitwiseAND(low)
    if isinstance(bound, int) and 0 <= bound <= low:
        return F.shiftright(above * limit + F.shiftright(below * limit, _HALF), _HALF)
    high, rest = F.shiftright(limit, _HALF), limit.bitwiseAND(low)
    middle = above * rest + below * high + F.shiftright(below * rest, _HALF)
    return above * high + F.shiftright(middle, _HALF)


class Draws:
    """Independent 60-bit draws for the rows identified by `key`."""

    def __init__(self, seed: int, label: str, key: Column) -> None:
        self._stem, self._key = f"{seed}|{label}", key

    def digest(self, block: int = 0) -> Column:
        return F.md5(F.concat_ws("|", F.lit(f"{self._stem}|{block}"), self._key.cast("string")))

    def word(self, number: int) -> Column:
        block, slot = divmod(number, SLOTS)
        return F.conv(F.substring(self.digest(block), 16 * slot + 1, DIGITS), 16, 10).cast("bigint")

    def below(self, number: int, bound: int | Column) -> Column:
        return scaled(self.word(number), bound)

    def between(self, number: int, low: int, high: int) -> Column:
        return self.below(number, high - low + 1) + low

    def cents(self, number: int, low: int, high: int, kind: str) -> Column:
        """A two-decimal amount between two bounds given in cents."""
        amount = self.between(number, low, high).cast("decimal(14,0)")
        return (amount * F.lit(Decimal("0.01"))).cast(kind)

    def pick(self, number: int, values: tuple[str, ...]) -> Column:
        options = F.array(*map(F.lit, values))
        return F.get(options, self.below(number, len(values)).cast("int"))
