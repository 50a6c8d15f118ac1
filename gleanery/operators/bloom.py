"""Bloom filter of a column, built by aggregation and tested within a row.

It lets a row drop the values that cannot be in another table before they become
rows of their own. A value of the table always passes; one that is not passes in
a few of a hundred cases while the table has up to MOST_BITS / BITS_EACH values, and
more often beyond. So it decides how much is joined and never what is found.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.scale import let

#: Bits per value, and in all; the latter bounds what the driver and every task hold.
BITS_EACH = 16
MOST_BITS = 1 << 24

LEAST_BITS = 64
WORD_BITS = 64


class BloomFilter:
    """Bits of the values of a column."""

    def __init__(self, size: int, words: list[int]):
        self.size = size
        self._words = words

    def column(self) -> Column:
        """The filter as one constant of the plan, to be given to `may_hold`."""
        return F.from_json(F.lit(json.dumps(self._words)), "array<bigint>")

    def may_hold(self, value: Column, words: Column) -> Column:
        """Whether `value` can be in the table."""

        def set_bit(place: Column) -> Column:
            word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
            return F.getbit(word, place.bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")) == 1

        first, second = _places(value, self.size)
        return set_bit(first) & set_bit(second)

    def passing(self, values: Column) -> Column:
        """Those elements of an array that can be in the table."""
        return let(self.column(), lambda words: F.filter(values, lambda v: self.may_hold(v, words)))


def _places(value: Column, size: int) -> tuple[Column, Column]:
    """Two bits that stand for a value, from either half of its hash; `size` is a power of two."""
    number = F.xxhash64(value)
    mask = F.lit(size - 1).cast("long")
    return number.bitwiseAND(mask), F.shiftrightunsigned(number, 32).bitwiseAND(mask)


def bloom_filter(df: DataFrame, value: str, most_bits: int = MOST_BITS) -> BloomFilter:
    """The filter of the values of a column; NULL is not among them.

    Bits are put together in every task before they are shuffled, and the
    driver gets one number for 64 of them.
    """
    values = df.filter(F.col(value).isNotNull())
    places = values.select(F.explode(F.array(*_places(F.col(value), most_bits))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    words = F.shiftright("place", 6).alias("word")
    found = places.groupBy(words).agg(F.bit_or(bit).alias("bits")).collect()
    size = LEAST_BITS
    while size < min(len(found) * BITS_EACH // 2, most_bits):
        size *= 2
    # A place in a smaller filter is the lower bits of that in a larger one.
    bits = [0] * (size // WORD_BITS)
    for row in found:
        bits[row.word % len(bits)] |= row.bits
    return BloomFilter(size, bits)
