"""A table of bits that tells which rows may have a partner, before anything is shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import let
from ..session import materialize

PLANES = 3  # bits of a key, each in a plane of its own
BITS_A_KEY = 4  # at least, in each plane
LEAST_BITS, MOST_BITS = 17, 27  # of a plane, powers of two: the table that each executor gets has 48 MB at most
BUCKET_BITS = 15
WORDS = (1 << BUCKET_BITS) // 64


def or_bits(a: Column, b: Column) -> Column:
    return a.bitwiseOR(b)


def low_bits(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


class BitTable:
    """Bits set for the ``key`` (a hash, long) of the rows of ``keys``; about ``count`` different ones are expected.

    A key has a bucket and in it one bit in each plane, from different bits of the hash; it is held if all are set, which
    with as many keys as expected one in 90 others is at most. The table follows their number up to ``MOST_BITS`` and is
    broadcast. With more keys than that, more rows pass by chance: what uses it has to join what passes. Nulls are never held.
    """

    def __init__(self, keys: DataFrame, count: int):
        self.bits = min(max(int(count * BITS_A_KEY).bit_length(), LEAST_BITS), MOST_BITS)
        key = F.col("key")
        rows = keys.filter("key IS NOT NULL").select(self._bucket(key).alias("_bucket"), *[self._bit(key, p).alias(f"bit{p}") for p in range(PLANES)])
        planes = [F.call_function("bitmap_construct_agg", F.col(f"bit{p}")).alias(f"plane{p}") for p in range(PLANES)]
        tables = rows.groupBy("_bucket").agg(*planes).select("_bucket", F.concat(*[f"plane{p}" for p in range(PLANES)]).alias("bitmap"))
        byte = lambda chars, at: F.ascii(F.get(chars, at)).cast("long")
        word = lambda chars, w: reduce(or_bits, [F.shiftleft(byte(chars, w * 8 + k), 56 - 8 * k) for k in range(8)])
        # as Latin-1, each byte is a character with its number
        words = let(F.split(F.decode("bitmap", "ISO-8859-1"), ""), lambda chars: F.transform(F.sequence(F.lit(0), F.lit(PLANES * WORDS - 1)), lambda w: word(chars, w)))
        self.table = materialize(tables.select("_bucket", words.alias("_words")), "bit-table")

    def _bucket(self, key: Column) -> Column:
        return low_bits(key, self.bits - BUCKET_BITS)

    def _bit(self, key: Column, plane: int) -> Column:
        """Its place in a plane of the bucket: bits of the hash that neither the bucket nor another plane has."""
        return low_bits(F.shiftright(key, MOST_BITS - BUCKET_BITS + plane * BUCKET_BITS), BUCKET_BITS)

    def held(self, key: Column) -> Column:
        """The condition of a join of rows with a hash and the table."""
        found = self._bucket(key) == F.col("_bucket")
        for plane in range(PLANES):
            bit = self._bit(key, plane)
            word = F.get("_words", (F.shiftright(bit, 6) + plane * WORDS).cast("int"))
            shift = ((7 - low_bits(F.shiftright(bit, 3), 3)) * 8 + low_bits(bit, 3)).cast("int")
            found &= low_bits(F.call_function("shiftright", word, shift), 1) == 1
        return found

    def holds(self, rows: DataFrame, key: Column | None = None) -> DataFrame:
        """The rows whose key is in the table, and a few others; nothing is shuffled."""
        return rows.join(F.broadcast(self.table), self.held(F.col("key") if key is None else key), "left_semi")

    def lacks(self, rows: DataFrame, key: Column | None = None) -> DataFrame:
        """The other rows; none of them has a key in the table."""
        return rows.join(F.broadcast(self.table), self.held(F.col("key") if key is None else key), "left_anti")
