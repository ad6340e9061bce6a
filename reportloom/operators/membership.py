"""Sets of words that an expression can ask inside the row, without a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import let

BITS_A_WORD = 32
LEAST_BITS, MOST_BITS = 12, 22  # powers of two: the set travels as one value of half a megabyte at most
NAME = "_words"


class WordSet:
    """The words of ``df[column]``, of which there are ``count``, as one value of bits.

    ``beside`` puts it into each row of a table, as a reference to the one value; ``holds`` asks it there. That is
    true for each word of the set and for a few others, of which there are more if the set has more
    than 130,000 words: what it lets through has to be checked exactly.
    """

    def __init__(self, df: DataFrame, column: str, count: int):
        self.bits = min(max(int(count * BITS_A_WORD).bit_length(), LEAST_BITS), MOST_BITS)
        slot = self._slot(F.col(column))
        here = df.select(F.shiftright(slot, 6).alias("id"), slot.bitwiseAND(F.lit(63).cast("long")).cast("int").alias("bit"))
        words = here.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word"))
        every = df.sparkSession.range(1 << (self.bits - 6)).join(words, "id", "left")
        pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))))
        self.value = every.agg(F.transform(pairs, lambda p: p["word"])).scalar()

    def _slot(self, word: Column) -> Column:
        return F.xxhash64(word).bitwiseAND(F.lit((1 << self.bits) - 1).cast("long"))

    def beside(self, df: DataFrame) -> DataFrame:
        return df.withColumn(NAME, self.value)

    def holds(self, word: Column) -> Column:
        def is_set(slot: Column) -> Column:
            bits = F.get(F.col(NAME), F.shiftright(slot, 6).cast("int"))
            bit = slot.bitwiseAND(F.lit(63).cast("long")).cast("int")
            return F.call_function("shiftright", bits, bit).bitwiseAND(F.lit(1).cast("long")) == 1

        return let(self._slot(word), is_set)
