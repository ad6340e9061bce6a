"""Feature-hashing embedding, a stand-in where no model is at hand."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import let
from ..functions.text import words

try:  # for short terms it takes half the time of OpenSSL's
    from _md5 import md5
except ImportError:
    from hashlib import md5


def totals(text: Column, dims: int) -> Column:
    """``array<bigint>`` of ``dims`` component totals, made in the row: no n-gram leaves it.

    Spark finds the words; their n-grams are hashed and counted in Arrow batches, a row at a time.
    """

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = np.zeros((len(batch), dims), np.int64)
            for row, joined in enumerate(batch):
                tokens = (joined.as_py() or "").split(" ")
                if tokens == [""]:
                    continue
                terms = tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]
                digests = b"".join([md5(term.encode()).digest() for term in terms])
                head = np.frombuffer(digests, ">u4")[::4].astype(np.int64)
                negative = np.frombuffer(digests, np.uint8)[4::16] >= 128  # the ninth hex digit is 8 or more
                slots = np.bincount(head % dims + negative * dims, minlength=2 * dims)
                found[row] = slots[:dims] - slots[dims:]
            yield pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * dims, found.ravel())

    call = F.arrow_udf(count, "array<bigint>")
    # Otherwise the optimizer may copy the call into a filter and count twice.
    return call.asNondeterministic()(F.array_join(words(text), " "))


def length(parts: Column) -> Column:
    return F.sqrt(F.aggregate(parts, F.lit(0).cast("long"), lambda total, x: total + x * x))


def hashing_values(df: DataFrame, key: str, text: str, dims: int) -> DataFrame:
    """``(key, dim, value)`` for non-zero components of the unit-length hashed n-grams.

    A term's component is given by the first eight hex digits of its MD5, its sign by the ninth.
    """

    def values(parts: Column) -> Column:
        numbered = F.transform(parts, lambda x, i: F.struct(i.alias("dim"), x.alias("total")))
        present = F.filter(numbered, lambda p: p["total"] != 0)
        return let(length(parts), lambda norm: F.transform(present, lambda p: F.struct(p["dim"].alias("dim"), (p["total"] / norm).alias("value"))))

    counted = df.select(key, totals(F.col(text), dims).alias("_totals"))
    return counted.select(key, F.inline(values(F.col("_totals"))))


def hashing_vectors(df: DataFrame, key: str, text: str, dims: int) -> DataFrame:
    """``(key, embedding)`` of every row; a text without terms gets zeros."""

    def unit(parts: Column) -> Column:
        value = lambda x, norm: F.when(norm > 0, x / norm).otherwise(0.0).cast("float")
        return let(length(parts), lambda norm: F.transform(parts, lambda x: value(x, norm)))

    counted = df.select(key, totals(F.col(text), dims).alias("_totals"))
    return counted.select(key, unit(F.col("_totals")).alias("embedding"))
