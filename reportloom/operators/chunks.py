"""Chunk tables and their way back to reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chunk import join_chunks


def chunk_table(df: DataFrame, chunks: Column, *ids: str) -> DataFrame:
    """``(ids…, chunk_no, chunk)`` of an array column, without a shuffle.

    The plain form of ``posexplode`` lets the optimizer make the array once more in a filter.
    """
    return df.select(*ids, F.posexplode_outer(chunks).alias("chunk_no", "chunk")).filter("chunk_no IS NOT NULL")


def rejoin_chunks(
    chunks: DataFrame, *ids: str, chunk: str = "chunk", out: str = "text", strip_each: bool = False
) -> DataFrame:
    """One row per ``ids`` with its chunks joined in order; ids must identify one record."""
    ordered = F.array_sort(F.collect_list(F.struct("chunk_no", F.col(chunk).alias("c"))))
    pieces = F.transform(ordered, lambda p: p["c"])
    return chunks.groupBy(*ids).agg(join_chunks(pieces, strip_each).alias(out))
