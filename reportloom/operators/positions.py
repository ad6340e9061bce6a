"""Row numbers over large tables without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


def positions(
    df: DataFrame,
    source: str,
    position: str,
    out: str,
    within_source: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """0-based dense row number in ``(source, position)`` order.

    ``position`` is a whole number that is unique within its source, such as a row index
    with gaps. Rows are numbered within blocks of ``block_rows`` positions; only one row
    per block takes part in the running sum, so a source that holds most rows is still
    numbered by many tasks. With ``within_source`` each source starts at zero.
    """
    block = F.floor(F.col(position) / block_rows)
    blocked = df.withColumn("_block", block)
    sizes = blocked.groupBy(source, "_block").agg(F.count("*").alias("_n"))
    in_source = W.partitionBy(source).orderBy("_block")
    offsets = sizes.select(
        source,
        "_block",
        F.coalesce(F.sum("_n").over(in_source.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(
            "_offset"
        ),
    )
    if not within_source:
        totals = sizes.groupBy(source).agg(F.sum("_n").alias("_n"))
        # One row per source file.
        starts = totals.select(
            source,
            F.coalesce(
                F.sum("_n").over(W.orderBy(source).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ).alias("_start"),
        )
        offsets = offsets.join(starts, source).select(
            source, "_block", (F.col("_offset") + F.col("_start")).alias("_offset")
        )
    local = F.row_number().over(W.partitionBy(source, "_block").orderBy(position)) - 1
    return (
        blocked.withColumn("_local", local)
        .join(offsets, [source, "_block"])
        .withColumn(out, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_block", "_local", "_offset")
    )
