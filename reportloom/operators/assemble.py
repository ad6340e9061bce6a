"""Fragment assembly, load statistics and preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import PREVIEW_ENCODED_CHARS, PREVIEW_PLAIN_CHARS, PREVIEW_ROWS
from ..functions.text import clip

SEQ_BLOCK = 4096


def _in_order(pieces: Column, field: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(pieces)), lambda p: p[field]), "")


def assemble(
    fragments: DataFrame,
    key: str = "report_key",
    seq: str = "seq",
    text: str = "text",
    source: str = "source_file",
    scope: str = "file",
    seq_block: int = SEQ_BLOCK,
) -> DataFrame:
    """One row per report with its fragments joined in sequence order.

    Null fragments are skipped, a report of only null fragments is ``''``, a null
    sequence comes first and a null key forms a report. Equal sequence numbers are
    ordered by text. ``scope="file"`` keeps a report of two files as two rows,
    ``scope="global"`` joins them.

    Texts are shuffled once, to their report; blocks of ``seq_block`` sequence numbers and then the
    blocks of a report are put together there, without another shuffle or another look at the
    fragments. So no single array holds all fragments of a long report. Empty fragments add nothing
    and are not collected: what a task holds of one report never exceeds the text it has to return.
    """
    if scope not in ("file", "global"):
        raise ValueError(f"scope is 'file' or 'global', not {scope!r}")
    report = [source, key] if scope == "file" else [key]
    piece = F.when(F.col(text) != "", F.struct(F.col(seq).alias("seq"), F.col(text).alias("text")))
    numeric = dict(fragments.dtypes)[seq] in ("tinyint", "smallint", "int", "bigint")
    if not numeric:
        return fragments.groupBy(*report).agg(_in_order(piece, "text").alias("text"))
    block = F.floor(F.col(seq) / seq_block)
    # A null sequence is a block of its own, the first.
    placed = fragments.repartition(*report)
    blocks = placed.groupBy(*report, block.alias("_block")).agg(_in_order(piece, "text").alias("_part"))
    part = F.struct(F.col("_block").alias("block"), F.col("_part").alias("part"))
    return blocks.groupBy(*report).agg(_in_order(part, "part").alias("text"))


def load_stats(
    fragments: DataFrame, key: str = "report_key", source: str = "source_file"
) -> DataFrame:
    """Rows and reports per file, and their totals in a row with a null file."""
    per_key = fragments.groupBy(source, key).agg(F.count("*").alias("_n"))
    return (
        per_key.rollup(source)
        .agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_reports"))
    )


def preview(
    reports: DataFrame,
    key: str = "report_key",
    encoded: str = "text",
    decoded: str = "text_decoded",
    plain: str = "text_plain",
    rows: int = PREVIEW_ROWS,
) -> DataFrame:
    """The first reports in key order, their texts cut to a readable length."""
    return (
        reports.orderBy(key)
        .limit(rows)
        .select(
            key,
            clip(F.col(encoded), PREVIEW_ENCODED_CHARS).alias("encoded"),
            clip(F.col(decoded), PREVIEW_ENCODED_CHARS).alias("decoded"),
            clip(F.col(plain), PREVIEW_PLAIN_CHARS).alias("plain"),
        )
    )
