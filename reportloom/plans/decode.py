"""Fragments to readable reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import decode_hex, strip_rtf
from ..functions.fixed import PREVIEW_ROWS
from ..operators.assemble import assemble, preview


def decode_reports(
    fragments: DataFrame, scope: str = "file", min_hex_len: int = 0, **columns: str
) -> DataFrame:
    """Assembled reports with ``text``, ``text_decoded`` and ``text_plain``."""
    return (
        assemble(fragments, scope=scope, **columns)
        .withColumn("text_decoded", decode_hex(F.col("text"), min_hex_len))
        .withColumn("text_plain", strip_rtf(F.col("text_decoded")))
    )


def export_columns(reports: DataFrame, key: str = "report_key", plain: str = "text_plain") -> DataFrame:
    """The columns that exports carry."""
    return reports.select(F.col(key).alias("report_key"), F.col(plain).alias("text"))


def preview_reports(
    fragments: DataFrame,
    rows: int = PREVIEW_ROWS,
    key: str = "report_key",
    source: str = "source_file",
) -> DataFrame:
    """The first reports in key order, cut to a readable length.

    The keys are chosen first, so only the fragments of these few reports are assembled.
    """
    first = (
        fragments.select(F.col(source).alias("_source"), F.col(key).alias("_key"))
        .distinct()
        .orderBy("_key", "_source")
        .limit(rows)
    )
    chosen = fragments[source].eqNullSafe(F.col("_source")) & fragments[key].eqNullSafe(F.col("_key"))
    few = fragments.join(F.broadcast(first), chosen, "left_semi")
    return preview(decode_reports(few, key=key, source=source), key, rows=rows)
