"""The stateless record steps on JSON-lines files as they arrive.

Parsing, routing, date redaction and rewriting work on one line at a time, so they run on
a file stream unchanged. Jobs that compare or rank records stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.redact import redact_dates
from ..operators.records import rewrite_lines
from ..sources.records import parse_records


def stream_lines(
    spark: SparkSession, path: str, glob: str = "*.jsonl", files_per_batch: int = 1000
) -> DataFrame:
    """Lines of the files that arrive in a folder."""
    return (
        spark.readStream.option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(path)
    )


def redact_stream(
    lines: DataFrame, text: str = "text", output_key: str | None = None, preserve: bool = False
) -> DataFrame:
    """Lines with dates redacted; malformed lines and null texts pass unchanged."""
    records = parse_records(lines, text=text)
    suffix = "_de" if preserve else None
    return rewrite_lines(records, redact_dates(F.col("text")), text, output_key, suffix).select("value")


def write_lines(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all lines that have arrived, each once, and stop."""
    return (
        lines.writeStream.format("text")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
