"""Fragment scan: parquet files of report pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import is_directory, require_match


def read_fragments(
    spark: SparkSession,
    path: str,
    key: str = "report_key",
    seq: str = "seq",
    text: str = "text",
) -> DataFrame:
    """``(report_key, seq, text, source_file)`` of one file or of a directory's parquet files.

    A file is taken whatever its extension; a directory is not searched below its own level.
    """
    reader = spark.read
    if is_directory(spark, path):
        require_match(spark, path, "*.parquet")
        reader = reader.option("pathGlobFilter", "*.parquet")
    return reader.parquet(path).select(
        F.col(key).alias("report_key"),
        F.col(seq).alias("seq"),
        F.col(text).alias("text"),
        F.col("_metadata.file_name").alias("source_file"),
    )
