"""Vector scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import is_finite


def finite_vectors(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Rows whose vector has only finite components."""
    return vectors.filter(is_finite(F.col(embedding)))


def read_vectors(
    spark: SparkSession,
    *paths: str,
    key: str = "report_key",
    embedding: str = "embedding",
    extra: tuple[str, ...] = (),
    finite: bool = True,
) -> DataFrame:
    """``(report_key, embedding, source_file, file_path, row_index)`` of all finite vectors, or of all.

    Several paths form one merged set that remembers the file and row of each vector. A
    ``source_file`` that the set itself carries is kept; ``file_path`` tells files of one
    name apart.
    """
    raw = spark.read.parquet(*paths)
    missing = {key, embedding} - set(raw.columns)
    if missing:
        raise ValueError(f"vector files lack {sorted(missing)}")
    rows = (
        raw.select(
            F.col(key).cast("string").alias("report_key"),
            F.col(embedding).cast("array<float>").alias("embedding"),
            (F.col("source_file") if "source_file" in raw.columns else F.col("_metadata.file_name")).alias("source_file"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.row_index").alias("row_index"),
            *extra,
        )
    )
    return finite_vectors(rows) if finite else rows
