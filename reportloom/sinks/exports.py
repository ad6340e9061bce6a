"""Report, vector, cluster and version exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _by_source(df: DataFrame, source: str):
    """A writer with one folder per source; large sources are spread over several tasks."""
    return df.hint("rebalance", source).write.partitionBy(source)


def export_jsonl(df: DataFrame, path: str, source: str | None = None) -> None:
    """JSON lines with all columns, nulls written; one folder per ``source`` if given."""
    writer = _by_source(df, source) if source else df.write
    writer.option("ignoreNullFields", "false").json(path)


def export_csv(df: DataFrame, path: str, source: str | None = None) -> None:
    """CSV with a header and doubled quotes; one folder per ``source`` if given.

    Null is written as nothing and empty text as ``""``.
    """
    writer = _by_source(df, source) if source else df.write
    writer.option("header", "true").option("escape", '"').csv(path)


def export_bucketed(
    df: DataFrame, path: str, key: str = "report_key", buckets: int = 32
) -> None:
    """JSON lines in folders by key hash, so one report is found by reading one folder."""
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
    (
        df.withColumn("bucket", bucket)
        .hint("rebalance", "bucket")
        .write.option("ignoreNullFields", "false")
        .partitionBy("bucket")
        .json(path)
    )


def export_lines(lines: DataFrame, path: str, value: str = "value") -> None:
    """Raw or rewritten lines as text."""
    lines.select(value).write.text(path)


def export_vectors(df: DataFrame, path: str) -> None:
    """Vectors as parquet; no rows give an empty table with its columns."""
    df.write.parquet(path)


def export_clusters(representatives: DataFrame, topic_lists: DataFrame, path: str) -> None:
    """Representatives and topic lists as JSON lines in two folders below ``path``."""
    base = path.rstrip("/")
    representatives.write.option("ignoreNullFields", "false").json(f"{base}/clusters")
    topic_lists.write.json(f"{base}/topics")


def export_pairs(pairs: DataFrame, path: str) -> None:
    """Version pairs as JSON lines."""
    pairs.select("report_key", "text_a", "text_b").write.json(path)
