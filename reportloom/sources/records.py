"""JSON-lines scan, malformed-line handling and decoding of mixed encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import replace_matches
from ..functions.text import strip
from ..operators.records import field
from ..operators.skew import join_to_unique
from ..session import materialize
from .files import is_directory, require_match


def read_lines(
    spark: SparkSession, path: str, recursive: bool = False, glob: str = "*.jsonl"
) -> DataFrame:
    """``(value, source_file, file_path, block_start, line_id)`` of the lines below ``path``.

    ``(file_path, block_start, line_id)`` orders lines as they stand in the files. It
    holds because it is taken on the scan itself: a file block is read by one task.
    ``source_file`` is the name for display; files of one name in different folders differ
    in ``file_path``.
    """
    reader = spark.read
    if is_directory(spark, path):
        if recursive:
            reader = reader.option("recursiveFileLookup", "true")
        else:
            require_match(spark, path, glob)
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def decode_lines(lines: DataFrame, value: str = "value", source: str | None = None) -> DataFrame:
    """Read each file as UTF-8, or as Latin-1 when any of its lines is not valid UTF-8.

    Files are told apart by ``source``, by default their path where it is known. The list of
    Latin-1 files is written first, so that its size is known: a short one is broadcast, and no line is shuffled.
    """
    source = source or ("file_path" if "file_path" in lines.columns else "source_file")
    per_file = (
        lines.groupBy(source)
        .agg(F.bool_and(F.is_valid_utf8(F.col(value))).alias("all_utf8"))
        .filter(~F.col("all_utf8"))
        .select(source, F.lit(True).alias("_latin1"))
    )
    per_file = materialize(per_file, "latin1-files")
    spread = [c for c in ("block_start", "line_id") if c in lines.columns] or [value]
    joined = join_to_unique(lines, per_file, source, how="left", spread_by=spread)
    latin1 = F.decode(F.col(value).cast("binary"), "ISO-8859-1")
    return joined.withColumn(
        value, F.when(F.col("_latin1"), latin1).otherwise(F.col(value))
    ).drop("_latin1")


_STRING_OR_NUMBER_NAME = r'"(?:[^"\\]++|\\.)*+"|-?\b(?:NaN|Infinity)\b'


def parse_line(line: Column) -> Column:
    """A line as a variant, null if it is no JSON even with the names of non-finite numbers."""
    parsed = F.try_parse_json(line)
    named = F.contains(line, F.lit("NaN")) | F.contains(line, F.lit("Infinity"))
    finite = replace_matches(line, _STRING_OR_NUMBER_NAME, lambda m: F.when(F.startswith(m, F.lit('"')), m).otherwise("null"))
    return F.when(parsed.isNull() & named, F.try_parse_json(finite)).otherwise(parsed)


def parse_records(
    lines: DataFrame, key: str = "report_key", text: str = "text", value: str = "value"
) -> DataFrame:
    """Adds ``record`` (variant), ``report_key``, ``text`` and ``status`` to non-blank lines.

    ``status`` is ``record`` for a JSON object, ``not_object`` for other JSON and
    ``unparsable`` for the rest. Keys become strings, so ``1`` and ``"1"`` are one key. NaN
    and infinite numbers are read as null. Of fields with one name the last counts where the
    session has ``spark.sql.variant.allowDuplicateKeys``, as ``build_session`` sets it.
    """
    line = strip(F.col(value))
    parsed = parse_line(line)
    status = (
        F.when(parsed.isNull(), "unparsable")
        .when(F.substring(line, 1, 1) != "{", "not_object")
        .otherwise("record")
    )
    return (
        lines.filter(line != "")
        .withColumn("status", status)
        .withColumn("record", F.when(F.col("status") == "record", parsed))
        .withColumn("report_key", field(F.col("record"), key))
        .withColumn("text", field(F.col("record"), text))
    )


def apply_policy(records: DataFrame, policy: str) -> DataFrame:
    """Malformed lines: ``pass_through`` keeps them raw, ``drop`` leaves them out."""
    if policy == "pass_through":
        return records
    if policy == "drop":
        return records.filter(F.col("status") == "record")
    raise ValueError(f"unknown policy {policy!r}; use malformed_counts to count")


def malformed_counts(records: DataFrame) -> DataFrame:
    """One row of counters: all, kept, unparsable, not an object or without a key."""
    keyless = (F.col("status") == "record") & F.col("report_key").isNull()
    return records.agg(
        F.count("*").alias("n_lines"),
        F.count_if((F.col("status") == "record") & ~keyless).alias("n_records"),
        F.count_if(F.col("status") == "unparsable").alias("n_unparsable"),
        F.count_if((F.col("status") == "not_object") | keyless).alias("n_malformed"),
    )
