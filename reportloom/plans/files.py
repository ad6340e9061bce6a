"""Whole jobs from files to files: each scan, policy, operator, rewrite and sink in one call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CLUSTERS, REPRESENTATIVES, TOPIC_TERMS
from ..functions.text import strip
from ..operators.attach import discover_sources
from ..operators.infer import Factory, embed
from ..operators.records import rewrite_lines, to_rewrite, with_field, without_field
from ..operators.positions import positions
from ..operators.topics import topic_lists
from ..session import materialize
from ..sinks.exports import export_clusters, export_lines, export_vectors
from ..sources.records import apply_policy, decode_lines, parse_line, parse_records, read_lines
from ..sources.vectors import read_vectors
from .anonymize import Tagger, anonymize
from .cluster import Clustering, cluster_each_source, cluster_reports
from .compare import Comparison, compare_versions
from .translate import Translator, translate

LINE_ORDER = ["file_path", "block_start", "line_id"]


def read_records(
    spark: SparkSession, path: str, key: str, text: str, policy: str = "pass_through", glob: str = "*.jsonl"
) -> DataFrame:
    """Parsed lines of all files below ``path``, each file in its own encoding."""
    lines = decode_lines(read_lines(spark, path, recursive=True, glob=glob))
    return apply_policy(parse_records(lines, key, text), policy)


def _write(done: DataFrame, out: str, text: str, output_key: str | None, suffix: str | None, empty_passes: bool) -> None:
    """Put ``_result`` into the records and write all lines; malformed lines stay as they are."""
    records = done.withColumn("record", parse_line(strip(F.col("value"))))
    export_lines(rewrite_lines(records, F.col("_result"), text, output_key, suffix, empty_passes), out)


def anonymize_jsonl(
    spark: SparkSession,
    path: str,
    out: str,
    tagger: Tagger,
    key: str = "report_key",
    text: str = "text",
    policy: str = "pass_through",
    output_key: str | None = None,
    preserve_original: bool = False,
    glob: str = "*.jsonl",
) -> None:
    """Redact the text field of all records below ``path`` and write the lines to ``out``.

    Other fields are kept; keys may be missing or repeat.
    """
    records = read_records(spark, path, key, text, policy, glob)
    done = anonymize(records.drop("record"), tagger, output="_result")
    _write(done, out, text, output_key, "_de" if preserve_original else None, False)


def translate_jsonl(
    spark: SparkSession,
    path: str,
    out: str,
    translator: Translator,
    key: str = "report_key",
    text: str = "text",
    policy: str = "pass_through",
    output_key: str | None = None,
    hosted: bool = False,
    preserve_original: bool = False,
    glob: str = "*.jsonl",
) -> None:
    """Translate the text field of all records below ``path`` and write the lines to ``out``.

    A line whose text gives way to its translation goes on without it: the text is stored as chunks.
    """
    records = read_records(spark, path, key, text, policy, glob).withColumn("_changed", to_rewrite(hosted))
    in_place = not preserve_original and output_key in (None, text)
    if in_place:
        records = records.withColumn("value", F.when(F.col("_changed"), without_field(F.col("record"), text)).otherwise(F.col("value")))
    lines = records.select("value", "_changed", F.col("text").alias("_result"))
    done = translate(lines, translator, text="_result", hosted=hosted)
    if in_place:
        whole = with_field(F.col("value"), text, F.col("_result"))
        done = done.withColumn("value", F.when(F.col("_changed"), whole).otherwise(F.col("value")))
    else:
        suffix = "_original" if preserve_original else None
        done = done.withColumn("record", parse_line(strip(F.col("value"))))
        done = rewrite_lines(done, F.col("_result"), text, output_key, suffix, changed=F.col("_changed"))
    export_lines(done, out)


def embed_jsonl(
    spark: SparkSession,
    path: str,
    out: str,
    factory: Factory,
    key: str = "report_key",
    text: str = "text",
    glob: str = "*.jsonl",
) -> None:
    """Vectors ``(report_key, embedding, source_file)`` of the records with key and text, as parquet."""
    records = read_records(spark, path, key, text, "drop", glob).dropna(subset=["report_key", "text"])
    export_vectors(records.select("report_key", embed(F.col("text"), factory).alias("embedding"), "source_file"), out)


def compare_folders(
    spark: SparkSession,
    path: str,
    key: str = "report_key",
    text: str = "text",
    min_unique: int | None = 2,
    query: str | None = None,
    glob: str = "*.jsonl",
) -> Comparison:
    """Compare the versions of each report over all files below ``path``, in the order of paths and lines."""
    records = read_records(spark, path, key, text, "drop", glob).dropna(subset=["report_key", "text"])
    return compare_versions(records.drop("record", "value"), LINE_ORDER, min_unique=min_unique, query=query)


def name_of_file(path: str = "file_path") -> Column:
    """The name of a file, or of the folder if Spark wrote the table as part files."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    return F.when(F.startswith(name, F.lit("part-")), F.element_at(parts, -2)).otherwise(name)


def base_of(name: Column) -> Column:
    """A vector file's name without its endings."""
    return F.regexp_replace(name, r"(\.emb)?\.(jsonl|parquet)$", "")


def cluster_files(
    spark: SparkSession,
    vectors: str,
    path: str,
    out: str,
    merge: bool = False,
    key: str = "report_key",
    text: str = "text",
    k: int = CLUSTERS,
    reps: int = REPRESENTATIVES,
    top_n: int = TOPIC_TERMS,
    with_projection: bool = True,
    glob: str = "*.jsonl",
) -> dict[str, Clustering | Exception]:
    """Cluster the vector files below ``vectors``, each alone or ``merge``d, and write results below ``out``.

    Texts are those of the JSON lines below ``path``. A vector file alone takes them from the one
    file that its keys come from, found for all of them at once; merged vectors from the first
    line of their key. Each result has a folder of its own: ``clusters`` (representatives with texts),
    ``topics``, and ``projection``. A vector file that fails is reported, the rest go on.
    """
    # Part files of one table have rows of equal number; each row gets a number over all files.
    read = positions(read_vectors(spark, vectors, key=key, finite=False), "file_path", "row_index", "place")
    rows = materialize(read, "vectors")
    records = read_records(spark, path, key, text, "drop", glob).dropna(subset=["report_key"])
    texts = materialize(records.select("report_key", "text", name_of_file().alias("source_file"), *LINE_ORDER), "texts")
    if merge:
        results: dict[str, Clustering | Exception] = {
            "merged": cluster_reports(rows, texts, LINE_ORDER, "place", k, reps, top_n, with_projection=with_projection)
        }
    else:
        sets = rows.select("source_file", base_of(F.col("source_file")).alias("base"), "report_key")
        found = discover_sources(texts, sets.dropna().select("base", "report_key"))
        named = found.withColumnRenamed("source_file", "text_file").join(sets.select("source_file", "base").distinct(), "base")
        files = {r.source_file: r.text_file for r in named.collect()}  # one row per vector file
        results = cluster_each_source(
            rows, texts, LINE_ORDER, "place", k, reps, top_n, with_projection=with_projection, text_files=files
        )
    for name, result in results.items():
        if isinstance(result, Clustering):
            folder = f"{out.rstrip('/')}/{name}"
            export_clusters(result.representatives, topic_lists(result.members, result.topics), folder)
            if result.projection is not None:
                result.projection.write.parquet(f"{folder}/projection")
    return results
