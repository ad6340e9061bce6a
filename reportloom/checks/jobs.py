"""Queries: whole jobs from files to files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed import REPRESENTATIVES
from ..operators.attach import discover_sources
from ..plans.files import cluster_files, compare_folders, embed_jsonl, translate_jsonl
from ..plans.translate import glossary_translator
from ..session import scratch_path
from ..sinks.exports import export_jsonl, export_vectors
from .compare import INDEX
from .inputs import table, versions
from .models import _dense, glossary, hashing_model
from .models import QUERIES as MODELS
from .topics import documents
from .vectors import in_three_sets

PART_FILES = "part-*"


def documents_as_lines(spark, d):
    path = scratch_path(spark, "lines")
    export_jsonl(documents(spark, d).select(F.col("doc_id").alias("report_key"), "text"), path)
    return path


def translated_files(spark, d):
    out = scratch_path(spark, "translated")
    translate_jsonl(spark, documents_as_lines(spark, d), out, glossary_translator(glossary(spark, d)), glob=PART_FILES)
    return spark.read.schema("report_key long, text string").json(out).select(F.col("report_key").alias("doc_id"), "text")


def embedded_files(spark, d):
    out = scratch_path(spark, "embedded")
    embed_jsonl(spark, documents_as_lines(spark, d), out, hashing_model, glob=PART_FILES)
    return (
        spark.read.parquet(out)
        .select(F.col("report_key").cast("long").alias("doc_id"), F.posexplode("embedding").alias("dim", "value"))
        .select("doc_id", "dim", F.round(F.col("value").cast("double"), 4).alias("value"))
    )


def compared_folders(spark, d):
    """The index of versions that lie in one folder per file."""
    path = scratch_path(spark, "versions")
    rows = versions(spark, d).select(F.col("report_key").cast("string").alias("report_key"), F.coalesce("text", F.lit("")).alias("text"), "source_file")
    export_jsonl(rows, path, source="source_file")
    return compare_folders(spark, path, min_unique=2, glob=PART_FILES).index


def text_files(spark, d):
    """Texts of each set of vectors: one has the set's name, though a file that comes first has its keys too."""
    docs = table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("report_key"), "text")
    own = F.element_at(F.array(F.lit("t0.jsonl"), F.lit("t1.jsonl"), F.lit("set2.jsonl")), (F.col("doc_id") % 3 + 1).cast("int"))
    copies = docs.filter("doc_id % 3 = 2").select("report_key", F.concat(F.lit("Kopie: "), "text").alias("text"), F.lit("a.jsonl").alias("source_file"))
    return docs.select("report_key", "text", own.alias("source_file")).unionByName(copies)


def sources_of_sets(spark, d):
    ids = in_three_sets(spark, d).select(F.col("source_file").alias("base"), F.col("row_index").alias("report_key"))
    return discover_sources(text_files(spark, d), ids)


def clustered_files(spark, d):
    """Vectors and lines as files, each vector file clustered around one centre, read back from the results."""
    base = scratch_path(spark, "cluster-files")
    export_vectors(in_three_sets(spark, d).select(F.col("row_index").cast("string").alias("report_key"), "embedding", "source_file"), f"{base}/vectors")
    lines = text_files(spark, d)
    for (name,) in lines.select("source_file").distinct().collect():  # four files
        export_jsonl(lines.filter(F.col("source_file") == name).drop("source_file"), f"{base}/lines/{name}")
    found = cluster_files(spark, f"{base}/vectors", f"{base}/lines", f"{base}/out", k=1, glob=PART_FILES, with_projection=False)
    failed = ",".join(sorted(name for name, result in found.items() if isinstance(result, Exception)))
    back = spark.read.schema("cluster int, rank int, report_key string, distance double, source_file string, text string")
    return back.json([f"{base}/out/{name}/clusters" for name in found if name not in failed.split(",")]).select(
        "source_file", "rank", "report_key", F.round("distance", 6).alias("distance"), "text", F.lit(failed).alias("failed")
    )


IDS = """SELECT 'set' || vec_id % 3 AS base, vec_id FROM embeddings
         UNION ALL SELECT 'set3', vec_id FROM embeddings WHERE vec_id % 3 = 0"""

SOURCES = f"""
  WITH ids AS ({IDS}), needed AS (SELECT base, greatest(1, least(50, count(*) // 100))::BIGINT AS n_needed FROM ids GROUP BY base),
  lines AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 't0.jsonl' WHEN 1 THEN 't1.jsonl' ELSE 'set2.jsonl' END AS source_file FROM documents
            UNION ALL SELECT doc_id, 'a.jsonl' FROM documents WHERE doc_id % 3 = 2),
  found AS (SELECT base, CASE WHEN source_file = base || '.jsonl' THEN 0 ELSE 2 END AS match, source_file, count(*) AS n_hits
            FROM ids JOIN lines ON doc_id = vec_id GROUP BY ALL)
  SELECT base, match::INTEGER AS match, source_file, n_hits, n_needed FROM found JOIN needed USING (base)
  WHERE match = 0 OR n_hits >= n_needed
  QUALIFY row_number() OVER (PARTITION BY base ORDER BY match, source_file) = 1"""

CLUSTERED = f"""
  WITH v AS (SELECT 'set' || vec_id % 3 AS source_file, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
  means AS (SELECT source_file, list(m ORDER BY dim) AS center FROM (
    SELECT source_file, dim, avg(x) AS m FROM (SELECT source_file, unnest(range(len(e))) AS dim, unnest(e) AS x FROM v)
    GROUP BY ALL) GROUP BY source_file),
  nearest AS (SELECT source_file, vec_id, list_distance(e, center) AS distance FROM v JOIN means USING (source_file)
    QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY list_distance(e, center), vec_id) <= {REPRESENTATIVES})
  SELECT source_file, (row_number() OVER (PARTITION BY source_file ORDER BY distance, vec_id))::INTEGER AS rank,
    vec_id::VARCHAR AS report_key, round(distance, 6) AS distance, text, 'set3' AS failed
  FROM nearest LEFT JOIN documents ON doc_id = vec_id"""

QUERIES = {
    "translate_jsonl": (translated_files, MODELS["translate_reports"][1]),
    "embed_jsonl": (embedded_files, _dense(4)),
    "compare_folders": (compared_folders, f"SELECT * FROM ({INDEX}) WHERE n_unique >= 2"),
    "sources_of_sets": (sources_of_sets, SOURCES),
    "cluster_files": (clustered_files, CLUSTERED),
}
