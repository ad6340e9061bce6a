"""Queries: JSON lines, exports and what comes back from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.redact import redact_dates
from ..operators import clusters as C
from ..operators.records import rewrite_lines
from ..operators.topics import topic_lists
from ..plans.decode import export_columns
from ..session import scratch_path
from ..sinks import exports as X
from ..sources.records import apply_policy, decode_lines, malformed_counts, parse_records, read_lines
from .decode import decoded
from .inputs import BROKEN_JSONL, DATED_REPORTS, broken_jsonl, dated_reports, labelled_vectors, redact_sql, table
from .topics import TOPICS, topics
from .vectors import REPRESENTED, measured

REPORT = "report_key long, text string"
PART_FILES = "part-*"


def reports(spark, d):
    return export_columns(decoded(spark, d))


def scanned_lines(spark, d):
    path = scratch_path(spark, "lines")
    X.export_lines(broken_jsonl(spark, d), path)
    return read_lines(spark, path, glob=PART_FILES)


def jsonl_policies(spark, d):
    records = parse_records(scanned_lines(spark, d), key="conv_id")
    columns = ["status", "report_key", "text"]
    kept = apply_policy(records, "pass_through").select(F.lit("pass_through").alias("policy"), *columns)
    return kept.unionByName(apply_policy(records, "drop").select(F.lit("drop").alias("policy"), *columns))


def counted_lines(spark, d):
    """Lines below folders, read recursively."""
    path = scratch_path(spark, "tree")
    lines = broken_jsonl(spark, d)
    for role in ("user", "assistant"):
        X.export_lines(lines.filter(F.col("role") == role), f"{path}/deep/{role}")
    X.export_lines(lines.filter(~F.col("role").isin("user", "assistant")), f"{path}/other")
    return malformed_counts(parse_records(read_lines(spark, path, True, PART_FILES), key="conv_id"))


def mixed_encodings(spark, d):
    """Files of odd sources in Latin-1, the others in UTF-8."""
    number = F.regexp_extract("source", "([0-9]+)", 1).cast("int")
    narrow = F.regexp_replace("text", r"[^\x00-\xff]", "")
    as_latin1 = F.encode(narrow, "ISO-8859-1").cast("string")
    lines = table(spark, d, "documents").select(
        "doc_id",
        F.col("source").alias("source_file"),
        F.when(number % 2 == 1, as_latin1).otherwise(F.col("text")).alias("value"),
    )
    return decode_lines(lines)


def rewritten(spark, d):
    """Dated reports with a nested field as JSON lines, redacted and read back."""
    lines = dated_reports(spark, d).select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").alias("id"),
                F.struct(F.array(F.lit(1.5), F.lit(2)).alias("list"), F.lit(None).cast("string").alias("gone")).alias("more"),
                F.when(F.col("o_orderkey") % 9 != 0, F.col("text")).alias("text"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )
    done = rewrite_lines(
        parse_records(lines, key="id"), redact_dates(F.col("text")), output_key="clean", preserve_suffix="_de"
    )
    fields = "id long, text string, clean string, text_de string, more struct<list array<double>, gone string>"
    return done.select(F.from_json("value", fields).alias("r")).select(
        "r.id", "r.text", "r.clean", "r.text_de", F.get("r.more.list", F.lit(0)).alias("nested")
    )


def jsonl_back(spark, d):
    path = scratch_path(spark, "jsonl")
    X.export_jsonl(reports(spark, d), path)
    return spark.read.schema(REPORT).json(path)


def csv_back(spark, d):
    path = scratch_path(spark, "csv")
    X.export_csv(reports(spark, d), path)
    reader = spark.read.schema(REPORT).option("header", "true").option("escape", '"')
    # With a null mark that no text holds, quoted empty text does not become null.
    return reader.option("multiLine", "true").option("nullValue", "\0").csv(path)


def bucketed_back(spark, d):
    path = scratch_path(spark, "bucketed")
    X.export_bucketed(reports(spark, d), path, buckets=8)
    return spark.read.schema(REPORT).json(path).select("report_key", "text")


def by_source_back(spark, d):
    path = scratch_path(spark, "by-source")
    both = decoded(spark, d).select("report_key", F.col("text_plain").alias("text"), "source_file")
    X.export_jsonl(both, path, source="source_file")
    back = spark.read.schema(REPORT + ", source_file string").json(path)
    return back.groupBy("source_file").agg(
        F.count("*").alias("n"), F.sum(F.length("text").cast("long")).alias("n_chars")
    )


def vectors_back(spark, d):
    path = scratch_path(spark, "vectors")
    X.export_vectors(labelled_vectors(spark, d).select("report_key", "embedding"), path)
    back = spark.read.parquet(path)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    return back.select("report_key", F.round(total, 6).alias("total"))


def clusters_back(spark, d):
    path = scratch_path(spark, "clusters")
    nearest = C.representatives(measured(spark, d)).select("cluster", "rank", "report_key")
    X.export_clusters(nearest, topic_lists(labelled_vectors(spark, d), topics(spark, d)), path)
    back = spark.read.schema("cluster int, rank int, report_key string").json(f"{path}/clusters")
    terms = spark.read.schema("cluster int, terms array<string>").json(f"{path}/topics")
    return back.join(terms, "cluster").select(
        "cluster", "rank", "report_key", F.array_join("terms", ", ").alias("terms")
    )


_DOCUMENTS = "SELECT doc_id AS report_key, text FROM documents"

QUERIES = {
    "jsonl_scan_policy": (
        jsonl_policies,
        f"""SELECT policy, status, CASE WHEN status = 'record' AND NOT keyless THEN conv_id::VARCHAR END AS report_key,
              CASE WHEN status = 'record' THEN text END AS text
            FROM ({BROKEN_JSONL}), (VALUES ('pass_through'), ('drop')) AS p(policy)
            WHERE status <> 'blank' AND (policy = 'pass_through' OR status = 'record')""",
    ),
    "malformed_counts": (
        counted_lines,
        f"""SELECT count(*) FILTER (status <> 'blank') AS n_lines,
              count(*) FILTER (status = 'record' AND NOT keyless) AS n_records,
              count(*) FILTER (status = 'unparsable') AS n_unparsable,
              count(*) FILTER (status = 'not_object' OR keyless) AS n_malformed
            FROM ({BROKEN_JSONL})""",
    ),
    "utf8_latin1_fallback": (
        mixed_encodings,
        r"""SELECT doc_id, source AS source_file,
              CASE WHEN regexp_extract(source, '([0-9]+)', 1)::INTEGER % 2 = 1
                THEN regexp_replace(text, '[^\x00-\x{ff}]', '', 'g') ELSE text END AS value
            FROM documents""",
    ),
    "rewrite_records": (
        rewritten,
        f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 <> 0 THEN text END AS text,
              CASE WHEN o_orderkey % 9 <> 0 THEN {redact_sql('text')} END AS clean,
              CASE WHEN o_orderkey % 9 <> 0 THEN text END AS text_de, 1.5::DOUBLE AS nested
            FROM ({DATED_REPORTS})""",
    ),
    "export_jsonl_roundtrip": (jsonl_back, _DOCUMENTS),
    "export_csv_roundtrip": (csv_back, _DOCUMENTS),
    "export_bucketed_roundtrip": (bucketed_back, _DOCUMENTS),
    "export_by_source": (
        by_source_back,
        """SELECT source AS source_file, count(*) AS n, sum(length(text))::BIGINT AS n_chars
           FROM documents GROUP BY source""",
    ),
    "embedding_sink_roundtrip": (
        vectors_back,
        "SELECT vec_id::VARCHAR AS report_key, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings",
    ),
    "cluster_exports_roundtrip": (
        clusters_back,
        f"""SELECT "cluster", rank, report_key, terms FROM ({REPRESENTED})
            JOIN (SELECT "cluster", string_agg(term, ', ' ORDER BY rank) AS terms FROM ({TOPICS}) GROUP BY ALL)
            USING ("cluster")""",
    ),
}
