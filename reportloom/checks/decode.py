"""Queries: scan, assembly, decoding, dates, chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.chunk import chunk, split_sentences
from ..functions.decode import decode_hex, strip_rtf
from ..functions.fixed import ANONYMISE_CHUNK_CHARS, HOSTED_CHUNK_CHARS, LOCAL_CHUNK_CHARS
from ..functions.redact import redact_dates
from ..operators.assemble import assemble, load_stats
from ..operators.chunks import chunk_table, rejoin_chunks
from ..operators.records import put_result, require_key_text, route
from ..plans.decode import decode_reports, export_columns, preview_reports
from ..sources.fragments import read_fragments
from .inputs import (
    DATED_REPORTS,
    NULL_FRAGMENTS,
    SPACE_SQL,
    dated_reports,
    hex_fragments,
    null_fragments,
    redact_sql,
    rtf_reports,
    strip_sql,
    table,
)


def scan_fragments(spark, d):
    return read_fragments(spark, f"{d}/conversations.parquet", key="conv_id", seq="turn")


def assemble_fragments(spark, d):
    return assemble(null_fragments(spark, d))


def decode_hex_text(spark, d):
    latin1 = F.regexp_replace("text", r"[^\x00-\xff]", "")
    docs = table(spark, d, "documents").select(
        "doc_id",
        F.hex(F.encode("text", "UTF-8")).alias("utf8"),
        F.lower(F.hex(F.encode(latin1, "ISO-8859-1"))).alias("latin1"),
        "text",
    )
    spaced = F.regexp_replace("latin1", "(.{64})", "$1\n ")
    return docs.select(
        "doc_id",
        decode_hex(F.col("utf8")).alias("from_utf8"),
        decode_hex(spaced).alias("from_latin1"),
        decode_hex(F.concat("utf8", F.lit("0"))).alias("odd"),
        decode_hex(F.col("text")).alias("unchanged"),
    )


def strip_rtf_text(spark, d):
    return rtf_reports(spark, d).select("doc_id", strip_rtf(F.col("text")).alias("text_plain"))


def decoded(spark, d):
    return decode_reports(hex_fragments(spark, d))


def decode_reports_query(spark, d):
    return decoded(spark, d).select("source_file", "report_key", "text_plain")


def redact_dates_text(spark, d):
    return dated_reports(spark, d).select(
        "o_orderkey", redact_dates(F.col("text")).alias("text"), redact_dates(F.col("months")).alias("months")
    )


def preserve_original(spark, d):
    reports = dated_reports(spark, d).drop("months")
    return put_result(reports, redact_dates(F.col("text")), preserve_suffix="_de")


def sentences(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.posexplode(split_sentences(F.col("text"))).alias("pos", "sentence")
    )


def packed(spark, d):
    chunks = chunk(F.col("text"), ANONYMISE_CHUNK_CHARS, always=True)
    return chunk_table(table(spark, d, "documents"), chunks, "doc_id")


def chunk_variants(spark, d):
    docs = table(spark, d, "documents")
    sizes = {"local": LOCAL_CHUNK_CHARS, "hosted": HOSTED_CHUNK_CHARS}
    both = F.array(
        *[
            F.struct(F.lit(name).alias("variant"), chunk(F.col("text"), size, always=False).alias("chunks"))
            for name, size in sizes.items()
        ]
    )
    return chunk_table(docs.select("doc_id", F.inline(both)), F.col("chunks"), "doc_id", "variant")


def rejoined(spark, d):
    return rejoin_chunks(packed(spark, d), "doc_id", strip_each=True)


SENTENCES = f"""
  SELECT doc_id, text, list_filter(list_transform(string_split_regex(
      regexp_replace(text, '([.!?…;]){SPACE_SQL}+', '\\1' || chr(10), 'g'), '\\n+'),
      lambda p: {strip_sql('p')}), lambda p: p <> '') AS parts
  FROM documents"""


def pack_sql(size: int) -> str:
    """Chunks of the documents as ``(doc_id, text, chunks)``."""
    return f"""
  SELECT doc_id, text,
    CASE WHEN len(parts) = 0 THEN [{strip_sql('text')}] ELSE list_append(acc.done, acc.cur) END AS chunks
  FROM (
    SELECT doc_id, text, parts,
      list_reduce(
        list_transform(parts, lambda p: {{'done': []::VARCHAR[], 'cur': p}}),
        lambda a, b: CASE WHEN length(a.cur) + 1 + length(b.cur) <= {size}
          THEN {{'done': a.done, 'cur': a.cur || ' ' || b.cur}}
          ELSE {{'done': list_append(a.done, a.cur), 'cur': b.cur}} END) AS acc
    FROM ({SENTENCES}))"""


def _variant_sql(name: str, size: int) -> str:
    return f"""
  SELECT doc_id, '{name}' AS variant,
    CASE WHEN length(text) <= {size} THEN [text] ELSE chunks END AS chunks
  FROM ({pack_sql(size)})"""


EXPLODE = """
  SELECT {ids}, (unnest(range(len(chunks))))::INTEGER AS chunk_no, unnest(chunks) AS chunk FROM ({sql})"""

HEX_SQL = """
  SELECT doc_id AS report_key, source AS source_file, hex(encode(text)) AS text, text AS plain FROM documents"""

STATS = f"""
  SELECT source_file, report_key, (ceil(length(text) / 200.0))::BIGINT AS n FROM ({HEX_SQL})"""

QUERIES = {
    "scan_fragments": (
        scan_fragments,
        """SELECT conv_id AS report_key, turn AS seq, text, 'conversations.parquet' AS source_file
           FROM conversations""",
    ),
    "load_stats": (
        lambda s, d: load_stats(hex_fragments(s, d)),
        f"""SELECT source_file, sum(n)::BIGINT AS n_rows, count(*) AS n_reports
            FROM ({STATS}) GROUP BY ROLLUP (source_file)""",
    ),
    "assemble_fragments": (
        assemble_fragments,
        f"""SELECT source_file, report_key, coalesce(string_agg(text, '' ORDER BY seq), '') AS text
            FROM ({NULL_FRAGMENTS}) GROUP BY ALL""",
    ),
    "union_sources": (
        lambda s, d: decode_reports(
            scan_fragments(s, d).unionByName(hex_fragments(s, d))
        ).select("source_file", "report_key", "text_plain"),
        """SELECT 'conversations.parquet' AS source_file, conv_id AS report_key,
             string_agg(text, '' ORDER BY turn) AS text_plain
           FROM conversations GROUP BY conv_id
           UNION ALL SELECT source, doc_id, text FROM documents""",
    ),
    "decode_hex": (
        decode_hex_text,
        r"""SELECT doc_id, text AS from_utf8, regexp_replace(text, '[^\x00-\x{ff}]', '', 'g') AS from_latin1,
              hex(encode(text)) || '0' AS odd, text AS unchanged FROM documents""",
    ),
    "strip_rtf": (
        strip_rtf_text,
        "SELECT doc_id, replace(text, chr(13), '') AS text_plain FROM documents",
    ),
    "decode_reports": (
        decode_reports_query,
        "SELECT source AS source_file, doc_id AS report_key, text AS text_plain FROM documents",
    ),
    "export_projection": (
        lambda s, d: export_columns(decoded(s, d)),
        "SELECT doc_id AS report_key, text FROM documents",
    ),
    "preview_reports": (
        lambda s, d: preview_reports(hex_fragments(s, d)),
        f"""SELECT report_key, left(text, 100) || '...' AS encoded, left(plain, 100) || '...' AS decoded,
              left(plain, 200) || '...' AS plain
            FROM ({HEX_SQL}) ORDER BY report_key LIMIT 10""",
    ),
    "redact_dates": (
        redact_dates_text,
        f"""SELECT o_orderkey, {redact_sql('text')} AS text, {redact_sql('months')} AS months
            FROM ({DATED_REPORTS})""",
    ),
    "preserve_original": (
        preserve_original,
        f"SELECT o_orderkey, text AS text_de, {redact_sql('text')} AS text FROM ({DATED_REPORTS})",
    ),
    "embeddable_reports": (
        lambda s, d: require_key_text(
            null_fragments(s, d).withColumn(
                "report_key", F.when(F.col("seq") % 4 != 3, F.col("report_key"))
            )
        ),
        f"""SELECT report_key::VARCHAR AS report_key, text FROM ({NULL_FRAGMENTS})
            WHERE seq % 4 <> 3 AND report_key IS NOT NULL AND text IS NOT NULL""",
    ),
    "passthrough_routing": (
        lambda s, d: null_fragments(s, d).select(
            "report_key",
            "seq",
            route(F.col("text"), empty_passes=False).alias("local"),
            route(F.col("text"), empty_passes=True).alias("hosted"),
        ),
        f"""SELECT report_key, seq, CASE WHEN text IS NULL THEN 'pass' ELSE 'process' END AS "local",
              CASE WHEN coalesce(text, '') = '' THEN 'pass' ELSE 'process' END AS hosted
            FROM ({NULL_FRAGMENTS})""",
    ),
    "split_sentences": (
        sentences,
        f"""SELECT doc_id, (unnest(range(len(parts))))::INTEGER AS pos, unnest(parts) AS sentence
            FROM ({SENTENCES})""",
    ),
    "pack_chunks": (packed, EXPLODE.format(ids="doc_id", sql=pack_sql(ANONYMISE_CHUNK_CHARS))),
    "chunk_table": (
        chunk_variants,
        EXPLODE.format(
            ids="doc_id, variant",
            sql=_variant_sql("local", LOCAL_CHUNK_CHARS)
            + " UNION ALL "
            + _variant_sql("hosted", HOSTED_CHUNK_CHARS),
        ),
    ),
    "chunk_rejoin": (
        rejoined,
        f"""SELECT doc_id, {strip_sql("replace(array_to_string(chunks, ' '), '  ', ' ')")} AS text
            FROM ({pack_sql(ANONYMISE_CHUNK_CHARS)})""",
    ),
}
