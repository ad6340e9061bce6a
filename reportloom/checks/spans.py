"""Queries: person spans and redaction of reports."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.redact import redact_spans
from ..operators.chunks import chunk_table
from ..operators.records import field
from ..operators.spans import gazetteer_spans, person_spans
from ..plans.anonymize import anonymize, gazetteer_tagger, model_tagger
from ..plans.files import anonymize_jsonl
from ..session import scratch_path
from ..sources.records import parse_records, read_lines
from .inputs import NAMED_REPORTS, gazetteer, named_reports, repeated_keys


def report_chunks(spark, d):
    return chunk_table(named_reports(spark, d), F.array("text"), "report_key")


def found_spans(spark, d):
    return gazetteer_spans(report_chunks(spark, d), gazetteer(spark, d), "report_key")


def redacted(spark, d):
    spans = person_spans(found_spans(spark, d)).groupBy("report_key", "chunk_no").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    chunks = report_chunks(spark, d).join(spans, ["report_key", "chunk_no"], "left")
    return chunks.select("report_key", redact_spans(F.col("chunk"), F.col("spans")).alias("text"))


def customer_tagger():
    """A tagger that knows customers by their pattern; every second span has no offsets."""
    pattern = re.compile(r"Customer#\d+")

    def tag(texts):
        found = []
        for text in texts:
            hits = [(m.start(), m.end(), "PER", m.group()) for m in pattern.finditer(text)]
            hits = [(None, None, *h[2:]) if i == 0 else h for i, h in enumerate(hits)]
            places = [(m.start(), m.end(), "LOC", m.group()) for m in re.finditer(r"NATION_\d+", text)]
            found.append(hits + places)
        return found

    return tag


# Length of the text before the second mention of the name.
_SECOND = "length('Befund: ' || person || ' aus ' || n_name || ' wurde am 12.03.1998 aufgenommen;  Kontakt ')"

SPANS = f"""
  SELECT report_key, 0 AS chunk_no, 8 AS start, 8 + length(c_name) AS "end", 'B-PER' AS label
  FROM ({NAMED_REPORTS}) WHERE known
  UNION ALL SELECT report_key, 0, {_SECOND}, {_SECOND} + length(c_name), 'B-PER'
  FROM ({NAMED_REPORTS}) WHERE known
  UNION ALL SELECT report_key, 0, 13 + length(person), 13 + length(person) + length(n_name), 'LOC'
  FROM ({NAMED_REPORTS})"""

_SPAN_COLUMNS = 'report_key, chunk_no::INTEGER AS chunk_no, start::INTEGER AS start, "end"::INTEGER AS "end", label'

# The chunks of these reports are joined with single spaces.
_FLAT = "replace(replace(text, '  ', ' '), chr(10), ' ')"
_DATES = f"replace({_FLAT}, '12.03.1998', '[DATE_REDACTED]')"

def redacted_files(spark, d):
    """Reports written as JSON lines, redacted from files to files and read again."""
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "redacted")
    reports = repeated_keys(named_reports(spark, d), "report_key")
    reports.select(F.to_json(F.struct("report_key", "text", F.lit(1).alias("it's"))).alias("value")).write.text(source)
    anonymize_jsonl(spark, source, target, model_tagger(customer_tagger), preserve_original=True, glob="part-*")
    records = parse_records(read_lines(spark, target, glob="part-*"))
    return records.select("report_key", "text", field(F.col("record"), "text_de").alias("text_de"), field(F.col("record"), "it's", "int").alias("extra"))


QUERIES = {
    "anonymize_jsonl": (
        redacted_files,
        f"""SELECT CASE WHEN report_key % 5 <> 0 THEN (report_key // 2)::VARCHAR END AS report_key,
              replace({_DATES}, c_name, '[NAME_REDACTED]') AS text, text AS text_de, 1 AS extra FROM ({NAMED_REPORTS})""",
    ),
    "gazetteer_spans": (found_spans, f"SELECT {_SPAN_COLUMNS} FROM ({SPANS})"),
    "person_spans": (
        lambda s, d: person_spans(found_spans(s, d)),
        f"SELECT {_SPAN_COLUMNS} FROM ({SPANS}) WHERE label = 'B-PER'",
    ),
    "redact_spans": (
        redacted,
        f"""SELECT report_key, CASE WHEN known
              THEN replace(text, c_name, '[NAME_REDACTED]') ELSE text END AS text FROM ({NAMED_REPORTS})""",
    ),
    "anonymize_names": (
        lambda s, d: anonymize(named_reports(s, d), model_tagger(customer_tagger), preserve_original=True),
        f"""SELECT report_key, text AS text_de, replace({_DATES}, c_name, '[NAME_REDACTED]') AS text
            FROM ({NAMED_REPORTS})""",
    ),
    "anonymize_repeated_keys": (
        lambda s, d: anonymize(repeated_keys(named_reports(s, d), "report_key"), model_tagger(customer_tagger)),
        f"""SELECT CASE WHEN report_key % 5 <> 0 THEN (report_key // 2)::VARCHAR END AS report_key,
              replace({_DATES}, c_name, '[NAME_REDACTED]') AS text FROM ({NAMED_REPORTS})""",
    ),
    "anonymize_reports": (
        lambda s, d: anonymize(named_reports(s, d), gazetteer_tagger(gazetteer(s, d))),
        f"""SELECT report_key, CASE WHEN known
              THEN replace({_DATES}, c_name, '[NAME_REDACTED]') ELSE {_DATES} END AS text
            FROM ({NAMED_REPORTS})""",
    ),
}
