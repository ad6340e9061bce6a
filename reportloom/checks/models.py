"""Queries: embedding and translation."""

from __future__ import annotations

import hashlib
import math
import re
import uuid

from pyspark.errors import PythonException
from pyspark.sql import functions as F

from ..functions.fixed import HOSTED_CHUNK_CHARS, LOCAL_CHUNK_CHARS
from ..operators.hashing import hashing_values, hashing_vectors
from ..operators.infer import attach_translations, distinct_chunks, embed, translate_with
from ..operators.ledger import answers, open_ledger, place
from ..operators.translate import glossary_translations, translation_budget
from ..plans.translate import client_translator, glossary_translator, report_chunks, translate
from ..session import materialize, scratch_path
from .decode import EXPLODE, _variant_sql
from .inputs import repeated_keys, strip_sql, table
from .topics import _DOCS, documents

DIMS = 64
BUDGET = 500_000


def hashing_model():
    """The hashing embedding as a Python model."""

    def model(texts):
        vectors = []
        for text in texts:
            words = [w for w in re.findall(r"\w+", text.lower()) if len(w) > 1]
            totals = [0] * DIMS
            for term in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
                digest = hashlib.md5(term.encode()).hexdigest()
                totals[int(digest[:8], 16) % DIMS] += 1 if digest[8] < "8" else -1
            norm = math.sqrt(sum(t * t for t in totals)) or 1.0
            vectors.append([t / norm for t in totals])
        return vectors

    return model


def embedded(spark, d):
    vectors = documents(spark, d).select("doc_id", embed(F.col("text"), hashing_model).alias("embedding"))
    return vectors.select("doc_id", F.posexplode("embedding").alias("dim", "value")).select(
        "doc_id", "dim", F.round(F.col("value").cast("double"), 4).alias("value")
    )


def glossary(spark, d):
    """Every word of the benchmark texts, its target marked."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    return (
        table(spark, d, "benchmark")
        .select(F.explode(words).alias("word"))
        .distinct()
        .withColumn("target", F.concat(F.lit("en:"), "word"))
    )


def fake_client(source_lang, target_lang, formality):
    """A client that marks what it was given."""
    mark = f"<{source_lang}>{target_lang}:{formality or ''}>"
    return lambda texts: [mark + t for t in texts]


def chunks(spark, d):
    return report_chunks(documents(spark, d), ("doc_id",))


def glossary_translated(spark, d):
    table_of_chunks = materialize(chunks(spark, d), "chunks")
    answers = glossary_translations(distinct_chunks(table_of_chunks), glossary(spark, d))
    return attach_translations(table_of_chunks, answers, "doc_id")


CHUNKS = EXPLODE.format(ids="doc_id", sql=_variant_sql("local", LOCAL_CHUNK_CHARS))

TRANSLATED = f"""
  WITH chunks AS MATERIALIZED ({CHUNKS}),
  glossary AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS word FROM benchmark),
  pieces AS (
    SELECT doc_id, chunk_no, unnest(range(len(p))) AS pos, unnest(p) AS piece FROM (
      SELECT doc_id, chunk_no, regexp_extract_all(chunk, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+') AS p FROM chunks)),
  replaced AS (
    SELECT doc_id, chunk_no,
      string_agg(CASE WHEN word IS NULL THEN piece ELSE 'en:' || word END, '' ORDER BY pos) AS translated
    FROM pieces LEFT JOIN glossary ON word = lower(piece) GROUP BY ALL)
  SELECT doc_id, chunk_no, coalesce(translated, '') AS translated FROM chunks LEFT JOIN replaced USING (doc_id, chunk_no)"""

HASHED = f"""
  SELECT doc_id, dim, total, sqrt(sum(total * total) OVER (PARTITION BY doc_id)) AS norm FROM (
    SELECT doc_id, (('0x' || md5(term)[1:8])::BIGINT % {DIMS})::INTEGER AS dim,
      sum(CASE WHEN md5(term)[9] < '8' THEN 1 ELSE -1 END) AS total
    FROM ({_DOCS}) GROUP BY ALL) WHERE total <> 0"""


def _dense(digits: int) -> str:
    return f"""
  SELECT doc_id, dim, round(coalesce(total / norm, 0)::DOUBLE, {digits}) AS value
  FROM (SELECT doc_id, (unnest(range({DIMS})))::INTEGER AS dim FROM documents)
  LEFT JOIN ({HASHED}) USING (doc_id, dim)"""


LEDGER_BATCH = 16


def ledger_client(calls: str, broken: bool):
    """A paid client that notes the chunks it is asked for; a ``broken`` one fails at some chunk, before it is paid."""

    def factory():
        system, base = place(calls)
        notes = system.open_output_stream(f"{base}/{uuid.uuid4().hex}.txt", compression=None)  # one file per client

        def client(texts):
            marks = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            if broken and any(m[0] == "8" for m in marks):
                notes.close()
                raise RuntimeError("the service is away")
            notes.write("".join(m + "\n" for m in marks).encode())
            notes.flush()
            return ["en " + t for t in texts]

        return client

    return factory


def ledger_run(spark, d):
    """A job whose client fails half-way, and a second one with the same ledger; how often each chunk was paid for."""
    distinct = materialize(distinct_chunks(chunks(spark, d)), "chunks")
    ledger, calls = scratch_path(spark, "ledger"), scratch_path(spark, "calls")
    open_ledger(calls)
    try:
        translate_with(distinct, ledger_client(calls, broken=True), LEDGER_BATCH, callers=1, paid=True, ledger=ledger)
    except PythonException:
        pass  # the service was away; batches before that are kept
    first = materialize(answers(spark, ledger).select("chunk_id", F.lit(True).alias("kept")), "first-answers")
    done = translate_with(distinct, ledger_client(calls, broken=False), LEDGER_BATCH, callers=4, paid=True, ledger=ledger)
    paid = spark.read.text(calls).groupBy(F.unhex("value").alias("chunk_id")).agg(F.count("*").alias("n_calls"))
    rows = done.join(paid, "chunk_id").join(first, "chunk_id", "left")
    return rows.select(
        F.lower(F.hex("chunk_id")).alias("chunk_id"), F.md5("translated").alias("translated"), "n_calls", F.coalesce("kept", F.lit(False)).alias("first_run")
    )


LEDGER = f"""
  WITH c AS (SELECT DISTINCT chunk, sha256(chunk) AS chunk_id FROM ({CHUNKS})),
  b AS (SELECT *, (row_number() OVER (ORDER BY chunk_id) - 1) // {LEDGER_BATCH} AS batch FROM c)
  SELECT chunk_id, md5('en ' || chunk) AS translated, 1::BIGINT AS n_calls,
    batch < (SELECT coalesce(min(batch), 1 << 40) FROM b WHERE chunk_id[1] = '8') AS first_run
  FROM b"""

QUERIES = {
    "translate_ledger": (ledger_run, LEDGER),
    "embed_texts": (embedded, _dense(4)),
    "embed_hashing": (
        lambda s, d: hashing_values(documents(s, d), "doc_id", "text", DIMS).select(
            "doc_id", "dim", F.round("value", 6).alias("value")
        ),
        f"SELECT doc_id, dim, round(total / norm, 6) AS value FROM ({HASHED})",
    ),
    "embed_hashing_dense": (
        lambda s, d: hashing_vectors(documents(s, d), "doc_id", "text", DIMS)
        .select("doc_id", F.posexplode("embedding").alias("dim", "value"))
        .select("doc_id", "dim", F.round(F.col("value").cast("double"), 4).alias("value")),
        _dense(4),
    ),
    "glossary_translate": (glossary_translated, TRANSLATED),
    "translation_budget": (
        lambda s, d: translation_budget(
            distinct_chunks(report_chunks(documents(s, d), ("doc_id",), max_chunk_chars=HOSTED_CHUNK_CHARS, hosted=True)),
            BUDGET,
        ),
        f"""SELECT count(*) AS n_chunks, coalesce(sum(length(chunk)), 0)::BIGINT AS n_chars,
              ({BUDGET} - coalesce(sum(length(chunk)), 0))::BIGINT AS remaining,
              coalesce(sum(length(chunk)), 0) > {BUDGET} AS exceeded
            FROM (SELECT DISTINCT chunk FROM ({EXPLODE.format(ids="doc_id", sql=_variant_sql("hosted", HOSTED_CHUNK_CHARS))}))
            WHERE chunk <> ''""",
    ),
    "translate_reports": (
        lambda s, d: translate(documents(s, d), glossary_translator(glossary(s, d))),
        f"""SELECT doc_id, {strip_sql("replace(string_agg(translated, ' ' ORDER BY chunk_no), '  ', ' ')")} AS text
            FROM ({TRANSLATED}) GROUP BY doc_id""",
    ),
    "translate_repeated_keys": (
        lambda s, d: translate(
            repeated_keys(documents(s, d).drop("source"), "doc_id"), glossary_translator(glossary(s, d)), output="en"
        ).groupBy("report_key").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(F.md5("en"))), " ").alias("texts")),
        f"""SELECT CASE WHEN doc_id % 5 <> 0 THEN (doc_id // 2)::VARCHAR END AS report_key, count(*) AS n,
              string_agg(md5(en), ' ' ORDER BY md5(en)) AS texts
            FROM (SELECT doc_id, {strip_sql("replace(string_agg(translated, ' ' ORDER BY chunk_no), '  ', ' ')")} AS en
                  FROM ({TRANSLATED}) GROUP BY doc_id) GROUP BY 1""",
    ),
    "translate_client": (
        lambda s, d: translate(
            documents(s, d),
            client_translator(fake_client, formality="more", callers=4),
            hosted=True,
            preserve_original=True,
        ),
        f"""SELECT doc_id, any_value(original) AS text_original,
              {strip_sql("replace(string_agg('<DE>EN-US:more>' || chunk, ' ' ORDER BY chunk_no), '  ', ' ')")} AS text
            FROM ({EXPLODE.format(ids="doc_id, original", sql=f"SELECT h.*, text AS original FROM ({_variant_sql('hosted', HOSTED_CHUNK_CHARS)}) h JOIN documents USING (doc_id)")})
            GROUP BY doc_id""",
    ),
}
