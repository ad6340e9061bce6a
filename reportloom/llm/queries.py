"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checks.inputs import SPACE_SQL
from . import (
    exact_dedup, language_id, line_dedup, merkle, mixing, neighbours, ngram_join, pii, runs, sentencepiece, token_files, toxicity, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents")
    ids = docs.select("doc_id", sentencepiece.encode_column(F.col("text"), model).alias("ids"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(sentencepiece.decode_column(F.col("ids"), model), 256).alias("decoded_sha256"),
    )


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^{SPACE_SQL[1:]}+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + k - 1], ' ') AS run
      FROM (SELECT doc_id, words, least(5, len(words)) AS k, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS i
            FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS runs FROM s GROUP BY doc_id),
l AS (SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.run = b.run
                            WHERE a.doc_id <> b.doc_id GROUP BY ALL) p
      JOIN n a ON a.doc_id = p.x JOIN n b ON b.doc_id = p.y WHERE common >= 0.8 * (a.runs + b.runs - common)),
r AS (SELECT doc_id AS x, doc_id AS root FROM documents UNION SELECT l.y, r.root FROM r JOIN l ON r.x = l.x),
c AS (SELECT x AS doc_id, min(root) AS class_id FROM r GROUP BY x)
SELECT doc_id, class_id, coalesce(links, 0) AS links, count(*) OVER (PARTITION BY class_id) AS class_size
FROM c LEFT JOIN (SELECT x, count(*) AS links FROM l GROUP BY x) ON x = doc_id
"""


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "line_count", "dropped_count", F.sha2("text", 256).alias("text_sha256")
    )


# DuckDB's levenshtein counts bytes: letters of two bytes that the four languages have become one byte each
LETTERS_OF_TWO_BYTES = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöüàâîôûáú"
ONE_BYTE_SQL = f"translate({{0}}, '{LETTERS_OF_TWO_BYTES}', list_aggregate(list_transform(list_concat(range(1, 9), range(11, {len(LETTERS_OF_TWO_BYTES) + 3})), lambda c: chr(c::INT)), 'string_agg', ''))"


def lines_sql(documents: str) -> str:
    """SQL for the deduplicated texts of the table or subquery ``documents``: ``deduped`` has all its
    columns but the text, and ``line_count``, ``dropped_count`` and the new text as ``kept``."""
    return f"""
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM {documents})),
firsts AS (SELECT line, {ONE_BYTE_SQL.format('line')} AS bytes, min(doc_id) AS doc_id, arg_min(n, (doc_id, n)) AS n, len(line) AS size
           FROM lines WHERE line <> '' GROUP BY line),
near AS (SELECT DISTINCT a.line FROM (SELECT *, unnest(range(size - 6, size + 7)) AS other FROM firsts WHERE size >= 24) a
         JOIN firsts b ON a.other = b.size AND b.size >= 24 AND (b.doc_id, b.line) < (a.doc_id, a.line)
         WHERE abs(a.size - b.size) <= least(6, least(a.size, b.size) // 12) AND levenshtein(a.bytes, b.bytes) <= least(6, least(a.size, b.size) // 12)),
marked AS (SELECT l.doc_id, l.n, l.line, l.line <> '' AND ((l.doc_id, l.n) <> (f.doc_id, f.n) OR near.line IS NOT NULL) AS gone
           FROM lines l LEFT JOIN firsts f ON l.line = f.line LEFT JOIN near ON l.line = near.line),
joined AS (SELECT doc_id, count(*)::INT AS line_count, count_if(gone)::INT AS dropped_count,
                  coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '') AS kept FROM marked GROUP BY doc_id),
deduped AS (SELECT d.* EXCLUDE (text), coalesce(line_count, 0)::INT AS line_count,
                   coalesce(dropped_count, 0)::INT AS dropped_count, CASE WHEN d.text IS NOT NULL THEN kept END AS kept
            FROM {documents} d LEFT JOIN joined j USING (doc_id))
"""


OP3_SQL = f"WITH {lines_sql('documents')} SELECT doc_id, line_count, dropped_count, sha256(kept) AS text_sha256 FROM deduped"


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


OP4_SQL = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN f USING (payload_digest)
"""


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))
    return found.drop("doc_hash")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def mixing_sql(documents: str) -> str:
    """SQL for the mix of the table or subquery ``documents``: sources' targets by water filling,
    then documents in order of their hash until the budget is met as nearly as may be."""
    return f"""
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))[1:15])::BIGINT AS h
      FROM {documents}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight,
             3 * source_size AS most FROM s),
r AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER b, 0))::DOUBLE
             / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS rate
      FROM w WINDOW b AS (ORDER BY most / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, CASE WHEN most <= rate * weight THEN most::DOUBLE
                     ELSE max(rate) FILTER (most > rate * weight) OVER () * weight END AS target FROM r),
p AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size)::BIGINT, 3) ELSE 0 END AS repeats FROM g),
c AS (SELECT d.source, h, sum(size)::BIGINT AS size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL),
a AS (SELECT c.source, h, size, n, coalesce(sum(size) OVER (PARTITION BY c.source ORDER BY h
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below FROM c),
e AS (SELECT a.source, max(h) AS cut, arg_max(least(n, greatest(0, floor((target - repeats * source_size - below) / (size / n) + 0.5)::BIGINT)), h) AS more
      FROM a JOIN p ON a.source IS NOT DISTINCT FROM p.source
      WHERE below <= target - repeats * source_size GROUP BY a.source),
mixed AS (
SELECT d.doc_id, d.source, size, source_size, target,
       (size * least(repeats + coalesce(h < cut OR h = cut AND number <= more, false)::BIGINT, 3))::BIGINT AS taken
FROM (SELECT *, row_number() OVER (PARTITION BY source, h) AS number FROM d) d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source)
"""


OP9_SQL = f"WITH {mixing_sql('documents')} SELECT doc_id, size, source_size, target, taken FROM mixed"


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


def leaf_sql(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    coded = [f"coalesce(octet_length(encode(({f})::VARCHAR)) || ':' || ({f})::VARCHAR, '-')" for f in fields]
    return f"sha256({' || '.join(coded)})"


CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [1, 2, 3, 4, 5, 6, 7, 8]), lambda x, k: xor(x // 2, 3988292384 * (x % 2)))))"""
OP11_SQL = f"""
WITH RECURSIVE
d AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM (
      SELECT doc_id, lang, {leaf_sql('n_chars')} AS leaf,
             CASE WHEN {CRC_SQL} % 7 = 0 THEN {leaf_sql('n_chars + 1')} ELSE {leaf_sql('n_chars')} END AS given FROM documents)),
t AS (SELECT lang, 0 AS level, i, leaf AS h FROM d
      UNION ALL SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
      FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM t) WHERE n > 1 GROUP BY lang, level, i // 2),
high AS (SELECT lang, max(level) AS high FROM t GROUP BY lang),
s AS (SELECT t.lang, h AS subroot, row_number() OVER (ORDER BY encode(t.lang) NULLS FIRST) - 1 AS j
      FROM t JOIN high ON t.lang IS NOT DISTINCT FROM high.lang AND level = high),
u AS (SELECT 0 AS level, j AS i, subroot AS h FROM s
      UNION ALL SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
      FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY level, i // 2),
top AS (SELECT h AS root, level FROM u ORDER BY level DESC LIMIT 1),
steps AS (
  SELECT d.i AS leaf_at, d.lang, k, (d.i >> k) % 2 AS odd, t.h AS sibling
  FROM (SELECT d.*, unnest(range(high)) AS k FROM d JOIN high ON d.lang IS NOT DISTINCT FROM high.lang) d
  LEFT JOIN t ON t.lang IS NOT DISTINCT FROM d.lang AND t.level = k AND t.i = xor(d.i >> k, 1)
  UNION ALL
  SELECT d.i, d.lang, high + k, (s.j >> k) % 2, u.h
  FROM (SELECT s.*, unnest(range((SELECT level FROM top))) AS k FROM s) s
  JOIN d ON d.lang IS NOT DISTINCT FROM s.lang JOIN high ON high.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN u ON u.level = k AND u.i = xor(s.j >> k, 1)),
paths AS (SELECT leaf_at, lang, list(CASE WHEN sibling IS NULL THEN '' WHEN odd = 1 THEN 'L' || sibling ELSE 'R' || sibling END ORDER BY k) AS path
          FROM steps GROUP BY leaf_at, lang),
done AS (SELECT d.doc_id, leaf, subroot, root, coalesce(path, []) AS path, list_reduce(list_prepend(given, coalesce(path, [])),
                lambda h, p: sha256(CASE WHEN p[1] = 'L' THEN p[2:] ELSE '' END || h || CASE WHEN p[1] = 'R' THEN p[2:] ELSE '' END)) AS folded_root
         FROM d JOIN s ON d.lang IS NOT DISTINCT FROM s.lang CROSS JOIN top
         LEFT JOIN paths ON leaf_at = d.i AND paths.lang IS NOT DISTINCT FROM d.lang)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_transform(path, lambda p: p[2:]), 'string_agg', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM done
"""


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("redacted")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


QUERIES = {
    "op1_sentencepiece": (op1_sentencepiece, None),
    "op2_ngram_join": (op2_ngram_join, OP2_SQL),
    "op3_line_dedup": (op3_line_dedup, OP3_SQL),
    "op4_warc": (op4_warc, OP4_SQL),
    "op5_token_files": (op5_token_files, None),
    "op6_exact_dedup": (op6_exact_dedup, OP6_SQL),
    "op7_toxicity": (op7_toxicity, None),
    "op8_language_id": (op8_language_id, None),
    "op9_mixing": (op9_mixing, OP9_SQL),
    "op10_neighbours": (op10_neighbours, None),
    "op11_merkle": (op11_merkle, OP11_SQL),
    "op12_pii": (op12_pii, None),
    "op13_runs": (op13_runs, None),
}
