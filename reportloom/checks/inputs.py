"""Inputs that the given tables do not have as such, derived from whole tables.

Every definition has a SQL twin below it. The remainders (``% 7`` and the like) decide
where a defect is put in; no row is left out by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import replace_matches
from ..functions.fixed import BIRTH_LABELS, BIRTH_REACH, MONTH_NAMES, SPACES

WORD_SQL = r"[\p{L}\p{N}_]"
SPACE_SQL = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip_sql(expr: str) -> str:
    return f"trim({expr}, '{SPACES}')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole given table, dealt out row by row if its files do not keep all cores busy.

    The small tables have one row group each, which one task would read; large ones have many and
    are read as they lie, without a shuffle. No keys are used, so no shuffle by key that an operator
    needs is spared.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    # From the files' footers alone; one row per task of the scan.
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    even = len(sizes) >= cores and max(sizes) * cores <= 2 * sum(sizes)
    return rows if even else rows.repartition(cores)


# --- hex fragments ------------------------------------------------------------------
def hex_fragments(spark: SparkSession, d: str) -> DataFrame:
    """Documents as hex, cut into pieces of 200 digits."""
    pieces = F.regexp_extract_all(F.hex(F.encode("text", "UTF-8")), F.lit(".{1,200}"), F.lit(0))
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("report_key"),
        F.col("source").alias("source_file"),
        F.posexplode(pieces).alias("seq", "text"),
    )


# --- fragments with nulls -----------------------------------------------------------
def null_fragments(spark: SparkSession, d: str) -> DataFrame:
    gone = (F.col("turn") % 3 == 1) | (F.col("conv_id") % 10 == 0)
    return table(spark, d, "conversations").select(
        F.lit("conversations").alias("source_file"),
        F.col("conv_id").alias("report_key"),
        F.col("turn").alias("seq"),
        F.when(~gone, F.when(F.col("turn") % 5 == 2, "").otherwise(F.col("text"))).alias("text"),
    )


NULL_FRAGMENTS = """
  SELECT 'conversations' AS source_file, conv_id AS report_key, turn AS seq,
         CASE WHEN turn % 3 = 1 OR conv_id % 10 = 0 THEN NULL
              WHEN turn % 5 = 2 THEN '' ELSE text END AS text
  FROM conversations"""


# --- RTF documents ------------------------------------------------------------------
def rtf_reports(spark: SparkSession, d: str) -> DataFrame:
    """Documents as RTF: ``\\par`` for line breaks, ``\\uN`` for other than ASCII characters."""
    plain = F.regexp_replace(F.translate("text", "\r", ""), r"([\\{}])", r"\\$1")
    coded = replace_matches(
        plain, r"[\x{80}-\x{7fff}]", lambda c: F.concat(F.lit("\\u"), F.ascii(c), F.lit("?"))
    )
    coded = F.replace(coded, F.lit("\n"), F.lit("\\par "))
    head = "{\\rtf1\\ansi\\deff0{\\fonttbl{\\f0 Arial;}{\\f1 Times;}}{\\colortbl;\\red0;}{\\info{\\a{\\b{\\c{\\d hidden}}}}}\\pard\\b0 "
    return table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit(head), coded, F.lit("}")).alias("text")
    )


# --- reports with dates -------------------------------------------------------------
def dated_reports(spark: SparkSession, d: str) -> DataFrame:
    """Orders as short reports with all date forms, split over two columns."""
    day = F.col("o_orderdate")
    months = F.array(*[F.lit(m) for m in MONTH_NAMES if len(m) > 3 or m == "Mai"])
    month = F.get(months, F.month(day) - 1)
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit("Patient "), "o_custkey", F.lit(", geb. "), F.date_format(day, "dd.MM.yyyy"),
            F.lit(". Befund vom "), F.date_format(day, "d-M-yy"), F.lit(" ohne Auffaelligkeit, Geraet 10.1.2.34."),
        ).alias("text"),
        F.concat(
            F.lit("Kontrolle am "), F.date_format(day, "d"), F.lit(" "), month, F.lit(" "),
            F.date_format(day, "yyyy"), F.lit(" und "), F.date_format(day, "d"), F.lit(". "), month,
            F.lit(" nach "), "o_custkey", F.lit(" "), F.upper(month), F.lit(" geboren: im Mai"),
        ).alias("months"),
    )


_MONTH_LIST = ", ".join(f"'{m}'" for m in MONTH_NAMES if len(m) > 3 or m == "Mai")
DATED_REPORTS = f"""
  SELECT o_orderkey,
    'Patient ' || o_custkey || ', geb. ' || strftime(o_orderdate, '%d.%m.%Y') || '. Befund vom '
      || strftime(o_orderdate, '%-d-%-m-%y') || ' ohne Auffaelligkeit, Geraet 10.1.2.34.' AS text,
    'Kontrolle am ' || strftime(o_orderdate, '%-d') || ' ' || m || ' ' || strftime(o_orderdate, '%Y')
      || ' und ' || strftime(o_orderdate, '%-d') || '. ' || m || ' nach ' || o_custkey || ' ' || upper(m)
      || ' geboren: im Mai' AS months
  FROM (SELECT *, [{_MONTH_LIST}][month(o_orderdate)] AS m FROM orders)"""


def redact_sql(expr: str) -> str:
    """The three date rules for text whose edges are ASCII."""
    months = "|".join(MONTH_NAMES)
    rules = [
        r"\b\d{1,2}[.\-/]\d{1,2}[.\-/]\d{2,4}\b",
        rf"(?i)\b\d{{1,2}}\s+(?:{months})(?:\s+\d{{2,4}})?\b",
        rf"(?i)\b({'|'.join(BIRTH_LABELS)})\s*[:\-]?\s*\S.{{0,{BIRTH_REACH}}}\b",
    ]
    for rule in rules:
        expr = f"regexp_replace({expr}, '{rule}', '[DATE_REDACTED]', 'g')"
    return expr


# --- reports with names -------------------------------------------------------------
def named_reports(spark: SparkSession, d: str) -> DataFrame:
    """Reports on customers; every fourth one is on a guest, whom no dictionary knows."""
    person = F.when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("Gast#"), "c_custkey")).otherwise(F.col("c_name"))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        table(spark, d, "customer")
        .join(nations, "c_nationkey")
        .select(
            F.col("c_custkey").alias("report_key"),
            F.concat(
                F.lit("Befund: "), person, F.lit(" aus "), "n_name",
                F.lit(" wurde am 12.03.1998 aufgenommen;  Kontakt "), person,
                F.lit(".\nSegment "), "c_mktsegment", F.lit("."),
            ).alias("text"),
        )
    )


NAMED_REPORTS = """
  SELECT c_custkey AS report_key, c_name, n_name, c_mktsegment, person, c_custkey % 4 <> 1 AS known,
    'Befund: ' || person || ' aus ' || n_name || ' wurde am 12.03.1998 aufgenommen;  Kontakt '
      || person || '.' || chr(10) || 'Segment ' || c_mktsegment || '.' AS text
  FROM (SELECT *, CASE WHEN c_custkey % 4 = 1 THEN 'Gast#' || c_custkey ELSE c_name END AS person FROM customer)
  JOIN nation ON n_nationkey = c_nationkey"""


def gazetteer(spark: SparkSession, d: str) -> DataFrame:
    """Names of all customers as persons, of all nations as places."""
    people = table(spark, d, "customer")
    return people.select(F.col("c_name").alias("name"), F.lit("B-PER").alias("label")).unionByName(
        table(spark, d, "nation").select(F.col("n_name").alias("name"), F.lit("LOC").alias("label"))
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The same rows with a key that is null for every fifth row and shared by two others."""
    shared = F.when(F.col(key) % 5 != 0, F.expr(f"{key} DIV 2").cast("string"))
    return df.withColumn("_key", shared).drop(key).withColumnRenamed("_key", "report_key")


# --- JSON lines with defects --------------------------------------------------------
def broken_jsonl(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns as JSON lines, some of them broken in one of four ways."""
    line_no = F.col("conv_id") * 8 + F.col("turn")
    whole = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    keyless = F.to_json(F.struct("turn", "role", "text"))
    return table(spark, d, "conversations").select(
        F.when(line_no % 7 == 0, whole.substr(F.lit(1), F.length(whole) - 1))
        .when(line_no % 11 == 0, "   ")
        .when(line_no % 13 == 0, "[1]")
        .when(line_no % 17 == 0, keyless)
        .otherwise(whole)
        .alias("value"),
        "role",
    )


BROKEN_JSONL = """
  SELECT *, CASE WHEN n % 7 = 0 THEN 'unparsable' WHEN n % 11 = 0 THEN 'blank'
                 WHEN n % 13 = 0 THEN 'not_object' ELSE 'record' END AS status,
         n % 7 <> 0 AND n % 11 <> 0 AND n % 13 <> 0 AND n % 17 = 0 AS keyless
  FROM (SELECT *, conv_id * 8 + turn AS n FROM conversations)"""


# --- versions of a report -----------------------------------------------------------
def versions(spark: SparkSession, d: str) -> DataFrame:
    """Documents as file ``a``; changed and repeated copies in files ``b`` to ``d``."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")

    def file(name: str, rows: DataFrame, text: Column) -> DataFrame:
        return rows.select(
            F.col("doc_id").alias("report_key"), text.alias("text"), F.lit(name).alias("source_file"),
            F.col("doc_id").alias("line_no"),
        )

    no_first_line = F.regexp_replace("text", r"\A[^\n]*\n", "")
    addendum = F.concat("text", F.lit("\nNachtrag "), "doc_id")
    return (
        file("a", docs, F.col("text"))
        .unionByName(file("b", docs.filter(F.contains("text", F.lit("\n"))), no_first_line))
        .unionByName(file("c", docs.filter(F.col("lang") == "de"), addendum))
        .unionByName(file("d", docs, F.when(F.col("lang") != "es", F.col("text"))))
    )


VERSIONS = """
  SELECT doc_id AS report_key, text, 'a' AS source_file FROM documents
  UNION ALL SELECT doc_id, regexp_replace(text, '\\A[^\\n]*\\n', ''), 'b' FROM documents
            WHERE contains(text, chr(10))
  UNION ALL SELECT doc_id, text || chr(10) || 'Nachtrag ' || doc_id, 'c' FROM documents WHERE lang = 'de'
  UNION ALL SELECT doc_id, CASE WHEN lang <> 'es' THEN text END, 'd' FROM documents"""


def reordered(spark: SparkSession, d: str) -> DataFrame:
    """Each text with numbered lines, and again with lines out of order and some of them changed."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(i.cast("string"), F.lit(": "), x))
    changed = lambda x, i: F.when(i % 4 == 3, F.concat(x, F.lit("!"))).otherwise(x)
    places = F.transform(lines, lambda x, i: F.struct((i * 7 % 5).alias("a"), i.alias("b"), changed(x, i).alias("line")))
    return table(spark, d, "documents").filter("text IS NOT NULL").select(
        F.col("doc_id").alias("report_key"),
        F.array_join(lines, "\n").alias("text_a"),
        F.array_join(F.transform(F.array_sort(places), lambda p: p["line"]), "\n").alias("text_b"),
    )


REORDERED = """
  SELECT report_key, string_agg(line, chr(10) ORDER BY i) AS text_a,
    string_agg(CASE WHEN i % 4 = 3 THEN line || '!' ELSE line END, chr(10) ORDER BY i * 7 % 5, i) AS text_b
  FROM (SELECT report_key, i, i || ': ' || part AS line FROM (
    SELECT doc_id AS report_key, unnest(string_split(text, chr(10))) AS part,
      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents WHERE text IS NOT NULL))
  GROUP BY report_key"""


# --- vectors ------------------------------------------------------------------------
def dirty_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with NaN or infinity in the first component of some."""
    bad = (
        F.when(F.col("vec_id") % 7 == 0, F.lit(float("nan")))
        .when(F.col("vec_id") % 11 == 0, F.lit(float("inf")))
        .cast("float")
    )
    tail = F.slice("embedding", F.lit(2), F.size("embedding") - 1)
    return table(spark, d, "embeddings").withColumn(
        "embedding",
        F.when(bad.isNotNull(), F.concat(F.array(bad), tail)).otherwise(F.col("embedding")),
    )


def labelled_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with their given label as cluster."""
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("idx_global"),
        F.col("vec_id").cast("string").alias("report_key"),
        F.lit("embeddings.parquet").alias("source_file"),
        F.col("label").alias("cluster"),
        "embedding",
    )


def texts(spark: SparkSession, d: str) -> DataFrame:
    """Report texts with changed copies, some of them in a file that comes first."""
    docs = table(spark, d, "documents")
    copies = docs.select(
        F.col("doc_id").cast("string").alias("report_key"),
        F.concat(F.lit("Kopie: "), "text").alias("text"),
        F.when(F.col("doc_id") % 3 == 0, "0.jsonl").otherwise("b.jsonl").alias("source_file"),
        F.col("doc_id").alias("line_no"),
    )
    originals = docs.select(
        F.col("doc_id").cast("string").alias("report_key"),
        "text",
        F.lit("a.jsonl").alias("source_file"),
        F.col("doc_id").alias("line_no"),
    )
    return originals.unionByName(copies)


FIRST_TEXTS = """
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Kopie: ' || text ELSE text END AS text FROM documents"""


def labelled_docs(spark: SparkSession, d: str) -> DataFrame:
    """The corpus of topic queries: one row per vector, empty text where there is none."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("idx_global"), "text")
    return (
        labelled_vectors(spark, d)
        .select("idx_global", "cluster")
        .join(docs, "idx_global", "left")
        .withColumn("text", F.coalesce("text", F.lit("")))
    )


LABELLED_DOCS = """
  SELECT vec_id AS idx_global, label AS cluster, coalesce(text, '') AS text
  FROM embeddings LEFT JOIN documents ON doc_id = vec_id"""
