"""Queries: tokens, term statistics, TF-IDF, topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed import TOPIC_TERMS, VOCABULARY_SIZE
from ..functions.text import ngrams
from ..operators import topics as T
from .inputs import LABELLED_DOCS, labelled_docs, labelled_vectors, table


def documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


def scores(spark, d):
    return T.cluster_term_scores(labelled_docs(spark, d), "idx_global")


def topics(spark, d):
    return T.cluster_topics(scores(spark, d))


def ngrams_sql(source: str, *ids: str) -> str:
    """``(ids…, pos, term)`` of the n-grams of ``source``'s text."""
    names = ", ".join(ids)
    return f"""
  SELECT {names}, (unnest(range(len(terms))))::INTEGER AS pos, unnest(terms) AS term FROM (
    SELECT {names}, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS terms
    FROM (SELECT {names}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM ({source})))"""


_DOCS = ngrams_sql("SELECT doc_id, text FROM documents", "doc_id")
_LABELLED = ngrams_sql(LABELLED_DOCS, "idx_global", '"cluster"')

STATS = f"""
  SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df
  FROM (SELECT doc_id, term, count(*) AS tf FROM ({_DOCS}) GROUP BY ALL) GROUP BY term"""

WEIGHTS = f"""
  WITH grams AS MATERIALIZED ({_LABELLED}),
  vocabulary AS (SELECT term, count(*) AS n FROM grams GROUP BY term ORDER BY n DESC, term LIMIT {VOCABULARY_SIZE}),
  counted AS (SELECT idx_global, "cluster", term, count(*) AS tf FROM grams SEMI JOIN vocabulary USING (term) GROUP BY ALL),
  idfs AS (SELECT term, ln((1 + (SELECT count(*) FROM embeddings)) / (1 + count(*))) + 1 AS idf FROM counted GROUP BY term),
  raw AS (SELECT idx_global, "cluster", term, tf * idf AS w FROM counted JOIN idfs USING (term))
  SELECT idx_global, "cluster", term, w / sqrt(sum(w * w) OVER (PARTITION BY idx_global)) AS weight FROM raw"""

SCORES = f"""
  SELECT "cluster", term, total / n AS score
  FROM (SELECT "cluster", term, sum(weight) AS total FROM ({WEIGHTS}) GROUP BY ALL)
  JOIN (SELECT label AS "cluster", count(*) AS n FROM embeddings GROUP BY label) USING ("cluster")"""

TOPICS = f"""
  SELECT * FROM (
    SELECT "cluster", term, score,
      (row_number() OVER (PARTITION BY "cluster" ORDER BY round(score, 12) DESC, term))::INTEGER AS rank
    FROM ({SCORES}) WHERE score > 0)
  WHERE rank <= {TOPIC_TERMS}"""

QUERIES = {
    "tokenize_ngrams": (
        lambda s, d: documents(s, d).select(
            "doc_id", F.posexplode(ngrams(F.col("text"))).alias("pos", "term")
        ),
        _DOCS,
    ),
    "term_stats": (lambda s, d: T.term_stats(documents(s, d)), STATS),
    "topic_vocabulary": (
        lambda s, d: T.vocabulary(documents(s, d)),
        f"SELECT term, tf, df FROM ({STATS}) ORDER BY tf DESC, term LIMIT {VOCABULARY_SIZE}",
    ),
    "tfidf_weights": (
        lambda s, d: T.tfidf_weights(labelled_docs(s, d), "idx_global").select(
            "idx_global", "term", F.round("weight", 6).alias("weight")
        ),
        f"SELECT idx_global, term, round(weight, 6) AS weight FROM ({WEIGHTS})",
    ),
    "cluster_term_scores": (
        lambda s, d: scores(s, d).select("cluster", "term", F.round("score", 6).alias("score")),
        f'SELECT "cluster", term, round(score, 6) AS score FROM ({SCORES})',
    ),
    "cluster_topics": (
        lambda s, d: topics(s, d).select("cluster", "rank", "term", F.round("score", 6).alias("score")),
        f'SELECT "cluster", rank, term, round(score, 6) AS score FROM ({TOPICS})',
    ),
    "cluster_labels": (
        lambda s, d: T.cluster_labels(labelled_vectors(s, d), topics(s, d)),
        f"""SELECT label AS "cluster", coalesce(term, 'cluster ' || label) AS "label"
            FROM (SELECT DISTINCT label FROM embeddings)
            LEFT JOIN (SELECT "cluster" AS label, term FROM ({TOPICS}) WHERE rank = 1) USING (label)""",
    ),
}
