"""Queries: versions of the same report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.compare import (
    distinct_versions,
    line_difference,
    multi_version,
    search_reports,
    sorted_keys,
    top_of_index,
    version_index,
    version_pairs,
)
from ..operators.difference import ordered_difference
from ..operators.text_index import search_indexed, write_text_index
from ..plans.compare import compare_versions
from ..session import scratch_path
from .inputs import REORDERED, VERSIONS, reordered, versions

ORDER = ["source_file", "line_no"]


def index(spark, d):
    return version_index(versions(spark, d))


def compared(spark, d):
    found = compare_versions(versions(spark, d), ORDER, min_unique=2)
    changes = found.lines.groupBy("report_key").agg(
        F.coalesce(F.sum(F.when(F.col("change") == "added", F.col("n"))), F.lit(0)).alias("n_added"),
        F.coalesce(F.sum(F.when(F.col("change") == "removed", F.col("n"))), F.lit(0)).alias("n_removed"),
    )
    return found.index.join(changes, "report_key", "left")


def indexed_search(spark, d):
    path = scratch_path(spark, "text-index")
    write_text_index(versions(spark, d), path)
    return search_indexed(spark, path, "NACHTRAG 1", min_unique=2)


def moved(spark, d):
    """Lines of each pair by what became of them; pairs without a change have no row."""
    counts = [F.count_if(F.col("change") == c).alias(f"n_{c}") for c in ("moved", "added", "removed")]
    return ordered_difference(reordered(spark, d)).groupBy("report_key").agg(*counts)


# The lines of a text differ, so the kept ones are a longest rising part of their places. ``tails`` has
# the least last place of a rising part of each length.
MOVED = f"""
  WITH a AS (SELECT report_key, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM (
         SELECT report_key, string_split(text_a, chr(10)) AS parts FROM ({REORDERED}))),
  b AS (SELECT report_key, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM (
         SELECT report_key, string_split(text_b, chr(10)) AS parts FROM ({REORDERED}))),
  both_sides AS (
    SELECT report_key, count(*) FILTER (a.place IS NOT NULL) AS n_a, count(*) FILTER (b.place IS NOT NULL) AS n_b,
      list([a.place] ORDER BY b.place) FILTER (a.place IS NOT NULL AND b.place IS NOT NULL) AS places
    FROM a FULL JOIN b USING (report_key, line) GROUP BY report_key),
  counted AS (
    SELECT report_key, n_a, n_b, coalesce(len(places), 0) AS n_both, len(list_reduce(coalesce(places, []),
        lambda tails, x: list_filter(tails, lambda y: y < x[1]) || x || list_filter(tails, lambda y: y > x[1])[2:],
        []::BIGINT[])) AS n_kept FROM both_sides)
  SELECT report_key, (n_both - n_kept)::BIGINT AS n_moved, (n_b - n_both)::BIGINT AS n_added,
    (n_a - n_both)::BIGINT AS n_removed FROM counted WHERE n_a > n_kept OR n_b > n_kept"""

INDEX = f"""
  SELECT report_key::VARCHAR AS report_key, count(*) AS n, count(DISTINCT coalesce(text, '')) AS n_unique
  FROM ({VERSIONS}) GROUP BY report_key"""

DISTINCT = f"""
  SELECT report_key::VARCHAR AS report_key, coalesce(text, '') AS text, min(source_file) AS first_file
  FROM ({VERSIONS}) GROUP BY ALL"""

PAIRS = f"""
  SELECT report_key, max(text) FILTER (nth = 1) AS text_a, coalesce(max(text) FILTER (nth = 2), '') AS text_b
  FROM (SELECT *, row_number() OVER (PARTITION BY report_key ORDER BY first_file) AS nth FROM ({DISTINCT}))
  GROUP BY report_key"""

_LINES = r"""
  SELECT report_key, {sign} AS sign, unnest(CASE WHEN parts[-1] = '' THEN parts[:-2] ELSE parts END) AS line
  FROM (SELECT report_key, string_split_regex({side}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')
        AS parts FROM ({pairs}) WHERE text_b <> '')"""

DIFFERENCE = f"""
  SELECT report_key, line, CASE WHEN net > 0 THEN 'added' ELSE 'removed' END AS change, abs(net)::BIGINT AS n
  FROM (SELECT report_key, line, sum(sign) AS net FROM (
    {_LINES.format(sign=-1, side='text_a', pairs=PAIRS)}
    UNION ALL {_LINES.format(sign=1, side='text_b', pairs=PAIRS)}) GROUP BY ALL)
  WHERE net <> 0"""

QUERIES = {
    "version_index": (index, INDEX),
    "multi_version_keys": (
        lambda s, d: multi_version(index(s, d)),
        f"SELECT * FROM ({INDEX}) WHERE n_unique >= 2",
    ),
    "version_index_top": (
        lambda s, d: top_of_index(index(s, d), n=25),
        f"SELECT * FROM ({INDEX}) ORDER BY n_unique DESC, n DESC, report_key LIMIT 25",
    ),
    "sorted_keys": (
        lambda s, d: sorted_keys(index(s, d)),
        f"SELECT DISTINCT report_key FROM ({INDEX}) ORDER BY report_key",
    ),
    "search_key_hit": (
        lambda s, d: search_reports(versions(s, d), "^1[0-9]*5$", min_unique=2),
        f"SELECT * FROM ({INDEX}) WHERE n_unique >= 2 AND regexp_matches(report_key, '^1[0-9]*5$')",
    ),
    "search_text_fallback": (
        lambda s, d: search_reports(versions(s, d), "NACHTRAG 1", min_unique=2),
        f"""SELECT * FROM ({INDEX}) WHERE n_unique >= 2 AND report_key IN (
              SELECT report_key::VARCHAR FROM ({VERSIONS}) WHERE contains(lower(text), 'nachtrag 1'))""",
    ),
    "search_indexed": (
        indexed_search,
        f"""SELECT * FROM ({INDEX}) WHERE n_unique >= 2 AND report_key IN (
              SELECT report_key::VARCHAR FROM ({VERSIONS}) WHERE contains(lower(text), 'nachtrag 1'))""",
    ),
    "distinct_versions": (
        lambda s, d: distinct_versions(versions(s, d), ORDER).select(
            "report_key", "text", F.col("first_seen.source_file").alias("first_file")
        ),
        DISTINCT,
    ),
    "version_pairs": (lambda s, d: version_pairs(versions(s, d), ORDER), PAIRS),
    "version_line_diff": (
        lambda s, d: line_difference(version_pairs(versions(s, d), ORDER)),
        DIFFERENCE,
    ),
    "moved_lines": (moved, MOVED),
    "compare_versions": (
        compared,
        f"""SELECT i.*, c.n_added, c.n_removed FROM ({INDEX}) i LEFT JOIN (
              SELECT report_key, coalesce(sum(n) FILTER (change = 'added'), 0)::BIGINT AS n_added,
                coalesce(sum(n) FILTER (change = 'removed'), 0)::BIGINT AS n_removed
              FROM ({DIFFERENCE}) GROUP BY report_key) c USING (report_key)
            WHERE i.n_unique >= 2""",
    ),
}
