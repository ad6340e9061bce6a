"""Texts for vectors: first occurrence, source discovery, recovery rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fixed import DISCOVERY_HIT_CAP, DISCOVERY_HIT_SHARE
from .skew import HOT_ROWS, join_to_unique


BROADCAST_ROWS = 200_000


def wanted_texts(
    texts: DataFrame, ids: DataFrame, key: str = "report_key", max_ids: int | None = None
) -> DataFrame:
    """Texts whose key occurs among ``ids``.

    ``max_ids`` is an upper bound of the number of ids, where there is one; ids with a
    small bound are broadcast and the texts stay where they are.
    """
    wanted = ids.select(key).distinct()
    if max_ids is not None and max_ids <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return texts.join(wanted, key, "left_semi")


def first_texts(
    texts: DataFrame, order: list[str], key: str = "report_key", text: str = "text"
) -> DataFrame:
    """``(key, text)`` of each key's first row in ``order``.

    Spark applies the limit of one row per key before the shuffle as well, so repeats of
    a key are dropped where they are read.
    """
    first = W.partitionBy(key).orderBy(*order)
    return (
        texts.filter(F.col(key).isNotNull())
        .select(key, text, *order, F.row_number().over(first).alias("_nth"))
        .filter(F.col("_nth") == 1)
        .select(key, text)
    )


def attach_text(
    vectors: DataFrame,
    texts: DataFrame,
    order: list[str],
    spread_by: list[str],
    key: str = "report_key",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Vectors with the first text of their key, null where there is none."""
    keyed = texts.withColumn(key, F.col(key).cast("string"))
    return join_to_unique(
        vectors, first_texts(keyed, order, key), key, "left", spread_by, hot_rows=hot_rows
    )


def text_recovery(attached: DataFrame, text: str = "text") -> DataFrame:
    """How many rows found a text."""
    return attached.agg(
        F.count("*").alias("n_total"),
        F.count(text).alias("n_found"),
        F.try_divide(F.count(text), F.count("*")).alias("rate"),
    )


def discovery_threshold(n_ids: Column) -> Column:
    """Hits that make a file the source of an id set."""
    share = F.floor(n_ids / DISCOVERY_HIT_SHARE)
    return F.greatest(F.lit(1), F.least(F.lit(DISCOVERY_HIT_CAP), share)).cast("long")


def discover_source(
    lines: DataFrame,
    ids: DataFrame,
    base: str,
    key: str = "report_key",
    source: str = "source_file",
) -> DataFrame:
    """The JSON-lines file an id set ``base`` came from, as one row or none.

    ``<base>.jsonl`` wins, then ``<base>.emb.jsonl``, else the first file by name with
    enough lines (not distinct ids) whose key is an id. All lines count.
    """
    distinct_ids = ids.select(F.col(key).cast("string").alias(key)).distinct()
    needed = distinct_ids.agg(discovery_threshold(F.count("*")).alias("needed")).scalar()
    marked = join_to_unique(
        lines.select(source, F.col(key).cast("string").alias(key), F.monotonically_increasing_id().alias("_line")),
        distinct_ids.withColumn("_known", F.lit(True)),
        key,
        "left",
        [source, "_line"],
    )
    hits = marked.groupBy(source).agg(F.count_if("_known").alias("n_hits"))
    by_name = (
        F.when(F.col(source) == f"{base}.jsonl", 0)
        .when(F.col(source) == f"{base}.emb.jsonl", 1)
        .otherwise(2)
    )
    return (
        hits.select(by_name.alias("match"), source, "n_hits")
        .withColumn("n_needed", needed)
        .filter((F.col("match") < 2) | (F.col("n_hits") >= F.col("n_needed")))
        .orderBy("match", source)
        .limit(1)
    )


def discover_sources(
    lines: DataFrame, ids: DataFrame, base: str = "base", key: str = "report_key", source: str = "source_file"
) -> DataFrame:
    """``(base, match, source_file, n_hits, n_needed)``: ``discover_source`` for all id sets ``(base, key)`` at once.

    Lines are counted by file and key before they meet the ids, so that a key of very many
    lines is one row per file. Sets without a file have no row.
    """
    wanted = ids.select(base, F.col(key).cast("string").alias(key)).distinct()
    needed = wanted.groupBy(base).agg(discovery_threshold(F.count(key)).alias("n_needed"))
    counted = lines.groupBy(source, F.col(key).cast("string").alias(key)).agg(F.count("*").alias("_lines"))
    hits = counted.join(wanted, key).groupBy(base, source).agg(F.sum("_lines").alias("n_hits"))
    names = F.array(*[F.struct(F.lit(i).alias("match"), F.concat(base, F.lit(end)).alias(source)) for i, end in enumerate((".jsonl", ".emb.jsonl"))])
    named = needed.select(base, F.inline(names)).join(lines.select(source).distinct(), source)
    found = hits.join(needed, base).join(named.select(base, source, "match"), [base, source], "full")
    rank = F.struct(F.coalesce("match", F.lit(2)).alias("match"), F.col(source), F.coalesce("n_hits", F.lit(0)).alias("n_hits"))
    best = found.filter("match IS NOT NULL OR n_hits >= n_needed").groupBy(base).agg(F.min(rank).alias("_best"))
    return best.select(base, "_best.*").join(needed, base)
