"""Versions of the same report: index, search, pairs and line differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def version_index(
    records: DataFrame, key: str = "report_key", text: str = "text", query: str | None = None
) -> DataFrame:
    """``(key, n, n_unique)``; with ``query`` also whether key or a text matches it.

    Texts are told apart by their SHA-256, so the shuffle carries 32 bytes for each.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    extra = []
    if query:
        extra = [F.bool_or(F.contains(F.lower("_text"), F.lit(query.lower()))).alias("_text_hit")]
    per_version = (
        records.filter(F.col(key).isNotNull())
        .select(F.col(key).cast("string").alias(key), body.alias("_text"))
        .groupBy(key, F.unhex(F.sha2("_text", 256)).alias("_version"))
        .agg(F.count("*").alias("_n"), *extra)
    )
    hit = [F.bool_or("_text_hit").alias("_text_hit")] if query else []
    return per_version.groupBy(key).agg(
        F.sum("_n").alias("n"), F.count("*").alias("n_unique"), *hit
    )


def multi_version(index: DataFrame, min_unique: int | None = 2) -> DataFrame:
    """Keys with enough different texts; None keeps all."""
    return index if min_unique is None else index.filter(F.col("n_unique") >= min_unique)


def search_reports(
    records: DataFrame,
    query: str,
    key: str = "report_key",
    text: str = "text",
    min_unique: int | None = None,
) -> DataFrame:
    """Index rows that match ``query``.

    The query is a case-insensitive pattern on the key. Only if it finds no listed key,
    it is taken as literal text and looked for in the reports, in any case.
    """
    listed = multi_version(version_index(records, key, text, query), min_unique)
    key_hit = F.col(key).rlike(f"(?iu){query}")
    if min_unique is None:
        keys = records.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull())
    else:
        keys = multi_version(version_index(records, key, text), min_unique)
    any_key = keys.agg(F.coalesce(F.bool_or(key_hit), F.lit(False)).alias("any")).scalar()
    return (
        listed.withColumn("_any_key", any_key)
        .filter(F.when(F.col("_any_key"), key_hit).otherwise(F.col("_text_hit")))
        .select(key, "n", "n_unique")
    )


def top_of_index(index: DataFrame, key: str = "report_key", n: int | None = None) -> DataFrame:
    """The index by different texts, then texts, most first."""
    ordered = index.orderBy(F.desc("n_unique"), F.desc("n"), key)
    return ordered if n is None else ordered.limit(n)


def sorted_keys(index: DataFrame, key: str = "report_key") -> DataFrame:
    """The keys in order."""
    return index.select(key).distinct().orderBy(key)


def distinct_versions(
    records: DataFrame, order: list[str], key: str = "report_key", text: str = "text"
) -> DataFrame:
    """``(key, text, first_seen)``: each different text of a key with its first position.

    Repeats are dropped where they are read, before the shuffle, and texts are told apart
    by their SHA-256, so no sort compares whole texts.
    """
    same = W.partitionBy(key, "_version").orderBy("first_seen")
    return (
        records.filter(F.col(key).isNotNull())
        .select(
            F.col(key).cast("string").alias(key),
            F.coalesce(F.col(text), F.lit("")).alias(text),
            F.struct(*order).alias("first_seen"),
        )
        .withColumn("_version", F.unhex(F.sha2(text, 256)))
        .withColumn("_nth", F.row_number().over(same))
        .filter(F.col("_nth") == 1)
        .select(key, text, "first_seen")
    )


def version_pairs(
    records: DataFrame, order: list[str], key: str = "report_key", text: str = "text"
) -> DataFrame:
    """``(key, text_a, text_b)``: the first two different texts, ``''`` if there is one."""
    nth = W.partitionBy(key).orderBy("first_seen")
    first_two = (
        distinct_versions(records, order, key, text)
        .withColumn("_nth", F.row_number().over(nth))
        .filter(F.col("_nth") <= 2)
    )
    return first_two.groupBy(key).agg(
        F.max(F.when(F.col("_nth") == 1, F.col(text))).alias("text_a"),
        F.coalesce(F.max(F.when(F.col("_nth") == 2, F.col(text))), F.lit("")).alias("text_b"),
    )


def line_difference(pairs: DataFrame, key: str = "report_key") -> DataFrame:
    """``(key, line, change, n)``: lines that one version has more often than the other.

    Only pairs with a second version are compared. Lines end where Python's
    ``splitlines`` ends them, and a final line break opens no further line.
    """
    breaks = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
    both = F.array(
        F.struct(F.lit(-1).alias("_sign"), F.col("text_a").alias("_text")),
        F.struct(F.lit(1).alias("_sign"), F.col("text_b").alias("_text")),
    )
    whole = F.split(F.col("_text"), breaks, -1)
    kept = F.when(
        F.element_at(whole, -1) == "", F.slice(whole, F.lit(1), F.size(whole) - 1)
    ).otherwise(whole)
    return (
        pairs.filter(F.col("text_b") != "")
        .select(key, F.inline(both))
        .select(key, "_sign", F.explode(kept).alias("line"))
        .groupBy(key, "line")
        .agg(F.sum("_sign").alias("_net"))
        .filter(F.col("_net") != 0)
        .select(
            key,
            "line",
            F.when(F.col("_net") > 0, "added").otherwise("removed").alias("change"),
            F.abs("_net").alias("n"),
        )
    )
