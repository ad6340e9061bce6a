"""Word-for-word glossary translation and the translation budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import WORD_CLASS
from .membership import WordSet


def glossary_translations(chunks: DataFrame, glossary: DataFrame) -> DataFrame:
    """``(chunk_id, translated)``: words found in ``glossary(word, target)`` replaced.

    Lookup is in lower case; other words and all characters between words stay. Null chunks give no row.

    Only a chunk's different words that the glossary may hold become rows; their targets come back as
    one map per chunk, and the replacement is made inside the row. A frequent word is a hot key
    of the lookup, which Spark's skewed join splits.
    """
    word = WORD_CLASS + "+"
    pieces = F.regexp_extract_all("chunk", F.lit(word), F.lit(0))
    known = WordSet(glossary, "word", glossary.count())
    asked = F.filter(F.array_distinct(F.transform(pieces, F.lower)), known.holds)
    # The plain form of ``explode`` lets the optimizer make the words once more in a filter.
    words = known.beside(chunks).select("chunk_id", F.explode_outer(asked).alias("word")).filter("word IS NOT NULL")
    found = words.join(glossary.select("word", "target"), "word")
    targets = found.groupBy("chunk_id").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "target"))).alias("_targets")
    )
    # Each word with the characters before it; a last empty word takes the text's end.
    gaps = F.split("chunk", word, -1)
    words = F.concat(pieces, F.array(F.lit("")))
    changed = F.zip_with(
        gaps, words, lambda g, w: F.concat(g, F.coalesce(F.element_at("_targets", F.lower(w)), w))
    )
    return (
        chunks.filter(F.col("chunk").isNotNull())
        .join(targets, "chunk_id", "left")
        .select("chunk_id", F.array_join(changed, "").alias("translated"))
    )


def translation_budget(distinct: DataFrame, limit: int) -> DataFrame:
    """Characters of the distinct non-empty chunks against the service's limit."""
    used = F.coalesce(F.sum(F.length("chunk").cast("long")), F.lit(0))
    return (
        distinct.filter(F.col("chunk") != "")
        .agg(F.count("*").alias("n_chunks"), used.alias("n_chars"))
        .withColumn("remaining", F.lit(limit).cast("long") - F.col("n_chars"))
        .withColumn("exceeded", F.col("n_chars") > limit)
    )
