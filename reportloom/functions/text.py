"""Small text expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import SPACES, WORD_CLASS
from .scan import let


def strip(text: Column) -> Column:
    """Trim all Unicode white space (Spark's plain ``trim`` takes spaces only)."""
    return F.btrim(text, F.lit(SPACES))


def words(text: Column) -> Column:
    """Lower-cased runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_CLASS + "{2,}"), F.lit(0))


def _neighbours(tokens: Column) -> Column:
    inner = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), inner),
        F.slice(tokens, F.lit(2), inner),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def pairs_of(tokens: Column) -> Column:
    """Each pair of neighbours joined by a space."""
    return let(tokens, _neighbours)


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by their pairs."""
    return let(tokens, lambda ts: F.concat(ts, _neighbours(ts)))


def ngrams(text: Column) -> Column:
    """Unigrams and bigrams of ``text``."""
    return with_bigrams(words(text))


def clip(text: Column, n: int) -> Column:
    """The first ``n`` characters and dots, null kept."""
    return F.concat(F.substring(text, 1, n), F.lit("..."))
