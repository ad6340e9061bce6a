"""Date and name redaction of reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chunk import chunk, join_chunks
from ..functions.fixed import ANONYMISE_CHUNK_CHARS, TAG_BATCH
from ..functions.redact import redact_dates
from ..operators.chunks import chunk_table
from ..operators.infer import Factory, tag
from ..operators.records import RECORD, put_result, with_record_id
from ..operators.spans import gazetteer_spans, person_spans, redact_chunks, spans_by_report

Tagger = Callable[..., DataFrame]


def gazetteer_tagger(gazetteer: DataFrame, max_words: int | None = None) -> Tagger:
    """Tags by a join with a table of names ``(name, label)``; ``max_words`` as in ``gazetteer_spans``."""
    return lambda chunks, *ids: gazetteer_spans(chunks, gazetteer, *ids, max_words=max_words)


def model_tagger(factory: Factory, batch_size: int = TAG_BATCH) -> Tagger:
    """Tags by a model built on the executors."""
    return lambda chunks, *ids: tag(chunks, factory, *ids, batch_size=batch_size)


def anonymize(
    df: DataFrame,
    tagger: Tagger,
    text: str = "text",
    max_chunk_chars: int = ANONYMISE_CHUNK_CHARS,
    output: str | None = None,
    preserve_original: bool = False,
    day_dot_month: bool = False,
) -> DataFrame:
    """Reports with dates and person names replaced; rows with null text pass.

    Dates go before chunking and again at the end, where chunks have met. Each row is a
    record of its own; keys may repeat or be null. Overlapping spans are resolved to the
    leftmost, then longest one.
    """
    df = with_record_id(df)
    chunks = chunk(redact_dates(F.col(text), day_dot_month), max_chunk_chars, always=True)
    pieces = chunk_table(df.filter(F.col(text).isNotNull()), chunks, RECORD)
    found = spans_by_report(person_spans(tagger(pieces, RECORD)), RECORD)
    redacted = join_chunks(redact_chunks(chunks, F.col("found")), strip_each=True)
    result = F.when(F.col(text).isNotNull(), redact_dates(redacted, day_dot_month))
    joined = df.join(found, RECORD, "left")
    suffix = "_de" if preserve_original else None
    return put_result(joined, result, text, output, suffix).drop("found", RECORD)
