"""Sentence splitting, chunk packing and rejoining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import SENTENCE_ENDS, SPACE_CLASS
from .scan import fold_emit, let
from .text import strip

SENTENCE_BREAK = rf"(?<=[{SENTENCE_ENDS}]){SPACE_CLASS}+|\n+"


def split_sentences(text: Column) -> Column:
    """Trimmed, non-empty pieces between sentence ends and line breaks."""
    pieces = F.transform(F.split(text, SENTENCE_BREAK, -1), strip)
    return F.filter(pieces, lambda p: p != "")


def pack_sentences(parts: Column, max_chars: int) -> Column:
    """Greedy packing: a part joins the open chunk, after a space, while it fits."""
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def fits(chunk: Column, part: Column) -> Column:
        return F.length(chunk) + 1 + F.length(part) <= max_chars

    return fold_emit(
        rest,
        state=F.get(parts, 0),
        step=lambda chunk, part: F.when(
            fits(chunk, part), F.concat(chunk, F.lit(" "), part)
        ).otherwise(part),
        emits=lambda chunk, part: ~fits(chunk, part),
        value=lambda chunk, part: chunk,
        value_type="string",
        finish=lambda chunk: chunk,
    )


def pack_chunks(text: Column, max_chars: int) -> Column:
    """Chunks of ``text``; null gives one empty chunk, a long sentence stays whole."""
    packed = let(
        split_sentences(text),
        lambda parts: F.when(F.size(parts) == 0, F.array(strip(text))).otherwise(
            pack_sentences(parts, max_chars)
        ),
    )
    return F.when(text.isNull(), F.array(F.lit(""))).otherwise(packed)


def chunk(text: Column, max_chars: int, always: bool) -> Column:
    """Chunks of ``text``; unless ``always``, text that fits is left as it is."""
    packed = pack_chunks(text, max_chars)
    if always:
        return packed
    return F.when(F.length(text) <= max_chars, F.array(text)).otherwise(packed)


def join_chunks(pieces: Column, strip_each: bool = False) -> Column:
    """Pieces joined by a space, double spaces replaced once, trimmed."""
    if strip_each:
        pieces = F.transform(pieces, strip)
    return strip(F.replace(F.array_join(pieces, " "), F.lit("  "), F.lit(" ")))
