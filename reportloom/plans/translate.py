"""Translation of reports, each different chunk once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chunk import chunk
from ..functions.fixed import HOSTED_CHUNK_CHARS, LOCAL_CHUNK_CHARS, TRANSLATE_BATCH
from ..operators.chunks import chunk_table, rejoin_chunks
from ..operators.infer import (
    Factory,
    attach_translations,
    chunk_id,
    distinct_chunks,
    translate_with,
    with_chunk_id,
)
from ..operators.records import RECORD, put_result, route, with_record_id
from ..operators.translate import glossary_translations

Translator = Callable[[DataFrame], DataFrame]
PASSES, CHUNKS, CHUNK_IDS = "_passes", "_chunks", "_chunk_ids"


def glossary_translator(glossary: DataFrame) -> Translator:
    """Word-for-word replacement by a join."""
    return lambda chunks: glossary_translations(chunks, glossary)


def model_translator(factory: Factory, batch_size: int = TRANSLATE_BATCH) -> Translator:
    """A model on the executors."""
    return lambda chunks: translate_with(chunks, factory, batch_size)


def client_translator(
    client: Callable[..., Callable[[list[str]], list[str]]],
    source_lang: str = "DE",
    target_lang: str = "EN-US",
    formality: str = "default",
    batch_size: int = TRANSLATE_BATCH,
    callers: int | None = None,
    ledger: str | None = None,
) -> Translator:
    """A paid service; ``client(source_lang, target_lang, formality)`` runs on the executors.

    ``ledger`` names a shared folder that keeps the answers, so that a job which is started again goes on
    where it stopped.
    """
    wanted = None if formality == "default" else formality

    def factory():
        return client(source_lang=source_lang, target_lang=target_lang, formality=wanted)

    return lambda chunks: translate_with(chunks, factory, batch_size, callers, paid=True, ledger=ledger)


def text_chunks(text: Column, max_chunk_chars: int | None) -> Column:
    """Chunks of a text to translate: one if it fits, or if there is no limit."""
    return F.array(text) if max_chunk_chars is None else chunk(text, max_chunk_chars, always=False)


def report_chunks(
    df: DataFrame,
    ids: tuple[str, ...] = ("report_key",),
    text: str = "text",
    max_chunk_chars: int | None = LOCAL_CHUNK_CHARS,
    hosted: bool = False,
) -> DataFrame:
    """``(ids…, chunk_no, chunk, chunk_id)`` of the rows to translate.

    Text that fits stays whole. ``hosted`` leaves out empty texts; ``max_chunk_chars=None``
    sends every text as one chunk.
    """
    todo = df.filter(route(F.col(text), empty_passes=hosted) == "process")
    return with_chunk_id(chunk_table(todo, text_chunks(F.col(text), max_chunk_chars), *ids))


def translate(
    df: DataFrame,
    translator: Translator,
    text: str = "text",
    max_chunk_chars: int | None = None,
    hosted: bool = False,
    whole: bool = False,
    output: str | None = None,
    preserve_original: bool = False,
) -> DataFrame:
    """Reports with ``text`` translated; rows not to be translated pass unchanged.

    Each row is a record of its own; keys may repeat or be null. ``whole`` sends each text as
    it is, without chunks.
    """
    limit = max_chunk_chars or (HOSTED_CHUNK_CHARS if hosted else LOCAL_CHUNK_CHARS)
    if whole:
        limit = None
    passes = route(F.col(text), empty_passes=hosted) == "pass"
    renamed = bool(output and output != text)
    df = df.withColumns({PASSES: passes, CHUNKS: F.when(~passes, text_chunks(F.col(text), limit))})
    df = df.withColumn(CHUNK_IDS, F.transform(CHUNKS, chunk_id))
    if not (renamed or preserve_original):  # a text to translate is then wanted as chunks only
        df = df.withColumn(text, F.when(F.col(PASSES), F.col(text)))
    # Written once, each text with its chunks: the different chunks, their places and the hot ones all start from here.
    df = with_record_id(df)
    chunks = df.select(F.inline_outer(F.arrays_zip(CHUNK_IDS, CHUNKS)).alias("chunk_id", "chunk")).filter("chunk_id IS NOT NULL")
    places = chunk_table(df, F.col(CHUNK_IDS), RECORD).withColumnRenamed("chunk", "chunk_id")
    answers = attach_translations(places, translator(distinct_chunks(chunks)), RECORD)
    rejoined = rejoin_chunks(answers, RECORD, chunk="translated", out="_translated")
    joined = df.drop(CHUNKS, CHUNK_IDS).join(rejoined, RECORD, "left")
    suffix = "_original" if preserve_original else None
    if renamed:
        result = F.when(~F.col(PASSES), F.col("_translated"))
    else:
        result = F.when(F.col(PASSES), F.col(text)).otherwise(F.col("_translated"))
    return put_result(joined, result, text, output, suffix).drop("_translated", PASSES, RECORD)
