"""Model calls: embedding, tagging and translation through factories.

A factory ``() -> callable(list[str]) -> list`` is shipped to the executors and called
once per Python worker, so any model or client plugs in. Nothing else runs in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import EMBED_BATCH, TAG_BATCH, TRANSLATE_BATCH
from ..session import scratch_path
from .ledger import answers, call_missing
from .skew import HOT_ROWS, join_to_unique, may_be_hot

Model = Callable[[list[str]], list]
Factory = Callable[[], Model]


def embed(text: Column, factory: Factory, batch_size: int = EMBED_BATCH) -> Column:
    """Float vectors of a text column, the model called with up to ``batch_size`` texts; null stays null."""

    def make():
        import numpy as np

        model = factory()

        def predict(texts: np.ndarray) -> np.ndarray:
            present = [i for i, t in enumerate(texts) if t is not None]
            found = np.asarray(model([str(texts[i]) for i in present]) if present else [[0.0]], dtype=np.float32)
            out = np.zeros((len(texts), found.shape[1]), np.float32)
            out[present] = found if present else 0
            return out

        return predict

    call = predict_batch_udf(make, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    # Otherwise the optimizer may copy the call into a filter and run the model twice.
    return F.when(text.isNotNull(), call.asNondeterministic()(text))


def _batches(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), size):
            yield frame.iloc[at : at + size]


def tag(chunks: DataFrame, factory: Factory, *ids: str, batch_size: int = TAG_BATCH) -> DataFrame:
    """``(ids…, chunk_no, start, end, label)`` from a tagger.

    The tagger returns per chunk a list of ``(start, end, label, span_text)``. Where it
    gives no offsets the first place of the span text in the chunk is taken, or none.
    """
    id_fields = [chunks.schema[c] for c in (*ids, "chunk_no")]
    schema = T.StructType(
        [
            *id_fields,
            T.StructField("_chunk", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("label", T.StringType()),
            T.StructField("_span_text", T.StringType()),
        ]
    )
    names = [f.name for f in id_fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for batch in _batches(frames, batch_size):
            rows = []
            tagged = model(batch["chunk"].tolist())
            for values, text, found in zip(
                batch[names].itertuples(index=False, name=None), batch["chunk"], tagged, strict=True
            ):
                for start, end, label, span_text in found:
                    located = start is not None and end is not None
                    rows.append((*values, None if located else text, start, end, label, span_text))
            out = pd.DataFrame(rows, columns=schema.names)
            yield out.astype({"start": "Int32", "end": "Int32"})

    raw = chunks.select(*names, "chunk").mapInPandas(run, schema)
    at = F.position("_span_text", "_chunk") - 1
    start = F.when(F.col("_chunk").isNull(), F.col("start")).otherwise(at)
    end = F.when(F.col("_chunk").isNull(), F.col("end")).otherwise(at + F.length("_span_text"))
    return raw.select(
        *names, start.cast("int").alias("start"), end.cast("int").alias("end"), "label"
    ).filter(F.col("start") >= 0)


def chunk_id(chunk: Column) -> Column:
    """A SHA-256 of the chunk that stands for it in joins."""
    return F.unhex(F.sha2(chunk, 256))


def with_chunk_id(chunks: DataFrame, chunk: str = "chunk") -> DataFrame:
    """Adds ``chunk_id``."""
    return chunks.withColumn("chunk_id", chunk_id(F.col(chunk)))


def distinct_chunks(chunks: DataFrame) -> DataFrame:
    """``(chunk_id, chunk)`` once per different chunk, split by its id as later joins want it."""
    return chunks.select("chunk_id", "chunk").dropDuplicates(["chunk_id"])


def translate_with(
    chunks: DataFrame,
    factory: Factory,
    batch_size: int = TRANSLATE_BATCH,
    callers: int | None = None,
    paid: bool = False,
    ledger: str | None = None,
) -> DataFrame:
    """``(chunk_id, translated)`` of distinct chunks from a model or client.

    ``callers`` bounds how many tasks call at the same time. With ``paid`` each batch of answers is
    committed to the folder ``ledger`` before the next one is asked for: a task that is run again
    finds them there, and a job that is started again with the same ledger asks only for chunks that it
    lacks. Without a name the ledger is a new folder in the scratch folder.
    """
    if paid:
        spark = chunks.sparkSession
        path = ledger or scratch_path(spark, "ledger")
        call_missing(chunks, factory, path, batch_size, callers)
        return answers(spark, path).join(chunks.select("chunk_id"), "chunk_id", "left_semi")
    if callers:
        chunks = chunks.repartition(callers)
    schema = T.StructType(
        [chunks.schema["chunk_id"], T.StructField("translated", T.StringType())]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for batch in _batches(frames, batch_size):
            yield pd.DataFrame({"chunk_id": batch["chunk_id"].array, "translated": model(batch["chunk"].tolist())})

    return chunks.select("chunk_id", "chunk").mapInPandas(run, schema)


def attach_translations(
    chunks: DataFrame, translations: DataFrame, *ids: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``(ids…, chunk_no, translated)``: the answer to each chunk, wherever it occurs.

    Answers split by ``chunk_id`` stay where they are unless a chunk is hot, which is counted first.
    """
    places = chunks.select(*ids, "chunk_no", "chunk_id")
    return join_to_unique(
        places,
        translations,
        "chunk_id",
        "left",
        [*ids, "chunk_no"],
        hot_rows=hot_rows,
        salt=None if may_be_hot(places, "chunk_id", hot_rows) else False,
    ).drop("chunk_id")
