"""A ledger of paid calls: answers are committed batch by batch, and what is committed is never asked again.

The ledger is a folder of Parquet files, one per batch, named by the hash of the batch's chunks. When all
batches of a group are there, one file takes their place, so a ledger of n batches has about n / GROUP
files. A task writes a file under another name and then renames it, so a file that can be seen is
whole. A task that is run again forms the same groups and batches and finds the files of those that
were paid for; a job that is started again leaves out all chunks of the ledger.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

ANSWER = "chunk_id binary, translated string"
GROUP = 256  # batches that end up in one file
ANSWER_FIELDS = pa.schema([("chunk_id", pa.binary()), ("translated", pa.string())])


def place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def open_ledger(path: str) -> None:
    """Create the folder, if it is not there yet."""
    system, base = place(path)
    system.create_dir(base, recursive=True)


def answers(spark: SparkSession, path: str) -> DataFrame:
    """``(chunk_id, translated)`` of all committed batches, each chunk once."""
    return spark.read.schema(ANSWER).option("pathGlobFilter", "*.parquet").parquet(path).dropDuplicates(["chunk_id"])


def batches_of(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows again, in tables of ``size`` rows whatever the sizes they come in; the last may be smaller."""
    held: list[pa.Table] = []
    count = 0
    for batch in rows:
        held.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count >= size:
            table = pa.concat_tables(held).combine_chunks()
            whole = count - count % size
            for begin in range(0, whole, size):
                yield table.slice(begin, size)
            held, count = [table.slice(whole)], count - whole
    if count:
        yield pa.concat_tables(held).combine_chunks()


def exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type == fs.FileType.File


def commit(system: fs.FileSystem, path: str, table: pa.Table) -> None:
    """Write a file under a name that readers leave out, then give it its own."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/_{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        pq.write_table(table, out, use_dictionary=False, write_statistics=False)
    system.move(draft, path)


def name_of(ids: list[bytes]) -> str:
    return hashlib.sha256(b"".join(ids)).hexdigest()


def call_missing(
    chunks: DataFrame,
    factory: Callable[[], Callable[[list[str]], list[str]]],
    path: str,
    batch_size: int,
    callers: int | None = None,
) -> int:
    """Ask for all distinct chunks ``chunk_id, chunk`` that the ledger lacks; gives the number of batches asked for.

    ``callers`` tasks call at the same time, at most; each goes through its share batch by batch, so
    a large share costs no more when its task is lost than a small one. The rows of a batch follow from the
    chunks alone: shares by a hash, in order of the id. Speculative execution would pay twice; leave it off.
    """
    spark = chunks.sparkSession
    open_ledger(path)
    done = answers(spark, path).select("chunk_id")
    missing = materialize(chunks.select("chunk_id", "chunk").join(done, "chunk_id", "left_anti"), "missing-chunks")
    tasks = callers or spark.sparkContext.defaultParallelism

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        system, base = place(path)
        asked = 0
        for group in batches_of(rows, batch_size * GROUP):
            all_ids = group["chunk_id"].to_pylist()
            whole = f"{base}/group-{name_of(all_ids)}.parquet"
            if exists(system, whole):
                continue  # paid for by an earlier attempt of this task
            texts, found, files = group["chunk"].to_pylist(), [], []
            for at in range(0, len(all_ids), batch_size):
                ids = all_ids[at : at + batch_size]
                file = f"{base}/{name_of(ids)}.parquet"
                if exists(system, file):  # paid for by an earlier attempt of this task
                    found.append(pq.read_table(file, filesystem=system, schema=ANSWER_FIELDS, partitioning=None))
                else:
                    model = model or factory()
                    got = model(texts[at : at + batch_size])
                    found.append(pa.table([pa.array(ids, pa.binary()), pa.array(got, pa.string())], schema=ANSWER_FIELDS))
                    commit(system, file, found[-1])
                    asked += 1
                files.append(file)
            if len(files) == GROUP:
                commit(system, whole, pa.concat_tables(found))
                for file in files:
                    system.delete_file(file)
        yield pa.RecordBatch.from_arrays([pa.array([asked], pa.int64())], ["asked"])

    shared = missing.repartition(tasks, "chunk_id").sortWithinPartitions("chunk_id")
    return shared.mapInArrow(run, "asked long").agg(F.sum("asked")).first()[0] or 0
