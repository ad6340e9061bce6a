"""Token ids as binary shards of independent zstandard frames with a trailing seek table.

A shard holds documents in ascending order of doc_id, one frame per document: its ids as
little-endian unsigned 32-bit integers, with zstandard's own content checksum. A skippable
frame with the documents' ids follows, and last the seek table in the public seekable
format of zstandard (sizes and a checksum per frame, then a 9-byte footer), so that a
reader takes the footer, the table and then only the frames it wants.

Shards are written by tasks to the shared folder under names of their own; the manifest, a
Parquet table written once, says which files count. A task that is run again writes another
file, and files that the manifest does not name are never read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .words import WordStore, in_portions, space_words

END = 2
SEEK_MAGIC = 0x8F92EAB1
TABLE_FRAME = 0x184D2A5E
NAMES_FRAME = 0x184D2A50
FRAMES_PER_READ = 8192
MOST_READERS = 20_000
PORTION_CHARS = 1_000_000
MARKS = ".,;:!?"
SHOWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed: stand for themselves in byte-level letters
HIDDEN_BYTES = sorted(set(range(256)) - set(SHOWN_BYTES))
BYTE_LETTERS = {byte: 256 + i for i, byte in enumerate(HIDDEN_BYTES)}
SHOWN_SPACE = chr(BYTE_LETTERS[ord(" ")])
NO_DOC = -(1 << 63)  # stands for a null doc_id in a shard
MANIFEST = "shard int, path string, docs int, ids long"


class Encoder:
    """Whole texts to ids with a model file of the tokenizers library; each different word once.

    Texts that hold one of the model's added tokens, such as an end-of-text marker, are given to
    the library as a whole, so that these get the ids that it gives them.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.bpe = self.model.model
        self.tails: dict[str, list[int]] = {"": []}
        self.store = WordStore(self.tokenize)

    def ids_of(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def tokenize(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The words in another order, their ids and the number of ids of each.

        The library splits a text before letters and after them, so a word of letters with
        marks behind it goes straight to its BPE model, in byte-level letters, which spares
        most of the time; all other words go through the whole of the library's encoding.
        """
        order, ids, rest = [], [], []
        for word in words:
            letters = word.rstrip(MARKS)
            if not letters[1:].isalpha() or not (letters[0] == " " or letters[0].isalpha()):
                rest.append(word)
                continue
            tail = word[len(letters) :]
            if tail not in self.tails:
                self.tails[tail] = self.ids_of([tail])[0]
            ids.append(self.letters(letters) + self.tails[tail])
            order.append(word)
        ids += self.ids_of(rest)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return order + rest, np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def letters(self, word: str) -> list[int]:
        """Ids of a word of letters, perhaps after a space."""
        at = self.store.place.get(word)
        if at is not None:  # known without the marks behind it
            start = self.store.starts[at]
            return self.store.ids[start : start + self.store.lengths[at]].tolist()
        shown = word.replace(" ", SHOWN_SPACE) if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in self.bpe.tokenize(shown)]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; null and empty texts have none."""
        for portion in in_portions(texts, PORTION_CHARS):
            marked = {i for i, text in enumerate(portion) if any(token in text for token in self.added)}
            ids, sizes = self.store.encode([[] if i in marked else space_words(text) for i, text in enumerate(portion)])
            for i, own in enumerate(np.split(ids, np.cumsum(sizes)[:-1])):
                yield np.array(self.ids_of([portion[i]])[0], np.int32) if i in marked else own


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a model file, loaded once per Python worker."""
    return Encoder(path)


def skippable(magic: int, data: bytes) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


def write_shard(out, documents: Iterator[tuple[int | None, np.ndarray]]) -> tuple[int, int]:
    """Write ``(doc_id, ids)`` pairs to the binary file ``out``; gives the number of documents and of ids."""
    packer = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
    names, table, total = [], [], 0
    for doc_id, ids in documents:
        data = ids.astype("<u4").tobytes()
        frame = packer.compress(data)
        out.write(frame)
        table.append(struct.pack("<III", len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        names.append(NO_DOC if doc_id is None else doc_id)
        total += len(ids)
    out.write(skippable(NAMES_FRAME, np.array(names, "<i8").tobytes()))
    footer = struct.pack("<IBI", len(table), 0x80, SEEK_MAGIC)
    out.write(skippable(TABLE_FRAME, b"".join(table) + footer))
    return len(names), total


class ShardReader:
    """Random access to the documents of one shard."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        frames, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError("not a shard with a seek table of checksums")
        at = size - 9 - 12 * frames
        entries = np.frombuffer(file.read_at(12 * frames, at), "<u4").reshape(frames, 3)
        self.packed, self.sizes, self.checks = entries.T.astype(np.int64)
        self.ends = np.cumsum(self.packed)
        self.starts = np.cumsum(self.sizes // 4) - self.sizes // 4
        self.names = np.frombuffer(file.read_at(8 * frames, at - 8 - 8 * frames), "<i8")
        self.unpacker = zstandard.ZstdDecompressor()

    def ids(self, frame: int) -> np.ndarray:
        """The ids of one document; only its frame is read and unpacked, and both checksums are tested."""
        length = int(self.packed[frame])
        data = self.unpacker.decompress(self.file.read_at(length, int(self.ends[frame]) - length))
        if len(data) != self.sizes[frame] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checks[frame]:
            raise ValueError(f"frame {frame} does not match its checksum")
        return np.frombuffer(data, "<u4")


def place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def write_shards(docs: DataFrame, model: str, folder: str | None = None, end: int = END) -> DataFrame:
    """Encode ``doc_id, text`` and write shards; gives the manifest ``shard, path, docs, ids``.

    Shards are ranges of doc_id in ascending order (null first, equal ids by a hash of the text), so shard
    by shard and frame by frame the documents ascend. A null text is an empty one and still
    has the end id. An empty table gives no shard.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = next(batches, None)
        if first is None:
            return
        system, base = place(folder)
        system.create_dir(base, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}.zst"
        coder = encoder(model)

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            batch = first
            while batch is not None:
                texts = batch.column("text").to_pylist()
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(texts), strict=True):
                    yield doc_id, np.append(ids, end)
                batch = next(batches, None)

        with system.open_output_stream(name, compression=None) as out:
            count, total = write_shard(out, documents())
        if count:
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [name], "docs": pa.array([count], pa.int32()), "ids": [total]})

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = ordered.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    return materialize(ordered.mapInArrow(write, MANIFEST), "shards").withColumn(
        "folder", F.lit(folder)
    )


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document from the shards: ``doc_id, start, n_tokens, ids_crc32``.

    The manifest has a row per shard; tasks get ranges of frames, and so a large shard is
    read by many tasks. ``start`` counts the ids of all documents before.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    ranges = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).select(
        "folder", "path", "base",
        F.explode(F.sequence(F.lit(0), F.col("docs") - 1, F.lit(FRAMES_PER_READ))).alias("first"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with place(row["folder"])[0].open_input_file(row["path"]) as file:
                    shard = ShardReader(file)
                    frames = range(row["first"], min(row["first"] + FRAMES_PER_READ, len(shard.sizes)))
                    crcs = [zlib.crc32(shard.ids(i).tobytes()) for i in frames]
                    part = slice(frames.start, frames.stop)
                    names = [None if n == NO_DOC else n for n in shard.names[part].tolist()]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(names, pa.int64()),
                        "start": row["base"] + shard.starts[part],
                        "n_tokens": shard.sizes[part] // 4,
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    })

    # a number of its own, as the rows are too small for Spark to see the work behind them
    reads = manifest.agg(F.sum(F.ceil(F.col("docs") / FRAMES_PER_READ))).first()[0] or 1
    spread = ranges.repartition(min(int(reads), MOST_READERS), "path", "first")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, model: str, folder: str | None = None, end: int = END) -> DataFrame:
    """Write the documents' ids as shards and read every document back from the files."""
    return read_shards(write_shards(docs, model, folder, end))


def fetch(spark: SparkSession, manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ids of chosen documents, ``doc_id, ids``: only shards whose range holds a wanted id are
    opened, and only the wanted frames are unpacked. ``wanted`` has ``doc_id``."""
    shards = manifest.select("folder", "path")

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with place(row["folder"])[0].open_input_file(row["path"]) as file:
                    names = ShardReader(file).names
                yield pa.RecordBatch.from_pydict({"folder": [row["folder"]] * len(names), "path": [row["path"]] * len(names), "frame": np.arange(len(names)), "doc_id": names})

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with place(row["folder"])[0].open_input_file(row["path"]) as file:
                    shard = ShardReader(file)
                    ids = [shard.ids(i).astype(np.int64) for i in row["frames"]]
                yield pa.RecordBatch.from_pydict({"doc_id": shard.names[row["frames"]], "ids": pa.array(ids, pa.list_(pa.int64()))})

    index = shards.mapInArrow(bounds, "folder string, path string, frame long, doc_id long")
    frames = index.join(wanted.select("doc_id").distinct(), "doc_id").groupBy("folder", "path")
    return frames.agg(F.sort_array(F.collect_list("frame")).alias("frames")).mapInArrow(take, "doc_id long, ids array<long>")
