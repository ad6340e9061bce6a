"""A stored trigram index of report texts, for searches that are asked again and again.

Folders of an index: ``versions`` (key, n, n_unique), ``texts`` (the different texts of each key with a
number, in folders), ``postings`` (a trigram and the numbers of the texts of one block that have it), sorted and split by
range, and ``trigrams`` (how many texts have it). A search reads the few row groups of its rarest trigrams, then
the folders of texts that have them all, and verifies those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scan import let
from ..session import materialize
from .compare import multi_version, version_index

GRAM = 3
PROBES = 4  # rarest trigrams of a query that are looked up
TEXT_PARTS = 64  # folders of texts; more for larger tables
BLOCK_BYTES = 1 << 22  # of texts whose postings are made together; a longer text is a block of its own
BLOCK_SPAN = 1 << 15  # numbers of a block: their offsets are short
CODE_POINTS = 0x110000
FOLDERS = {
    "texts": "key string, text string, number long, part int",
    "postings": "trigram string, part int, first long, offsets array<smallint>",
    "trigrams": "trigram string, n long",
    "versions": "key string, n long, n_unique long",
}


def stored(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """A folder of the index; one without rows may have no file."""
    return spark.read.schema(FOLDERS[folder]).parquet(f"{path.rstrip('/')}/{folder}")


def trigrams(text: Column) -> Column:
    """The different runs of three characters of a lower-case text; a shorter or null text has none."""
    characters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))

    def runs(c: Column) -> Column:
        places = F.when(F.size(c) >= GRAM, F.sequence(F.lit(0), F.size(c) - GRAM)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(places, lambda i: F.concat(*[F.get(c, i + j) for j in range(GRAM)])))

    return let(characters, runs)


def write_text_index(records: DataFrame, path: str, key: str = "report_key", text: str = "text", parts: int = TEXT_PARTS) -> None:
    """Write the index of all reports with a key; a null text counts as empty.

    Texts are told apart by key and SHA-256 and numbered where they are written, so the texts are shuffled
    once. A posting is a trigram with all texts of a block that have it, as short offsets from the block's first number;
    a trigram that most texts have is many pieces, one a block.
    """
    base = path.rstrip("/")
    spark = records.sparkSession
    version_index(records, key, text).withColumnRenamed(key, "key").write.parquet(f"{base}/versions")
    body = F.coalesce(F.col(text), F.lit(""))
    different = (
        records.filter(F.col(key).isNotNull())
        .select(F.col(key).cast("string").alias("key"), F.lower(body).alias("text"))
        .groupBy("key", F.unhex(F.sha2("text", 256)).alias("version"))
        .agg(F.first("text").alias("text"))
        .select("key", "text", F.monotonically_increasing_id().alias("number"), F.pmod(F.spark_partition_id(), F.lit(parts)).alias("part"))
    )
    different.write.partitionBy("part").parquet(f"{base}/texts")
    texts = stored(spark, base, "texts").select(F.col("text").cast("binary").alias("text"), "number", "part")
    # written before they are split by range: the sample of the ranges would make them once more
    postings = materialize(texts.mapInArrow(postings_of_blocks, FOLDERS["postings"]), "postings")
    order = ["trigram", "part", "first"]
    postings.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{base}/postings")
    counts = stored(spark, base, "postings").groupBy("trigram").agg(F.sum(F.size("offsets")).alias("n"))
    counts.repartitionByRange("trigram").sortWithinPartitions("trigram").write.parquet(f"{base}/trigrams")


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of texts in pieces of one part, with numbers close together and of bounded size."""
    part, number, size = batch["part"].to_numpy(), batch["number"].to_numpy(), pc.binary_length(batch["text"]).to_numpy()
    begin = held = 0
    for at in range(batch.num_rows):
        close = part[at] == part[begin] and 0 <= number[at] - number[begin] < BLOCK_SPAN
        if at > begin and not (close and held + size[at] <= BLOCK_BYTES):
            yield batch.slice(begin, at - begin)
            begin, held = at, 0
        held += size[at]
    if batch.num_rows:
        yield batch.slice(begin)


def postings_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(trigram, part, first, offsets)`` of batches of ``(text, number, part)``, texts in UTF-8."""
    names = ["trigram", "part", "first", "offsets"]
    for batch in batches:
        for block in blocks(batch):
            number = block["number"].to_numpy()
            part, first = block["part"][0].as_py(), int(number[0])
            for found, starts, of in texts_by_trigram(block["text"].to_pylist(), (number - first).astype(np.int16)):
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(of, pa.int16()))
                columns = [pa.array(found, pa.string()), pa.array(np.full(len(found), part, np.int32)), pa.array(np.full(len(found), first, np.int64)), lists]
                yield pa.RecordBatch.from_arrays(columns, names)


def texts_by_trigram(texts: list[bytes], labels: np.ndarray) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """The different trigrams of some texts, where each one's labels start, and the labels of its texts.

    Trigram and text are one number, by which all are sorted at once. Texts whose alphabet is too large for that are halved;
    three characters of any alphabet and one text always fit.
    """
    split = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for t in texts]
    chars = np.concatenate(split)
    seen = np.zeros(CODE_POINTS, bool)
    seen[chars] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    size, bits = len(alphabet), (len(texts) - 1).bit_length()
    if size**GRAM << bits >= 1 << 63:
        middle = len(texts) // 2
        yield from texts_by_trigram(texts[:middle], labels[:middle])
        yield from texts_by_trigram(texts[middle:], labels[middle:])
        return
    rank = (np.cumsum(seen) - 1)[chars]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
    codes = (rank[:-2] * size + rank[1:-1]) * size + rank[2:]
    inside = owner[:-2] == owner[2:]
    keys = np.sort((codes[inside] << bits) | owner[:-2][inside])
    keys = keys[np.diff(keys, prepend=-1) != 0]
    codes, owner = keys >> bits, keys & ((1 << bits) - 1)
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    codes = codes[starts]
    runs = alphabet[np.stack([codes // (size * size), codes // size % size, codes % size], axis=1)].tobytes().decode("utf-32-le") if size else ""
    yield [runs[i : i + GRAM] for i in range(0, len(runs), GRAM)], np.append(starts, len(keys)), labels[owner]


def rarest(spark: SparkSession, path: str, query: str) -> list[str] | None:
    """The rarest trigrams of a query, or None if no text has one of them."""
    asked = sorted({query[i : i + GRAM] for i in range(len(query) - GRAM + 1)})
    counts = stored(spark, path, "trigrams").filter(F.col("trigram").isin(asked))
    found = sorted((r.n, r.trigram) for r in counts.collect())  # no more than the query has characters
    return None if len(found) < len(asked) else [trigram for _, trigram in found[:PROBES]]


def text_hits(spark: SparkSession, path: str, query: str) -> DataFrame:
    """``(key)`` of the reports of which a text holds ``query``, in any case.

    A query of less than three characters reads all texts.
    """
    wanted = query.lower()
    texts = stored(spark, path, "texts")
    if len(wanted) >= GRAM:
        probes = rarest(spark, path, wanted)
        if probes is None:
            return texts.select("key").limit(0)
        postings = stored(spark, path, "postings").filter(F.col("trigram").isin(probes)).select("trigram", "part", "first", F.explode("offsets").alias("offset"))
        postings = postings.select("trigram", "part", (F.col("first") + F.col("offset")).alias("number"))
        candidates = postings.groupBy("part", "number").agg(F.countDistinct("trigram").alias("n")).filter(F.col("n") == len(probes))
        texts = texts.join(candidates.select("part", "number"), ["part", "number"], "left_semi")
    return texts.filter(F.contains("text", F.lit(wanted))).select("key").distinct()


def search_indexed(spark: SparkSession, path: str, query: str, min_unique: int | None = None, key: str = "report_key") -> DataFrame:
    """What ``search_reports`` finds, from a stored index: ``(key, n, n_unique)``."""
    listed = multi_version(stored(spark, path, "versions"), min_unique)
    by_key = listed.filter(F.col("key").rlike(f"(?iu){query}"))
    found = by_key if by_key.head(1) else listed.join(text_hits(spark, path, query), "key", "left_semi")
    return found.withColumnRenamed("key", key)
