"""Exact duplicates by composable polynomial fingerprints.

A text's UTF-8 bytes are cut into chunks, whose polynomial hashes are computed in parallel,
each already shifted by the number of bytes that follow it: ``H(ab) = H(a) * r^len(b) + H(b)``.
Their sum modulo a prime is the hash of the whole text, whatever the cut. Two primes below
2^31 and the length make the fingerprint. Texts of equal fingerprints are then compared with
the group's representative chunk by chunk; what differs forms groups of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

CHUNK_BYTES = 1 << 16
MEMBERS_PER_COPY = 256
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_664_525_007, 1_103_515_289)


def power_table(size: int, base: int, prime: int) -> np.ndarray:
    """``base^0 .. base^(size - 1)`` modulo ``prime``."""
    powers = np.ones(size, np.uint64)
    done = 1
    while done < size:
        more = min(done, size - done)
        powers[done : done + more] = powers[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return powers


def chunk_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace ``chunk`` by its two hashes, shifted by the ``after`` bytes that follow it."""
    tables = [power_table(CHUNK_BYTES, b, p) for b, p in zip(BASES, PRIMES, strict=True)]
    for batch in batches:
        after = batch.column("after").to_pylist()
        sums: list[list[int]] = [[], []]
        for chunk, rest in zip(batch.column("chunk").to_pylist(), after, strict=True):
            # bytes count from 1, so leading zero bytes matter
            values = np.frombuffer(chunk, np.uint8)[::-1].astype(np.uint64) + np.uint64(1)
            for k, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
                # products stay below 2^40 and a chunk has 2^16 of them
                own = int(values @ tables[k][: len(values)]) % prime
                sums[k].append(own * pow(base, rest, prime) % prime)
        kept = batch.select(["doc_id", "sha", "bytes", "number"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64())],
            [*kept.schema.names, "h0", "h1"],
        )


def chunks(texts: DataFrame) -> DataFrame:
    """``number, after, chunk`` per chunk of ``data``; an empty text has one empty chunk."""
    pieces = F.greatest(F.ceil(F.col("bytes") / CHUNK_BYTES).cast("int"), F.lit(1))
    cut = F.transform(
        F.sequence(F.lit(0), pieces - 1),
        lambda i: F.struct(
            i.alias("number"),
            F.greatest(F.col("bytes") - (i.cast("long") + 1) * CHUNK_BYTES, F.lit(0)).alias("after"),
            F.substring(F.col("data"), i * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES)).alias("chunk"),
        ),
    )
    others = [c for c in texts.columns if c != "data"]
    return texts.select(*others, F.inline(cut))


def prepared(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.encode(text, "UTF-8").alias("data"))
    return rows.select(
        "doc_id", "data", F.octet_length("data").cast("long").alias("bytes"), F.sha2("data", 256).alias("sha")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``doc_id, text``: ``doc_id, sha, bytes, h0, h1``.

    Rows of one chunk are done when hashed; only those of several are brought together.
    """
    hashed = chunks(prepared(docs)).mapInArrow(
        chunk_hashes, "doc_id long, sha string, bytes long, number int, h0 long, h1 long"
    )
    hashed = materialize(hashed, "chunk-hashes")
    short = hashed.filter(F.col("bytes") <= CHUNK_BYTES).drop("number")
    long = hashed.filter(F.col("bytes") > CHUNK_BYTES)
    # rows repeated as a whole are brought together once and laid out again
    parts = long.groupBy("doc_id", "sha", "bytes", "number").agg(
        F.first("h0").alias("h0"), F.first("h1").alias("h1"), F.count("*").alias("rows")
    )
    whole = parts.groupBy("doc_id", "sha", "bytes").agg(
        *[F.pmod(F.sum(h), F.lit(p)).alias(h) for h, p in zip(("h0", "h1"), PRIMES, strict=True)],
        F.first("rows").cast("int").alias("rows"),
    )
    laid = whole.withColumn("row", F.explode(F.sequence(F.lit(1), "rows")))
    return short.unionByName(laid.select(*short.columns))


def differing(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Compare members with their representative chunk by chunk; gives ``doc_id, sha`` that differ.

    ``groups`` has ``doc_id, sha, h0, h1, bytes, keep_id, keep_sha, members`` for the rows to
    compare. Representatives of large groups are copied once per ``MEMBERS_PER_COPY`` members,
    so that no task compares a whole large group.
    """
    fingerprint = ["h0", "h1", "bytes"]
    copies = F.ceil(F.col("members") / MEMBERS_PER_COPY).cast("int")
    keeps = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha"))
    roles = groups.select(
        F.col("doc_id").alias("id"), F.col("sha").alias("of"), "h0", "h1", keeps.alias("keeps"), copies.alias("copies"),
        F.pmod(F.xxhash64("doc_id"), copies).cast("int").alias("copy"),
    )
    texts = prepared(docs)
    texts = texts.join(roles, texts.doc_id.eqNullSafe(roles.id) & (texts.sha == roles.of)).drop("id", "of")
    texts = materialize(texts.dropDuplicates(["doc_id", "sha"]), "compared")
    key = [*fingerprint, "copy", "number"]
    one = texts.filter("keeps").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    right = chunks(one).select(*key, F.col("chunk").alias("kept_chunk"))
    left = chunks(texts.filter("NOT keeps")).select(*key, "doc_id", "sha", "chunk")
    other = left.join(right, key).filter(F.col("chunk") != F.col("kept_chunk"))
    return other.select("doc_id", "sha").distinct()


def exact_groups(docs: DataFrame) -> DataFrame:
    """Groups of identical texts in ``doc_id, text``, no normalisation; a null text is an empty one.

    Returns one row per row: ``doc_id, keep_id, group_size, kept, text_sha256``. The row with
    the largest doc_id stays (a null doc_id only if there is no other). Of rows that repeat
    both text and doc_id all are marked as kept, as nothing tells them apart. An empty table
    gives an empty result; other columns do not matter.
    """
    rows = materialize(fingerprints(docs), "fingerprints")
    rest = rows.groupBy("doc_id", "sha", "bytes", "h0", "h1").agg(F.count("*").alias("rows"))
    group = ["h0", "h1", "bytes", "round"]
    rest = rest.withColumn("round", F.lit(0))
    settled = []
    number = 0
    while True:
        best = rest.groupBy(*group).agg(
            F.max(F.struct(F.col("doc_id"), F.col("sha"))).alias("keep"), F.sum("rows").alias("members"),
            F.count("*").alias("different"),
        )
        merged = join_group(rest, best, group)
        merged = materialize(merged, "groups")
        to_compare = merged.filter("different > 1")
        wrong = materialize(differing(docs, to_compare), "differing")
        if wrong.isEmpty():
            settled.append(merged)
            break
        # a collision of fingerprints: what differs from its representative is grouped again
        match = merged.doc_id.eqNullSafe(wrong.doc_id) & (merged.sha == wrong.sha)
        number += 1
        settled.append(merged.join(wrong, match, "left_anti"))
        rest = materialize(
            merged.join(wrong, match, "left_semi").select(
                "doc_id", "sha", "bytes", "h0", "h1", "rows", F.lit(number).alias("round")
            ), "again",
        )
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    if len(settled) > 1:
        sizes = found.groupBy(*group).agg(F.sum("rows").alias("members"))
        found = join_group(found.drop("members"), sizes, group)
    return found.select(
        "doc_id", "keep_id", F.col("members").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_row"),
    ).drop("_row")


def join_group(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the groups' columns; Spark splits the rows of a large group by itself (skewed join)."""
    out = rows.join(groups, keys)
    if "keep" in groups.columns:
        out = out.withColumns({"keep_id": F.col("keep.doc_id"), "keep_sha": F.col("keep.sha")}).drop("keep")
    return out
