"""Nearest neighbours with hash-prefix forests.

Vectors are dealt into blocks. Each block has a forest: per tree the vectors' long hash
strings (signs of random projections, one bit each) as a sorted array. A query descends
every tree to its longest matching prefix, then all trees ascend together, one bit at a
time, so that ever more vectors share the prefix, until enough candidates are found.
Candidates are compared exactly, and the blocks' best are merged.

Queries meet the vectors block by block; only each block's best per query leave a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

TREES = 48
BITS = 48
BLOCK_ROWS = 8_192
QUERY_ROWS = 8_192
SAMPLE_ROWS = 4_096  # rows of the sample that the candidate share is fitted on, at most
SAMPLE_QUERIES = 128
TARGET_RECALL = 0.96
FOUND = "query long, query_id long, vec_id long, score double"


def usable(vectors: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    value = vectors.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def planes(dimensions: int) -> np.ndarray:
    """Fixed random directions, ``BITS`` for each tree."""
    return np.random.default_rng(20_011).standard_normal((dimensions, TREES * BITS))


class Forest:
    """Sorted hash strings of one block's vectors, per tree."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.center = vectors.mean(axis=0)
        keys = self.hashes(vectors)
        self.order = np.argsort(keys, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(keys, self.order, axis=0)
        self.squares = (vectors**2).sum(axis=1)

    def hashes(self, vectors: np.ndarray) -> np.ndarray:
        """One integer of ``BITS`` bits per vector and tree."""
        out = np.empty((len(vectors), TREES), np.int64)
        places = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        directions = planes(vectors.shape[1])
        for tree in range(TREES):
            signs = (vectors - self.center) @ directions[:, tree * BITS : (tree + 1) * BITS] > 0
            out[:, tree] = signs @ places
        return out

    def spans(self, keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree the slice of vectors that share a prefix of ``length`` bits."""
        low = keys >> (BITS - length) << (BITS - length)
        high = low + (1 << (BITS - length))
        first, last = np.empty(keys.shape, np.int64), np.empty(keys.shape, np.int64)
        for tree in range(TREES):
            first[:, tree] = np.searchsorted(self.sorted[:, tree], low[:, tree])
            last[:, tree] = np.searchsorted(self.sorted[:, tree], high[:, tree])
        return first, last

    def candidates(self, queries: np.ndarray, wanted: int):
        """Per query the vectors found when at least ``wanted`` of the block (or all of it) are reached."""
        keys = self.hashes(queries)
        wanted = min(wanted, len(self.vectors))
        seen = np.zeros((len(queries), len(self.vectors)), bool)
        open_ = np.arange(len(queries))
        for length in range(BITS, -1, -1):  # descended to the longest prefix, all trees ascend together
            first, last = self.spans(keys[open_], length)
            enough = []
            for row, query in enumerate(open_):
                if (last[row] - first[row]).sum() < wanted:
                    continue  # not even with all different
                mark = seen[query]
                for tree in range(TREES):
                    mark[self.order[first[row, tree] : last[row, tree], tree]] = True
                if np.count_nonzero(mark) >= wanted:
                    enough.append(row)
            open_ = np.delete(open_, enough)
            if not len(open_):
                break
        return seen

    def search(self, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, wanted: int, k: int):
        """``(number of the query, vec_id, distance)`` of the ``k`` best candidates of each query, its own row excluded."""
        found = []
        for begin in range(0, len(queries), 512):
            part = slice(begin, begin + 512)
            seen = self.candidates(queries[part], wanted)
            for row, (query, own) in enumerate(zip(queries[part], query_rows[part], strict=True)):
                at = np.flatnonzero(seen[row] & (rows != own))
                rough = self.squares[at] - 2 * (self.vectors[at] @ query)
                if len(at) > 4 * k:  # exact distances for the best by the rounded ones, ties included
                    limit = np.partition(rough, 2 * k)[2 * k]
                    at = at[rough <= limit + 1e-9 * (abs(limit) + query @ query)]
                exact = np.sqrt(((self.vectors[at] - query) ** 2).sum(axis=1))
                best = np.lexsort((ids[at], exact))[:k]
                found.append((np.full(len(best), begin + row), ids[at][best], exact[best]))
        return [np.concatenate(x) for x in zip(*found, strict=True)]


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = chunk.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def fitted_share(sample: np.ndarray, k: int) -> float:
    """The share of a block that has to be candidates for the target recall, measured on ``sample``
    against all distances. Small samples and unclear cases give 1: everything is compared."""
    if len(sample) < 50 * k:
        return 1.0
    queries = sample[:SAMPLE_QUERIES]
    forest = Forest(sample)
    distance = ((queries**2).sum(1)[:, None] - 2 * queries @ sample.T) + forest.squares
    nearest = np.argsort(distance, axis=1)[:, : k + 1]
    for share in np.arange(0.05, 1.0, 0.05):
        seen = forest.candidates(queries, math.ceil(share * len(sample)))
        if np.take_along_axis(seen, nearest, axis=1).mean() >= TARGET_RECALL:
            return float(share)
    return 1.0


def prepare(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, vector, dims`` of the rows that take part, ``row`` being a number of their own; written once.

    Several rows may share a vec_id. Rows with a null vec_id cannot be named in a result and take no part.
    """
    value = F.col("embedding").cast("array<double>")
    kept = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    return kept.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), value.alias("vector"), F.size(value).alias("dims")
    )


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The ``k`` nearest vectors found for each row whose vec_id is divisible by ``every``.

    ``vectors`` has ``vec_id, embedding``; the result has ``query_id, rank, vec_id, score``,
    with exact Euclidean distances and ties to the smaller vec_id. Vectors of other lengths
    than the query's are no candidates. Every row but the query's own is a candidate, also one of the
    same vec_id; each row of an id that is asked for is a query. Of identical vectors only the
    ``k + 1`` smallest ids can be in a result, so only those are indexed. Other columns do not matter.
    """
    rows = materialize(prepare(vectors), "vectors")
    same = Window.partitionBy("dims", "vector").orderBy("vec_id", "row")
    indexed = rows.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).drop("copy")
    indexed = materialize(indexed, "indexed")
    counts = {r["dims"]: r["count"] for r in indexed.groupBy("dims").count().collect()}  # few lengths
    asked = materialize(rows.filter(F.col("vec_id") % every == 0), "queries")
    asking = {r["dims"]: r["count"] for r in asked.groupBy("dims").count().collect()}
    best = []
    for dims in sorted(asking):
        own = indexed.filter(F.col("dims") == dims)
        ordered = own.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE_ROWS)  # bounded sample
        share = fitted_share(np.array([r["vector"] for r in ordered.select("vector").collect()]), k)
        blocks = max(1, math.ceil(counts[dims] / BLOCK_ROWS))
        parts = max(1, math.ceil(asking[dims] / QUERY_ROWS))
        best.append(in_blocks(own, asked.filter(F.col("dims") == dims), blocks, parts, share, k))
    if not best:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    found = best[0]
    for more in best[1:]:
        found = found.unionByName(more)
    ranked = Window.partitionBy("query").orderBy("score", "vec_id")
    found = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def in_blocks(own: DataFrame, asked: DataFrame, blocks: int, parts: int, share: float, k: int) -> DataFrame:
    """Best ``k`` per query and block. A task holds one block of vectors and one part of the queries."""
    block = F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("vec_id", "row", F.lit(1)), F.lit(parts)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = own.select(block.alias("block"), every(parts).alias("part"), "row", "vec_id", "vector")
    right = asked.select(every(blocks).alias("block"), part.alias("part"), "row", "vec_id", "vector")

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(vectors) and len(queries):
            forest = Forest(matrix(vectors["vector"]))
            wanted = max(math.ceil(share * len(vectors)), k + 1)
            asked_rows = queries["row"].to_numpy()
            at, *found = forest.search(vectors["vec_id"].to_numpy(), vectors["row"].to_numpy(), matrix(queries["vector"]), asked_rows, wanted, k)
            out = [asked_rows[at], queries["vec_id"].to_numpy()[at], *found]
        return pa.table(dict(zip(("query", "query_id", "vec_id", "score"), out, strict=True)))

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(search, FOUND)
