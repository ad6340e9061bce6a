"""Merkle dataset manifest with incremental witnesses.

Every row is a leaf. The leaves of a language are in order of doc_id and are appended, one after
the other, to a list of open subtrees of equal alignment. Two subtrees of one height become
their parent, and this completion extends the witnesses (siblings on the way up) of all
leaves on both sides by one more digest; so every leaf leaves with its witness, and no level is
visited again. Blocks of aligned leaves are appended by different tasks; their roots are
further appends, again in blocks, until one root is left. Witnesses are put together from the
top: a block's own part is extended by that of its root.

A step of a witness is a text: ``L`` or ``R`` and the sibling's digest, by the side it stands on,
or nothing where a node has no sibling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BLOCK = 1024  # leaves or roots of a block, a power of two
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 7


def encoded(value: Column) -> Column:
    """A value as its number of UTF-8 bytes, a colon and its text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256, in hex, of the encoded values in a row."""
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def parent(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class OpenTrees:
    """Aligned subtrees that wait for a sibling, the highest first; each holds the witnesses of its leaves so far."""

    def __init__(self) -> None:
        self.trees: list[tuple[int, str, list[list[str]]]] = []

    def append(self, digest: str) -> None:
        """Append a leaf; completes as many parents as it can."""
        self.trees.append((0, digest, [[]]))
        while len(self.trees) > 1 and self.trees[-1][0] == self.trees[-2][0]:
            self.join()

    def join(self) -> None:
        right_height, right, right_leaves = self.trees.pop()
        height, left, leaves = self.trees.pop()
        for steps in leaves:
            steps.append("R" + right)
        for steps in right_leaves:
            steps.append("L" + left)
        self.trees.append((height + 1, parent(left, right), leaves + right_leaves))

    def lift(self) -> None:
        """Give the last subtree a parent of its own, as it will have no sibling."""
        height, digest, leaves = self.trees.pop()
        for steps in leaves:
            steps.append("")
        self.trees.append((height + 1, parent(digest), leaves))

    def close(self, height: int = 0) -> tuple[str, list[list[str]]]:
        """Root and witnesses when nothing is appended any more and the tree is ``height`` high at least."""
        while len(self.trees) > 1:
            if self.trees[-1][0] < self.trees[-2][0]:
                self.lift()
            else:
                self.join()
        while self.trees[0][0] < height:
            self.lift()
        return self.trees[0][1], self.trees[0][2]


def subtree(digests: Iterable[str], height: int = 0) -> tuple[str, list[list[str]]]:
    """Root and witnesses of leaves that are appended in order."""
    trees = OpenTrees()
    for digest in digests:
        trees.append(digest)
    return trees.close(height)


def numbered(rows: DataFrame, group: str, *by: str) -> DataFrame:
    """Add ``index``, the place of a row in its group in the order of ``by`` (nulls first), and ``size``, the group's rows.

    Rows are range partitioned, so a group that holds most of them is numbered by many tasks. Rows
    that are equal in all of ``by`` take any order.
    """
    order = [F.col(c).asc_nulls_first() for c in (group, *by)]
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "unordered")
    placed = rows.repartitionByRange(*order, "_row").sortWithinPartitions(*order, "_row").drop("_row")
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("_part", F.shiftright("_at", 33).cast("int"))
    parts = placed.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    own = Window.partitionBy(group)  # a row per partition and group
    before = F.coalesce(F.sum("_rows").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = materialize(
        parts.select(
            F.col("_part").alias("_p"), F.col(group).alias("_g"), (F.col("_first") - before).alias("_offset"),
            F.sum("_rows").over(own).alias("size"),
        ),
        "offsets",
    )
    joined = placed.join(parts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn("index", F.col("_at") - F.col("_offset")).drop("_at", "_part", "_p", "_g", "_offset")


def in_blocks(nodes: DataFrame, group: str, block: int) -> DataFrame:
    """Append the nodes ``index, digest, size`` of each group block by block.

    Adds ``steps``, the witness within the block, and to each block's first row its ``root``. A block is as
    high as all others, unless it is its group's only one.
    """

    def append(table: pa.Table) -> pa.Table:
        table = table.sort_by("index").drop_columns(["_block"])
        height = (block - 1).bit_length() if table["size"][0].as_py() > block else 0
        root, steps = subtree(table["digest"].to_pylist(), height)
        table = table.append_column("steps", pa.array(steps, pa.list_(pa.string())))
        return table.append_column("root", pa.array([root] + [None] * (len(steps) - 1), pa.string()))

    schema = ", ".join(f"`{c}` {t}" for c, t in nodes.dtypes)
    grouped = nodes.withColumn("_block", F.expr(f"index DIV {block}")).groupBy(group, "_block")
    return grouped.applyInArrow(append, f"{schema}, steps array<string>, root string")


def climb(nodes: DataFrame, group: str, block: int = BLOCK) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of appends: their tables, the nodes' own first, and ``group, digest`` of each group's root.

    A round has a ``block``-th of the rows of the one before.
    """
    rounds = []
    while True:
        most = nodes.agg(F.max("size")).first()[0] or 0
        done = materialize(in_blocks(nodes, group, block), "blocks")
        rounds.append(done)
        roots = done.filter("root IS NOT NULL")
        if most <= block:
            return rounds, roots.select(group, F.col("root").alias("digest"))
        nodes = roots.select(
            group, F.expr(f"index DIV {block}").alias("index"), F.col("root").alias("digest"),
            F.expr(f"(size + {block - 1}) DIV {block}").alias("size"),
        )


def extended(rounds: list[DataFrame], group: str, tops: DataFrame, block: int = BLOCK) -> DataFrame:
    """The first round's rows with whole witnesses. ``tops`` has ``group, steps`` above the group's root and may have
    more columns, which are added to each row of the group."""
    above = tops.withColumn("index", F.lit(0).cast("long"))
    more = [c for c in tops.columns if c not in (group, "steps")]
    for number, own in reversed(list(enumerate(rounds))):
        upper = above.select(
            F.col(group).alias("_g"), F.col("index").alias("_i"), F.col("steps").alias("_steps"), *more
        )
        own = own.drop("root", "size", *([] if number == 0 else ["digest"]))
        same = F.col(group).eqNullSafe(F.col("_g")) & (F.expr(f"index DIV {block}") == F.col("_i"))
        above = own.join(upper, same).withColumn("steps", F.concat("steps", "_steps")).drop("_g", "_i", "_steps")
    return above


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its witness give."""

    def up(digest: Column, step: Column) -> Column:
        sibling = F.substring(step, 2, 64)
        left, right = F.when(F.startswith(step, F.lit("L")), sibling), F.when(F.startswith(step, F.lit("R")), sibling)
        return F.sha2(F.concat_ws("", left, digest, right).cast("binary"), 256)

    return F.aggregate(steps, leaf, up)


def proof_digest(steps: Column) -> Column:
    """SHA-256 of the siblings of a witness in a row, from the leaf's to the root's children."""
    siblings = F.array_join(F.transform(steps, lambda s: F.substring(s, 2, 64)), "")
    return F.sha2(siblings.cast("binary"), 256)


def tampered_id(doc_id: Column) -> Column:
    """Whether 7 divides the CRC-32 of the id as text; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))


def manifest(docs: DataFrame, group: str = "lang", block: int = BLOCK) -> DataFrame:
    """Leaf, roots and witness of each row: ``doc_id, group, leaf, tampered, steps, subroot, root``.

    ``docs`` has ``doc_id, source, lang, n_chars, text``. Rows of a language are in order of
    doc_id, null first, equal ids by their leaf; languages are in order of their bytes, null
    first. A null field is told from an empty one. ``tampered`` is the leaf with ``n_chars`` one
    higher for the rows that ``tampered_id`` names, null for others. An empty table gives an
    empty manifest. Other columns do not matter.
    """
    fields = [F.col(c) for c in FIELDS]
    higher = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    leaves = docs.select(
        F.col("doc_id").cast("long"), F.col(group).cast("string").alias("_group"), leaf_digest(*fields).alias("digest"),
        F.when(tampered_id(F.col("doc_id")), leaf_digest(*higher)).alias("tampered"),
    )
    rounds, roots = climb(numbered(leaves, "_group", "doc_id", "digest"), "_group", block)
    all_of = roots.withColumn("_all", F.lit(0)).select("_all", "_group", "digest")
    upper_rounds, top = climb(numbered(all_of, "_all", "_group"), "_all", block)
    top = top.select("_all", F.col("digest").alias("root"), F.array().cast("array<string>").alias("steps"))
    subroots = extended(upper_rounds, "_all", top, block)
    subroots = subroots.select("_group", "steps", F.col("digest").alias("subroot"), "root")
    rows = extended(rounds, "_group", subroots, block)
    return rows.select("doc_id", F.col("_group").alias(group), F.col("digest").alias("leaf"), "tampered", "steps", "subroot", "root")


def verified_manifest(docs: DataFrame, group: str = "lang") -> DataFrame:
    """The manifest with each row's proof, the root that its (perhaps tampered) leaf gives, and whether that is the root."""
    rows = manifest(docs, group).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("steps")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
