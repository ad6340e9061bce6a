"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

A text is the set of its runs of five words. Texts of equal sets form one member with a
count. A member's MinHash signature is cut into trees; members sorted by a tree's part of
the signature form a prefix trie, in which similar sets share long prefixes. In each tree a
member's prefix is shortened, from the whole part of the signature, until a neighbour in the
sorted order shares it, but no further than where pairs at the threshold share one in some tree
with the target probability. Members that find no neighbour so far go on in other trees only;
those that share a prefix of at least that length are compared by their exact sets.

Members that share a prefix are compared in blocks, two blocks at a time, so that no task
holds a large group; a pair is compared in the first tree in which it meets. Pairs never
leave a task: what comes out is each member's number of links and edges that span the links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .bits import BitTable
from .grams import WordValues

WORDS = 5
SIMILARITY = 0.8
TREES = 32
DEPTH = 6
DIGIT_BITS = 10  # of a minimum in a tree's key; members that share digits by chance are told apart by their sets
TARGET_RECALL = 0.9999995  # for a pair just at the threshold
BLOCK_ROWS = 256
BLOCK_SHINGLES = 400_000
COLUMNS = 4_096
PLACE = ["tree", "key", "left", "right"]


def depth_for(similarity: float, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> int:
    """The longest prefix at which a pair of that similarity meets in some tree with the target probability."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < target:
        depth -= 1
    return depth


def word_hashes(words: list[str]) -> np.ndarray:
    hashed = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words]
    return np.array(hashed, np.uint64).reshape(-1, 1)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's runs of ``width`` words."""

    def __init__(self, width: int):
        self.width = width
        self.known = WordValues(word_hashes, 1, np.uint64)
        self.factors = np.random.default_rng(5).integers(1, 1 << 62, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, text: str | None) -> np.ndarray:
        """A text of fewer words is one run; a text without words has none."""
        words = (text or "").split()
        if not words:
            return np.zeros(0, np.uint64)
        places = self.known.places(words)  # the table may start anew in that call
        hashes = self.known.values[places, 0]
        width = min(self.width, len(words))
        runs = len(words) - width + 1
        total = np.full(runs, width, np.uint64)
        for i in range(width):
            total = (total ^ hashes[i : i + runs]) * self.factors[i]
            total ^= total >> np.uint64(31)
        return np.unique(total)


def fingerprint(shingles: np.ndarray) -> bytes | None:
    """What stands for a set; none for the empty one."""
    return hashlib.sha256(shingles.tobytes()).digest()[:16] if len(shingles) else None


def tree_keys(shingles: list[np.ndarray], depth: int = DEPTH, trees: int = TREES) -> np.ndarray:
    """Each tree's minima as the digits of one number, one row per set; sets are not empty.

    The numbers sort as the lists of minima would; equal leading digits are a shared prefix.
    """
    rng = np.random.default_rng(11)
    factors = rng.integers(0, 1 << 63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, trees * depth, dtype=np.uint64)
    keys = np.zeros((len(shingles), trees), np.uint64)
    starts = np.cumsum([0, *map(len, shingles[:-1])])
    flat = np.concatenate(shingles)
    for tree in range(trees):
        for i in range(tree * depth, (tree + 1) * depth):
            least = np.minimum.reduceat(flat * factors[i] + shifts[i], starts)
            digit = (least ^ (least >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - DIGIT_BITS)
            keys[:, tree] = keys[:, tree] << np.uint64(DIGIT_BITS) | digit
    return keys.view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, text_hash, same, runs, keys``: the set's fingerprint and size, and its key per tree (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):  # keeps the flat arrays small
                part = batch.slice(begin, 64)
                sets = [shingler.of(t) for t in part.column("text").to_pylist()]
                full = [s for s in sets if len(s)]
                rows = iter(tree_keys(full).tolist() if full else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(list(map(fingerprint, sets)), pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_hash", "same", "runs", "keys"],
                )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), text_hash(text).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, same binary, runs int, keys array<long>")


def text_hash(text: Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def with_neighbours(tries: DataFrame, least: int) -> DataFrame:
    """The rows of ``tree, key, member, …`` that share a prefix of ``least`` digits or more in their tree.

    Rows are sorted tree by tree; one that shares a prefix with any other shares it with the one
    before or after it. Rows at the edges of a partition, whose neighbours are elsewhere, stay. ``shared`` is the
    length of the longest such prefix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last row, whose next neighbour is not known yet
        before = DEPTH  # what it shares with the one before it
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            if len(table) < 2:
                held = table if len(table) else held
                continue
            tree, key = columns_of(table, "tree", "key")
            common = shared_digits(key[:-1], key[1:])
            common[tree[:-1] != tree[1:]] = -1
            shared = np.maximum(np.concatenate([[before], common[:-1]]), common)
            yield from marked(table.slice(0, len(shared)), shared, least)
            held, before = table.slice(len(table) - 1), common[-1]
        if held is not None:
            yield from marked(held, np.array([DEPTH]), least)

    order = ("tree", "key", "member")
    sorted_ = tries.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{c}` {t}" for c, t in tries.dtypes)
    return sorted_.mapInArrow(run, f"{schema}, shared int")


def shared_digits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal leading digits."""
    equal = np.zeros(len(a), np.int64)
    for digits in range(1, DEPTH + 1):
        shift = DIGIT_BITS * (DEPTH - digits)
        equal += (a >> shift) == (b >> shift)
    return equal


def marked(table: pa.Table, shared: np.ndarray, least: int) -> list[pa.RecordBatch]:
    table = table.append_column("shared", pa.array(shared, pa.int32())).filter(pa.array(shared >= least))
    return table.combine_chunks().to_batches()


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``member, rows_of, keys, copies, sets``: adds the hashes themselves to rows with a ``text`` that are to be compared.

    Rows whose text has another set than the member's are left out: an id may have several texts.
    """
    others = ["member", "rows_of", "keys", "copies"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                sets = [shingler.of(t) for t in part.column("text").to_pylist()]
                own = pa.array([fingerprint(s) == m for s, m in zip(sets, part.column("member").to_pylist(), strict=True)], pa.bool_())
                lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.select(others).columns, lists], [*others, "sets"]).filter(own)

    return docs.select(*others, "text").mapInArrow(run, "member binary, rows_of long, keys array<long>, copies long, sets array<long>")


def new_pairs(keys_a: np.ndarray, keys_b: np.ndarray, tree: int) -> np.ndarray:
    """Which pairs share this tree's prefix and none of an earlier tree."""
    new = keys_a[:, tree, None] == keys_b[None, :, tree]
    for earlier in range(tree):
        new &= keys_a[:, earlier, None] != keys_b[None, :, earlier]
    return new


def overlaps(flat: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of common hashes of each set of ``left`` with each of ``right``; ``flat`` holds all sets in a row."""
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    shared = times[column] > 1  # the others are in no overlap
    number = np.cumsum(times > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [begin, begin + COLUMNS]))
        holds = np.zeros((len(sizes), COLUMNS), np.float32)
        holds[row[part], column[part] - begin] = 1
        common += holds[left] @ holds[right].T
    return common.astype(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables of whole groups, each with the groups' bounds; groups are small."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = (pa.concat_tables([rest, table]) if rest is not None else table).combine_chunks()
        if not len(table):
            continue
        change = np.zeros(len(table), bool)
        change[0] = True
        for name in names:
            values = table[name].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        rest = table.slice(starts[-1])
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def sides(blocks: np.ndarray, left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two blocks that are compared."""
    rows = np.flatnonzero(blocks == left)
    return rows, rows if left == right else np.flatnonzero(blocks == right)


def columns_of(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[n].to_numpy() for n in names]


def prefixes(table: pa.Table, depth: int) -> np.ndarray:
    """The first ``depth`` digits of each row's key in each tree."""
    flat = table["keys"].combine_chunks().flatten().to_numpy()
    return flat.reshape(len(table), -1) >> DIGIT_BITS * (DEPTH - depth)


def pairs_here(keys, sizes, rows_a, rows_b, tree: int, same: bool, similarity: float) -> np.ndarray:
    """Pairs of two blocks that first meet in this tree and whose sizes allow the similarity."""
    new = new_pairs(keys[rows_a], keys[rows_b], tree)
    if same:
        new = np.triu(new, 1)
    a, b = sizes[rows_a][:, None], sizes[rows_b][None, :]
    return new & (np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9)


def needed(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows of members that have a pair to compare in their pair of blocks; looks at keys only."""
    for table, bounds in whole_groups(batches, PLACE):
        tree, left, right, block, runs = columns_of(table, "tree", "left", "right", "block", "runs")
        keys = prefixes(table, depth_for(similarity))
        use = np.zeros(len(table), bool)
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            own = slice(begin, end)
            a, b = sides(block[own], left[begin], right[begin])
            if len(a) and len(b):
                same = left[begin] == right[begin]
                new = pairs_here(keys[own], runs[own], a, b, tree[begin], same, similarity)
                use[begin + a[new.any(axis=1)]] = True
                use[begin + b[new.any(axis=0)]] = True
        kept = table.select([*PLACE, "block", "member"]).filter(pa.array(use))
        yield from kept.combine_chunks().to_batches()


def compare(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Links within pairs of blocks: ``member, weight, peer``.

    ``weight`` is the number of documents linked to the member here; ``peer`` is another
    member of the same class, given for all but one member of each class found here.
    """
    for table, bounds in whole_groups(batches, PLACE):
        tree, left, right, block, copies = columns_of(table, "tree", "left", "right", "block", "copies")
        keys = prefixes(table, depth_for(similarity))
        lists = table["sets"].combine_chunks()
        flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        weight = np.zeros(len(table), np.int64)
        parent = np.arange(len(table))

        def root(x: int, parent=parent) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            own = slice(begin, end)
            a, b = sides(block[own], left[begin], right[begin])
            if not (len(a) and len(b)):
                continue
            new = pairs_here(keys[own], sizes[own], a, b, tree[begin], left[begin] == right[begin], similarity)
            if not new.any():
                continue
            common = overlaps(flat[ends[begin] - sizes[begin] : ends[end - 1]], sizes[own], a, b)
            total = sizes[own][a][:, None] + sizes[own][b][None, :] - common
            x, y = np.nonzero(new & (common >= similarity * total - 1e-9))
            x, y = begin + a[x], begin + b[y]
            np.add.at(weight, x, copies[y])
            np.add.at(weight, y, copies[x])
            for one, other in zip(x.tolist(), y.tolist(), strict=True):
                one, other = root(one), root(other)
                if one != other:
                    parent[max(one, other)] = min(one, other)
        found = np.flatnonzero(weight)
        roots = np.array([root(x) for x in found.tolist()], np.int64)
        members = table["member"].combine_chunks()
        peers = members.take(pa.array(roots, mask=roots == found))
        yield pa.RecordBatch.from_arrays(
            [members.take(pa.array(found)), pa.array(weight[found]), peers], ["member", "weight", "peer"]
        )


def in_groups(rows: DataFrame, run, schema: str) -> DataFrame:
    """Bring the rows of each pair of blocks together and run on them."""
    return rows.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(run, schema)


def classes(edges: DataFrame) -> DataFrame:
    """Connected components of ``a, b`` (binary): ``member, root`` with the smallest member as root.

    Large stars and small stars in turn until nothing changes; every round is written out.
    A hub's neighbours are handled by grouped minima, so no group is held in one task.
    """
    both = edges.select("a", "b").filter("a <> b")
    both = materialize(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    labels = labels.withColumnRenamed("a", "member")
    while True:
        # the smallest label among the neighbours, then the label of that label
        near = both.join(labels.withColumnRenamed("member", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "member"), "member").select(
            "member", F.col("root").alias("old"), F.least("root", "near").alias("via")
        )
        jump = labels.select(F.col("member").alias("via"), F.col("root").alias("next"))
        step = step.join(jump, "via", "left").select("member", "old", F.least("via", F.coalesce("next", "via")).alias("root"))
        step = materialize(step, "labels")
        labels = step.select("member", "root")
        if step.filter("root <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """Join ``doc_id, text`` with itself on the Jaccard similarity of runs of ``words`` words.

    Returns one row per row: ``doc_id, class_id, links, class_size``. ``links`` is the number
    of other documents with at least ``similarity``, ``class_id`` the smallest doc_id of the
    documents connected by links, and ``class_size`` their number. A text of fewer words is
    one run; null texts and texts without words have no links and a class each. Rows with
    equal texts are links of each other, whatever their ids. Other columns do not matter.
    """
    return labelled(docs, similarity, words).drop("text_hash", "same")


def labelled(docs: DataFrame, similarity: float, words: int) -> DataFrame:
    """As ``near_duplicates``, with ``text_hash`` and the fingerprint ``same``."""
    rows = materialize(signatures(docs, words), "signatures")
    members = rows.filter("same IS NOT NULL").groupBy("same").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least_id"), F.first("runs").alias("runs"), F.first("keys").alias("keys")
    )
    members = materialize(members.withColumnRenamed("same", "member"), "members")
    tries = members.select("member", "runs", F.posexplode("keys").alias("tree", "key"))
    depth = depth_for(similarity)
    tries = with_neighbours(tries, depth).withColumn("key", F.shiftright("key", DIGIT_BITS * (DEPTH - depth)))
    tries = materialize(tries, "prefixes")
    shared = tries.groupBy("tree", "key").agg(F.count("*").alias("n"), F.sum(F.col("runs").cast("long")).alias("total"))
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    shared = shared.filter("n > 1").select("tree", "key", parts.alias("parts"))
    grouped = tries.join(shared, ["tree", "key"]).withColumn("block", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int"))
    grouped = materialize(grouped, "tries")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    paired = grouped.select("tree", "key", "member", "block", every.alias("other")).select(
        "tree", "key", "member", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )
    keyed = paired.join(members.select("member", "keys", "runs"), "member")
    place = "tree int, key long, left int, right int, block int, member binary"
    found = in_groups(keyed, lambda batches: needed(batches, similarity), place)
    found = materialize(found, "candidates")
    compared = found.select("member").distinct().join(members.select("member", "least_id", "keys", "copies"), "member")
    # any document of the member has its set; that of the smallest id is looked up, which may be
    # several rows, some of them with other texts; only then sets are brought together for one of them
    wanted = rows.select("doc_id", "same").join(compared, F.col("same") == F.col("member"))
    wanted = wanted.filter(F.col("doc_id").eqNullSafe(F.col("least_id"))).groupBy("member").agg(
        F.first("doc_id").alias("_id"), F.count("*").alias("rows_of"), F.first("keys").alias("keys"), F.first("copies").alias("copies")
    )
    wanted = materialize(wanted, "wanted")
    # most texts are not wanted and are not shuffled
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    there = BitTable(wanted.select(F.xxhash64("_id").alias("key")), wanted.count())
    texts = there.holds(texts, F.xxhash64("doc_id"))
    sets = shingle_sets(texts.join(wanted, texts.doc_id.eqNullSafe(wanted["_id"])), words)
    sets = materialize(sets, "sets")
    sets = sets.filter("rows_of = 1").unionByName(sets.filter("rows_of > 1").dropDuplicates(["member"])).drop("rows_of")
    compared = found.join(sets, "member")
    links = in_groups(compared, lambda batches: compare(batches, similarity), "member binary, weight long, peer binary")
    links = materialize(links, "links")
    roots = classes(links.filter("peer IS NOT NULL").select(F.col("member").alias("a"), F.col("peer").alias("b")))
    counts = links.groupBy("member").agg(F.sum("weight").alias("weight"))
    named = members.select("member", "copies", "least_id").join(roots, "member", "left").join(counts, "member", "left")
    named = named.withColumn("root", F.coalesce("root", "member"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size"))
    named = named.join(ids, "root").select(
        F.col("member").alias("same"), "class_id", "class_size",
        (F.coalesce("weight", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    return rows.join(named, "same", "left").select(
        "doc_id", "text_hash", "same", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each class: of its smallest doc_id (null first), then by a hash of the text.

    Documents without words stay. Of rows that are alike in id and text any one stays. Texts are
    shuffled only for rows that may go, by a table of bits of their ids and texts.
    """
    rows = labelled(docs, similarity, words).filter("same IS NOT NULL")
    per_row = rows.groupBy("class_id", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    place = F.struct("doc_id", "text_hash")
    firsts = per_row.groupBy("class_id").agg(F.min(place).alias("first"))
    named = per_row.join(firsts.withColumnRenamed("class_id", "_class"), F.col("class_id").eqNullSafe(F.col("_class")))
    stays = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash"))
    named = named.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_of"), stays.alias("_stays"), F.col("n").alias("_n"))
    some = materialize(named.filter("_n > 1 OR NOT _stays"), "near-rows")
    there = BitTable(some.select(F.xxhash64("_id", "_of").alias("key")), some.count())
    hashed = docs.withColumn("_hash", text_hash(F.col("text").cast("string")))
    row_key = F.xxhash64(F.col("doc_id").cast("long"), "_hash")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of"))
    joined = there.holds(hashed, row_key).join(some, same, "left")
    once = joined.filter("_stays AND _n > 1").dropDuplicates(["doc_id", "_hash"])
    kept = joined.filter("_stays IS NULL").unionByName(once).drop("_id", "_of", "_stays", "_n")
    return there.lacks(hashed, row_key).unionByName(kept).drop("_hash")
