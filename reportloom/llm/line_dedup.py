"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

A line is cut into ``threshold + 1`` segments. Two lines within ``threshold`` edits share at
least one segment, at places that the length difference and the segment's number bound; so a
line probes the index of each admissible length with few substrings. Lines that meet are
compared by a banded bit-parallel automaton: one bit per diagonal of the band, one word per
number of edits.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import let
from ..session import materialize
from .bits import BitTable, or_bits

#: Thresholds that grow with the line, by the length they hold from: a replaced word is within them.
#: Shorter lines are duplicates only when they are equal.
BY_LENGTH = ((24, 2), (36, 3), (48, 4), (60, 5), (72, 6))
KEY_CHARS = 32
ROUNDS = 2  # in which each line is compared with its most alike earlier line, before all that is left
STEPS = 16  # characters after which a comparison may end early
LONGEST_BITS = 30
INDEX, PROBE = 1, 2
LETTERS = "etaoinsrhldcumfpgwybvk "  # counted, and all others together


def band_of(chars: Column, classes: tuple[tuple[int, int], ...]) -> Column:
    """The least length of a line's band: the three highest binary digits of its length, or the least of its class."""
    digits = F.greatest(F.length(F.bin(chars)) - 3, F.lit(0))
    first = F.lit(classes[0][0])
    for least, _ in classes[1:]:
        first = F.when(chars >= least, least).otherwise(first)
    return F.greatest(F.call_function("shiftleft", F.call_function("shiftright", chars, digits), digits), first)


def segments(lines: DataFrame, classes: tuple[tuple[int, int], ...]) -> DataFrame:
    """Add ``keys`` to ``chars, wide``: the segments of a line, by which it is indexed; null for lines left out.

    A line of a class with threshold ``t`` has ``t + 1`` segments, at the same places in all lines of a band: they
    cover as many characters as its shortest line has. A key holds the segment's number, the band and the segment,
    of a long one its first ``KEY_CHARS`` characters: equal segments have equal keys.
    """
    lines = lines.withColumn("_band", band_of(F.col("chars"), classes))
    lines = lines.withColumn("_parts", threshold_of(F.col("_band"), classes) + 1)

    def key(i: Column) -> Column:
        start, size = place_of(i, F.col("_band"), F.col("_parts"))
        return F.xxhash64(i, "_band", cut("wide", start, size))

    keys = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), key)
    return lines.withColumn("keys", F.when(F.col("chars") >= classes[0][0], keys)).drop("_band", "_parts")


def probes(lines: DataFrame, classes: tuple[tuple[int, int], ...]) -> DataFrame:
    """``key, line_key, chars``: the substrings by which a line can meet the segments of a line that is as long or
    shorter, but for its own segments.

    A pair's threshold is that of its shorter line, so a line probes the bands of all lengths it may meet. Of a pair
    within ``t`` edits take the first segment ``i`` up to whose end the shorter line has ``i`` edits at most: it has
    ``i`` before and none in it, so it is found in the longer line, moved by ``i`` at most. To the left it is moved by
    deletions, which as many later insertions have to make good: by ``t - i`` at most.

    Each segment's surroundings are cut out first, so that its places, of which there are many, copy little.
    """
    most, chars = classes[-1][1], F.col("chars")
    moves = []
    for _, threshold in classes:
        for i in range(threshold + 1):
            places = ", ".join(str(shift) for shift in range(-min(i, threshold - i), i + 1))
            moves.append(f"WHEN parts = {threshold + 1} AND i = {i} THEN array({places})")
    # a band of long lines is wider than any threshold: they probe their own and the one before at most
    lengths = F.filter(F.sequence(F.greatest(chars - most, F.lit(classes[0][0])), chars), lambda other: chars - other <= threshold_of(other, classes))
    bands = F.when(chars >= max(2 * classes[-1][0], 16 * most), F.array(band_of(chars, classes), band_of(chars - most, classes)))
    bands = F.array_distinct(bands.otherwise(F.transform(lengths, lambda other: band_of(other, classes))))
    of_band = lambda band: F.struct(band.alias("band"), (threshold_of(band, classes) + 1).alias("parts"))

    def piece(of: Column, i: Column) -> Column:
        start, size = place_of(i, of["band"], of["parts"])
        left = F.greatest(start - most, F.lit(0))
        around = F.substring(F.col("wide"), left * 4 + 1, (F.least(size, F.lit(KEY_CHARS)) + 2 * most) * 4)
        return F.struct(i.alias("i"), of["band"].alias("band"), of["parts"].alias("parts"), left.alias("left"), around.alias("around"))

    pieces = lambda of: F.transform(F.sequence(F.lit(0), of["parts"] - 1), lambda i: piece(of, i))
    rows = lines.select("line_key", "chars", "wide", band_of(chars, classes).alias("own"), F.transform(bands, of_band).alias("bands"))
    rows = rows.select("line_key", "chars", "own", F.inline(F.flatten(F.transform("bands", pieces))))
    rows = rows.select("*", F.explode(F.expr(f"CASE {' '.join(moves)} END")).alias("shift"))
    start, size = place_of(F.col("i"), F.col("band"), F.col("parts"))
    at = start + F.col("shift")
    rows = rows.filter(((F.col("shift") != 0) | (F.col("band") != F.col("own"))) & (at >= 0) & (at + size <= chars))
    return rows.select(F.xxhash64("i", "band", cut("around", at - F.col("left"), size)).alias("key"), "line_key", "chars")


def place_of(i: Column, length: Column, parts: Column) -> tuple[Column, Column]:
    """Start and size of a segment."""
    start, end = F.floor(length * i / parts).cast("int"), F.floor(length * (i + 1) / parts).cast("int")
    return start, end - start


def cut(wide: str, at: Column, size: Column) -> Column:
    """Characters of a column that has four bytes for each: cut out without counting those before."""
    return F.substring(wide, at * 4 + 1, F.least(size, F.lit(KEY_CHARS)) * 4)


def threshold_of(length: Column, classes: tuple[tuple[int, int], ...]) -> Column:
    """The threshold of the class of a length."""
    out = F.lit(classes[0][1])
    for least, threshold in classes[1:]:
        out = F.when(length >= least, threshold).otherwise(out)
    return out


def letter_counts(line: Column, chars: Column) -> Column:
    """How often each of ``LETTERS`` and any other character occurs, 255 at most: the counts, eight to a number, and their sum."""
    found = F.array(*[F.octet_length(line) - F.octet_length(F.replace(line, F.lit(x), F.lit(""))) for x in LETTERS])  # of one byte each

    def packed(counts: Column) -> Column:
        capped = F.transform(counts, lambda n: F.least(n, F.lit(255)).cast("long"))
        return let(capped, lambda all_: F.struct(
            *[reduce(or_bits, [F.shiftleft(all_[i], 8 * (i % 8)) for i in range(k, k + 8)]).alias(f"n{k // 8}") for k in range(0, len(LETTERS) + 1, 8)],
            F.aggregate(all_, F.lit(0).cast("long"), lambda total, n: total + n).alias("total"),
        ))

    others = lambda counts: chars - F.aggregate(counts, F.lit(0), lambda total, n: total + n)
    return let(let(found, lambda counts: F.concat(counts, F.array(others(counts)))), packed)


def counts_apart(a: str, b: str) -> Column:
    """Twice a lower bound of the edit distance of two rows' lines.

    An edit adds one to the characters of ``b`` that ``a`` lacks, to those of ``a`` that ``b`` lacks, or to
    both; the larger of the two is half of their sum and of their difference.
    """
    byte = lambda side, i: F.shiftright(F.col(f"{side}.n{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(255).cast("long"))
    apart = reduce(add, [F.abs(byte(a, i) - byte(b, i)) for i in range(len(LETTERS) + 1)])
    return apart + F.abs(F.col(f"{a}.total") - F.col(f"{b}.total"))


def within(a: Column, b: Column, threshold: int) -> Column:
    """Whether two strings are within ``threshold`` edits (insertion, deletion, substitution).

    Bit ``d`` of word ``e`` says that with ``e`` edits the read part of ``b`` matches a part of
    ``a`` that ends ``d - threshold`` characters further on. Diagonals beyond the band cannot
    end within the threshold.
    """
    word = lambda e: f"e{e}"
    mask = (1 << (2 * threshold + 1)) - 1
    first = F.struct(*[
        F.lit(sum(1 << (threshold + d) for d in range(e + 1))).cast("long").alias(word(e)) for e in range(threshold + 1)
    ])

    def same(chars: Column, at: Column) -> Column:
        """Bit ``d``: the character ``d - threshold`` places further on in ``a`` is that of ``b``."""
        return let(F.get(chars["b"], at), lambda char: reduce(or_bits, [
            F.when(F.get(chars["a"], at + (d - threshold)) == char, F.lit(1 << d)).otherwise(F.lit(0)) for d in range(2 * threshold + 1)
        ]).cast("long"))

    def read(words: Column, same: Column) -> Column:
        new: list[Column] = []
        for e in range(threshold + 1):
            value = words[word(e)].bitwiseAND(same)
            if e:
                less = words[word(e - 1)]
                value = reduce(or_bits, [value, less, F.shiftright(less, 1), F.shiftleft(new[-1], 1)])
            new.append(value.bitwiseAND(F.lit(mask).cast("long")))
        return F.struct(*[v.alias(word(e)) for e, v in enumerate(new)])

    def rest(chars: Column) -> Column:
        """The last state, block by block of ``b``; a state without bits stays so and is not computed on."""
        length = F.size(chars["b"])

        def block(words: Column, begin: Column) -> Column:
            places = F.sequence(begin, F.least(begin + (STEPS - 1), length - 1))
            return F.when(words[word(threshold)] == 0, words).otherwise(F.aggregate(F.transform(places, lambda at: same(chars, at)), words, read))

        begins = F.when(length > 0, F.sequence(F.lit(0), length - 1, F.lit(STEPS))).otherwise(F.array().cast("array<int>"))
        words = F.aggregate(begins, first, block)
        return F.call_function("shiftright", words[word(threshold)], F.size(chars["a"]) - length + threshold).bitwiseAND(F.lit(1).cast("long")) == 1

    # characters are bound once, not split again at each of them
    chars = lambda both: F.struct(F.split(both["a"], "").alias("a"), F.split(both["b"], "").alias("b"))
    reached = let(let(without_common_ends(a, b), chars), rest)
    return (F.abs(F.char_length(a) - F.char_length(b)) <= threshold) & reached


def without_common_ends(a: Column, b: Column) -> Column:
    """Two strings without their common beginning and then their common end, as ``struct<a,b>``: the distance stays."""

    def common(x: Column, y: Column) -> Column:
        """Number of equal characters at the beginning, by halving steps."""
        least = F.least(F.char_length(x), F.char_length(y))
        steps = F.array(*[F.lit(1 << k) for k in range(LONGEST_BITS, -1, -1)])

        def step(found: Column, by: Column) -> Column:
            same = F.substring(x, found + 1, by) == F.substring(y, found + 1, by)
            return F.when((found + by <= least) & same, found + by).otherwise(found)

        return F.aggregate(steps, F.lit(0), step)

    def cut(both: Column) -> Column:
        tail = lambda x, n: F.substring(x, n + 1, F.char_length(x))
        return let(common(both["a"], both["b"]), lambda n: F.struct(tail(both["a"], n).alias("a"), tail(both["b"], n).alias("b")))

    def reverse(both: Column) -> Column:
        return F.struct(F.reverse(both["a"]).alias("a"), F.reverse(both["b"]).alias("b"))

    return let(let(let(F.struct(a.alias("a"), b.alias("b")), cut), reverse), cut)


def occurrences(docs: DataFrame, classes: tuple[tuple[int, int], ...] = BY_LENGTH) -> DataFrame:
    """``doc_id, doc_hash, line_no, chars, line_key`` (MD5) and ``keys`` of all lines but empty ones; a null text has none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("line_no"), F.char_length(x).alias("chars")))
    wide = lambda x: F.when(x["chars"] >= classes[0][0], F.encode(x["line"], "UTF-32"))
    lines = F.transform(
        F.filter(lines, lambda x: x["chars"] > 0),
        lambda x: F.struct(x["line_no"].alias("line_no"), x["chars"].alias("chars"), F.unhex(F.md5(x["line"])).alias("line_key"), wide(x).alias("wide")),
    )
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("doc_hash"), lines.alias("lines"))
    rows = rows.select("doc_id", "doc_hash", F.inline("lines"))
    return materialize(segments(rows, classes).drop("wide"), "lines")


def described(least: int, wide: bool = False) -> Column:
    """The lines of a text with ``least`` characters or more as ``struct<line,chars,line_no,line_key>``, on request with the line as UTF-32.

    All of it is made in the array of lines: Spark would otherwise make it again for each row that a line gives.
    """
    lines = F.transform(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"), lambda x, i: F.struct(x.alias("line"), F.char_length(x).alias("chars"), i.alias("line_no")))
    more = lambda x: [F.encode(x["line"], "UTF-32").alias("wide")] if wide else []
    return F.transform(
        F.filter(lines, lambda x: x["chars"] >= least),
        lambda x: F.struct(x["line"].alias("line"), x["chars"].alias("chars"), x["line_no"].alias("line_no"), F.unhex(F.md5(x["line"])).alias("line_key"), *more(x)),
    )


def first_lines(rows: DataFrame) -> DataFrame:
    """``line_key, first, n, chars``: per different line of ``occurrences`` where it occurs first (``doc_id, line_no``), how often, its length."""
    first = F.min(F.struct("doc_id", "line_no")).alias("first")
    return materialize(rows.groupBy("line_key").agg(first, F.count("*").alias("n"), F.max("chars").alias("chars")), "first-lines")


def near_lines(docs: DataFrame, classes: tuple[tuple[int, int], ...] = BY_LENGTH, rows: DataFrame | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """``line_key`` (MD5) of the lines that have an earlier line within the threshold of the shorter one.

    ``classes`` are pairs of a length and the threshold that holds from it on, both ascending; shorter
    lines are left out. Lines are ordered by the smallest doc_id they occur in (null first), then
    by their bytes. ``rows`` and ``firsts`` are what ``occurrences`` and ``first_lines`` give for the same documents.

    A line has a few segments and many probes; probes are tested against a table of bits of the
    segments' keys before they are shuffled. Of the segments only keys are counted; those that are
    there twice or probed, and only lines that share a key with another one, are brought together,
    first by their keys alone, then with the letters they have.
    """
    least = classes[0][0]
    rows = occurrences(docs, classes) if rows is None else rows
    firsts = (first_lines(rows) if firsts is None else firsts).filter(F.col("chars") >= least)
    # of equal lines only the first is cut; a bit table of the first places, so that no text is shuffled
    places = firsts.select(F.xxhash64("line_key", "first.doc_id", "first.line_no").alias("key"))
    size = firsts.agg(F.count("*").alias("lines"), F.sum(threshold_of(F.col("chars"), classes) + 1).alias("keys")).first()
    places = BitTable(places, size["lines"])
    place = F.xxhash64("line_key", "doc_id", "line_no")
    once_each = lambda wide: places.holds(docs.select(F.col("doc_id").cast("long"), F.inline(described(least, wide))), place)
    own = once_each(False).drop("line_no")
    cut_lines = once_each(True).select("line_key", "chars", "wide")
    index = places.holds(rows.filter("keys IS NOT NULL"), place).select("line_key", "chars", F.explode("keys").alias("key"))
    met = materialize(BitTable(index.select("key"), size["keys"] or 1).holds(probes(cut_lines, classes)), "probes")
    # most segments are of one line and meet no probe
    twice = index.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    asked = materialize(twice.unionByName(met.select("key").distinct()), "asked-keys")
    index = BitTable(asked, asked.count()).holds(index)
    both = materialize(index.withColumn("role", F.lit(INDEX)).unionByName(met.withColumn("role", F.lit(PROBE))), "met-lines")
    mark = F.xxhash64("line_key")
    shared = both.groupBy("key").agg(F.min(mark).alias("low"), F.max(mark).alias("high"), F.bit_or("role").alias("roles"))
    shared = shared.filter((F.col("low") < F.col("high")) & (F.col("roles").bitwiseAND(F.lit(INDEX)) > 0)).select("key")
    shared = materialize(shared, "shared-keys")
    few = BitTable(shared, shared.count()).holds(both).join(shared, "key").groupBy("key", "line_key", "chars").agg(F.bit_or("role").alias("role"))
    few = materialize(few, "shared-lines")
    # the texts of these lines only, and how often they have each letter
    wanted = materialize(few.select("line_key").distinct().select(F.xxhash64("line_key").alias("key")), "wanted")
    lines = BitTable(wanted, wanted.count()).holds(own, F.xxhash64("line_key"))
    lines = lines.groupBy("line_key", "line", "chars").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("none"))
    first = F.when(~F.col("none"), F.col("first"))  # a null id is the smallest
    lines = lines.select("line_key", "line", first.alias("first"), letter_counts(F.col("line"), F.col("chars")).alias("counts"))
    lines = materialize(lines.select("line_key", "line", "first", "counts.*"), "long-lines")
    few = few.join(lines.drop("line"), "line_key")
    a, b = few.filter(F.col("role").bitwiseAND(F.lit(INDEX)) > 0).alias("a"), few.alias("b")
    # lines of one length meet twice: once is enough
    once = (F.col("a.chars") < F.col("b.chars")) | ((F.col("a.chars") == F.col("b.chars")) & (F.col("a.line_key") < F.col("b.line_key")))
    threshold = threshold_of(F.col("a.chars"), classes)
    alike = (F.col("b.chars") - F.col("a.chars") <= threshold) & (counts_apart("a", "b") <= 2 * threshold)
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & once & alike)
    pairs = pairs.select(F.col("a.line_key").alias("a_key"), F.col("b.line_key").alias("b_key"), F.col("a.chars").alias("chars")).distinct()
    # taken after the join: both in its condition would be too long for one compiled method
    for side in ("a", "b"):
        pairs = pairs.join(lines.select(F.col("line_key").alias(f"{side}_key"), F.struct(F.struct("first").alias("at"), "n0", "n1", "n2", "total").alias(side)), f"{side}_key")
    later = F.when(F.col("a.at") > F.col("b.at"), F.col("a_key")).when(F.col("a.at") < F.col("b.at"), F.col("b_key"))
    pairs = materialize(pairs.select("a_key", "b_key", "chars", later.alias("later"), counts_apart("a", "b").cast("int").alias("apart")), "line-pairs")
    texts = lines.select("line_key", F.struct("first", "line").alias("place"))
    return compared(pairs, texts, classes)


def compared(pairs: DataFrame, texts: DataFrame, classes: tuple[tuple[int, int], ...]) -> DataFrame:
    """``line_key`` of the later lines of the ``pairs`` within their threshold.

    One earlier line is enough. So each line is compared with the one whose letters are most alike first, and
    then only the lines that are left with all others. ``later`` is null where both lines first occur in one
    document; such pairs are compared at the end.
    """
    found = []
    for turn in range(ROUNDS):
        order = F.struct("apart", "a_key", "b_key", "chars")
        best = pairs.filter("later IS NOT NULL").groupBy("later").agg(F.min(order).alias("best"))
        best = materialize(best, f"best-pairs-{turn}")
        near = materialize(near_of(best.select("best.*"), texts, classes), f"near-lines-{turn}")
        found.append(near)
        # a pair is left if its line is, and if it comes after the one compared
        done = best.join(near.select(F.col("line_key").alias("later"), F.lit(True).alias("near")), "later", "left")
        done = done.select(F.col("later").alias("_later"), "best", F.coalesce("near", F.lit(False)).alias("_near"))
        pairs = pairs.join(done, F.col("later") == F.col("_later"), "left")
        pairs = pairs.filter(F.col("later").isNull() | (~F.col("_near") & (order > F.col("best"))))
        pairs = materialize(pairs.drop("_later", "best", "_near"), f"line-pairs-{turn}")
    found.append(near_of(pairs, texts, classes))
    return materialize(reduce(DataFrame.unionByName, found).distinct(), "near-lines")


def near_of(pairs: DataFrame, texts: DataFrame, classes: tuple[tuple[int, int], ...]) -> DataFrame:
    """``line_key`` of the later line of each of the ``pairs`` (``a_key, b_key, chars``) within its threshold."""
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("line_key").alias(f"{side}_key"), F.col("place").alias(f"{side}_place")), f"{side}_key")
    near = F.lit(False)
    for _, threshold in classes:
        own_class = threshold_of(F.col("chars"), classes) == threshold
        near = F.when(own_class, within(F.col("a_place.line"), F.col("b_place.line"), threshold)).otherwise(near)
    later = F.when(F.col("a_place") > F.col("b_place"), F.col("a_key")).otherwise(F.col("b_key"))
    return pairs.filter(near).select(later.alias("line_key")).distinct()


def dropped_lines(docs: DataFrame, classes: tuple[tuple[int, int], ...] = BY_LENGTH) -> DataFrame:
    """``doc_id, doc_hash, dropped``: per document with any, the numbers of the lines that go."""
    rows = occurrences(docs, classes)
    place = F.struct("doc_id", "line_no")
    firsts = first_lines(rows)
    near = near_lines(docs, classes, rows, firsts).withColumn("near", F.lit(True))
    marks = materialize(firsts.filter("n > 1").select("line_key", "first").join(near, "line_key", "full"), "marks")
    gone = rows.drop("keys").join(marks, "line_key").filter(F.col("near").isNotNull() | (place > F.col("first")))
    return gone.groupBy("doc_id", "doc_hash").agg(F.collect_set("line_no").alias("dropped"))


def dedup_lines(docs: DataFrame, classes: tuple[tuple[int, int], ...] = BY_LENGTH) -> DataFrame:
    """``docs`` without lines that repeat an earlier line of any document, equal or within some edits.

    Lines end at line feeds. Of equal lines the first stays, by doc_id (null first) and place
    in the text. A line also goes if any earlier line is within as many edits as ``classes`` give
    for the shorter of the two. Empty lines stay. Rows that repeat an id and a text are treated
    alike. A null text stays null; a text all of whose lines go becomes empty. Columns are kept
    and ``line_count`` and ``dropped_count`` are added; clashing columns are replaced.
    """
    gone = materialize(dropped_lines(docs, classes), "dropped-lines")
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("doc_hash").alias("_of"), F.col("dropped").alias("_dropped"))
    rows = docs.withColumn("_hash", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    # only documents that lose lines are shuffled
    some = BitTable(gone.select(F.xxhash64("_id", "_of").alias("key")), gone.count())
    row_key = F.xxhash64(F.col("doc_id").cast("long"), "_hash")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of"))
    joined = some.holds(rows, row_key).join(gone, same, "left").drop("_id", "_of")
    joined = joined.unionByName(some.lacks(rows, row_key).withColumn("_dropped", F.lit(None).cast("array<int>")))
    lines = F.split("text", "\n")

    def left(all_: Column) -> Column:
        return F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), F.col("_dropped")), lambda i: F.get(all_, i))

    kept = F.array_join(let(lines, left), "\n")  # bound once, not split again for each line
    return joined.withColumns({
        "line_count": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)),
        "dropped_count": F.coalesce(F.size("_dropped"), F.lit(0)),
        "text": F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(kept),
    }).drop("_hash", "_dropped")
