"""Mixing sources to target weights with hash-threshold histograms, without sorting.

Each document has a fixed hash. Per source the sizes are summed by the leading bits of the
hash; the running sum over these buckets gives the threshold below which a budget is
reached. Only the bucket in which the budget falls is looked at again, by the next bits,
until one hash value remains. Documents below the threshold are taken once more than the
rest of their source. A larger budget has a larger threshold, so mixes are nested.

Only DataFrame functions are used. Per level one histogram row per source and bucket is
shuffled, whatever the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

HASH_BITS = 60
LEVEL_BITS = 12
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space, tab, line feed, vertical tab, form feed and
    carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of an MD5 of the id and the text, a null counting as empty: rows that share an id are told apart."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text.cast("string"), F.lit("")))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Targets of ``source, source_size``: shares by weight, none above ``most`` times its source.

    Sources in order of code points, null last, get ``weights`` in turn. With the ratio of
    limit to weight ascending, the sources that stop at their limit come first; the rest
    share what those leave over. There is one row per source, and so one window over all.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(named) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)
    shares = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shares = shares.withColumn("rate", left / weights_left)
    held = F.col("most") <= F.col("rate") * F.col("weight")  # stops at its limit
    shares = shares.withColumn("held", held)
    rate = F.max(F.when(~F.col("held"), F.col("rate"))).over(everything)  # of the first that is not held
    target = F.when(F.col("held"), F.col("most").cast("double")).otherwise(rate * F.col("weight"))
    return shares.select("source", "source_size", target.alias("target"))


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the hash below which its documents' sizes come nearest to ``budget``.

    ``docs`` has ``source, hash, size`` and ``budgets`` one row per source. The result has
    ``source, cut, at_cut, more``: documents with ``hash < cut`` are taken, and of the ``at_cut`` rows of
    the hash ``cut``, at which the budget is passed, as many (``more``) as come nearest to it. These are rows
    alike in id and text.
    """
    zero = F.lit(0).cast("long")
    edges = budgets.select("source", "budget", zero.alias("low"), zero.alias("below"))
    rows = docs.select("source", "hash", "size")
    for bits in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        slot = F.expr(f"hash DIV {1 << bits}L")
        sums = rows.groupBy("source", slot.alias("slot")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        so_far = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.join(sums, edges.source.eqNullSafe(sums.source)).drop(sums.source)
        start = F.col("below") + F.coalesce(F.sum("size").over(so_far), zero)
        edges = edges.withColumn("start", start).filter(F.col("start") <= F.col("budget"))
        last = F.max_by(F.struct("slot", "start", "size", "n"), "slot").alias("at")
        edges = edges.groupBy("source", "budget").agg(last).select(
            "source", "budget", (F.col("at.slot") * (1 << bits)).alias("low"), F.col("at.start").alias("below"), "at.size", "at.n"
        )
        edges = materialize(edges, "edges")
        if bits:  # only documents of the boundary bucket go on
            hit = edges.select(F.col("source").alias("of"), F.expr(f"low DIV {1 << bits}L").alias("slot"))
            rows = rows.join(hit, rows.source.eqNullSafe(hit.of) & (slot == hit.slot), "left_semi")
            rows = materialize(rows, "boundary")
            edges = edges.drop("size", "n")
    nearest = F.floor((F.col("budget") - F.col("below")) / (F.col("size") / F.col("n")) + 0.5)
    more = F.least(F.greatest(nearest, zero), F.col("n")).cast("long")
    return edges.select("source", F.col("low").alias("cut"), F.col("n").alias("at_cut"), more.alias("more"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: ``source, source_size, target, repeats, cut, at_cut, more``.

    Documents are taken ``repeats`` times, those with a hash below ``cut`` and ``more`` of the
    ``at_cut`` ones with that hash once more.
    """
    sized = docs.select("source", word_count(F.col("text")).alias("size"), order_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    sized = materialize(sized, "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, most), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("repeats", F.least(whole.cast("long"), F.lit(most).cast("long")))
    budgets = targets.filter("source_size > 0").select(
        "source", (F.col("target") - F.col("repeats") * F.col("source_size")).alias("budget")
    )
    cuts = thresholds(sized.filter("size > 0"), budgets)
    joined = targets.join(cuts, targets.source.eqNullSafe(cuts.source), "left").drop(cuts.source)
    return materialize(joined.fillna(0, ["cut", "at_cut", "more"]), "plan")


def with_plan(docs: DataFrame, made: DataFrame, most: int) -> DataFrame:
    """``docs`` with ``_size``, the plan's ``_total`` and ``_target``, and ``_times``, how often a document is taken."""
    rows = docs.withColumns({"_size": word_count(F.col("text")), "_hash": order_hash(F.col("doc_id"), F.col("text"))})
    names = {"source": "_source", "source_size": "_total", "target": "_target", "repeats": "_repeats", "cut": "_cut", "at_cut": "_at", "more": "_more"}
    several = made.filter("at_cut > 1 AND more BETWEEN 1 AND at_cut - 1").count()  # at most a row per source
    made = made.select([F.col(old).alias(new) for old, new in names.items()])
    joined = rows.join(made, rows.source.eqNullSafe(F.col("_source")), "left")
    at_cut = (F.col("_hash") == F.col("_cut")) & (F.col("_size") > 0)
    if several:
        # rows that nothing tells apart: so many of them, numbered where they lie
        open_ = at_cut & (F.col("_more") > 0) & (F.col("_more") < F.col("_at"))
        alike = numbered(joined.filter(open_))
        joined = joined.filter(~open_).withColumn("_number", F.lit(0).cast("long")).unionByName(alike)
    else:
        joined = joined.withColumn("_number", F.lit(0).cast("long"))
    more = ((F.col("_hash") < F.col("_cut")) & (F.col("_size") > 0)) | (at_cut & (F.col("_number") < F.col("_more")))
    return joined.withColumn("_times", F.least(F.col("_repeats") + more.cast("long"), F.lit(most).cast("long")))


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``_number``, from 0 on, within each source; no task sees more than its own rows and a count per part."""
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "alike")
    part = F.shiftright("_row", 33)
    counts = rows.groupBy("_source", part.alias("_part")).agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("_source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_source", part).orderBy("_row")) - 1
    placed = rows.withColumn("_inside", inside).join(counts, F.col("_source").eqNullSafe(F.col("_s")) & (part == F.col("_p")))
    return placed.withColumn("_number", (F.col("_before") + F.col("_inside")).cast("long")).drop("_row", "_inside", "_s", "_p", "_before")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per document of ``doc_id, text, source``: how many of its words the mix takes.

    Returns ``doc_id, source, size, source_size, target, taken``. ``taken`` is a multiple of
    ``size``, at most ``most`` times it. Rows alike in id and text are taken as often as it needs, any of
    them. Empty and null texts have size 0 and take nothing; a null source is a source of its own. An empty
    table gives an empty result. Other columns do not matter.
    """
    rows = docs.select("doc_id", "text", "source")
    return with_plan(rows, plan(rows, weights, most), most).select(
        "doc_id", "source", F.col("_size").alias("size"), F.col("_total").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_times")).alias("taken")
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """The mix itself: each document of ``docs`` as many times as it is taken, all columns kept.

    Texts without words take nothing and are not in the mix.
    """
    made = plan(docs.select("doc_id", "text", "source"), weights, most)
    taken = with_plan(docs, made, most).filter("_size > 0 AND _times > 0")
    again = taken.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])
