"""Person spans: dictionary matching as a join, and redaction of whole reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import WORD_CLASS
from ..functions.redact import is_person_label, redact_spans
from ..functions.scan import fold_emit, let
from ..session import materialize
from .membership import WordSet
from .skew import HOT_ROWS, join_to_unique


def token_spans(text: Column) -> Column:
    """``array<struct<start,end,token>>`` of words, with character offsets, lower-cased."""
    word = WORD_CLASS + "+"
    tokens = F.regexp_extract_all(text, F.lit(word), F.lit(0))
    gaps = F.transform(F.split(text, word, -1), lambda g: F.length(g))
    pairs = let(
        tokens,
        lambda ts: F.zip_with(
            F.slice(gaps, F.lit(1), F.size(ts)), ts, lambda g, t: F.struct(g.alias("g"), t.alias("t"))
        ),
    )

    def end(at: Column, pair: Column) -> Column:
        return at + pair["g"] + F.length(pair["t"])

    return fold_emit(
        pairs,
        state=F.lit(0),
        step=end,
        emits=lambda at, pair: F.lit(True),
        value=lambda at, pair: F.struct(
            (at + pair["g"]).alias("start"), end(at, pair).alias("end"), F.lower(pair["t"]).alias("token")
        ),
        value_type="struct<start:int,end:int,token:string>",
    )


def dictionary_key(name: Column) -> Column:
    """A name as the dictionary join sees it: its words in lower case."""
    return F.array_join(F.regexp_extract_all(F.lower(name), F.lit(WORD_CLASS + "+"), F.lit(0)), " ")


def name_starts(text: Column, first_words: WordSet, longest: int) -> Column:
    """The words that a name may start with, as ``struct<first,start,run>``; ``run`` are the words from there on."""

    def starts(spans: Column) -> Column:
        numbered = F.transform(spans, lambda s, i: F.struct(s["token"].alias("first"), s["start"].alias("start"), i.alias("at")))
        here = F.filter(numbered, lambda s: first_words.holds(s["first"]))
        return F.transform(here, lambda s: F.struct(s["first"].alias("first"), s["start"].alias("start"), F.slice(spans, s["at"] + 1, F.lit(longest)).alias("run")))

    return let(token_spans(text), starts)


def gazetteer_spans(
    chunks: DataFrame,
    gazetteer: DataFrame,
    *ids: str,
    max_words: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(ids…, chunk_no, start, end, label)`` of dictionary names ``(name, label)`` in chunks.

    Names of any number of words are found. The dictionary's first words, each with the lengths of
    the names that start with it, are a prefix table: a word of a text becomes a row only if it may
    start a name (tested in the row), and only runs of lengths that such names have are looked up.
    A long name costs nothing where its first word does not occur. ``max_words`` leaves out longer names.
    """
    entries = (
        gazetteer.select(dictionary_key(F.col("name")).alias("name"), "label")
        .filter(F.col("name") != "")
        .groupBy("name")
        .agg(F.min("label").alias("label"))
    )
    words = F.size(F.split("name", " "))
    if max_words is not None:
        entries = entries.filter(words <= max_words)
    entries = materialize(entries, "names")
    firsts = entries.select(F.substring_index("name", " ", 1).alias("first"), words.alias("words")).groupBy("first")
    firsts = materialize(firsts.agg(F.array_sort(F.collect_set("words")).alias("lengths")), "first-words")
    size = firsts.agg(F.count("*").alias("n"), F.max(F.array_max("lengths")).alias("longest")).first()
    first_words = WordSet(firsts, "first", size["n"])
    starts = name_starts(F.col("chunk"), first_words, size["longest"] or 1)
    spread = [*ids, "chunk_no", "start"]
    begun = join_to_unique(first_words.beside(chunks).select(*ids, "chunk_no", F.inline(starts)), firsts, "first", "inner", spread, hot_rows=hot_rows)
    runs = begun.select(*spread, "run", F.explode("lengths").alias("n")).filter(F.col("n") <= F.size("run"))
    run = F.slice("run", F.lit(1), F.col("n"))
    candidates = runs.select(
        *spread, F.element_at("run", F.col("n"))["end"].alias("end"), F.array_join(F.transform(run, lambda s: s["token"]), " ").alias("name")
    )
    found = join_to_unique(candidates, entries, "name", "inner", spread, hot_rows=hot_rows)
    return found.select(*ids, "chunk_no", "start", "end", "label")


def person_spans(spans: DataFrame) -> DataFrame:
    """Spans whose label names a person."""
    return spans.filter(is_person_label(F.col("label")))


def resolve_spans(spans: Column) -> Column:
    """Leftmost, then longest spans that do not overlap."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("neg_end")))
    )
    return fold_emit(
        ordered,
        state=F.lit(0),
        step=lambda end, s: F.greatest(end, F.when(s["start"] >= end, -s["neg_end"]).otherwise(end)),
        emits=lambda end, s: s["start"] >= end,
        value=lambda end, s: F.struct(s["start"].alias("start"), (-s["neg_end"]).alias("end")),
        value_type="struct<start:int,end:int>",
    )


def spans_by_report(spans: DataFrame, *ids: str) -> DataFrame:
    """``(ids…, found)``: per report its chunks with spans, in order, spans not overlapping."""
    span = F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    per_chunk = spans.groupBy(*ids, "chunk_no").agg(
        resolve_spans(F.collect_list(span)).alias("spans")
    )
    return per_chunk.groupBy(*ids).agg(
        F.array_sort(F.collect_list(F.struct("chunk_no", "spans"))).alias("found")
    )


def redact_chunks(chunks: Column, found: Column) -> Column:
    """Chunks with their spans replaced; ``found`` is null where a report has none."""
    kind = "array<struct<start:int,end:int>>"

    def nothing(n: Column) -> Column:
        return F.array_repeat(F.array().cast(kind), n)

    def redact(texts: Column) -> Column:
        at = F.transform(found, lambda f: f["chunk_no"])
        following = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(texts)))
        runs = F.zip_with(
            found,
            following,
            lambda f, then: F.concat(F.array(f["spans"]), nothing(then - f["chunk_no"] - 1)),
        )
        lists = F.concat(nothing(F.get(at, F.lit(0))), F.flatten(runs))
        return F.zip_with(texts, lists, lambda text, spans: redact_spans(text, spans))

    return F.when(found.isNull(), chunks).otherwise(let(chunks, redact))
