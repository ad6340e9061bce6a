"""Topics: terms with the highest mean TF-IDF in each cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import TOPIC_TERMS, VOCABULARY_SIZE
from ..functions.scan import let
from ..functions.text import pairs_of, with_bigrams, words
from ..session import materialize
from .membership import WordSet

SCORE_DIGITS = 12


def count_terms(terms: Column, kind: str = "string") -> Column:
    """``array<struct<term,tf>>`` of an array of terms: sorted, runs counted, in the row."""

    def runs(sorted_terms: Column) -> Column:
        all_but_last = F.slice(sorted_terms, F.lit(1), F.greatest(F.size(sorted_terms) - 1, F.lit(0)))
        before = F.concat(F.array(F.lit(None).cast(kind)), all_but_last)
        numbered = F.transform(sorted_terms, lambda t, i: F.struct(t.alias("term"), i.alias("at")))
        marked = F.zip_with(
            numbered,
            before,
            lambda here, last: F.struct(
                here["term"].alias("term"),
                here["at"].alias("at"),
                (~here["term"].eqNullSafe(last)).alias("first"),
            ),
        )

        def lengths(starts: Column) -> Column:
            following = F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0)))
            ends = F.concat(F.transform(following, lambda s: s["at"]), F.array(F.size(sorted_terms)))
            return F.zip_with(
                starts,
                ends,
                lambda s, end: F.struct(
                    s["term"].alias("term"), (end - s["at"]).cast("long").alias("tf")
                ),
            )

        return let(F.filter(marked, lambda m: m["first"]), lengths)

    return F.when(F.size(terms) > 0, let(F.sort_array(terms), runs))


def tokens(docs: DataFrame, text: str) -> Column:
    """The words of a column of texts; a column of words as it is."""
    return F.col(text) if isinstance(docs.schema[text].dataType, T.ArrayType) else words(F.col(text))


def document_terms(docs: DataFrame, text: str = "text", *keep: str, known: WordSet | None = None) -> DataFrame:
    """``(keep…, term, tf)``: each document's n-grams with their counts, without a shuffle.

    With ``known`` most n-grams that are not in that set are dropped before they are counted.
    """
    terms = with_bigrams(tokens(docs, text))
    if known:
        docs, terms = known.beside(docs), F.filter(terms, known.holds)
    return docs.select(*keep, F.inline(let(terms, lambda t: count_terms(t))))


def frequent_pairs(docs: DataFrame, frequent: DataFrame, text: str = "text") -> DataFrame:
    """``(term, tf)`` of each document's pairs of two ``frequent`` words, and of few others.

    Words are tested where they stand, before pairs are made: a pair with a rare word is no row.
    """
    known = WordSet(frequent, "term", frequent.count())

    def pairs(tokens: Column) -> Column:
        marked = F.transform(tokens, lambda w: F.when(known.holds(w), w))
        return F.filter(pairs_of(marked), lambda p: p.isNotNull())

    return known.beside(docs).select(F.inline(let(let(tokens(docs, text), pairs), lambda t: count_terms(t))))


def term_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(term, tf, df)`` over the corpus; one row of ``docs`` is one document."""
    return (
        document_terms(docs, text)
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    )


def vocabulary(
    docs: DataFrame,
    text: str = "text",
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """``(term, tf, df)`` of the most frequent n-grams, ties by term.

    A threshold in three phases. Single words are counted first and kept as a table; the
    ``size`` most frequent of them bound what it takes to be in the vocabulary. A pair is no more frequent
    than either of its words, so pairs are made only of words that reach the bound, which
    travel as one value of bits. The pairs that remain are counted exactly, those below the
    bound fall out, and ties at the bound are all there for the final order.
    """
    total = [F.sum("tf").alias("tf"), F.count("*").alias("df")]
    single = materialize(
        docs.select(F.inline(let(tokens(docs, text), lambda t: count_terms(t)))).groupBy("term").agg(*total),
        "words",
    )
    top = single.orderBy(F.desc("tf"), "term").limit(size)
    bound = top.agg(F.count("*").alias("n"), F.min("tf").alias("tf")).first()
    reaches = F.col("tf") >= (bound["tf"] if bound["n"] == size else 1)
    frequent = single.filter(reaches)
    pairs = frequent_pairs(docs, frequent, text).groupBy("term").agg(*total).filter(reaches)
    return frequent.unionByName(pairs).orderBy(F.desc("tf"), "term").limit(size)


def tfidf_weights(
    docs: DataFrame,
    doc: str,
    text: str = "text",
    keep: tuple[str, ...] = (),
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """``(doc, keep…, term, weight)``: tf times smoothed idf, unit length per document.

    The texts, or their words if the column holds words, are read for the vocabulary with its document
    frequencies and again for the weights. Only the ``size`` vocabulary rows are broadcast, and only terms in it
    are shuffled, for the length of each document. A document is one row of the corpus,
    also one with an empty text; ``doc`` identifies it.
    """
    n_docs = docs.agg(F.count("*").alias("n")).scalar()
    idf = F.log((F.lit(1) + F.col("_n")) / (F.lit(1) + F.col("df"))) + 1
    idfs = vocabulary(docs, text, size).withColumn("_n", n_docs).select("term", idf.alias("idf"))
    idfs = materialize(idfs, "vocabulary")
    raw = (
        document_terms(docs, text, doc, *keep, known=WordSet(idfs, "term", size))
        .join(F.broadcast(idfs), "term")
        .select(doc, *keep, "term", (F.col("tf") * F.col("idf")).alias("_w"))
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(doc)))
    return raw.select(doc, *keep, "term", (F.col("_w") / norm).alias("weight"))


def cluster_term_scores(
    docs: DataFrame,
    doc: str,
    text: str = "text",
    cluster: str = "cluster",
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """``(cluster, term, score)``: mean weight over all rows of the cluster, empty ones too."""
    sizes = docs.groupBy(cluster).agg(F.count("*").alias("_n"))
    sums = (
        tfidf_weights(docs, doc, text, (cluster,), size)
        .groupBy(cluster, "term")
        .agg(F.sum("weight").alias("_sum"))
    )
    return sums.join(sizes, cluster).select(
        cluster, "term", (F.col("_sum") / F.col("_n")).alias("score")
    )


def cluster_topics(
    scores: DataFrame, cluster: str = "cluster", top_n: int = TOPIC_TERMS
) -> DataFrame:
    """``(cluster, rank, term, score)`` of the best terms; equal scores go by term."""
    rounded = F.round("score", SCORE_DIGITS)
    best = W.partitionBy(cluster).orderBy(F.desc(rounded), "term")
    return (
        scores.filter(F.col("score") > 0)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top_n)
        .select(cluster, "rank", "term", "score")
    )


def cluster_labels(clusters: DataFrame, topics: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, label)``: the first topic, else ``cluster`` and its number."""
    first = topics.filter(F.col("rank") == 1).select(cluster, "term")
    return (
        clusters.select(cluster)
        .distinct()
        .join(first, cluster, "left")
        .select(
            cluster,
            F.coalesce("term", F.concat(F.lit("cluster "), F.col(cluster).cast("string"))).alias("label"),
        )
    )


def topic_lists(clusters: DataFrame, topics: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, terms)`` with an empty list for a cluster without topics."""
    listed = topics.groupBy(cluster).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda t: t["term"]).alias(
            "terms"
        )
    )
    return (
        clusters.select(cluster)
        .distinct()
        .join(listed, cluster, "left")
        .select(cluster, F.coalesce("terms", F.array().cast("array<string>")).alias("terms"))
    )
