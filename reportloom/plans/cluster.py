"""Vectors to clusters with representatives, topics and a projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import CLUSTERS, RANDOM_STATE, REPRESENTATIVES, TOPIC_TERMS, VOCABULARY_SIZE
from ..functions.text import words
from ..operators import clusters as C
from ..operators import topics as T
from ..operators.attach import attach_text, wanted_texts
from ..operators.lloyd import cluster_sets
from ..operators.positions import positions
from ..operators.project import project
from ..session import materialize
from ..sources.vectors import finite_vectors


@dataclass
class Clustering:
    """Results of one clustering, each a table."""

    members: DataFrame
    representatives: DataFrame
    topics: DataFrame
    labels: DataFrame
    summary: DataFrame
    projection: DataFrame | None = None
    explained_variance: float | None = None


def describe(
    members: DataFrame,
    texts: DataFrame | None,
    text_order: list[str],
    k: int = CLUSTERS,
    reps: int = REPRESENTATIVES,
    top_n: int = TOPIC_TERMS,
    vocabulary_size: int = VOCABULARY_SIZE,
) -> Clustering:
    """Representatives, topics and labels of vectors whose cluster and distance are known.

    ``members`` has ``idx_global, report_key, source_file, cluster, distance``.
    """
    slim = members.select("idx_global", "report_key", "source_file", "cluster", "distance")
    if texts is None:
        with_text = slim.withColumn("text", F.lit(None).cast("string"))
    else:
        with_text = attach_text(slim, texts, text_order, ["idx_global"])
    # The corpus serves the counts, the vocabulary and the weights, the topics also the labels. Words are cut out once.
    own_words = words(F.coalesce("text", F.lit(""))).alias("words")
    corpus = materialize(with_text.select("idx_global", "cluster", "report_key", "text", own_words), "corpus")
    nearest = C.representatives(slim, "idx_global", reps)
    # The text joins the few representatives, not every member. Rows of one key have one text.
    if texts is not None:
        few = wanted_texts(corpus.select("report_key", "text", "idx_global"), nearest, max_ids=k * reps)
        nearest = attach_text(nearest, few, ["idx_global"], ["idx_global"])
    else:
        nearest = nearest.withColumn("text", F.lit(None).cast("string"))
    docs = corpus.select("idx_global", "cluster", "words")
    scores = T.cluster_term_scores(docs, "idx_global", text="words", size=vocabulary_size)
    best = materialize(T.cluster_topics(scores, top_n=top_n), "topics")
    return Clustering(
        members=members,
        representatives=nearest.select(
            "cluster", "rank", "idx_global", "report_key", "distance", "source_file", "text"
        ),
        topics=best,
        labels=T.cluster_labels(slim, best),
        summary=C.cluster_summary(slim, k, reps),
    )


def cluster_reports(
    vectors: DataFrame,
    texts: DataFrame | None,
    text_order: list[str],
    position: str = "row_index",
    k: int = CLUSTERS,
    reps: int = REPRESENTATIVES,
    top_n: int = TOPIC_TERMS,
    random_state: int = RANDOM_STATE,
    with_projection: bool = True,
) -> Clustering:
    """Cluster one vector set, merged from any number of files.

    The indexed vectors are written once to the scratch folder: fitting, assignment and
    projection each read them again, and a lost executor costs no earlier step.
    """
    indexed = materialize(
        positions(finite_vectors(vectors), "source_file", position, "idx_global"), "vectors"
    )
    members, _ = C.cluster_vectors(indexed, k, random_state)
    members = materialize(members, "members")
    result = describe(members, texts, text_order, k, reps, top_n)
    if with_projection:
        projected, share = project(members)
        result.projection = projected.join(F.broadcast(result.labels), "cluster").select(
            "report_key", "x", "y", "cluster", "label"
        )
        result.explained_variance = share
    return result


def cluster_each_source(
    vectors: DataFrame,
    texts: DataFrame | None,
    text_order: list[str],
    position: str = "row_index",
    k: int = CLUSTERS,
    reps: int = REPRESENTATIVES,
    top_n: int = TOPIC_TERMS,
    random_state: int = RANDOM_STATE,
    with_projection: bool = True,
    text_files: dict[str, str] | None = None,
) -> dict[str, Clustering | Exception]:
    """One clustering per source file; a source that fails is reported, the rest go on.

    With ``text_files`` a source takes its texts from the file named there, or has none.
    All sources are clustered in the same passes; what is asked of a source afterwards (topics, texts)
    is a job of its own. A source without a finite vector fails.
    """
    members, _, failed = cluster_sources(vectors, position, k, random_state)
    results: dict[str, Clustering | Exception] = {}
    for (source,) in vectors.select("source_file").distinct().orderBy("source_file").toLocalIterator():
        if source in failed:
            results[source] = ValueError(f"no vectors to cluster in {source}")
            continue
        own = members.filter(F.col("source_file").eqNullSafe(F.lit(source)))
        own_texts = texts
        if texts is not None and text_files is not None:
            file = text_files.get(source)
            own_texts = texts.filter(F.col("source_file") == file) if file else None
        try:
            result = describe(own, own_texts, text_order, k, reps, top_n)
            if with_projection:
                projected, share = project(own)
                result.projection = projected.join(F.broadcast(result.labels), "cluster").select("report_key", "x", "y", "cluster", "label")
                result.explained_variance = share
            results[source] = result
        except Exception as error:
            results[source] = error
    return results


def cluster_sources(
    vectors: DataFrame,
    position: str = "row_index",
    k: int = CLUSTERS,
    random_state: int = RANDOM_STATE,
    max_iter: int = 300,
    tol: float = 1e-4,
) -> tuple[DataFrame, DataFrame, set[str]]:
    """``(members, centers, failed)`` of all sources at once: the number of jobs does not grow with the sources.

    Rows are numbered within their source. ``failed`` are the sources that have rows but no finite vector.
    """
    finite = finite_vectors(vectors)
    indexed = materialize(positions(finite, "source_file", position, "idx_global", within_source=True), "vectors")
    members, centers = cluster_sets(indexed, k, random_state, max_iter, tol)
    sources = vectors.select("source_file").distinct()
    failed = sources.join(indexed.select("source_file").distinct(), "source_file", "left_anti")
    return materialize(members, "members"), centers, {r["source_file"] for r in failed.collect()}
