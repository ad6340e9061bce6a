"""K-means for many sets of vectors at once: weighted starts and Lloyd steps keyed by (set, cluster).

All sets take part in the same passes over the vectors, so the number of Spark jobs depends on
``k`` and on the number of steps, not on the number of sets. A set's centres travel to its vectors
by a join on the set; Spark broadcasts them as long as they are small.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import CLUSTERS, RANDOM_STATE
from ..functions.vector import distance
from ..session import materialize

DIGITS = 9  # centres are rounded, so that sums in another order give the same ones
UNIFORM_BITS = 52


def uniform(idx: Column, step: Column | int, seed: int) -> Column:
    """A number between 0 and 1, both excluded, from an MD5 of the row's number, the step and the seed."""
    text = F.concat_ws(":", idx.cast("string"), F.lit(step).cast("string") if isinstance(step, int) else step, F.lit(seed).cast("string"))
    whole = F.conv(F.substring(F.md5(text), 1, UNIFORM_BITS // 4), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(1 << UNIFORM_BITS))


def with_centers(vectors: DataFrame, centers: DataFrame, source: str) -> DataFrame:
    """Adds ``_centers``, the set's ``array<struct<cluster,center>>``."""
    lists = centers.groupBy(F.col(source).alias("_source")).agg(F.array_sort(F.collect_list(F.struct("cluster", "center"))).alias("_centers"))
    return vectors.join(lists, F.col(source).eqNullSafe(F.col("_source"))).drop("_source")


def nearest_center(embedding: str) -> Column:
    """``struct<distance,cluster>`` of the nearest of ``_centers``, ties to the smaller number."""
    return F.array_min(
        F.transform("_centers", lambda c: F.struct(distance(F.col(embedding), c["center"]).alias("distance"), c["cluster"].alias("cluster")))
    )


def starts(
    vectors: DataFrame, k: int = CLUSTERS, seed: int = RANDOM_STATE, source: str = "source_file", idx: str = "idx_global", embedding: str = "embedding"
) -> DataFrame:
    """``source, cluster, center``: k-means++ starts of every set, up to ``k`` or the number of its different vectors.

    Each start is drawn with a chance in proportion to the squared distance from the starts before: of
    all rows that with the smallest ``-ln(u) / distance²``, where ``u`` follows from the row's number, the
    step and the seed. Equal values go to the smaller number. The draw needs no random state and no order.
    """
    chosen: DataFrame | None = None
    for step in range(k):
        rows = vectors if chosen is None else with_centers(vectors, chosen, source)
        squared = F.lit(1.0) if chosen is None else F.pow(nearest_center(embedding)["distance"], 2)
        rows = rows.select(source, idx, embedding, squared.alias("_d")).filter(F.col("_d") > 0)
        wait = -F.log(uniform(F.col(idx), step, seed)) / F.col("_d")
        first = rows.groupBy(source).agg(F.min_by(F.col(embedding), F.struct(wait, F.col(idx))).alias("center"))
        new = first.select(source, F.lit(step).alias("cluster"), F.col("center").cast("array<double>").alias("center"))
        chosen = materialize(new if chosen is None else chosen.unionByName(new), "starts")
    return chosen


def assigned(vectors: DataFrame, centers: DataFrame, source: str = "source_file", embedding: str = "embedding") -> DataFrame:
    """Adds ``cluster`` and ``distance`` of the nearest centre of the row's own set."""
    rows = with_centers(vectors, centers, source).withColumn("_nearest", nearest_center(embedding))
    return rows.select(*vectors.columns, F.col("_nearest")["cluster"].alias("cluster"), F.col("_nearest")["distance"].alias("distance"))


def moved(vectors: DataFrame, centers: DataFrame, source: str = "source_file", embedding: str = "embedding") -> DataFrame:
    """The centres after one step, with ``shift``, how far each has moved; one without members stays."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(embedding))))
    means = assigned(vectors, centers, source, embedding).groupBy(source, "cluster").agg(mean.alias("_mean"))
    means = means.select(F.col(source).alias("_source"), F.col("cluster").alias("_cluster"), F.transform("_mean", lambda x: F.round(x, DIGITS)).alias("_mean"))
    same = F.col(source).eqNullSafe(F.col("_source")) & (F.col("cluster") == F.col("_cluster"))
    both = centers.join(means, same, "left").withColumn("_new", F.coalesce("_mean", "center"))
    return both.select(source, "cluster", F.col("_new").alias("center"), distance(F.col("center"), F.col("_new")).alias("shift"))


def lloyd(
    vectors: DataFrame, centers: DataFrame, max_iter: int = 300, tol: float = 1e-4, source: str = "source_file", embedding: str = "embedding"
) -> DataFrame:
    """Centres of every set after steps until none of any set moves more than ``tol``, or ``max_iter`` steps."""
    for _ in range(max_iter):
        step = materialize(moved(vectors, centers, source, embedding), "centers")
        centers = step.drop("shift")
        if (step.agg(F.max("shift")).first()[0] or 0.0) <= tol:
            break
    return centers


def cluster_sets(
    vectors: DataFrame,
    k: int = CLUSTERS,
    seed: int = RANDOM_STATE,
    max_iter: int = 300,
    tol: float = 1e-4,
    source: str = "source_file",
    idx: str = "idx_global",
    embedding: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """``(members, centers)`` of every set. ``vectors`` should be written out: each pass reads them again."""
    centers = lloyd(vectors, starts(vectors, k, seed, source, idx, embedding), max_iter, tol, source, embedding)
    return assigned(vectors, centers, source, embedding), centers
