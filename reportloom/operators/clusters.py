"""Clustering: centroids, assignment, Lloyd steps, k-means, representatives."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fixed import CLUSTERS, RANDOM_STATE, REPRESENTATIVES
from ..functions.vector import distance


def cluster_sizes(members: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows per cluster."""
    return members.groupBy(cluster).agg(F.count("*").alias("n"))


def centroids(
    members: DataFrame, cluster: str = "cluster", embedding: str = "embedding"
) -> DataFrame:
    """``(cluster, center)``: component-wise means, summed up where the rows are."""
    mean = Summarizer.mean(array_to_vector(F.col(embedding)))
    return members.groupBy(cluster).agg(vector_to_array(mean).alias("center"))


def assign_nearest(
    vectors: DataFrame, centers: DataFrame, embedding: str = "embedding"
) -> DataFrame:
    """Adds ``cluster`` and ``distance`` of the nearest of a few centres.

    The k centres travel as one array value, so no row is multiplied and nothing is
    shuffled. Equal distances go to the smaller cluster number.
    """
    all_centers = centers.agg(
        F.array_sort(F.collect_list(F.struct("cluster", "center"))).alias("all")
    ).scalar()

    def measure(c):
        return F.struct(
            distance(F.col(embedding), c["center"]).alias("distance"), c["cluster"].alias("cluster")
        )

    nearest = vectors.withColumn("_centers", all_centers).withColumn(
        "_nearest", F.array_min(F.transform("_centers", measure))
    )
    return nearest.select(
        *vectors.columns,
        F.col("_nearest")["cluster"].alias("cluster"),
        F.col("_nearest")["distance"].alias("distance"),
    )


def lloyd_step(
    vectors: DataFrame, centers: DataFrame, embedding: str = "embedding"
) -> DataFrame:
    """Centres after one assignment and one averaging."""
    return centroids(assign_nearest(vectors, centers, embedding), "cluster", embedding)


def member_distances(
    members: DataFrame, centers: DataFrame, embedding: str = "embedding"
) -> DataFrame:
    """Adds ``distance`` of each member to the centre of its own cluster."""
    lookup = centers.agg(
        F.map_from_entries(F.collect_list(F.struct("cluster", "center"))).alias("all")
    ).scalar()
    return (
        members.withColumn("_centers", lookup)
        .withColumn("distance", distance(F.col(embedding), F.element_at("_centers", F.col("cluster"))))
        .drop("_centers")
    )


def representatives(
    measured: DataFrame, idx: str = "idx_global", reps: int = REPRESENTATIVES
) -> DataFrame:
    """The ``reps`` members nearest to each centre, ranked from 1, ties by ``idx``.

    The rank limit is applied before the shuffle too, so of a cluster of any size only
    ``reps`` rows per task move.
    """
    nearest = W.partitionBy("cluster").orderBy("distance", idx)
    return measured.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= reps)


def effective_k(n: int, k: int) -> int:
    """``k`` or the number of rows if that is smaller; no rows is an error."""
    if n <= 0:
        raise ValueError("no vectors to cluster")
    return min(k, n)


def fit_kmeans(
    vectors: DataFrame,
    k: int = CLUSTERS,
    seed: int = RANDOM_STATE,
    embedding: str = "embedding",
    max_iter: int = 300,
    tol: float = 1e-4,
) -> KMeansModel:
    """K-means on the cluster. The caller should have persisted ``vectors``."""
    k_eff = effective_k(vectors.count(), k)
    features = vectors.select(array_to_vector(F.col(embedding)).alias("features"))
    if k_eff == 1:
        raise ValueError("one cluster needs no fit; use single_cluster")
    return KMeans(
        k=k_eff, seed=seed, initMode="k-means||", maxIter=max_iter, tol=tol, featuresCol="features"
    ).fit(features)


def model_centers(model: KMeansModel, spark) -> DataFrame:
    """``(cluster, center)`` of a fitted model: k rows."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def cluster_vectors(
    vectors: DataFrame,
    k: int = CLUSTERS,
    seed: int = RANDOM_STATE,
    embedding: str = "embedding",
    max_iter: int = 300,
    tol: float = 1e-4,
) -> tuple[DataFrame, DataFrame]:
    """``(members, centers)``: vectors with their cluster and distance, and the centres."""
    k_eff = effective_k(vectors.count(), k)
    if k_eff == 1:
        centers = centroids(vectors.withColumn("cluster", F.lit(0)), "cluster", embedding)
    else:
        centers = model_centers(
            fit_kmeans(vectors, k_eff, seed, embedding, max_iter, tol), vectors.sparkSession
        )
    return assign_nearest(vectors, centers, embedding), centers


def cluster_summary(measured: DataFrame, k: int = CLUSTERS, reps: int = REPRESENTATIVES) -> DataFrame:
    """One row: rows, effective k and number of representatives."""
    return (
        cluster_sizes(measured)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.least("n", F.lit(reps))).alias("n_representatives"),
        )
        .select(
            "n",
            F.least(F.lit(k).cast("long"), F.col("n")).alias("k"),
            "n_representatives",
        )
    )
