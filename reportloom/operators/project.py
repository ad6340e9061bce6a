"""Two-dimensional projection of vectors for plotting."""

from __future__ import annotations

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DIMS = 50


def projection_dims(dims: int) -> int:
    """Dimensions kept by the projection: at most half of them, at least two."""
    return min(MAX_DIMS, dims, max(2, dims // 2))


def project(vectors: DataFrame, embedding: str = "embedding") -> tuple[DataFrame, float]:
    """Vectors with ``x`` and ``y``, and the variance share of all kept dimensions.

    Vectors are centred first. The sign of an axis is chosen so that its largest loading
    is positive.
    """
    dims = vectors.select(F.size(embedding).alias("d")).first()
    if dims is None:
        raise ValueError("no vectors to project")
    kept = projection_dims(dims["d"])
    features = vectors.withColumn("_raw", array_to_vector(F.col(embedding)))
    scaler = StandardScaler(withMean=True, withStd=False, inputCol="_raw", outputCol="_centred")
    centred = scaler.fit(features).transform(features)
    model = PCA(k=kept, inputCol="_centred", outputCol="_pc").fit(centred)
    loadings = model.pc.toArray()
    signs = [1.0 if abs(c.max()) >= abs(c.min()) else -1.0 for c in loadings.T[:2]]
    scores = vector_to_array("_pc")
    projected = model.transform(centred).select(
        *vectors.columns,
        (F.get(scores, F.lit(0)) * signs[0]).alias("x"),
        (F.get(scores, F.lit(1)) * signs[1]).alias("y"),
    )
    return projected, float(model.explainedVariance.toArray().sum())
