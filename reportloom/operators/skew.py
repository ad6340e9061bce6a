"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
BUCKETS = 1 << 16


def planned_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where the session does not expose it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def size_setting(spark: SparkSession, name: str, default: str) -> int:
    """A size setting such as ``64MB`` in bytes."""
    value = spark.conf.get(name, default).lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(value[-1:], 1)
    return int(value.rstrip("kmg")) * unit


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark would broadcast ``df`` by its own size limit."""
    size = planned_bytes(df)
    limit = size_setting(df.sparkSession, "spark.sql.autoBroadcastJoinThreshold", "10MB")
    return size is not None and 0 < size <= limit


def may_be_hot(df: DataFrame, on: str, hot_rows: int = HOT_ROWS) -> bool:
    """Whether some key, or none, could have more than ``hot_rows`` rows, told by counts of the keys' hash buckets; a no is sure."""
    buckets = df.groupBy(F.pmod(F.xxhash64(on), F.lit(BUCKETS)).alias("_bucket")).agg(F.count("*").alias("_rows"))
    return not buckets.filter(F.col("_rows") > hot_rows).isEmpty()


def join_to_unique(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    spread_by: list[str],
    hot_rows: int = HOT_ROWS,
    salt: bool | None = None,
) -> DataFrame:
    """Join to a side with one row per key; ``how`` is ``inner`` or ``left``.

    A right side within Spark's broadcast limit is joined as it is. Otherwise keys with
    more than ``hot_rows`` rows on the left are split by ``spread_by`` into parts of about
    that many rows, and only their right rows are copied. Rows without a key match nothing
    and are split like any other key. The list of such keys has at most ``rows / hot_rows``
    entries; Spark broadcasts it only within its own size limit.
    """
    if salt is None:
        salt = not fits_broadcast(right)
    if not salt:
        return left.join(right, on, how)
    hot = (
        left.groupBy(on)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(F.col(on).alias("_hot"), F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts"))
    )
    spread = F.xxhash64(*spread_by)
    part = F.when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts"))).otherwise(0).cast("int")
    many = left.join(hot, left[on].eqNullSafe(F.col("_hot")), "left")
    many = many.withColumn("_part", part).drop("_hot", "_parts")
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    one = (
        right.join(hot, right[on] == F.col("_hot"), "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
        .drop("_hot", "_parts")
    )
    return many.join(one, [on, "_part"], how).drop("_part")
