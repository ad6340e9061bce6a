"""Tables of bits hold all their keys and few others, in few bytes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reportloom.llm.bits import BUCKET_BITS, BitTable


@pytest.mark.parametrize("n", [1, 150_000])
def test_small_tables_hold_all_keys_and_few_others(spark, n):
    hashed = spark.range(2 * n).select(F.xxhash64("id").alias("key"), (F.col("id") < n).alias("own")).cache()
    table = BitTable(hashed.filter("own").select("key").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS key")), n)
    held, lacked = table.holds(hashed), table.lacks(hashed)
    assert held.filter("own").count() == n and lacked.filter("own").isEmpty()
    assert held.filter("NOT own").count() <= n * 0.013
    assert held.count() + lacked.count() == 2 * n
    nulls = hashed.limit(5).select(F.lit(None).cast("long").alias("key"))
    assert table.holds(nulls).isEmpty() and table.lacks(nulls).count() == nulls.count()
    # 32 bits a key, rounded up to a power of two, were up to eight bytes a key
    assert table.table.select(F.sum(F.size("_words") * 8)).first()[0] <= max(3 * n, 3 << BUCKET_BITS)
