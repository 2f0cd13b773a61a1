"""Samples by a hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.llm.storage import hashed_sample


def test_copies_leave_the_sample_full(spark):
    # Few values in many copies, and many values beside one with most rows.
    few = spark.range(40_000).select((F.col("id") % 20).alias("value"))
    mixed = spark.range(40_000).select(F.greatest(F.col("id") - 39_000, F.lit(0)).alias("value"))
    for rows, most, distinct in ((few, 500, 20), (few, 7, 20), (mixed, 300, 1000), (mixed, 1, 1000), (few.limit(0), 5, 0)):
        found = [row.value for row in hashed_sample(rows, F.xxhash64("value"), most).collect()]
        smallest = rows.distinct().orderBy(F.xxhash64("value")).limit(most).collect()
        assert found == [row.value for row in smallest]
        assert len(found) == min(most, distinct)
