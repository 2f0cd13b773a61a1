"""Joins and components for groups that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import stored

# Groups with more than one in so many of all rows are matched by broadcast: there are fewer of them than this.
MOST_LARGE_GROUPS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, group_size: str, total: int) -> DataFrame:
    """``rows`` joined with their row of ``groups``, without any task getting all rows of a large group.

    ``groups`` has one row per ``key`` and its size; ``total`` is at least the sum of sizes.
    """
    large = F.col(group_size) > total / MOST_LARGE_GROUPS
    added = [name for name in groups.columns if name != key]
    hit = rows.join(F.broadcast(groups.where(large)), key, "left")
    columns = [*rows.columns, *added]
    in_large = hit.where(F.col(group_size).isNotNull()).select(*columns)
    in_small = hit.where(F.col(group_size).isNull()).drop(*added).join(groups.where(~large), key).select(*columns)
    return in_large.unionByName(in_small)


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of bigint pairs ``a, b``: every node with the smallest node of its component.

    Each node hooks its neighbours to the smallest of them, in turn among larger and smaller neighbours, until nothing
    changes; the number of turns grows with the logarithm of the longest path. Each turn is stored.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    pairs = stored(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "component-edges")
    before = None
    while (now := _summary(pairs)) != before:
        before = now
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.withColumn("least", F.least("a", "least"))
        hooked = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        hooked = stored(hooked, "component-hooks")
        lower = hooked.groupBy("a").agg(F.min("b").alias("least"))
        hooked = hooked.join(lower, "a")
        pairs = stored(
            hooked.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
            .unionByName(lower.select("a", F.col("least").alias("b")))
            .distinct(),
            "component-edges",
        )
    labels = pairs.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
    roots = labels.select(F.col("label").alias("node"), "label").distinct()
    return labels.unionByName(roots)


def with_size_bound(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast where its counted rows allow it."""
    return F.broadcast(df) if df.count() <= rows else df


