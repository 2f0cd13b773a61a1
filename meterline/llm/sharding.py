"""Documents to shards of nearly equal bytes by longest-processing-time scheduling; equal texts stay together.

Groups of equal texts are sorted by size, and each goes to the shard with the least load, taken from a heap. What is
scheduled one by one on the driver is bounded whatever the number of documents: a group that holds at least one part in
``ITEMS`` of all bytes is an item of its own, of which there are at most ``ITEMS``; all smaller groups are dealt by their
digest into ``ITEMS`` bundles, and a bundle is an item. So shards differ by about the last items, a few hundredths of a
per cent, unless one group alone is larger than a shard.

Documents are numbered within their shard in parallel, in parts of about ``PART_ROWS`` rows whatever the shard.

A null text counts as empty, so null and empty texts are one group. Null and repeated ids are kept, each row on its own.
An empty table gives an empty result. Only id and text are read, so further columns of any name may be there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.storage import stored

SHARDS = 8
LAW = "bytes"

# Most groups scheduled alone, and the number of bundles that hold the others.
ITEMS = 32_768
# Rows numbered by one task at a time, about.
PART_ROWS = 65_536


def schedule(items: Iterable[tuple[int, tuple]], shards: int) -> dict[tuple, int]:
    """The shard of each ``(size, name)``: largest first, each to the least-loaded shard, ties to the smaller number."""
    loads = [(0, shard) for shard in range(shards)]
    chosen = {}
    for size, name in sorted(items, key=lambda item: (-item[0], item[1])):
        load, shard = heapq.heappop(loads)
        chosen[name] = shard
        heapq.heappush(loads, (load + size, shard))
    return chosen


def _placed(rows: DataFrame, shards: int, items: int) -> DataFrame:
    """Adds ``shard`` to rows with ``key`` and ``size``; every row of a key gets the same."""
    spark = rows.sparkSession
    bundle = F.pmod(F.xxhash64("key"), F.lit(items)).cast("int")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = F.col("bytes") * items >= total
    # At most ``items`` rows each.
    large = groups.where(alone).toArrow().to_pydict()
    bundles = groups.where(~alone).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).toArrow().to_pydict()
    chosen = schedule(
        [(size, (0, bytes(key))) for key, size in zip(large["key"], large["bytes"])]
        + [(size, (1, number)) for number, size in zip(bundles["bundle"], bundles["bytes"])],
        shards,
    )
    by_key = spark.createDataFrame([(name, shard) for (kind, name), shard in chosen.items() if kind == 0], "key binary, of_key int")
    by_bundle = spark.createDataFrame([(name, shard) for (kind, name), shard in chosen.items() if kind == 1], "bundle int, of_bundle int")
    return (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(by_key), "key", "left")
        .join(F.broadcast(by_bundle), "bundle", "left")
        .withColumn("shard", F.coalesce("of_key", "of_bundle"))
        .drop("key", "bundle", "of_key", "of_bundle")
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``slot``, counting from 0 in each shard; ``row`` tells rows apart and is replaced."""
    parts = max(1, -(-rows.count() // PART_ROWS))
    parted = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = parted.groupBy("shard", "part").count()
    # One row per part, of which there are few for each shard.
    before = sizes.withColumn(
        "before", F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")
    ).drop("count")
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "row"))
    return (
        parted.withColumn("within", within)
        .join(before, ["shard", "part"])
        .withColumn("slot", F.col("before") + F.col("within") - 1)
        .drop("part", "within", "before", "row")
    )


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", items: int = ITEMS
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per document; ``size`` is the text's bytes in UTF-8 and one more."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(value) + 1).cast("bigint").alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(value, 256)).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    placed = stored(_placed(rows, shards, items), "shard-placed")
    return _numbered(placed).select("doc_id", "size", "text_crc32", "shard", "slot")
