"""Checks on landed files, over a manifest with one row per file.

Manifest columns: ``bucket, key, size, columns array<string>, n_rows, read_error``. It comes from
:func:`meterline.sources.manifest.file_manifest` for files in storage, or from arrival events joined
with whatever recorded the columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.config import LANDING_PREFIX, LANDING_SUFFIX, MIN_FILE_BYTES, REQUIRED_COLUMNS
from meterline.functions.clock import iso_now
from meterline.functions.events import ARRIVAL_EVENT
from meterline.functions.text import fill, quoted_list

# The wording of findings.
BAD_EXTENSION = "Invalid extension — expected {expected}, got: {key}"
BAD_PREFIX = "Invalid S3 prefix — expected {expected}, got: {key}"
TOO_SMALL = "File too small — {size} bytes (min: {smallest})"
UNKNOWN_SIZE = "File size is unknown"
UNREADABLE = "Column validation failed: {error}"
EMPTY = "File is empty — no records found"
UNKNOWN_COLUMNS = "Columns are unknown"
MISSING = "Missing columns: {names}"


def explode_arrivals(events: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """One row per landed file named in arrival events (JSON text); an event without records gives none.

    Keys arrive percent-encoded and are decoded; a key that is no valid encoding is kept as it is. Columns of the event
    named in ``keep`` come along.
    """
    record = F.explode(F.from_json(F.col(body), ARRIVAL_EVENT)["Records"])
    return events.select(*keep, record.alias("record")).select(
        *keep,
        F.col("record.s3.bucket.name").alias("bucket"),
        F.coalesce(F.try_url_decode("record.s3.object.key"), F.col("record.s3.object.key")).alias("key"),
        F.col("record.s3.object.size").alias("size"),
    )


def extension_error(key: Column, suffix: str = LANDING_SUFFIX) -> Column:
    return F.when(~key.endswith(suffix), fill(BAD_EXTENSION, expected=F.lit(suffix), key=key))


def prefix_error(key: Column, prefix: str = LANDING_PREFIX) -> Column:
    return F.when(~key.startswith(prefix), fill(BAD_PREFIX, expected=F.lit(prefix), key=key))


def size_error(size: Column, smallest: int = MIN_FILE_BYTES) -> Column:
    message = fill(TOO_SMALL, size=size.cast("string"), smallest=F.lit(str(smallest)))
    return F.when(size.isNull(), F.lit(UNKNOWN_SIZE)).when(size < smallest, message)


def missing_columns(actual: Column, required: Sequence[str] = REQUIRED_COLUMNS) -> Column:
    """Required names the file lacks, sorted. Names compare case-sensitively."""
    return F.array_sort(F.array_except(F.array(*[F.lit(name) for name in required]), actual))


def columns_error(actual: Column, n_rows: Column, read_error: Column, required: Sequence[str] = REQUIRED_COLUMNS) -> Column:
    missing = missing_columns(actual, required)
    return (
        F.when(read_error.isNotNull(), fill(UNREADABLE, error=read_error))
        .when(F.coalesce(n_rows, F.lit(0)) == 0, F.lit(EMPTY))
        .when(actual.isNull(), F.lit(UNKNOWN_COLUMNS))
        .when(F.size(missing) > 0, fill(MISSING, names=quoted_list(missing)))
    )


def check_extension(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("extension_error", extension_error(F.col("key")))


def check_prefix(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("prefix_error", prefix_error(F.col("key")))


def check_size(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("size_error", size_error(F.col("size")))


def check_columns(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn(
        "columns_error", columns_error(F.col("columns"), F.col("n_rows"), F.col("read_error"))
    )


def validate_files(manifest: DataFrame) -> DataFrame:
    """Every check on every file; a file is valid when none of them has anything to say."""
    checks = F.array(
        extension_error(F.col("key")),
        prefix_error(F.col("key")),
        size_error(F.col("size")),
        columns_error(F.col("columns"), F.col("n_rows"), F.col("read_error")),
    )
    return (
        manifest.withColumn("errors", F.array_compact(checks))
        .withColumn("is_valid", F.size("errors") == 0)
        .withColumn("validated_at", iso_now())
    )
