"""Bronze columns: when a row was loaded and which file it came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.text import file_uri


def add_ingestion_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_time", F.current_timestamp())


def add_source_file(df: DataFrame) -> DataFrame:
    """The file each row was read from.

    ``_metadata.file_path`` is deterministic, so unlike ``input_file_name()`` it does not stop filters
    from reaching the scan. ``df`` must still lead straight to a file scan.
    """
    return df.withColumn("source_file", file_uri(F.col("_metadata.file_path")))
