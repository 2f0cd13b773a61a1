"""File manifests: what landed, read from listings and Parquet footers, and scans of the valid files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.config import LANDING_TYPES
from meterline.sources.stores import literal_path, split_path
from meterline.sources.workspace import cut_lineage

_FOOTER_SCHEMA = "path string, size bigint, columns array<string>, types array<string>, n_rows bigint, read_error string"

_FOOTER_TAIL = 8
_MAGIC = b"PAR1"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` and ``size`` of every file under ``root``. Listing is Spark's; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("length").alias("size"))


def file_manifest(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """One row per file under ``root``: name, size, columns, their types, and row count.

    Footers are read where the listing's partitions are, a file at a time.
    """
    _, authority, folder = split_path(root)
    base = f"{authority}{folder}".rstrip("/") + "/"
    key = F.substr("path", F.locate(base, F.col("path")) + F.lit(len(base)))
    return with_footers(list_files(spark, root)).select(
        "path", F.lit(bucket).alias("bucket"), key.alias("key"), "size", "columns", "types", "n_rows", "read_error"
    )


def with_footers(listing: DataFrame, may_be_gone: bool = False) -> DataFrame:
    """Adds column names, types and row count from each file's footer.

    A file that is no Parquet file gets ``read_error``, and with ``may_be_gone`` so does a name without a file, as
    something else than a listing may give it. A file that cannot be reached says nothing about itself: the read is
    tried again and then fails the job.
    """

    def read_footers(batches):
        import pyarrow
        import pyarrow.parquet

        from meterline.sources.stores import open_store, retried

        def footer_bytes(path, size):
            store, name = open_store(path)
            with store.open_input_file(name) as handle:
                size = handle.size()
                handle.seek(max(0, size - _FOOTER_TAIL))
                tail = handle.read(_FOOTER_TAIL)
                length = int.from_bytes(tail[:4], "little") if tail[4:] == _MAGIC else -1
                if not 0 < length <= size - _FOOTER_TAIL:
                    return None
                handle.seek(size - _FOOTER_TAIL - length)
                return handle.read(length) + tail

        gone = object()

        def bytes_or_gone(path, size):
            try:
                return footer_bytes(path, size)
            except FileNotFoundError:
                return gone

        def footer(path, size):
            # A name without a file is an answer, so it is not asked again.
            data = retried(lambda: bytes_or_gone(path, size) if may_be_gone else footer_bytes(path, size))
            if data is gone:
                return None, None, None, "no such file"
            if data is None:
                return None, None, None, "not a parquet file: no footer"
            try:
                metadata = pyarrow.parquet.read_metadata(pyarrow.BufferReader(_MAGIC + data))
                schema = metadata.schema.to_arrow_schema()
            except (pyarrow.ArrowException, OSError, ValueError) as error:  # the bytes are at hand, so they are at fault
                return None, None, None, f"not a parquet file: {error}"
            return list(schema.names), [str(kind) for kind in schema.types], metadata.num_rows, None

        for files in batches:
            found = [footer(path, size) for path, size in zip(files["path"], files["size"])]
            for position, column in enumerate(("columns", "types", "n_rows", "read_error")):
                files[column] = [one[position] for one in found]
            files["n_rows"] = files["n_rows"].astype("Int64")
            yield files

    return listing.select("path", "size").mapInPandas(read_footers, _FOOTER_SCHEMA)


def conform(df: DataFrame, types: dict[str, str] = LANDING_TYPES) -> DataFrame:
    """Declared columns in their declared types: integers where doubles are declared are taken, absent columns are null.

    Further columns stay as they are.
    """
    declared = [
        (F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name) for name, kind in types.items()
    ]
    return df.select(*declared, *[F.col(f"`{name}`") for name in df.columns if name not in types])


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    """All parts under one schema; a further column whose type differs between parts becomes text."""
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = [name for name, found in kinds.items() if len(found) > 1]
    cast = [
        part.withColumns({name: F.col(f"`{name}`").cast(T.StringType()) for name in mixed if name in part.columns}) for part in parts
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), cast)


def as_it_is(df: DataFrame) -> DataFrame:
    return df


def scan_files(
    spark: SparkSession, files: DataFrame, base_path: str, each: Callable[[DataFrame], DataFrame] = as_it_is
) -> DataFrame:
    """The files of a manifest (``path, columns, types``) as one table under the declared schema.

    ``each`` is applied to every scan before they are united, where a row still knows its file.

    Files with the same columns and types are one scan, so what a column becomes depends neither on the order nor on
    the number of files. As with any scan, the names of the files are in the plan.
    """
    named = files.select("path", F.to_json(F.struct("columns", "types")).alias("signature"))
    paths: dict[str, list[str]] = {}
    for row in named.orderBy("signature", "path").toLocalIterator():
        paths.setdefault(row["signature"], []).append(literal_path(row["path"]))
    if not paths:
        raise ValueError("no valid file to read")
    reader = spark.read.option("basePath", base_path)
    return _united([each(conform(reader.parquet(*group))) for group in paths.values()])


def validated_scan(
    spark: SparkSession, validated: DataFrame, base_path: str, each: Callable[[DataFrame], DataFrame] = as_it_is
) -> DataFrame:
    """All valid files as one table; see :func:`scan_files`."""
    return scan_files(spark, cut_lineage(validated.where("is_valid").select("path", "columns", "types")), base_path, each)
