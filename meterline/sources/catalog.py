"""Making stored tables queryable by name."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.config import LANDING_PREFIX
from meterline.operators.summaries import SUMMARIES
from meterline.sources.stores import split_path

# Fixed value: the folder name that stands for a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _quoted(*parts: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in parts)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Creates the database unless it exists; ``location`` matters only for tables stored inside it."""
    where = "" if location is None else f" LOCATION {_text(location)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{where}")


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _registered(spark: SparkSession, name: str) -> tuple[str, dict[str, str]]:
    """Location and columns of a registered table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    location = next((row.data_type for row in described if row.col_name == "Location"), "")
    return location, _types(spark.table(name))


def _types(df: DataFrame) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in df.schema.fields}


def _same_place(left: str, right: str) -> bool:
    return split_path(left.rstrip("/")) == split_path(right.rstrip("/"))


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def _folder_columns(stored: DataFrame, path: str) -> list[str] | None:
    """Columns that the folders below ``path`` are named after, from one file; None if no file has a row."""
    row = stored.select(F.col("_metadata.file_path").alias("file")).first()
    if row is None:
        return None
    folders = split_path(row.file)[2].split("/")[len(split_path(path.rstrip("/"))[2].split("/")) : -1]
    return [unquote(folder.split("=", 1)[0]) for folder in folders if "=" in folder]


def _can_alter(spark: SparkSession, name: str, path: str, columns: dict[str, str], stored: DataFrame) -> bool:
    """Whether the registered table can become the stored one: no column of another type, the same partitioning."""
    known = {column.lower(): kind for column, kind in columns.items()}
    if any(known.get(column.lower(), kind) != kind for column, kind in _types(stored).items()):
        return False
    folders = _folder_columns(stored, path)
    return folders is None or [one.lower() for one in folders] == [one.lower() for one in _partition_columns(spark, name)]


def _drop_partitions(spark: SparkSession, name: str) -> None:
    """Takes the partitions out of the catalog, all at once; the files of an external table stay."""
    specs = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        pairs = [part.split("=", 1) for part in row.partition.split("/")]
        specs.append(", ".join(f"{_quoted(unquote(key))} = {_partition_value(value)}" for key, value in pairs))
    if specs:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({spec})" for spec in specs))


def _partition_value(value: str) -> str:
    return "null" if value in (NO_VALUE, "null") else _text(unquote(value))


def _alter(spark: SparkSession, name: str, path: str, moved: bool, columns: dict[str, str], stored: DataFrame) -> None:
    known = {column.lower() for column in columns}
    added = [f"{_quoted(column)} {kind}" for column, kind in _types(stored).items() if column.lower() not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    if moved:
        # Partitions know their own folders, so those of the old place have to go before the new ones are looked for.
        partitioned = bool(_partition_columns(spark, name))
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(path)}")
        if partitioned:
            _drop_partitions(spark, name)


def register_table(spark: SparkSession, database: str, table: str, path: str) -> None:
    """Names the Parquet table at ``path``.

    Registering again follows the table and leaves the name, its properties and its rights in place: columns that are new
    are added, another place is set, and partitions are brought in line with the folders each time, including partitions
    an overwrite removed. A column that the files no longer have stays and is null. Only for a column of another type or
    another partitioning, which no table can be altered to, is the name given anew. The data is external and not touched.
    """
    name = _quoted(database, table)
    if spark.catalog.tableExists(name):
        location, columns = _registered(spark, name)
        stored = spark.read.option("mergeSchema", True).parquet(path)
        moved = not _same_place(location, path)
        if moved or _types(stored) != columns:
            if _can_alter(spark, name, path, columns, stored):
                _alter(spark, name, path, moved, columns, stored)
            else:
                spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet OPTIONS (mergeSchema 'true') LOCATION {_text(path)}")
    if _partition_columns(spark, name):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def register_raw(spark: SparkSession, database: str, landing_root: str) -> None:
    """Names the landed files; partitions are found directly below the table's own folder."""
    register_table(spark, database, "raw", f"{landing_root.rstrip('/')}/{LANDING_PREFIX.rstrip('/')}")


def register_silver(spark: SparkSession, database: str, path: str) -> None:
    register_table(spark, database, "silver", path)


def register_gold(spark: SparkSession, database: str, gold_path: str) -> None:
    """One table per gold folder, named after it."""
    for summary in SUMMARIES:
        register_table(spark, database, summary.name, f"{gold_path.rstrip('/')}/{summary.name}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Registered tables. Temporary views, which belong to no database, are left out."""
    listed = spark.sql(f"SHOW TABLES IN {_quoted(database)}")
    return listed.where(~F.col("isTemporary")).select(F.col("namespace").alias("database"), F.col("tableName").alias("table_name"))
