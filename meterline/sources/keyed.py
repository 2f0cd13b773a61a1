"""Tables with one row per key that are written by merging.

The rows lie in buckets by a hash of the key. A merge reads the buckets its rows fall into, keeps the last row of each
key, and writes those buckets anew under a version of their own; other buckets are not read. A commit then names the
version that counts for every bucket, and the last batch of every writer. Readers see the old table until the commit is
there, and a merge that died before it has changed nothing. A batch that comes again is known by its writer's name and
number and changes nothing either. One writer at a time may merge into a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64

_COMMIT = "kind string, name string, value string"
_BUCKET, _WRITER = "bucket", "writer"
# The partition column; no column of a table may have its name.
_SLOT = "hash_bucket"


def _of(kind: str, rows: Sequence) -> dict[str, str]:
    return {row["name"]: row["value"] for row in rows if row["kind"] == kind}


@dataclass(frozen=True)
class KeyedTable:
    """Where a table is, its columns, which of them are the key, and by which the last row of a key is told.

    The number of buckets must not change while the table lives. It should grow with the table, so that a bucket stays
    what one task can write.
    """

    path: str
    schema: str
    key: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int = BUCKETS

    def _columns(self) -> list[str]:
        return T._parse_datatype_string(self.schema).fieldNames()  # type: ignore[attr-defined]

    def _bucket(self, *key: Column) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def _folder(self, version: str, bucket: str) -> str:
        return f"{self.path.rstrip('/')}/data/version={version}/hash_bucket={bucket}"

    def _commits(self) -> str:
        return f"{self.path.rstrip('/')}/commits"

    def _state(self, spark: SparkSession) -> tuple[int, dict[str, str], dict[str, str]]:
        """Number of the last commit, versions by bucket, and last batches by writer: a row per bucket and writer."""
        try:
            commits = spark.read.schema(f"{_COMMIT}, number bigint").parquet(self._commits())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}, {}
        last = commits.agg(F.max("number")).first()[0] or 0
        rows = commits.where(F.col("number") == last).collect()
        return last, _of(_BUCKET, rows), _of(_WRITER, rows)

    def _read(self, spark: SparkSession, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)

    def _last(self, rows: DataFrame, *also: str) -> DataFrame:
        """The last row of each key; other columns break ties, so that the result is the same on every run."""
        columns = self._columns()
        rest = [name for name in columns if name not in self.key and name not in self.order]
        record = F.struct(*self.order, *rest)
        return rows.groupBy(*also, *self.key).agg(F.max(record).alias("last")).select(
            *also, *[F.col(name) if name in self.key else F.col(f"last.{name}") for name in columns]
        )

    def merge(self, rows: DataFrame, writer: str, number: int) -> bool:
        """Merges the rows of a writer's batch; says whether it was new. Batches of a writer have rising numbers."""
        spark = rows.sparkSession
        commit, versions, writers = self._state(spark)
        if int(writers.get(writer, -1)) >= number:
            return False
        fresh = self._last(rows.select(*self._columns())).withColumn(_SLOT, self._bucket(*[F.col(name) for name in self.key]))
        # Read twice, for the buckets and for the rows; what is lost is computed again.
        fresh.persist()
        try:
            touched = sorted(str(row[_SLOT]) for row in fresh.select(_SLOT).distinct().collect())
            if touched:
                version = uuid.uuid4().hex
                old = self._read(spark, [self._folder(versions[bucket], bucket) for bucket in touched if bucket in versions])
                old = old.withColumn(_SLOT, self._bucket(*[F.col(name) for name in self.key]))
                # Grouping by bucket and key keeps the rows where they are: one shuffle, and one task per bucket.
                together = old.unionByName(fresh).repartition(_SLOT)
                self._last(together, _SLOT).write.partitionBy(_SLOT).parquet(f"{self.path.rstrip('/')}/data/version={version}")
                versions = {**versions, **dict.fromkeys(touched, version)}
        finally:
            fresh.unpersist()
        state = [(_BUCKET, *entry) for entry in versions.items()] + [(_WRITER, *entry) for entry in {**writers, writer: str(number)}.items()]
        spark.createDataFrame(state, _COMMIT).coalesce(1).write.parquet(f"{self._commits()}/number={commit + 1}")
        return True

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of the last commit; nothing is shuffled."""
        _, versions, _ = self._state(spark)
        return self._read(spark, [self._folder(version, bucket) for bucket, version in versions.items()])

    def touched_by(self, keys: DataFrame) -> DataFrame:
        """The table's rows in the buckets that these keys fall into; other buckets are not read."""
        spark = keys.sparkSession
        buckets = keys.select(self._bucket(*[F.col(name) for name in self.key]).cast("string").alias(_SLOT)).distinct().collect()
        _, versions, _ = self._state(spark)
        return self._read(spark, [self._folder(versions[row[_SLOT]], row[_SLOT]) for row in buckets if row[_SLOT] in versions])

    def lookup(self, spark: SparkSession, **key: object) -> DataFrame:
        """The row of one key; only its bucket is read."""
        values = [F.lit(key[name]) for name in self.key]
        kinds = dict((field.name, field.dataType) for field in T._parse_datatype_string(self.schema).fields)  # type: ignore[attr-defined]
        values = [value.cast(kinds[name]) for name, value in zip(self.key, values)]
        bucket = str(spark.range(1).select(self._bucket(*values)).first()[0])
        _, versions, _ = self._state(spark)
        rows = self._read(spark, [self._folder(versions[bucket], bucket)] if bucket in versions else [])
        for name, value in zip(self.key, values):
            rows = rows.where(F.col(name).eqNullSafe(value))
        return rows

    def remove_old_versions(self, spark: SparkSession) -> int:
        """Deletes data and commits that the last commit does not name; readers that began before it must be done."""
        commit, versions, _ = self._state(spark)
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = root.getFileSystem(spark._jsc.hadoopConfiguration())
        kept = {self._folder(version, bucket).rsplit("/", 2)[-2] + f"/hash_bucket={bucket}" for bucket, version in versions.items()}
        removed = 0
        for status in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "data/version=*/hash_bucket=*")) or []:
            place = status.getPath()
            if f"{place.getParent().getName()}/{place.getName()}" not in kept:
                removed += bool(store.delete(place, True))
        for status in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "commits/number=*")) or []:
            if status.getPath().getName() != f"number={commit}":
                store.delete(status.getPath(), True)
        return removed
