"""Writes by folder do not sort the rows of a task first."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from meterline.checks import queries
from meterline.sources import sinks

SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def test_folders_are_written_side_by_side(spark, tmp_path, monkeypatch):
    seen, write = [], DataFrameWriter.parquet
    before = spark.conf.get(SETTING)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *rest: (seen.append(spark.conf.get(SETTING)), write(self, *rest))[1])
    # More folders in one task than are open at a time, and rows in no order.
    rows = spark.range(4000).select("id", (F.col("id") % 45).cast("int").alias("folder")).coalesce(1)
    sinks.write_table(rows, str(tmp_path / "table"), ("folder",))
    back = spark.read.parquet(str(tmp_path / "table"))
    assert sorted(map(tuple, back.select("id", "folder").collect())) == [(n, n % 45) for n in range(4000)]
    queries.land(rows.select("id", F.lit(2024).alias("year"), (F.col("folder") % 12).alias("month")), str(tmp_path / "landing"))
    assert spark.read.parquet(str(tmp_path / "landing")).count() == 4000
    assert seen == [str(sinks.OPEN_FILES)] * 2 and spark.conf.get(SETTING) == before


def test_the_setting_comes_back_after_a_failure(spark):
    before = spark.conf.get(SETTING)
    with pytest.raises(ValueError), sinks.without_sort(spark):
        assert spark.conf.get(SETTING) == str(sinks.OPEN_FILES)
        raise ValueError
    assert spark.conf.get(SETTING) == before
