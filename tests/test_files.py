from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from meterline.config import LANDING_TYPES, REQUIRED_COLUMNS, Layout
from meterline.operators import landed_files
from meterline.plans import stages
from meterline.sources import manifest, tables
from rows import trips

KEY = "raw/yellow_tripdata/year=2024/month=01/f.parquet"
SCHEMA = "bucket string, key string, size bigint, columns array<string>, n_rows bigint, read_error string"


def _errors(spark, key=KEY, size=4096, columns=REQUIRED_COLUMNS, n_rows=1, read_error=None):
    row = ("b", key, size, None if columns is None else list(columns), n_rows, read_error)
    found = landed_files.validate_files(spark.createDataFrame([row], SCHEMA)).first()
    assert found.is_valid == (not found.errors)
    return found.errors


def test_a_good_file_is_valid(spark):
    assert _errors(spark) == []
    assert _errors(spark, columns=[*REQUIRED_COLUMNS, "extra"]) == []


def test_size_boundary(spark):
    assert _errors(spark, size=1024) == []
    assert _errors(spark, size=1023) == ["File too small — 1023 bytes (min: 1024)"]


def test_column_names_compare_case_sensitively_and_missing_ones_are_sorted(spark):
    columns = ["vendorid" if name == "VendorID" else name for name in REQUIRED_COLUMNS if name != "fare_amount"]
    assert _errors(spark, columns=columns) == ["Missing columns: ['VendorID', 'fare_amount']"]


def test_empty_and_unreadable_files(spark):
    assert _errors(spark, n_rows=0) == ["File is empty — no records found"]
    assert _errors(spark, columns=None, n_rows=None, read_error="no footer") == ["Column validation failed: no footer"]


def test_all_checks_report(spark):
    assert _errors(spark, key="landing/f.csv", size=1, n_rows=0) == [
        "Invalid extension — expected .parquet, got: landing/f.csv",
        "Invalid S3 prefix — expected raw/yellow_tripdata/, got: landing/f.csv",
        "File too small — 1 bytes (min: 1024)",
        "File is empty — no records found",
    ]


def test_arrivals_are_decoded(spark):
    bodies = [
        '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"raw/year%3D2024/a+b.parquet","size":5}}},'
        '{"s3":{"bucket":{"name":"b"},"object":{"key":"bad%zz"}}}]}',
        "{}",
        '{"Records":[]}',
    ]
    events = spark.createDataFrame([(body,) for body in bodies], "body string")
    found = [tuple(row) for row in landed_files.explode_arrivals(events).collect()]
    assert found == [("b", "raw/year=2024/a b.parquet", 5), ("b", "bad%zz", None)]


def _landing(spark, tmp_path):
    """Three good months, one without a column, one that is no Parquet file at all."""
    root = str(tmp_path / "landing")
    for month in (1, 2, 3):
        trips(spark, {}, {}).coalesce(1).write.parquet(tables.month_folder(root, 2024, month))
    trips(spark, {}).drop("VendorID").coalesce(1).write.parquet(tables.month_folder(root, 2024, 4))
    broken = tmp_path / "landing/raw/yellow_tripdata/year=2024/month=05"
    broken.mkdir(parents=True)
    (broken / "broken.parquet").write_bytes(b"x" * 5000)
    return root


def test_manifest_reads_footers(spark, tmp_path):
    root = _landing(spark, tmp_path)
    rows = manifest.file_manifest(spark, root, "b").collect()
    assert len(rows) == 5
    assert all(row.key.startswith("raw/yellow_tripdata/year=2024/month=") for row in rows)
    good = [row for row in rows if "month=01" in row.key][0]
    assert good.n_rows == 2 and set(REQUIRED_COLUMNS) <= set(good["columns"]) and good.read_error is None
    broken = [row for row in rows if "broken" in row.key][0]
    assert broken.n_rows is None and broken.read_error


def test_only_valid_files_are_read(spark, tmp_path):
    root = _landing(spark, tmp_path)
    findings = landed_files.validate_files(manifest.file_manifest(spark, root, "b"))
    months = manifest.validated_scan(spark, findings, root).groupBy("month").count().collect()
    assert {row["month"]: row["count"] for row in months} == {1: 2, 2: 2, 3: 2}


def test_unknown_size_or_columns_are_findings(spark):
    assert _errors(spark, size=None) == ["File size is unknown"]
    assert _errors(spark, columns=None) == ["Columns are unknown"]


ODD_NAMES = ("a b.parquet", "c[1].parquet", "d%20e.parquet", "f#g.parquet", "h{x}.parquet", "plain.parquet")


def test_names_of_files_are_taken_literally(spark, tmp_path):
    root = str(tmp_path / "landing")
    trips(spark, {}, {}).coalesce(1).write.parquet(str(tmp_path / "made"))
    made = next((tmp_path / "made").glob("*.parquet")).read_bytes()
    folder = tmp_path / "landing/raw/yellow_tripdata/year=2024/month=01"
    folder.mkdir(parents=True)
    for name in ODD_NAMES:
        (folder / name).write_bytes(made)
    findings = landed_files.validate_files(manifest.file_manifest(spark, root, "b"))
    assert {row.key.rsplit("/", 1)[1]: list(row.errors) for row in findings.collect()} == {name: [] for name in ODD_NAMES}
    assert manifest.validated_scan(spark, findings, root).count() == 2 * len(ODD_NAMES)


def test_a_file_that_cannot_be_reached_fails_the_job(spark, tmp_path):
    gone = spark.createDataFrame([(str(tmp_path / "gone.parquet"), 5000)], "path string, size bigint")
    with pytest.raises(Exception, match="gone.parquet"):
        manifest.with_footers(gone).collect()


def test_only_bytes_that_are_no_parquet_file_are_a_finding(spark, tmp_path):
    cases = {"empty": b"", "short": b"PAR1", "text": b"x" * 100, "lying": b"PAR1" + (10_000).to_bytes(4, "little") + b"PAR1"}
    cases["garbage"] = b"PAR1" + b"\xff" * 64 + (64).to_bytes(4, "little") + b"PAR1"
    for name, data in cases.items():
        (tmp_path / name).write_bytes(data)
    files = spark.createDataFrame([(str(tmp_path / name), len(data)) for name, data in cases.items()], "path string, size bigint")
    assert all(row.read_error.startswith("not a parquet file") for row in manifest.with_footers(files).collect())


def _drifting(spark, root):
    """A month without a column, one with a further column, one whose passengers are whole numbers."""
    trips(spark, {}).drop("tolls_amount", "id").coalesce(1).write.parquet(tables.month_folder(root, 2024, 1))
    trips(spark, {}, {}).drop("id").withColumn("airport_fee", F.lit(1.25)).coalesce(1).write.parquet(tables.month_folder(root, 2024, 2))
    whole = trips(spark, {}, {}, {}).drop("id").withColumn("passenger_count", F.lit(2).cast("bigint"))
    whole.coalesce(1).write.parquet(tables.month_folder(root, 2024, 3))


@pytest.mark.parametrize("months", [(1, 2), (1, 2, 3), (3,)])
def test_months_are_read_under_one_schema(spark, tmp_path, months):
    layout = Layout.under(str(tmp_path))
    _drifting(spark, layout.raw)
    for month in {1, 2, 3} - set(months):
        shutil.rmtree(tables.month_folder(layout.raw, 2024, month))
    findings = landed_files.validate_files(manifest.file_manifest(spark, layout.raw, "b"))
    for scan in (tables.scan_raw(spark, layout.raw), manifest.validated_scan(spark, findings, layout.raw)):
        types = dict(scan.dtypes)
        assert {name: types[name] for name in LANDING_TYPES} == LANDING_TYPES
        rows = {row.month: row for row in scan.groupBy("month").agg(
            F.count("*").alias("rows"), F.count("tolls_amount").alias("tolls"), F.sum("passenger_count").alias("passengers"),
            *([F.sum("airport_fee").alias("fee")] if "airport_fee" in types else []),
        ).collect()}
        assert {month: row["rows"] for month, row in rows.items()} == {month: month for month in months}
        if 1 in months:
            assert rows[1].tolls == 0 and rows[2].fee == 2.5 and rows[1].fee is None
        if 3 in months:
            assert rows[3].passengers == 6.0 and rows[3].tolls == 3
    stages.bronze_stage(spark, layout)
    assert stages.silver_stage(spark, layout).valid == sum(months)


def test_no_valid_file_is_an_error_and_keeps_the_old_bronze(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    stages.sinks.write_bronze(trips(spark, {}, {}), layout.bronze)
    trips(spark, {}).drop("VendorID").coalesce(1).write.parquet(tables.month_folder(layout.raw, 2024, 4))
    with pytest.raises(ValueError, match="no valid file"):
        stages.validated_bronze_stage(spark, layout, "b")
    assert tables.scan_bronze(spark, layout.bronze).count() == 2


def test_bronze_from_valid_files(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    root = _landing(spark, tmp_path)
    assert root == layout.raw
    for _ in range(2):
        findings = stages.validated_bronze_stage(spark, layout, "b")
    assert findings.where(F.col("is_valid")).count() == 3
    bronze = tables.scan_bronze(spark, layout.bronze)
    assert bronze.count() == 6
    assert {"ingestion_time", "source_file", "year", "month"} <= set(bronze.columns)
