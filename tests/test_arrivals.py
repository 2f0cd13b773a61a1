"""Pickup of files as events name them: repeats, late events, bad files, batches tried again."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from meterline.checks import queries
from meterline.sources import manifest
from meterline.streaming import arrivals
from meterline.streaming.landing import run_available, stream_landing

PREFIX = "raw/yellow_tripdata/"


def event(*keys):
    return json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": key, "size": 5000}}} for key in keys]})


def test_each_valid_file_is_taken_once(spark, sf_dir, tmp_path, monkeypatch):
    root, inbox, bronze, findings, taken, progress = (str(tmp_path / name) for name in ("root", "in", "bronze", "findings", "ledger", "p"))
    trips = queries.raw_trips(spark, sf_dir).limit(40).drop("year", "month")
    for month, rows in ((1, trips), (2, trips.withColumn("VendorID", F.col("VendorID").cast("int"))), (3, trips.drop("fare_amount"))):
        rows.coalesce(1).write.parquet(f"{root}/{PREFIX}year=2024/month={month}")
    files = manifest.list_files(spark, root).where("path LIKE '%.parquet'").select("path").collect()
    months = {row.path.split("month=")[1][0]: PREFIX + row.path.split(PREFIX)[1].replace("=", "%3D") for row in files}

    def send(*bodies):
        spark.createDataFrame([(body,) for body in bodies], "body string").coalesce(1).write.mode("append").parquet(inbox)

    def run():
        stream = stream_landing(spark, inbox, "body string", files_per_trigger=1)
        run_available(arrivals.stream_arrivals(stream, root, bronze, findings, taken, progress))

    send(event(months["1"], months["1"]), event(months["1"]), "no json", event(), event(PREFIX + "gone.parquet"))
    run()
    assert arrivals.arrived(spark, bronze).count() == 40
    # A batch that fails after it has written bronze is done again.
    send(event(months["2"], months["1"]), event(months["3"]))
    merge = arrivals.KeyedTable.merge
    with monkeypatch.context() as patch:
        patch.setattr(arrivals.KeyedTable, "merge", lambda self, *rest: 1 / 0)
        try:
            run()
            raise AssertionError("the batch did not fail")
        except Exception as error:  # noqa: BLE001 - the stream wraps it
            assert "division" in str(error)
    run()
    assert arrivals.arrived(spark, bronze).count() == 80
    # And one that fails after the ledger knows its files.
    send(event(months["1"], months["2"], months["3"]))
    with monkeypatch.context() as patch:
        patch.setattr(arrivals.KeyedTable, "merge", lambda self, *rest: (merge(self, *rest), 1 / 0))
        try:
            run()
        except Exception as error:  # noqa: BLE001
            assert "division" in str(error)
    run()
    rows = arrivals.arrived(spark, bronze)
    assert rows.count() == 80 and rows.select("year", "month").distinct().count() == 2 and "source_file" in rows.columns
    found = {(row.key.split("/")[-1] if "gone" in row.key else row.key.split("month=")[1][0]): row for row in arrivals.arrival_findings(spark, findings).collect()}
    assert arrivals.arrival_findings(spark, findings).count() == len(found) == 4
    assert found["1"].is_valid and found["2"].is_valid and not found["3"].is_valid and not found["gone.parquet"].is_valid
    assert "fare_amount" in found["3"].errors[0] and "no such file" in found["gone.parquet"].errors[0]
