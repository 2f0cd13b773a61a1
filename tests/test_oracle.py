"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import differences

# Beyond SQL; the tests of the optional part hold them against plain versions.
WITHOUT_SQL = {"pipeline", *(name for name in entry.queries() if name.startswith("op"))}


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - WITHOUT_SQL))
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, name):
    assert differences(spark, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_only_the_optional_part_lacks_sql():
    assert set(entry.queries()) - set(entry.oracle_sql()) <= WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_schema_report_lists_every_column(spark, sf_dir):
    rows = entry.queries()["schema_report"](spark, sf_dir).collect()
    types = {row["name"]: row.type for row in rows}
    assert types["tpep_pickup_datetime"] == "timestamp_ntz"
    assert types["year"] == types["month"] == "int"
    assert len(rows) == 14


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5
