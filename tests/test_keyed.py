"""Tables merged by key: last rows, replays, failures before the commit, and what a read opens."""

from __future__ import annotations

import glob

import pytest

from meterline.sources.keyed import KeyedTable

SCHEMA = "name string, part int, value string, at bigint"


def table_at(path) -> KeyedTable:
    return KeyedTable(str(path), SCHEMA, ("name", "part"), ("at",), buckets=8)


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(table, spark):
    return sorted(map(tuple, table.read(spark).collect()), key=repr)


def test_the_last_row_of_a_key_stays(spark, tmp_path):
    table = table_at(tmp_path / "t")
    assert held(table, spark) == [] and table.lookup(spark, name="a", part=1).collect() == []
    assert table.merge(rows_of(spark, ("a", 1, "x", 5), ("a", 1, "y", 7), ("b", None, "z", 1), (None, 1, None, None)), "w", 0)
    assert table.merge(rows_of(spark, ("a", 1, "late", 6), ("b", None, "new", 2), ("c", 2, "c", 1)), "w", 1)
    assert held(table, spark) == sorted([("a", 1, "y", 7), ("b", None, "new", 2), ("c", 2, "c", 1), (None, 1, None, None)], key=repr)
    assert [tuple(row) for row in table.lookup(spark, name="b", part=None).collect()] == [("b", None, "new", 2)]


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    table = table_at(tmp_path / "t")
    assert table.merge(rows_of(spark, ("a", 1, "x", 5)), "w", 3)
    files = sorted(glob.glob(f"{table.path}/**", recursive=True))
    assert not table.merge(rows_of(spark, ("a", 1, "other", 9)), "w", 3)
    assert not table.merge(rows_of(spark, ("a", 1, "other", 9)), "w", 2)
    assert sorted(glob.glob(f"{table.path}/**", recursive=True)) == files and held(table, spark) == [("a", 1, "x", 5)]
    assert table.merge(rows_of(spark, ("a", 1, "other", 9)), "another", 0) and held(table, spark) == [("a", 1, "other", 9)]
    assert table.merge(rows_of(spark), "w", 4) and held(table, spark) == [("a", 1, "other", 9)]


def test_a_merge_without_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    table = table_at(tmp_path / "t")
    table.merge(rows_of(spark, ("a", 1, "x", 5)), "w", 0)
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_commits", lambda self: "/dev/null/no-folder")
        patch.setattr(KeyedTable, "_state", lambda self, spark, state=table._state(spark): state)
        with pytest.raises(Exception):
            table.merge(rows_of(spark, ("a", 1, "lost", 9)), "w", 1)
    assert held(table, spark) == [("a", 1, "x", 5)]
    assert table.merge(rows_of(spark, ("a", 1, "again", 9)), "w", 1) and held(table, spark) == [("a", 1, "again", 9)]


def test_a_merge_writes_only_the_buckets_it_touches_and_a_lookup_reads_one(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.merge(spark.range(200).selectExpr("concat('n', id) AS name", "1 AS part", "'v' AS value", "id AS at"), "w", 0)
    _, before, _ = table._state(spark)
    table.merge(rows_of(spark, ("n7", 1, "new", 999)), "w", 1)
    _, after, _ = table._state(spark)
    assert len(before) == 8 and len([bucket for bucket in before if before[bucket] != after[bucket]]) == 1
    found = table.lookup(spark, name="n7", part=1)
    assert [row.value for row in found.collect()] == ["new"]
    assert len({path.split("hash_bucket=")[1].split("/")[0] for path in found.inputFiles()}) == 1
    assert "Exchange" not in table.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert table.remove_old_versions(spark) == 1 and table.read(spark).count() == 200
    assert table.remove_old_versions(spark) == 0
