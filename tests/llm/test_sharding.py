"""Shards against the same schedule in memory."""

from __future__ import annotations

import random
import zlib

import pytest

from meterline.llm import sharding

SCHEMA = "doc_id bigint, text string, shard string, size int, key int, row int"


def rows_of(seed):
    draw = random.Random(seed)
    texts = [None, "", "é" * 40, "hot text", *("w" * draw.randint(1, 3000) + str(number) for number in range(150))]
    rows = [(draw.choice([None, number]), draw.choice(texts)) for number in range(300)] + [(5, "hot text")] * 200
    return [(*row, "s", 1, 2, 3) for row in rows]


def check(rows, found, shards):
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (repr(doc_id), len((text or "").encode()) + 1, zlib.crc32((text or "").encode())) for doc_id, text, *_ in rows
    )
    of_text, slots = {}, {}
    for row in found:
        assert of_text.setdefault((row.text_crc32, row.size), row.shard) == row.shard
        slots.setdefault(row.shard, []).append(row.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(places) == list(range(len(places))) for places in slots.values())
    return [sum(row.size for row in found if row.shard == shard) for shard in range(shards)]


def test_schedule_of_groups(spark):
    rows = rows_of(1)
    found = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA)).collect()
    loads = check(rows, found, sharding.SHARDS)
    groups = {}
    for _, text, *_ in rows:
        groups[text or ""] = groups.get(text or "", 0) + len((text or "").encode()) + 1
    expected = [0] * sharding.SHARDS
    for size in sorted(groups.values(), reverse=True):
        expected[expected.index(min(expected))] += size
    assert sorted(loads) == sorted(expected)


def test_bundles_and_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 50)
    rows = rows_of(2)
    loads = check(rows, sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), shards=3, items=40).collect(), 3)
    assert max(loads) - min(loads) < sum(loads) / 20


@pytest.mark.parametrize("texts", [[], [None], ["a"] * 30])
def test_few_rows(spark, texts):
    rows = [(number, text, "s", 1, 2, 3) for number, text in enumerate(texts)]
    found = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, found, sharding.SHARDS)
    assert len({row.shard for row in found}) == min(1, len(rows))


def test_schedule():
    items = [(7, "a"), (7, "b"), (6, "c"), (5, "d"), (4, "e"), (1, "f")]
    assert sharding.schedule(items, 2) == {"a": 0, "b": 1, "c": 0, "d": 1, "e": 1, "f": 0}
