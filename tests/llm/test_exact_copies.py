"""Exact copies against grouping in memory."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from meterline.llm import exact_copies as exact

SCHEMA = "doc_id bigint, text string, key string, maybe int"


def bare(text):
    return re.sub("[ \t\n\x0b\x0c\r]", "", text or "")


def rows_of(seed):
    draw = random.Random(seed)
    texts = [None, "", " ", "a", "a b", "a b", "ab ", "A b", "\x0bab\x0c", "x" * 100_000, "é", "é"]
    rows = [(draw.choice([None, *range(60)]), draw.choice(texts)) for _ in range(80)]
    return [(*row, "k", 1) for row in rows + [(100 + n, f"one of its kind {n}") for n in range(200)] + rows[:5]]


@pytest.mark.parametrize("bits_per_row", [0, 16])
def test_groups(spark, monkeypatch, bits_per_row):
    monkeypatch.setattr(exact, "BITS_PER_ROW", bits_per_row)
    rows = rows_of(bits_per_row)
    found = exact.exact_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(bare(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    expected = []
    for doc_id, text, *_ in rows:
        group = groups[bare(text)]
        expected.append((doc_id, min(group, key=lambda one: one[:3])[3], len(group), hashlib.sha256(bare(text).encode()).hexdigest()))
    key = str
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=key) == sorted(expected, key=key)
    kept = [row for row in found if row.kept]
    assert len(kept) == len(groups) == len({row.text_sha256 for row in kept}) and all(row.doc_id == row.keep_id for row in kept)


def test_the_rows_that_stay_keep_all_columns(spark):
    rows = rows_of(1)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert len(found) == len({bare(row.text) for row in found}) == len({bare(text) for _, text, *_ in rows})
    longest = {}
    for _, text, *_ in rows:
        longest[bare(text)] = max(len(text or ""), longest.get(bare(text), 0))
    assert all(len(row.text or "") == longest[bare(row.text)] for row in found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact.exact_copies(docs).collect() == exact.drop_exact_copies(docs).collect() == []


def test_unique_rows_are_not_shuffled(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    rows = docs.select("doc_id", exact.fingerprint(docs.text).alias("key"))
    blocks = exact.block_count(5000)
    marked = exact.mark_possible(rows, ("key",), exact.repeat_filter(rows, ("key",), blocks), blocks, "maybe")
    assert marked.where("maybe").count() < 100
    twice = rows.unionAll(rows.where("doc_id % 50 = 0"))
    marked = exact.mark_possible(twice, ("key",), exact.repeat_filter(twice, ("key",), blocks), blocks, "maybe")
    assert marked.where("maybe AND doc_id % 50 = 0").count() == 200


def test_lookups_copy_no_bitmap(spark):
    """Words hold the bits of the bitmap, and above the join nothing reads bytes or makes text of them."""
    rows = spark.range(3000).selectExpr("id AS key")
    bitmaps = exact.key_filter(rows.where("key % 3 = 0"), ("key",), 4)
    for row in bitmaps.select("bits", exact._words(F.col("bits")).alias("words")).collect():
        assert b"".join((word % 2**64).to_bytes(8, "big") for word in row.words) == bytes(row.bits)
    marked = exact.mark_possible(rows, ("key",), bitmaps, 4, "maybe")
    assert not marked.where("key % 3 = 0 AND NOT maybe").count() and marked.where("NOT maybe").count() > 1900
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join ")]
    assert "getbit" in above and "hex(" not in above and "substr" not in above
