"""The n-gram Jaccard join against comparing all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import near_copies as near


def token_set(text, width):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [word for word in re.split("[ \t\n\x0b\x0c\r]+", lowered) if word]
    if not words:
        return frozenset()
    span = min(width, len(words))
    return frozenset(tuple(words[i : i + span]) for i in range(len(words) - span + 1))


def brute_force(rows, width, percent):
    """``[(doc_id, n_shingles, component_id)]`` from all pairs."""
    sets = [token_set(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None and sets[i]:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [
        (doc_id, len(sets[i]), least.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)
    ]


def check(spark, rows, width, percent, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near.near_copies(docs, width, percent, **options).select("doc_id", "n_shingles", "component_id").collect()
    key = lambda row: tuple((value is None, value or 0) for value in row)
    assert sorted(map(tuple, found), key=key) == sorted(brute_force(rows, width, percent), key=key)


def varied(seed, families, copies, words=60):
    """Families of texts that differ in a few words, some only in one, among unrelated texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{number}" for number in range(400)]
    rows = []
    for _ in range(families):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(4, words))]
        for _ in range(draw.randint(1, copies)):
            text = list(base)
            for _ in range(draw.randint(0, 3)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                text = text[: draw.randint(1, len(text))]
            rows.append((len(rows), " ".join(text).replace("w1", "W1") + draw.choice(["", "\n", "  "])))
    draw.shuffle(rows)
    return rows


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "one two"), (7, "one\ttwo "), (8, "one two three"),
    (9, "ONE TWO THREE"), (None, "one two three"), (None, "alone here now"), (10, "é È x y z"), (11, "É È x y z"),
    (12, "a b " * 5000), (13, "a b " * 5001), (13, "a b " * 5001), (14, "x" * 100_000), (15, "    a b c"),
]


def test_odd_rows(spark):
    check(spark, ODD, 3, 90)


def test_empty_table(spark):
    check(spark, [], 3, 90)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_families(spark, width, percent):
    check(spark, varied(width, 60, 12), width, percent)


def test_groups_too_large_for_a_task(spark):
    check(spark, varied(7, 6, 60), 3, 80, group_tokens=900)


def test_common_blocks(spark):
    check(spark, varied(8, 12, 40), 3, 85)


def test_long_unrelated_texts_are_no_candidates(spark):
    """Many long texts leave the same blocks empty and share a passage; only the two that are near become candidates."""
    draw = random.Random(4)
    passage = " ".join(f"p{number}" for number in range(60))
    rows = [(number, passage + "".join(f" u{draw.getrandbits(40)}" for _ in range(draw.randint(1200, 1500)))) for number in range(120)]
    rows.append((500, rows[7][1] + " one more"))
    check(spark, rows, 5, 80)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = near.profiles(docs, 5, 80).withColumnRenamed("doc_id", "node").cache()
    keys = sets.select("node", F.explode("keys").alias("part")).select("node", "part.class", "part.key")
    assert {frozenset(row) for row in near.candidate_edges(keys, sets, 80).collect()} == {frozenset((7, 500))}


def test_buckets_that_are_not_searched(spark, monkeypatch):
    monkeypatch.setattr(near, "MOST_IN_BUCKET", 3)
    check(spark, varied(9, 12, 30), 3, 85)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(row) for row in docs.collect()], 3, 90)


def test_tree_finds_every_point_within_the_bound():
    draw = np.random.default_rng(1)
    points = draw.poisson(3, (700, near.GROUPS)).astype(np.int32)
    points[350:] = np.maximum(points[:350] + draw.integers(-1, 2, (350, near.GROUPS)), 0)
    sizes = points.sum(axis=1)
    tree = near.CountTree(points, sizes, 80)
    tree.remove(np.arange(0, 700, 7))
    for row in range(0, 700, 13):
        expected = {
            other for other in range(700)
            if other % 7 and np.minimum(points[row], points[other]).sum() >= near.need(sizes[row], sizes[other], 80)
        }
        assert set(tree.within(points[row], int(sizes[row])).tolist()) == expected


def test_drop_keeps_one_row_of_each_group(spark):
    docs = spark.createDataFrame(
        [(3, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "y"), (2, None, "z"), (4, "", None)],
        "doc_id bigint, text string, component_id string",
    )
    kept = near.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == [1, 2, 4]


def test_sets_apart_are_held_against_their_group(spark):
    """Every link between sets of different labels is found, whatever block and slice they fall in."""
    draw = random.Random(3)
    rows = []
    for node in range(90):
        base = rows[draw.randrange(len(rows))][4] if rows and draw.random() < 0.7 else [draw.getrandbits(62) for _ in range(draw.randint(8, 30))]
        tokens = sorted({*base[: len(base) - draw.randint(0, 1)], *(draw.getrandbits(62) for _ in range(draw.randint(0, 2)))})
        rows.append((node, node % 2, len(tokens), node % 5, tokens))
    expected = {
        frozenset((a[0], b[0])) for a in rows for b in rows
        if a[1] == b[1] and a[3] != b[3] and len({*a[4]} & {*b[4]}) >= near.need(len(a[4]), len(b[4]), 80)
    }
    sets = spark.createDataFrame(rows, "node bigint, group bigint, n bigint, label bigint, tokens array<bigint>")
    found = near._held_against(sets, sets.select("group", "node", "n"), 80, 100).collect()
    assert expected and {frozenset(row) for row in found} == expected


def test_whole_texts_go_to_python_in_small_batches(spark, monkeypatch):
    setting, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    before, store = spark.conf.get(setting), near.stored

    def watched(df, purpose, *more):
        seen[purpose] = int(spark.conf.get(setting))
        return store(df, purpose, *more)

    monkeypatch.setattr(near, "stored", watched)
    docs = spark.createDataFrame([(n, "a b c d e f g h i j k l m n o p q r s t " + "uv"[n % 2]) for n in range(4)], "doc_id bigint, text string")
    assert {row.component_id for row in near.near_copies(docs).collect()} == {0}
    assert seen["profiles"] <= 1000 and seen["candidate-tokens"] <= 1000 < int(before) == int(spark.conf.get(setting))
