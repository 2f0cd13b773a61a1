"""Phrases against counting in memory, the tiles against a dictionary, and the query against its SQL."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import differences

from meterline.llm import collocations as phrases
from meterline.llm.queries import QUERIES
from meterline.llm.sql import ORACLE_SQL

SCHEMA = "text string, lang string, rank string, phrase int, chunk int, word string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def best_phrases(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for at in range(len(words) - size + 1):
                    one = (lang, *words[at : at + size])
                    counts[one] = counts.get(one, 0) + 1
    candidates = {one: f for one, f in counts.items() if len(one) > 2 and f >= least}
    listed = {}
    for (lang, *words), a in candidates.items():
        if any(
            other[0] == lang and len(other) > len(words) + 1 and 100 * f >= 50 * a
            and any(list(other[at : at + len(words)]) == words for at in range(1, len(other)))
            for other, f in candidates.items()
        ):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        listed.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, found in listed.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows_of(seed):
    draw = random.Random(seed)
    rows = [(None, "en"), ("", None), (" \t", "de"), (".,;", "de"), ("x" * 40_000, "en"), ("Ab aB AB " * 20, "und"), ("É é é " * 15, None)]
    names = ["the", "of", "A", "new", "york", "city", "ß", "und so", *(f"w{number}" for number in range(30))]
    for _ in range(120):
        text = ""
        for _ in range(draw.randint(0, 40)):
            text += draw.choice(names[: draw.choice([4, 8, 38])]) + draw.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "!\x0b"])
        rows.append((text, draw.choice(["en", "de", None, "und"])))
    return [(*row, "r", 1, 2, "w") for row in rows + rows[10:40]]


@pytest.mark.parametrize("seed, chunk_words, bucket_pairs, top", [(1, 100, 50, 2000), (2, 1 << 21, 1_500_000, 7), (3, 700, 200, 40)])
def test_phrases(spark, monkeypatch, seed, chunk_words, bucket_pairs, top):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk_words)
    monkeypatch.setattr(phrases, "BUCKET_PAIRS", bucket_pairs)
    rows = rows_of(seed)
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least=4, top=top).collect()
    expected = best_phrases(rows, 4, top)
    assert len(expected) > 20 and sorted(map(tuple, found)) == expected


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(docs).collect() == []
    docs = spark.createDataFrame([(None, None, "r", 1, 2, "w"), ("rare words", "en", "r", 1, 2, "w")], SCHEMA)
    assert phrases.collocations(docs).collect() == []


def test_dense_and_sparse_tiles_count_alike():
    draw = np.random.default_rng(5)
    first, second = (np.minimum(draw.zipf(1.3, 20_000), 5_000) for _ in range(2))
    expected = Counter(zip(first.tolist(), second.tolist()))
    for dense_pairs in (1, 40, 1 << 40):
        a, b, n = phrases.count_pairs(first, second, tile=64, dense_pairs=dense_pairs)
        assert len(a) == len(expected) and dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == expected


def test_ranks_over_several_tasks(spark):
    rows = spark.range(0, 5000, numPartitions=7).selectExpr("id AS name", "id % 50 AS f")
    found = phrases.ranked(rows, rows.f.desc(), rows.name).orderBy("id").collect()
    assert [row.id for row in found] == list(range(5000))
    assert [(row.f, row.name) for row in found] == sorted(((row.f, row.name) for row in found), key=lambda one: (-one[0], one[1]))


def test_products_beyond_64_bits(spark):
    a, left, right = 10**13 - 1, 3 * 10**13, 2 * 10**13 + 7
    frame = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    assert frame.select(phrases._score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (left * right)


def test_sql(spark, sf_dir):
    assert differences(spark, sf_dir, QUERIES["op13_collocations"], ORACLE_SQL["op13_collocations"]) is None
