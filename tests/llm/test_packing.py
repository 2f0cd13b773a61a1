"""Packing: tokens against the library, bins without gaps, and how full they are."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from meterline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = [
    "a", "B", "é", "É", "İ", "ß", " ", "\n", "\t", " ", ".", ",", "'s", "'", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "1", "23", "²", "日", "é",
    "́", "\x0b", "\x1c", "!", "..", "Σ", "ς", "a.b", "foo.", "Foo,,",
]


def test_ids_are_the_librarys(monkeypatch):
    draw = random.Random(2)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(4000)] + ["", None]
    expected = [encoded.ids + [1] for encoded in LIBRARY.encode_batch([text or "" for text in texts], add_special_tokens=False)]
    for room in (packing.KNOWN_WORDS, 300):
        monkeypatch.setattr(packing, "KNOWN_WORDS", room)
        words = packing.WordIds(LIBRARY)
        found = [ids for at in range(0, len(texts), 100) for ids in words.encode(pa.array(texts[at : at + 100], pa.string()), 1)]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == expected


def test_fullest_combination_is_the_fullest():
    draw = random.Random(3)
    for _ in range(200):
        counts = Counter(draw.randint(1, 30) for _ in range(draw.randint(1, 9)))
        room = draw.randint(0, 60)
        pieces = list(counts.elements())
        best = max(sum(some) for n in range(len(pieces) + 1) for some in itertools.combinations(pieces, n) if sum(some) <= room)
        chosen = packing.fullest(sorted(counts, reverse=True), dict(counts), room)
        assert sum(chosen) == best and not Counter(chosen) - counts


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_and_fills_bins(seed):
    draw = random.Random(seed)
    counts = Counter(min(4095, int(draw.lognormvariate(6, 1)) + 1) for _ in range(4000))
    plan = packing.plan_bins(dict(counts), 4096)
    placed = Counter()
    for times, combination in plan:
        assert sum(length * number for length, number in combination.items()) <= 4096
        for length, number in combination.items():
            placed[length] += times * number
    assert placed == counts
    assert sum(times for times, _ in plan) <= 1.01 * sum(length * number for length, number in counts.items()) / 4096 + 1


def check(spark, rows, sequence_tokens):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    found = packing.pack(packing.token_pieces(docs, PATH, sequence_tokens=sequence_tokens), sequence_tokens).collect()
    expected = []
    for doc_id, text, _ in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        for number, at in enumerate(range(0, len(ids), sequence_tokens)):
            part = np.array(ids[at : at + sequence_tokens], dtype="<u4").tobytes()
            expected.append((doc_id, number, at, len(part) // 4, zlib.crc32(part)))
    key = str
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=key) == sorted(expected, key=key)
    bins = defaultdict(list)
    for row in found:
        bins[row.sequence_id].append((row.offset, row.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence_tokens
    return len(bins), sum(row.length for row in found)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b c", "x"), (3, "word " * 3000, "x"), (3, "word " * 3000, "x"), (4, "a " * 49, "x")]
    rows += [(n, "same text here", "x") for n in range(10, 150)]
    bins, tokens = check(spark, rows, 50)
    assert bins <= 1.02 * tokens / 50 + 1


def test_empty_table(spark):
    assert check(spark, [], 4096) == (0, 0)


def test_documents(spark, sf_dir):
    rows = [(row.doc_id, row.text, None) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    bins, tokens = check(spark, rows, 4096)
    assert bins <= 1.01 * tokens / 4096 + 1
