"""Periodic runs against trying every period, and the grammar against the words it stands for."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from meterline.llm import periodic_runs as runs_of

WORDS = re.compile("[^\x20\x09-\x0d]+")


def runs_by_trial(words):
    """``start, length, period`` of every run, by comparing the words with themselves at each distance."""
    found = {}
    for period in range(1, len(words) // 3 + 1):
        start = None
        for place in range(len(words) - period + 1):
            same = place + period < len(words) and words[place] == words[place + period]
            if same and start is None:
                start = place
            if not same and start is not None:
                length = place + period - start
                if length >= max(24, 3 * period):
                    found.setdefault((start, length), period)
                start = None
    return sorted((start, length, period) for (start, length), period in found.items())


def periodic_texts(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(12):
        letters = draw.choice([1, 2, 2, 3, 5, 40])
        size, words = draw.choice([0, 3, 23, 24, 60, 200]), []
        while len(words) < size:
            block = [draw.randrange(letters) for _ in range(draw.randint(1, 15))]
            words += (block * draw.randint(1, 30))[: draw.randint(1, 150)]
            words += [draw.randrange(letters) for _ in range(draw.randint(0, 4))]
        texts.append(list(draw.choice(texts)) if texts and draw.random() < 0.3 else words)
    return texts


@pytest.mark.parametrize("seed", range(40))
def test_runs(seed):
    texts = periodic_texts(seed)
    ends = np.cumsum([len(words) for words in texts])
    start, end, period = runs_of.find_runs(np.array([word for words in texts for word in words], dtype=np.int32), ends)
    expected, low = [], 0
    for words in texts:
        expected += [(first + low, first + length + low, distance) for first, length, distance in runs_by_trial(words)]
        low += len(words)
    assert list(zip(start.tolist(), end.tolist(), period.tolist())) == sorted(expected, key=lambda run: (run[0], run[2]))


def test_the_grammar_repeats_no_pair_and_derives_the_words():
    words = np.array([1, 2, 3, 4] * 300 + [7] * 500 + list(range(10, 400)) + [1, 2, 3, 4] * 9, dtype=np.int32)
    grammar = runs_of.compress(words, np.array([1200, len(words)]))
    assert len(grammar.rest) < 450
    for rule in np.flatnonzero(grammar.length >= runs_of.LEAST_WORDS):
        first, length = grammar.first[rule], grammar.length[rule]
        places = grammar.places[0 if rule == 0 else grammar.place_ends[rule - 1] : grammar.place_ends[rule]]
        assert len(places) > 1 and all((words[at : at + length] == words[first : first + length]).all() for at in places)


def expected_row(doc_id, text, rewrite):
    words = WORDS.findall(text or "")
    n = len(words)
    if rewrite and n and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % period] for i in range(n)]
    found = runs_by_trial(words)
    gone = {place for start, length, period in found for place in range(start + period, start + length)}
    kept = " ".join(word for place, word in enumerate(words) if place not in gone)
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in sorted(found, key=lambda run: (run[0], run[2])))
    best = min(found, key=lambda run: (-run[1] / run[2], run[0], run[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, n, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_documents(spark):
    draw = random.Random(3)
    texts = [None, "", " \t\n", "é", "a " * 23, "a " * 24, "\x0ba\x0cb\r" * 20, "ab cd " * 30, "x" * 50_000]
    texts += [" ".join(map(str, words)) for seed in range(6) for words in periodic_texts(seed)]
    rows = [(draw.choice([None, *range(400)]), text, "n", 1) for text in texts for _ in range(2)]
    rows += [(number, "one two three four five " * 8, "n", 1) for number in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_runs string, period int")
    for rewrite in (False, True):
        found = runs_of.periodic_runs(docs, rewrite=rewrite).collect()
        expected = [expected_row(doc_id, text, rewrite) for doc_id, text, *_ in rows]
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert runs_of.periodic_runs(docs.limit(0)).collect() == []
