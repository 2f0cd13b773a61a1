"""Counts against plain Python, and the estimation of what votes are worth."""

from __future__ import annotations

import random
import re

from meterline.llm import quality_rules as quality

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain_counts(text):
    text = text or ""
    words = [word for word in re.split("[ \t\n\x0b\x0c\r]+", text) if word]
    lines = [line for line in text.split("\n") if re.search("[^ \t\n\x0b\x0c\r]", line)]
    windows = {}
    for place in range(len(words) - 2):
        windows.setdefault(tuple(words[place : place + 3]), []).append(place)
    covered = {place + step for places in windows.values() if len(places) > 1 for place in places for step in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(sign) for sign in quality.SYMBOLS), len(lines) - len(set(lines)), len(covered)


def texts(seed):
    draw = random.Random(seed)
    out = [None, "", " ", "\n\n", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\n x\nx\r\nx\r", "#*$%&|<>!", "é ü é", "w " * 30_000]
    for _ in range(150):
        out.append("".join(draw.choice(["a ", "b ", "c ", "d\n", "# ", "\t", "é", "!"]) for _ in range(draw.randint(1, 90))))
    return out


def test_counts_and_base_checks(spark):
    rows = [(number, text, True) for number, text in enumerate(texts(1))] + [(None, "null id", True), (3, "\n\n", True)]
    found = quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, kept boolean")).collect()
    by_id = {(row.doc_id, row.word_chars): row for row in found}
    assert len(found) == len(rows)
    for doc_id, text, _ in rows:
        counts = plain_counts(text)
        row = by_id[doc_id, counts[1]]
        assert tuple(row[name] for name in COUNTS) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert row.base_failed == failed and not (failed and row.kept)


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def drawn(seed, rates, share, count):
    """Counted vote patterns of rules that call good and bad documents bad at the given rates."""
    draw = random.Random(seed)
    patterns = {}
    for _ in range(count):
        good = draw.random() < share
        pattern = "".join(
            quality.SILENT if draw.random() < 0.1 else quality.BAD if draw.random() < rate[0 if good else 1] else quality.GOOD for rate in rates
        )
        patterns[pattern] = patterns.get(pattern, 0) + 1
    return patterns


def test_estimation_finds_share_and_rates():
    rates = [(0.004, 0.8), (0.004, 0.5), (0.004, 0.3), (0.004, 0.6)]
    found = quality.estimate(drawn(1, rates, 0.85, 20_000), ["a", "b", "c", "d"])
    assert abs(found.share - 0.85) < 0.03
    for name, (_, of_bad) in zip("abcd", rates):
        assert abs(found.calls_bad[name][1] - of_bad) < 0.15
    assert found.posterior("gggg") > 0.9 and found.posterior("bbgg") < 0.1 and found.posterior("----") > 0.5


def test_a_rule_that_tells_nothing_does_not_decide_alone():
    rates = [(0.004, 0.9), (0.004, 0.9), (0.004, 0.9), (0.03, 0.05)]
    found = quality.estimate(drawn(2, rates, 0.8, 20_000), ["a", "b", "c", "idle"])
    assert found.posterior("gggb") > 0.5 > found.posterior("bbbg")


def test_no_documents():
    assert quality.estimate({}, ["a"]).posterior("g") > 0.5


def test_clean_documents_stay_and_junk_goes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/labels.parquet").select("doc_id", labelled_good := "quality")
    judged = quality.judge(docs).drop(labelled_good).join(labels, "doc_id").where("NOT base_failed").collect()
    kept = {value: [row.kept for row in judged if row.quality == value] for value in (0, 1)}
    assert sum(kept[1]) >= 0.98 * len(kept[1]) and sum(kept[0]) <= 0.2 * len(kept[0])


def test_nothing_runs_in_python(spark, sf_dir):
    plan = quality.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
