"""Base spans against the patterns as written, the tagger, and redaction."""

from __future__ import annotations

import random
import re

import pytest

from meterline.llm import private_data as private

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + place % 2) for place, d in enumerate(reversed(digits))]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    return [
        (kind, *match.span()) for kind, pattern in PATTERNS.items() for match in re.finditer(pattern, text or "") if passes(kind, match[0])
    ]


FIXED = [
    None, "", "x", "a@b.c", "a@b@c.d.e", "@b.c", "a@b.c@d.e", "me@x.org, you@y.org.", "1.2.3.4.5.6.7.8", "1.2.3.256", "001.2.3.4",
    "9" * 4000, "4111 1111-1111 1111", "4111111111111112", "+1 (415) 555-2671.", "+1234567", "é +49 30 901820 ü a.b%c@d-e.fr", "..@..", "a@b..c",
]


def test_base_spans_are_those_of_the_patterns():
    draw = random.Random(1)
    parts = ["a", "@", ".", "b.c", "1", "23", "4.5.6.7", "+1 ", "(415)", "-", " ", "4111111111111111", "%", "é", "\n", "255."]
    for text in FIXED + ["".join(draw.choice(parts) for _ in range(draw.randint(1, 25))) for _ in range(6000)]:
        assert private.base_spans(text) == plain_spans(text), text


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    return docs, private.train(docs)


def test_tagger_finds_held_out_spans_and_leaves_other_text_alone(trained):
    docs, tagger = trained
    draw = random.Random(5)
    words = "thing of the and was ereason ontion ingly that ofthe rest".split()
    texts, hidden = [], []
    for n in range(200):
        secret = draw.choice(
            [f"{draw.choice('abcdef') * 5}.{n}@mail{n % 9}.example.com", f"{draw.randint(1, 250)}.{draw.randint(1, 250)}.{n}.{draw.randint(1, 250)}",
             f"+1 ({draw.randint(200, 999)}) {draw.randint(200, 999)}-{draw.randint(1000, 9999)}"]
        )
        before = " ".join(draw.choice(words) for _ in range(draw.randint(0, 60))) + " "
        texts.append(before + secret + " " + " ".join(draw.choice(words) for _ in range(20)))
        hidden.append((len(before), len(before) + len(secret)))
    found = private.tagged_spans(tagger, texts)
    hit = sum(any((start, end) == span for _, start, end in spans) for span, spans in zip(hidden, found))
    assert hit >= 110
    added = [span for _, spans in private.all_spans([" ".join(draw.choice(words) for _ in range(300)) + " 12 in 1999"] * 3, tagger) for span in spans]
    assert added == []


def test_forms_the_patterns_do_not_know(trained):
    text = "please call (555) 123-4567 today or (212) 555-0187 later"
    (base, added), = private.all_spans([text], trained[1])
    assert base == [] and all(kind == "phone" for kind, _, _ in added)


def test_counts_listing_and_redaction(spark, trained):
    rows = [(n, text, 1) for n, text in enumerate(FIXED)] + [(0, None, 1), (None, "a@b.cd", 1), (99, "w " * 40_000 + "me@x.org", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_email int")
    found = {(row.doc_id, row.base_spans): row for row in private.find_private(docs, trained[1]).collect()}
    for doc_id, text, _ in rows:
        listed = ",".join(f"{kind}:{start}:{end}" for kind, start, end in plain_spans(text))
        row = found[doc_id, listed]
        for kind in private.KINDS:
            assert row[f"n_{kind}"] == sum(span[0] == kind for span in plain_spans(text))
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))
    clean = docs.select("text", private.redactor(trained[1])("text").alias("clean")).collect()
    for row in clean:
        assert (row.clean is None) == (row.text is None)
        assert not private.base_spans(row.clean) or "[" in row.clean
    assert [row.clean for row in clean if row.text == "me@x.org, you@y.org."] == ["[EMAIL], [EMAIL]."]


def test_without_spans_there_is_no_tagger(spark):
    docs = spark.createDataFrame([(1, "no digits"), (2, "year 1999")], "doc_id bigint, text string")
    assert private.train(docs) is None
    assert [row.spans for row in private.find_private(docs, None).collect()] == ["", ""]
    assert private.find_private(docs.limit(0), None).collect() == []


def test_overlapping_spans_are_one_stretch():
    assert private.redacted("ab cd ef", [("ip", 0, 5), ("card", 3, 8)]) == "[IP]"
    assert private.redacted("ab cd ef", [("ip", 0, 2), ("card", 3, 5)]) == "[IP] [CARD] ef"
