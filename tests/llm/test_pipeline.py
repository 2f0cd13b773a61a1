"""The pipeline against the same decisions taken in memory, and the registered queries against their SQL."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from compare import differences
from meterline.llm import private_data, sql, toxicity
from test_exact_copies import bare
from test_near_copies import brute_force


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "pii", "best_fit_packing"]


def test_run_gives_the_pieces_of_what_a_plain_version_keeps(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rejected = {row.doc_id for row in toxicity.toxicity(docs, model).where("rejected").collect()}
    rows = {row.doc_id: row.text for row in docs.collect() if row.doc_id not in rejected}
    best = {}
    for doc_id, text in rows.items():
        key = bare(text)
        best[key] = min(best.get(key, (0, doc_id)), (-len(text or ""), doc_id))
    rows = {doc_id: rows[doc_id] for _, doc_id in best.values()}
    rows = {doc_id: rows[doc_id] for doc_id, size, component in brute_force(list(rows.items()), 5, 80) if not size or doc_id == component}
    kept = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    tagger = private_data.train(kept)
    spans = private_data.all_spans([text or "" for text in rows.values()], tagger)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = set()
    for (doc_id, text), (base, added) in zip(rows.items(), spans):
        ids = [*tokenizer.encode(private_data.redacted(text or "", [*base, *added]), add_special_tokens=False).ids, 1]
        for number, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected.add((doc_id, number, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == expected and len(found) == len(expected)


def test_every_stage_but_the_last_returns_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs.limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.dtypes == docs.dtypes


@pytest.mark.parametrize("name", sorted(sql.ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, name):
    assert differences(spark, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in entry.queries() if name.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
