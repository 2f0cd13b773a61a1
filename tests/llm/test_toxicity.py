"""The toxicity classifier: held-out accuracy, whole texts, odd tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm import toxicity


def sentences(seed, count, bad):
    draw = random.Random(seed)
    words = [draw.choice("bcdfglmnprst") + draw.choice("aeiou") + draw.choice(["n", "r", "s", "tion", "ing"]) for _ in range(300)]
    out = []
    for n in range(count):
        text = [draw.choice(words) for _ in range(draw.randint(20, 120))]
        toxic = n % 5 == 0
        if toxic:
            for _ in range(2):
                text.insert(draw.randrange(len(text)), draw.choice(bad) + draw.choice(["", ".", "s", "ung"]))
        out.append((" ".join(text), int(toxic), draw.choice(["en", "de", None])))
    return out


@pytest.fixture(scope="module")
def model():
    return toxicity.fit(*map(list, zip(*sentences(1, 1500, ["vileword", "grimterm", "hateful"]))))


def scores(model, texts):
    return model.scores(pa.array(texts, pa.string()), toxicity.Vocabulary()).tolist()


def test_held_out_rows_are_told_apart(model):
    rows = sentences(1, 2500, ["vileword", "grimterm", "hateful"])[1500:]
    found = scores(model, [text for text, _, _ in rows])
    right = sum((score >= 0.5) == bool(label) for score, (_, label, _) in zip(found, rows))
    assert right >= 0.97 * len(rows)


def test_the_whole_text_is_read_and_neighbours_do_not_matter(model):
    far = "calm " * 50_000
    together = scores(model, [far + "vileword hateful", far, None, "", "vileword hateful"])
    assert together[0] > 0.5 > together[1] and together[2] == together[3]
    alone = [scores(model, [text])[0] for text in (far + "vileword hateful", far, None, "", "vileword hateful")]
    assert together == pytest.approx(alone, abs=1e-5)


def test_without_labels_of_both_kinds_the_share_is_the_score():
    assert toxicity.fit(["a", "b"], [1, 1], ["en", "en"]).constant == 1.0
    assert toxicity.fit([], [], []).constant == 0.0


def test_rows_held_out_and_odd_tables(spark, model):
    schema = "doc_id bigint, text string, score string"
    rows = [(n, "calm day", "x") for n in range(40)] + [(None, None, "x"), (1, "hateful vileword", "x")]
    docs = spark.createDataFrame(rows, schema)
    found = toxicity.toxicity(docs, model).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1
    empty = spark.createDataFrame([], schema)
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    untaught = toxicity.train(empty, labels)
    assert toxicity.toxicity(empty, untaught).collect() == []
    assert toxicity.drop_toxic(docs, untaught).count() == len(rows)


def test_labels_of_held_out_rows_are_not_learnt_from(spark):
    docs = spark.createDataFrame([(n, "text", "en") for n in range(100)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(n, int(zlib.crc32(str(n).encode()) % 5 == 0)) for n in range(100)], "doc_id bigint, toxic int")
    assert toxicity.train(docs, labels).constant == 0.0


def test_documents(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    found = toxicity.toxicity(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([row.predicted for row in found if row.toxic == label] for label in (1, 0))
    # Calling every row clean is right on nine in ten and gets one half here.
    assert len(toxic) > 40 and sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.03, (sum(toxic), len(toxic), sum(clean), len(clean))


def test_training_reads_long_texts_and_stops_at_its_bound(monkeypatch):
    long_one = "calm " * 40_000 + "hateful"
    rows = sentences(1, 300, ["hateful"]) + [(long_one, 1, "en")]
    batch = pa.RecordBatch.from_arrays(list(map(pa.array, zip(*((text, lang, label) for text, label, lang in rows)))), names=["text", "lang", "label"])
    read = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, languages: read.append((texts.to_pylist(), labels, languages)))
    toxicity._fit_batches(iter([batch, batch]))
    assert len(read[0][0]) == len(read[0][1]) == len(read[0][2]) == 602 and long_one in read[0][0]
    monkeypatch.setattr(toxicity, "TRAINING_BYTES", 1000)
    toxicity._fit_batches(iter([batch, batch]))
    assert 1 <= len(read[1][0]) < 20


def test_all_labelled_rows_are_learnt_from(spark, monkeypatch):
    # Each of many words marks a few rows only, so a model that saw a part of the rows misses most of the others.
    marks = [f"{a}{b}{c}xq" for a in "bdfg" for b in "aeio" for c in "klmn"]
    rows = [(n, text + (f" {marks[n % 64]} {marks[n % 64]}" if label else ""), lang, label)
            for n, (text, label, lang) in enumerate(sentences(3, 4000, ["mild"]))]
    docs = spark.createDataFrame([row[:3] for row in rows], "doc_id bigint, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(n, label) for n, _, _, label in rows], "doc_id bigint, toxic int")
    whole = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "TRAINING_ROWS", 800)
    monkeypatch.setattr(toxicity, "SPREAD_PASSES", 8)
    spread = toxicity.train(docs, labels)
    assert spread.constant is None and set(spread.thresholds) == set(whole.thresholds) == {"en", "de"}
    held = [(text, label) for n, text, _, label in rows if zlib.crc32(str(n).encode()) % 5 == 0]
    found = scores(spread, [text for text, _ in held])
    assert sum((score >= 0.5) == bool(label) for score, (_, label) in zip(found, held)) >= 0.97 * len(held)
    read = []
    monkeypatch.setattr(toxicity, "_fit_spread", lambda rows: read.append(rows.select("id", "label").collect()))
    toxicity.train(docs, labels)
    assert sorted(read[0]) == [(n, label) for n, _, _, label in rows if zlib.crc32(str(n).encode()) % 5]


def test_spread_rows_are_in_shards_of_the_stated_size(spark, monkeypatch):
    rows = [(n, f"text {n}", n % 2) for n in range(1000)]
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, label) for n, _, label in rows], "doc_id bigint, toxic int")
    read = []
    monkeypatch.setattr(toxicity, "TRAINING_ROWS", 20)
    monkeypatch.setattr(toxicity, "_fit_spread", lambda rows: read.extend(rows.withColumn("at", F.spark_partition_id()).collect()))
    toxicity.train(docs, labels)
    shards = -(-len(read) // 20)
    assert len({row.shard for row in read}) == shards > len({row.lane for row in read}) == toxicity.LANES
    assert len({(row.lane, row.at) for row in read}) == len({row.lane for row in read})


def test_a_lane_gives_one_move_that_counts_its_shards():
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["calm day", "vile day", "calm night", "vile night", "calm"]), pa.array([0, 1, 0, 1, 0]),
         pa.array([0, 0, 0, 0, 1]), pa.array([0, 0, 4, 4, 1])], names=["text", "label", "lane", "shard"],
    )
    table = toxicity._Weights.start(np.random.default_rng(1)).table()
    parts = np.array_split(table, toxicity.WEIGHT_PARTS)
    together = list(toxicity._lane_pass(table, np.float32(0.4), 0)(iter([batch.slice(0, 1), batch.slice(1)])))
    assert len(together) == 2
    apart = [list(toxicity._lane_pass(table, np.float32(0.4), 0)(iter([batch.slice(at, 2)])))[0] for at in (0, 2)]
    for part in (0, toxicity.WEIGHT_PARTS - 1):
        moves = [move for one in apart for number, move in zip(*one.to_pydict().values()) if number == part]
        whole = [move for number, move in zip(*together[0].to_pydict().values()) if number == part]
        one, two = (toxicity._merged_moves(pa.table({"part": [part] * len(some), "move": some})).column("move")[0].as_py() for some in (moves, whole))
        assert np.frombuffer(one, np.float32) == pytest.approx(np.frombuffer(two, np.float32), abs=1e-6)
        assert len(one) == parts[part].nbytes


def test_words_are_hashed_together_as_they_are_alone():
    words = ["\0", "", "a", "--a--", "__x_", "Ä", "ÄÖÜß!", "İstanbul", "ΣΑΣ", "x" * 64, "y" * 65, "Z" * 9999, "日本語テキスト", "«mot»", "\0a\0", "...", "é" * 70, "²³"]
    found = toxicity.Vocabulary().rows(pa.array(words)).tolist()
    assert found == [list(toxicity.word_hashes(word)) for word in words]
    assert toxicity.Vocabulary().rows(pa.array([], pa.string())).shape == (0, 4)
