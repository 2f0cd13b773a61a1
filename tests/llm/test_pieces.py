"""Piece encoding against the sentencepiece library, and spans against the source bytes."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from meterline.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = pieces.load_model(PATH)
ODD = [
    "", " ", "  a", "a  b ", "\n", "\n\n a", "▁x ▁", "日本語 😀 text\t\x00", "á é ß", "   ", "x\n  y", "x \n y\n", "<s> </s> <unk> <0x41>",
    "ä" * 50, " \n ", "é", "a" * 300, "​﻿ x", "  \n\n  ",
]


def some_texts(count, seed=1):
    draw = random.Random(seed)
    return ODD + ["".join(draw.choice("ab \n▁ é日😀\t  <") for _ in range(draw.randint(1, 30))) for _ in range(count)]


def encoded(encoder, texts):
    sizes, ids, starts, ends = encoder.encode_array(pa.array(texts, pa.string()))
    edges = np.cumsum(sizes)
    return [(ids[b - n : b].tolist(), starts[b - n : b], ends[b - n : b]) for n, b in zip(sizes, edges)]


def test_ids_are_the_librarys_by_own_merging_and_by_its():
    texts = some_texts(1500)
    expected = LIBRARY.encode(texts)
    own = pieces.Encoder(MODEL)
    fast = pieces.Encoder(MODEL, lambda many: LIBRARY.encode(many, num_threads=1))
    assert [ids for ids, _, _ in encoded(own, texts)] == expected
    assert [ids for ids, _, _ in encoded(fast, texts)] == expected


def test_spans_cover_the_source_bytes_in_order():
    texts = some_texts(500)
    for text, (ids, starts, ends) in zip(texts, encoded(pieces.Encoder(MODEL), texts)):
        source = text.encode("utf-8")
        if ids:
            assert starts[0] == 0 and ends[-1] == len(source) and (starts[1:] == ends[:-1]).all()
        for number, start, end in zip(ids, starts, ends):
            kind, piece = MODEL.kinds[number], MODEL.pieces[number]
            if kind != pieces.BYTE:
                shown = source[start:end].decode("utf-8").replace(" ", pieces.WORD_MARK)
                assert shown in (piece, piece[1:])


def test_decoding_is_the_librarys_for_any_ids():
    draw = random.Random(2)
    decoder = pieces.Decoder(MODEL)
    rows = [
        [draw.choice([3 + draw.randrange(256), draw.randrange(32000), 0, 1, 2, 28705]) for _ in range(draw.randint(0, 8))] for _ in range(1500)
    ]
    expected = [LIBRARY.decode(row) for row in rows]
    assert [decoder.decode(row) for row in rows] == expected
    assert decoder.decode_many([np.array(row, dtype=np.int32) for row in rows]) == expected


def test_full_store_starts_afresh(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_CUTS", 5)
    encoder = pieces.Encoder(MODEL)
    for text in ("a b c d", "e f g h", "a b c d e f g h i j"):
        assert encoded(encoder, [text])[0][0] == LIBRARY.encode(text)


def character_map(entries: dict[bytes, bytes]) -> bytes:
    """A compiled map: a double array laid out with a block of 256 units per trie node."""
    replacements, places = bytearray(), {}
    for key, value in entries.items():
        places[key] = len(replacements)
        replacements += value + b"\0"
    nodes = sorted({key[:n] for key in entries for n in range(len(key) + 1)}, key=lambda key: (len(key), key))
    base = {node: 256 * (number + 1) for number, node in enumerate(nodes)}
    units = [0] * (256 * (len(nodes) + 1))

    def unit(at, target, label, leaf):
        offset = at ^ target
        units[at] = (offset << 10 if offset < 1 << 21 else offset << 2 | 512) | label | (256 if leaf else 0)

    unit(0, base[b""], 0, False)
    for node in nodes:
        if node in places:
            units[base[node]] = places[node] | 1 << 31
        if node:
            unit(base[node[:-1]] ^ node[-1], base[node], node[-1], node in places)
    data = b"".join(number.to_bytes(4, "little") for number in units)
    return len(data).to_bytes(4, "little") + data + bytes(replacements)


def test_longest_prefix_of_the_character_map_and_where_it_came_from():
    entries = {"ﬁ".encode(): b"fi", b"a": b"A", b"ab": b"X", "é".encode(): "é".encode(), b"\t": b" ", b"z": b""}
    model = pieces.load_model(PATH)
    known = pieces.CharacterMap(character_map(entries))
    draw = random.Random(3)
    keys = sorted((key.decode() for key in entries), key=len, reverse=True)
    for _ in range(300):
        text = "".join(draw.choice(["ﬁ", "a", "b", "é", "\t", "z", "q", " "]) for _ in range(draw.randint(1, 10)))
        own = pieces.PieceModel.__new__(pieces.PieceModel)
        own.__dict__ = {**model.__dict__, "map": known, "trim": False, "dummy_prefix": False}
        normal, align = own.normalise(text)
        expected, origin, at = "", [], 0
        while at < len(text):
            key = next((key for key in keys if text.startswith(key, at)), text[at])
            value = entries[key.encode()].decode() if key.encode() in entries else key
            start = len(text[:at].encode())
            shown = value.replace(" ", pieces.WORD_MARK)
            same = value == key
            origin += [start + (n if same and value != " " else 0) for n in range(len(shown.encode()))]
            expected += shown
            at += len(key)
        assert normal == expected
        assert align[:-1] == origin


def test_odd_tables(spark):
    assert pieces.encode(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []
    rows = [(1, None, "i"), (1, None, "i"), (None, "a b", "j"), (2, "", "k"), (3, "x " * 60_000, "l")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = pieces.encode(docs, PATH, round_trip=True).collect()
    assert sorted((row.doc_id is None, row.doc_id or 0, row.decoded) for row in found) == sorted(
        (doc_id is None, doc_id or 0, text or "") for doc_id, text, _ in rows
    )
    decoded = pieces.encode(docs, PATH).select("ids", pieces.decoder(PATH)("ids").alias("text")).collect()
    assert all(row.text == LIBRARY.decode(row.ids) for row in decoded)
