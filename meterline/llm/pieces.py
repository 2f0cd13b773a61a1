"""SentencePiece encoding with byte offsets, and decoding.

A text is normalised by the longest prefix that the model's compiled character map knows at each place; every
normalised byte remembers the source byte it came from. The normalised text is cut where no piece can reach
across (before a run of word marks, and around characters that occur in no longer piece), each cut is merged by
piece score, best first and leftmost on ties, and every piece is projected back to a span of source bytes.
Words repeat, so each worker keeps the cuts it has merged. Where the character map changes nothing but spaces, as
an empty map does, cuts not met before are merged by the sentencepiece library, many at a time; any other text is
normalised and merged here.

Models: BPE with or without byte fallback. A null or empty text has no pieces and decodes to an empty text. Texts
of any length are taken whole, a batch at a time. Rows keep their order and repeats; an empty table gives an empty
result. Input columns are not passed on except the id, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_MARK = "▁"

# Piece kinds of a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2
UNKNOWN_TEXT = " ⁇ "

# Merged cuts a worker keeps at most; the store starts afresh beyond that.
KNOWN_CUTS = 600_000
# Bytes of text whose result is built at a time.
BATCH_BYTES = 2_000_000


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """A compiled map: a double-array trie over source bytes, and the replacements its leaves point at."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.replacements = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix at ``at`` and what replaces it."""
        units = self.units
        if not units:
            return None
        node, found = self._offset(units[0]), None
        for position in range(at, len(source)):
            node ^= source[position]
            if node >= len(units) or units[node] & 0x800000FF != source[position]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = position + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.replacements[start : self.replacements.index(b"\0", start)]


class PieceModel:
    """What a model file says about normalisation, merging and decoding."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer: dict[int, object] = {}
        normaliser: dict[int, object] = {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode("utf-8"))
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3, 1) != BPE_MODEL or UNUSED in self.kinds:
            raise ValueError("only BPE models without unused pieces can be used")
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix_marks = bool(trainer.get(24, 0))
        self.map = CharacterMap(normaliser.get(2, b""))
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.trim = bool(normaliser.get(4, 1))
        self.escape = bool(normaliser.get(5, 1))
        if self.suffix_marks or not self.escape:
            raise ValueError("only models that mark words at their start can be used")
        self.ids = {piece: number for number, piece in enumerate(self.pieces) if self.kinds[number] in (NORMAL, USER_DEFINED)}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, kind in enumerate(self.kinds) if kind == BYTE}
        longer = [piece for piece in self.ids if len(piece) > 1]
        self.joined = set("".join(longer))
        self.crossing = any(WORD_MARK in piece.lstrip(WORD_MARK) for piece in longer)
        fixed = sorted((p for p, i in self.ids.items() if self.kinds[i] == USER_DEFINED), key=len, reverse=True)
        self.fixed = re.compile("|".join(map(re.escape, fixed))) if fixed else None
        self.plain = not self.map.units and not self.trim and self.dummy_prefix and not self.crossing and not fixed
        self.cut = re.compile(f"{WORD_MARK}*[^{WORD_MARK}]+|{WORD_MARK}+")

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, and for each of its bytes (and its end) the source byte it came from."""
        source = text.encode("utf-8")
        mark = WORD_MARK.encode("utf-8")
        chunks: list[tuple[bytes, int, int]] = []
        at = 0
        while at < len(source):
            known = self.map.longest(source, at)
            if known is None:
                first = source[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                known = size, source[at : at + size]
            chunks.append((known[1], at, at + known[0]))
            at += known[0]
        if self.trim:
            while chunks and chunks[0][0].strip(b" ") == b"":
                chunks.pop(0)
        out = bytearray()
        align: list[int] = []
        if chunks and self.dummy_prefix:
            out += mark
            align += [chunks[0][1]] * len(mark)
        after_space = self.trim
        end = chunks[0][1] if chunks else 0
        for value, start, stop in chunks:
            if self.trim and after_space:
                value = value.lstrip(b" ")
            same = value == source[start:stop]
            for position, byte in enumerate(value):
                place = start + position if same else start
                if byte == 0x20:
                    out += mark
                    align += [place] * len(mark)
                else:
                    out.append(byte)
                    align.append(place)
            if value:
                after_space = self.trim and value.endswith(b" ")
                end = stop
        if self.trim:
            while out.endswith(mark):
                del out[-len(mark) :]
                end = align[-len(mark)]
                del align[-len(mark) :]
        return out.decode("utf-8"), [*align, end]

    def merge(self, cut: str) -> list[int]:
        """Ids of one cut: neighbours are joined by the best score, the leftmost first."""
        symbols: list[str | None] = []
        frozen: set[int] = set()
        if self.fixed:
            at = 0
            for match in self.fixed.finditer(cut):
                symbols += cut[at : match.start()]
                frozen.add(len(symbols))
                symbols.append(match[0])
                at = match.end()
            symbols += cut[at:]
        else:
            symbols += cut
        ids, scores = self.ids, self.scores
        left = list(range(-1, len(symbols) - 1))
        right = [*range(1, len(symbols)), -1]
        agenda: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a < 0 or b < 0 or a in frozen or b in frozen:
                return
            joined = symbols[a] + symbols[b]
            number = ids.get(joined)
            if number is not None:
                heapq.heappush(agenda, (-scores[number], a, b, joined))

        for position in range(len(symbols) - 1):
            offer(position, position + 1)
        while agenda:
            _, a, b, joined = heapq.heappop(agenda)
            if symbols[a] is None or symbols[b] is None or symbols[a] + symbols[b] != joined:
                continue
            symbols[a], symbols[b] = joined, None
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        out: list[int] = []
        for symbol in symbols:
            if symbol is None:
                continue
            number = ids.get(symbol)
            if number is not None:
                out.append(number)
            elif self.byte_fallback:
                out += [self.bytes[byte] for byte in symbol.encode("utf-8")]
            else:
                out.append(self.unknown)
        return out


class Encoder:
    """Encodes texts to ids and source byte spans."""

    def __init__(self, model: PieceModel, merge_many=None):
        """``merge_many`` gives the ids of many texts at once, faster than :meth:`PieceModel.merge` does."""
        import numpy as np

        self.np = np
        self.model = model
        self.merge_many = merge_many or (lambda texts: [self._encode(text)[0].tolist() for text in texts])
        self.known: dict[str, int] = {}
        self.flat: list = []
        self.offsets: list = [np.zeros(1, dtype=np.int64)]
        self.line_end_alone = "\n" not in model.joined
        self.mark_or_line = re.compile(f"\n[^{WORD_MARK}\n]*|{WORD_MARK}+[^{WORD_MARK}\n]*")
        # Source bytes of each piece where normalisation changes nothing but spaces.
        self.widths = np.array(
            [
                1 if kind == BYTE else len(piece.replace(WORD_MARK, " ").encode("utf-8"))
                for piece, kind in zip(model.pieces, model.kinds)
            ],
            dtype=np.int32,
        )
        self.norm_widths = np.array(
            [1 if kind == BYTE else len(piece.encode("utf-8")) for piece, kind in zip(model.pieces, model.kinds)], dtype=np.int64
        )

    def _learn(self, keys: list[str]) -> list[int]:
        """Numbers of cuts, merging those not met before. A cut is known by its text without its first word mark,
        or, if it starts with a line end, by its whole text."""
        np, known = self.np, self.known
        missing = [key for key in keys if key not in known]
        if len(known) + len(missing) > KNOWN_CUTS:
            known.clear()
            self.flat, self.offsets = [], [np.zeros(1, dtype=np.int64)]
            missing = keys
        if missing:
            merged = self.merge_many([key.replace(WORD_MARK, " ") for key in missing])
            lone = self.model.merge(WORD_MARK)
            # A line end is a piece of its own, so the mark the model puts before it is one too and comes off again.
            merged = [ids[1:] if key[:1] == "\n" else ids if key else lone for key, ids in zip(missing, merged)]
            sizes = np.fromiter(map(len, merged), dtype=np.int64, count=len(merged))
            last = self.offsets[-1][-1]
            self.flat.append(np.fromiter(chain.from_iterable(merged), dtype=np.int32, count=int(sizes.sum())))
            self.offsets.append(last + np.cumsum(sizes))
            known.update(zip(missing, range(len(known), len(known) + len(missing))))
        return [known[key] for key in keys]

    def _ids_of(self, cuts, cuts_per_text):
        """Ids of many texts, one after the other, and how many each has; ``cuts`` holds numbers of cuts."""
        np = self.np
        if len(self.flat) > 1:
            self.flat = [np.concatenate(self.flat)]
            self.offsets = [np.concatenate(self.offsets)]
        flat = self.flat[0] if self.flat else np.zeros(0, dtype=np.int32)
        offsets = np.concatenate(self.offsets)
        sizes = (offsets[1:] - offsets[:-1])[cuts]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[cuts] - (ends - sizes), sizes)
        text_ends = np.concatenate([[0], ends])[np.cumsum(cuts_per_text)]
        return flat[places], np.diff(text_ends, prepend=0)

    def _spans_of(self, ids, ids_per_text):
        """Spans where normalisation changed nothing but spaces: widths add up, less the mark put in front."""
        np = self.np
        widths = self.widths[ids]
        first = (np.cumsum(ids_per_text) - ids_per_text)[ids_per_text > 0]
        widths[first] -= 1
        ends = np.cumsum(widths, dtype=np.int64)
        starts = ends - widths
        base = np.repeat(starts[first], ids_per_text[ids_per_text > 0])
        return (starts - base).astype(np.int32), (ends - base).astype(np.int32)

    def encode_array(self, texts):
        """Encodes an Arrow array of texts: how many ids each has, and all ids, span starts and span ends in a row."""
        import pyarrow as pa
        import pyarrow.compute as pc

        np = self.np
        texts = pc.fill_null(texts, "")
        sizes = np.zeros(len(texts), dtype=np.int64)
        parts: list[tuple[int, object, object, object]] = []
        changed = pc.match_substring(texts, WORD_MARK).to_numpy(zero_copy_only=False)
        if not (self.model.plain and self.model.byte_fallback and self.line_end_alone):
            changed[:] = True
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        spaced = pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")).to_numpy(zero_copy_only=False)

        def keep(rows, cuts, cuts_per_text):
            ids, counts = self._ids_of(cuts, cuts_per_text)
            starts, ends = self._spans_of(ids, counts)
            sizes[rows] = counts
            edges = np.cumsum(counts) - counts
            parts.extend((row, ids[a : a + n], starts[a : a + n], ends[a : a + n]) for row, a, n in zip(rows, edges, counts))

        rows = np.flatnonzero(~changed & ~spaced & ~empty)
        if len(rows):
            words = pc.split_pattern(pc.replace_substring(texts.take(pa.array(rows)), "\n", " \n"), " ")
            coded = words.flatten().dictionary_encode()
            numbers = np.array(self._learn(coded.dictionary.to_pylist()), dtype=np.int64)
            keep(rows, numbers[coded.indices.to_numpy()], pc.list_value_length(words).to_numpy())
        rows = np.flatnonzero(~changed & spaced & ~empty)
        if len(rows):
            cuts = [
                [cut if cut[0] == "\n" else cut[1:] for cut in self.mark_or_line.findall(WORD_MARK + text.replace(" ", WORD_MARK))]
                for text in texts.take(pa.array(rows)).to_pylist()
            ]
            every = list(set().union(*cuts))
            numbers = dict(zip(every, self._learn(every)))
            keep(rows, np.array([numbers[cut] for own in cuts for cut in own], dtype=np.int64), np.array(list(map(len, cuts))))
        for row in np.flatnonzero(changed & ~empty):
            ids, starts, ends = self._encode(texts[int(row)].as_py())
            sizes[row] = len(ids)
            parts.append((row, ids, starts, ends))
        parts.sort(key=lambda part: part[0])
        nothing = np.zeros(0, dtype=np.int32)
        return sizes, *[np.concatenate([nothing, *[part[k] for part in parts]]).astype(np.int32) for k in (1, 2, 3)]

    def _encode(self, text: str | None):
        np, model = self.np, self.model
        if not text:
            empty = np.zeros(0, dtype=np.int32)
            return empty, empty, empty
        normal, align = model.normalise(text)
        if not normal:
            empty = np.zeros(0, dtype=np.int32)
            return empty, empty, empty
        cuts = [normal] if model.crossing or model.fixed else model.cut.findall(normal)
        ids: list[int] = []
        places = [0]
        for cut in cuts:
            merged = model.merge(cut)
            ids += merged
            if model.unknown in merged:
                known = [model.merge(character) for character in cut]
                if [number for part in known for number in part] != merged:
                    places += self._places_with_unknown(cut, merged, places[-1])
                    continue
                at = places[-1]
                for character in cut:
                    at += len(character.encode("utf-8"))
                    places.append(at)
                continue
            places += (places[-1] + np.cumsum(self.norm_widths[merged])).tolist()
        align = np.array(align, dtype=np.int32)
        spans = align[np.array(places, dtype=np.int64)]
        return np.array(ids, dtype=np.int32), spans[:-1], spans[1:]

    def _places_with_unknown(self, cut: str, merged: list[int], start: int) -> list[int]:
        """Ends of the pieces of a cut in which single characters are unknown."""
        places, at = [], 0
        for number in merged:
            piece = cut[at] if number == self.model.unknown else self.model.pieces[number]
            at += len(piece)
            start += len(piece.encode("utf-8"))
            places.append(start)
        return places


class Decoder:
    """Ids back to text."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.byte_of = {number: byte for byte, number in model.bytes.items()}
        self.surfaces = []
        for number, (piece, kind) in enumerate(zip(model.pieces, model.kinds)):
            if kind == CONTROL:
                surface = b""
            elif kind == UNKNOWN:
                surface = UNKNOWN_TEXT.encode("utf-8")
            elif kind == BYTE:
                surface = bytes([self.byte_of[number]])
            else:
                surface = piece.replace(WORD_MARK, " ").encode("utf-8")
            self.surfaces.append(surface)
        self.flat = None
        self.controls = [number for number, kind in enumerate(model.kinds) if kind == CONTROL]

    def decode(self, ids: list[int]) -> str:
        return self._text(b"".join(map(self.surfaces.__getitem__, ids)), lambda: ids, any(map(self.is_control, ids)))

    def decode_many(self, rows: list) -> list[str]:
        """Decodes arrays of ids together: one gather of the pieces' bytes."""
        import numpy as np

        if self.flat is None:
            self.flat = np.frombuffer(b"".join(self.surfaces), dtype=np.uint8)
            self.widths = np.fromiter(map(len, self.surfaces), dtype=np.int64, count=len(self.surfaces))
            self.starts = np.cumsum(self.widths) - self.widths
        ids = np.concatenate([np.zeros(0, dtype=np.int32), *rows])
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - widths), widths)
        out = self.flat[places].tobytes()
        edges = np.concatenate([[0], ends])[np.cumsum([0, *map(len, rows)])].tolist()
        broken = np.array(self.controls, dtype=np.int32)
        odd = [bool(len(broken)) and bool(np.isin(row, broken).any()) for row in rows]
        return [self._text(out[a:b], row.tolist, cut) for a, b, row, cut in zip(edges, edges[1:], rows, odd)]

    def is_control(self, number: int) -> bool:
        return self.model.kinds[number] == CONTROL

    def _text(self, out: bytes, ids, cut: bool) -> str:
        """The text of the bytes of some pieces; ``cut`` if a control piece may stand between the bytes of a character."""
        model = self.model
        if not out:
            return ""
        try:
            text = self._decode_with_stray_bytes(ids()) if cut else out.decode("utf-8")
        except UnicodeDecodeError:
            text = self._decode_with_stray_bytes(ids())
        if text[0] not in " \ufffd":
            return text
        first = next((number for number in ids() if model.kinds[number] != CONTROL), None)
        marked = model.kinds[first] in (NORMAL, USER_DEFINED) and model.pieces[first].startswith(WORD_MARK)
        return text[1:] if marked and (model.dummy_prefix or model.trim) else text

    def _decode_with_stray_bytes(self, ids: list[int]) -> str:
        """Each byte that is part of no character becomes U+FFFD."""
        text, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        text.append(bytes(run[at : at + size]).decode("utf-8"))
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    text.append("�")
                    at += 1
            run.clear()

        for number in ids:
            if number in self.byte_of:
                run.append(self.byte_of[number])
            else:
                flush()
                text.append(self.surfaces[number].decode("utf-8"))
        flush()
        return "".join(text)


_LOADED: dict[str, PieceModel] = {}


def load_model(path: str) -> PieceModel:
    """The model of a file, read once per process."""
    if path not in _LOADED:
        with open(path, "rb") as handle:
            _LOADED[path] = PieceModel(handle.read())
    return _LOADED[path]


_ENCODERS: dict[str, Encoder] = {}
_DECODERS: dict[str, Decoder] = {}


def _runs(lengths) -> Iterator[tuple[int, int]]:
    """Runs of rows with about BATCH_BYTES of text each."""
    start = total = 0
    for position, length in enumerate(lengths):
        total += length
        if total >= BATCH_BYTES:
            yield start, position + 1
            start, total = position + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def _id_runs(rows: list) -> Iterator[list]:
    """Runs of rows whose texts come to about BATCH_BYTES."""
    for start, stop in _runs([4 * len(row) for row in rows]):
        yield rows[start:stop]


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text", round_trip: bool = False) -> DataFrame:
    """``doc_id``, ``ids`` and the source bytes ``[starts, ends)`` of each piece, for every whole text.

    With ``round_trip`` there is also ``decoded``, the text that decoding the ids gives. ``model_path`` is a file that
    every executor has.
    """

    def work(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import sentencepiece

        if model_path not in _ENCODERS:
            library = sentencepiece.SentencePieceProcessor(model_file=model_path)
            _ENCODERS[model_path] = Encoder(load_model(model_path), lambda many: library.encode(many, num_threads=1))
        encoder = _ENCODERS[model_path]
        names = ["doc_id", "ids", "starts", "ends"]
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for start, stop in _runs(lengths):
                sizes, *columns = encoder.encode_array(batch.column(1).slice(start, stop - start))
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(column)) for column in columns]
                out = [batch.column(0).slice(start, stop - start), *lists]
                if round_trip:
                    rows = [columns[0][a:b] for a, b in zip(offsets, offsets[1:])]
                    out.append(pa.array(_decoder(model_path).decode_many(rows), pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=[*names, "decoded"][: len(out)])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    extra = ", decoded string" if round_trip else ""
    return chosen.mapInArrow(work, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>{extra}")


def _decoder(model_path: str) -> Decoder:
    if model_path not in _DECODERS:
        _DECODERS[model_path] = Decoder(load_model(model_path))
    return _DECODERS[model_path]


def decoder(model_path: str):
    """Column function: an array of ids to its text."""

    @F.pandas_udf("string")
    def decode_ids(ids):
        one = _decoder(model_path)
        texts = ids.copy()
        known = ids.notna()
        texts[known] = [text for run in _id_runs(list(ids[known])) for text in one.decode_many(run)]
        return texts

    def decode(ids: Column) -> Column:
        return decode_ids(ids)

    return decode
