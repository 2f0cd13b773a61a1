"""Best-fit packing of documents into sequences by minimum bin slack.

Documents are tokenised, cut where they exceed a sequence, and counted by the length of their pieces: at most as
many lengths as a sequence has tokens, whatever the number of documents. The packing is worked out on those counts.
Per bin, the longest piece left opens it, and a subset-sum table over the lengths left (one bit per reachable fill)
finds the fullest combination that completes it. The same combination would be found again as long as its pieces
last, so it is used that often at once. Pieces are then numbered within their length, in parallel, and the number
says which bin and which place a piece has.

A null text counts as empty and is one piece that holds only the end token. Null and repeated ids are kept, each
row packed on its own. An empty table gives an empty result. Only the id and the text are read, so other columns
of any name may be there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.storage import stored
from meterline.llm.words import BLANKS, ascii_lower_table, byte_classes, cut_words

SEQUENCE_TOKENS = 4096
END_TOKEN = 1

# Pieces of one length are numbered in so many parts, so that a length shared by a third of all rows is not one task's.
NUMBERING_PARTS = 256
# Tokenised words a worker keeps at most.
KNOWN_WORDS = 1_000_000

# Bytes of text tokenised at a time.
BATCH_BYTES = 4_000_000

# Words that are tokenised as one text.
JOINED_WORDS = 50

# Letters followed by these signs are two words for a tokenizer that separates letters from signs; both repeat more often.
SIGNS = ".,!?;:"
# Fixed value: how the tokenizer's vocabulary marks the last token of a word.
WORD_END = "</w>"

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


class WordIds:
    """Ids of words, each tokenised once while there is room."""

    def __init__(self, tokenizer):
        import numpy as np

        self.np, self.tokenizer = np, tokenizer
        vocabulary = tokenizer.get_vocab()
        self.word_ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.word_ends[[number for token, number in vocabulary.items() if token.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        np = self.np
        # Number of each word, and the ids of all words in a row with where each word's end.
        self.numbers: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.offsets = np.zeros(1, dtype=np.int64)

    def _keep(self, words: list[str], ids, sizes) -> None:
        np = self.np
        self.numbers.update(zip(words, range(len(self.numbers), len(self.numbers) + len(words))))
        self.flat = np.concatenate([self.flat, ids])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])

    def _learn(self, words: list[str]) -> None:
        """Tokenises words of which each is letters or signs only, and so one word to the tokenizer.

        Normalising, splitting and mapping to bytes leave words of small ASCII letters as they are, so those go to the
        tokenizer's model directly; others are joined to short texts, where the last token of a word carries its end mark.
        """
        np = self.np
        tokenize = self.tokenizer.model.tokenize
        letters = [word for word in words if word.isascii() and word.isalpha() and word.islower()]
        if letters:
            ids = [[token.id for token in tokenize(word)] for word in letters]
            self._keep(letters, np.array(list(chain.from_iterable(ids)), dtype=np.int32), np.array(list(map(len, ids)), dtype=np.int64))
        known = set(letters)
        rest = [word for word in words if word not in known]
        groups = [rest[at : at + JOINED_WORDS] for at in range(0, len(rest), JOINED_WORDS)]
        learnt = []
        encoded = self.tokenizer.encode_batch_fast([" ".join(group) for group in groups], add_special_tokens=False)
        for group, one in zip(groups, encoded):
            ids = np.array(one.ids, dtype=np.int32)
            ends = np.flatnonzero(self.word_ends[ids]) + 1
            if len(ends) == len(group):
                learnt.append((group, ids, np.diff(ends, prepend=0)))
            else:
                self._learn_singly(group)
        if learnt:
            groups, ids, sizes = zip(*learnt)
            self._keep(list(chain.from_iterable(groups)), np.concatenate(ids), np.concatenate(sizes))

    def _learn_singly(self, words: list[str]) -> None:
        np = self.np
        ids = [encoded.ids for encoded in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self._keep(words, np.array(list(chain.from_iterable(ids)), dtype=np.int32), np.array(list(map(len, ids)), dtype=np.int64))

    def _ids_of(self, numbers):
        """Ids of the words with these numbers in a row, and how many each has."""
        np = self.np
        sizes = self.offsets[numbers + 1] - self.offsets[numbers]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.offsets[numbers] - (ends - sizes), sizes)
        return self.flat[places], sizes

    def _numbers_of(self, words: list[str]):
        np = self.np
        numbers = np.array([self.numbers.get(word, -1) for word in words], dtype=np.int64)
        unknown = np.flatnonzero(numbers < 0)
        if len(self.numbers) + len(unknown) > KNOWN_WORDS:
            self._forget()
            unknown = np.arange(len(words))
        missing = [words[place] for place in unknown.tolist()]
        cores = [word.rstrip(SIGNS) for word in missing]
        # Some letters become letter and mark in lower case, hence the second look.
        letters = [core.lower().isalpha() for core in cores]
        joined = [(word, core) for word, core, plain in zip(missing, cores, letters) if plain and len(core) < len(word)]
        plain = {core for core, is_plain in zip(cores, letters) if is_plain} | {word[len(core) :] for word, core in joined}
        if plain := [word for word in plain if word not in self.numbers]:
            self._learn(plain)
        if odd := [word for word, is_plain in zip(missing, letters) if not is_plain and word not in self.numbers]:
            self._learn_singly(odd)
        if joined:
            halves = np.array(
                [self.numbers[part] for word, core in joined for part in (core, word[len(core) :])], dtype=np.int64
            )
            ids, sizes = self._ids_of(halves)
            self._keep([word for word, _ in joined], ids, sizes[0::2] + sizes[1::2])
        numbers[unknown] = [self.numbers[word] for word in missing]
        return numbers

    def encode(self, texts, end_token: int):
        """Ids of all texts of an Arrow array in a row, the end token behind each, and where each text's end."""
        import pyarrow as pa
        import pyarrow.compute as pc

        np = self.np
        texts = pc.fill_null(texts, "")
        # Special tokens are told by their exact letters, so texts that may hold one are not lower-cased first.
        whole = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        if len(whole):
            mask = np.zeros(len(texts), dtype=bool)
            mask[whole] = True
            plain = pc.replace_with_mask(texts, pa.array(mask), pa.array([""] * len(whole), texts.type))
        else:
            plain = texts
        cut = cut_words(plain, byte_classes(BLANKS), ascii_lower_table(), SIGNS.encode())
        words = self._numbers_of(cut.dictionary.to_numpy(zero_copy_only=False).tolist())[cut.codes]
        ids, sizes = self._ids_of(words)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        text_ends = ends[np.searchsorted(cut.text_of, np.arange(len(texts)), side="right")]
        starts = np.concatenate([[0], text_ends[:-1]]) if len(text_ends) else text_ends
        end = np.array([end_token], dtype="<u4").tobytes()
        out = [ids[a:b].astype("<u4").tobytes() + end for a, b in zip(starts, text_ends)]
        for row in whole:
            encoded = self.tokenizer.encode(texts[int(row)].as_py(), add_special_tokens=False)
            out[row] = np.array(encoded.ids, dtype="<u4").tobytes() + end
        return out


_WORKER: dict[str, WordIds] = {}


def _runs(texts) -> Iterator[tuple[int, int]]:
    """Runs of rows with about BATCH_BYTES of text each."""
    import pyarrow.compute as pc

    start = total = 0
    for position, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        total += size
        if total >= BATCH_BYTES:
            yield start, position + 1
            start, total = position + 1, 0
    if start < len(texts):
        yield start, len(texts)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
    sequence_tokens: int = SEQUENCE_TOKENS, end_token: int = END_TOKEN,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's tokens and the end token, cut where too long.

    The tokenizer must take lower case, separate letters from signs and drop white space between words, as models
    with word-end marks do; its file must be on every executor.
    """

    def work(batches):
        import os
        import zlib

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if tokenizer_path not in _WORKER:
            _WORKER[tokenizer_path] = WordIds(Tokenizer.from_file(tokenizer_path))
        words = _WORKER[tokenizer_path]
        width = 4 * sequence_tokens
        for batch in batches:
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            for first, last in _runs(batch.column(1)):
                for row, ids in enumerate(words.encode(batch.column(1).slice(first, last - first), end_token), first):
                    for number, at in enumerate(range(0, len(ids), width)):
                        part = ids[at : at + width]
                        rows.append(row)
                        pieces.append(number)
                        starts.append(at // 4)
                        lengths.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(work, f"doc_id {kind}, {PIECES}")


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """The multiset of available lengths with the largest sum up to ``room``, found with one bit per sum.

    ``lengths`` is in descending order. Counts are split into powers of two, so that a length many pieces share
    takes few steps.
    """
    mask = (1 << room + 1) - 1
    reached = 1
    steps: list[tuple[int, int, int]] = []
    for length in lengths:
        if length > room:
            continue
        left, share = min(counts[length], room // length), 1
        while left > 0 and not reached >> room & 1:
            times = min(share, left)
            before = reached
            reached |= reached << length * times & mask
            if reached != before:
                steps.append((before, length, times))
            left -= times
            share *= 2
        if reached >> room & 1:
            break
    target = reached.bit_length() - 1
    chosen: list[int] = []
    for before, length, times in reversed(steps):
        if not before >> target & 1:
            chosen += [length] * times
            target -= length * times
    return chosen


def plan_bins(counts: dict[int, int], room: int) -> list[tuple[int, dict[int, int]]]:
    """Combinations of lengths and how often each is used, until every piece has a bin.

    The longest piece left opens a bin; the fullest completion is removed with it. Work depends on the number of
    lengths and combinations, not on the number of pieces.
    """
    left = {length: number for length, number in counts.items() if number > 0}
    lengths = sorted(left, reverse=True)
    plan: list[tuple[int, dict[int, int]]] = []
    while lengths:
        opening = lengths[0]
        left[opening] -= 1
        chosen = fullest([x for x in lengths if left[x] > 0], left, room - opening)
        left[opening] += 1
        combination: dict[int, int] = {}
        for length in [opening, *chosen]:
            combination[length] = combination.get(length, 0) + 1
        times = min(left[length] // number for length, number in combination.items())
        for length, number in combination.items():
            left[length] -= number * times
        lengths = [length for length in lengths if left[length] > 0]
        plan.append((times, combination))
    return plan


def _segments(plan: list[tuple[int, dict[int, int]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length, the runs of its pieces: first number, pieces per bin, first bin, offset in the bin."""
    used: dict[int, int] = {}
    segments: dict[int, list[tuple[int, int, int, int]]] = {}
    first_bin = 0
    for times, combination in plan:
        offset = 0
        for length, number in combination.items():
            segments.setdefault(length, []).append((used.get(length, 0), number, first_bin, offset))
            used[length] = used.get(length, 0) + number * times
            offset += length * number
        first_bin += times
    return segments


def _numbered(pieces: DataFrame) -> DataFrame:
    """Adds ``number``, counting from 0 within each length; no task sees more than a part of a length."""
    parted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(NUMBERING_PARTS)))
    parted = stored(
        parted.withColumn("within", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))),
        "numbered-pieces",
    )
    sizes = parted.groupBy("length", "part").count()
    before = sizes.withColumn(
        "before", F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")
    ).drop("count")
    return parted.join(before, ["length", "part"]).withColumn("number", F.col("before") + F.col("within") - 1).drop("part", "within", "before")


def pack(pieces: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``sequence_tokens``."""
    kept = stored(pieces, "token-pieces")
    full = kept.where(F.col("length") == sequence_tokens)
    parts = _numbered(kept.where(F.col("length") < sequence_tokens))
    # At most one row per length below a full sequence.
    counts = {row["length"]: row["count"] for row in kept.where(F.col("length") < sequence_tokens).groupBy("length").count().collect()}
    plan = plan_bins(counts, sequence_tokens)
    segments = _segments(plan)
    bins = sum(times for times, _ in plan)

    columns = kept.columns
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in kept.schema.fields)

    def place(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        runs_of = {length: np.array(runs, dtype=np.int64) for length, runs in segments.items()}
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            numbers = batch.column("number").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros_like(numbers), np.zeros_like(numbers)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                runs = runs_of[int(length)]
                run = runs[np.searchsorted(runs[:, 0], numbers[rows], side="right") - 1]
                copy, place_in_bin = np.divmod(numbers[rows] - run[:, 0], run[:, 1])
                sequence[rows] = run[:, 2] + copy
                offset[rows] = run[:, 3] + place_in_bin * int(length)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in columns], pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"],
            )

    placed = parts.select(*columns, "number").mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")
    alone = full.select(*columns, (F.monotonically_increasing_id() + F.lit(bins)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return placed.unionByName(alone)
