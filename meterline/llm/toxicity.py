"""Toxicity of texts: a convolutional classifier over hashed word embeddings, trained in numpy.

Words are taken in lower case and without the signs around them. A word is the sum of the embeddings that the hashes of the word, its first four and six and its last four characters
select. Filters over one, two and three words run along the whole text, the largest response of each is pooled, and a
dense layer gives a logit, which a scale and shift fitted on rows kept out of training turn into a score from 0 to 1.
Every labelled row outside the held-out fold is learnt from or calibrates. What one task can hold is trained there; more
rows are dealt into shards of that size, which train apart, pass by pass, and after each pass a weight is
moved by the mean over the shards that moved it. Scale, shift and thresholds then come from counts over all calibrating rows.
For rejecting documents the threshold on the score is calibrated by language; the score itself sees the text only.

A null or empty text has no word and gets the score of an empty text. Where no labelled row of both kinds exists, the
score of every text is the share of positive labels, 0 without labels. Labels that are null are left out; an id that
is labelled more than once counts once per label. A null id is never held out. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.exact_copies import block_count, key_filter, mark_possible
from meterline.llm.storage import made_in_one_task, stored

# One task trains on so many rows with so many bytes of text; more are spread over shards of that size.
TRAINING_ROWS = 8_000
TRAINING_BYTES = 32_000_000
# Passes over all rows where they are spread, and parts that the weights are merged in.
SPREAD_PASSES = 4
WEIGHT_PARTS = 256
# More shards than LANES share lanes, up to LANE_SHARDS each: a task trains those of a lane in turn and adds their moves
# up, which bounds what is shuffled. There are more partitions than lanes, so that few lanes meet in one.
LANES, LANE_SHARDS = 16, 4
PARTITIONS_PER_LANE = 4
# Decimals of a score at which spread calibrating rows are counted, overall and by language.
CUT_PLACES, LANGUAGE_PLACES = 5, 4
# Of the training rows, one in this many calibrates the score and the thresholds instead.
CALIBRATION_SHARE = 6

BUCKETS = 1 << 16
WIDTHS = (1, 2, 3)
DIMENSIONS = 16
FILTERS = 16
# Steps of training, and passes over the rows at most.
UPDATES, MOST_EPOCHS = 750, 20
# One empty text, taken as clean, for so many rows: a text without a word, or without a known one, is no toxic one.
ROWS_PER_EMPTY = 25
BATCH_DOCUMENTS = 32
STEP = 0.05
SEED = 20240101

# A language gets a threshold of its own from so many positive calibration rows on.
LEAST_POSITIVES = 15
DEFAULT_THRESHOLD = 0.5

BATCH_BYTES = 1_000_000
# Words of more bytes are hashed one at a time.
LONG_WORD = 64
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_ASCII_SIGNS = "".join(chr(code) for code in range(128) if not chr(code).isalnum())
PAD = "\0"


def word_hashes(word: str) -> tuple[int, int, int, int]:
    """Embedding rows of a word; row 0 is the padding's and stays zero."""
    if word == PAD:
        return 0, 0, 0, 0
    word = _EDGES.sub("", word.lower())
    parts = (word, "^" + word[:4], "^^" + word[:6], word[-4:] + "$")
    return tuple(1 + zlib.crc32(part.encode("utf-8")) % (BUCKETS - 1) for part in parts)


def _crc_table():
    """What each byte does to a state, which is a CRC-32 before its last inversion."""
    import numpy as np

    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


def _crc32s(strings, before: bytes = b"", after: bytes = b""):
    """CRC-32 of ``before``, each string of an Arrow array and ``after``: byte by byte for all strings at once."""
    import numpy as np
    import pyarrow as pa

    strings = strings.cast(pa.large_binary())
    _, ends_buffer, data_buffer = strings.buffers()
    bounds = np.frombuffer(ends_buffer, dtype=np.int64, count=strings.offset + len(strings) + 1)[strings.offset :]
    data = np.frombuffer(data_buffer or b"", dtype=np.uint8)
    sizes = np.diff(bounds)
    table = _crc_table()
    order = np.argsort(-sizes, kind="stable")
    long = int((sizes > LONG_WORD).sum())
    out = np.empty(len(strings), dtype=np.uint32)
    for row in order[:long]:
        out[row] = zlib.crc32(before + data[bounds[row] : bounds[row + 1]].tobytes() + after)
    order = order[long:]
    starts, state = bounds[order], np.full(len(order), zlib.crc32(before) ^ 0xFFFFFFFF, dtype=np.uint32)
    # The longest come first, so those that have a byte at a place are the first ones.
    longer = len(order) - np.searchsorted(sizes[order][::-1], np.arange(LONG_WORD), side="right")
    for place, rows in enumerate(longer.tolist()):
        if not rows:
            break
        state[:rows] = table[(state[:rows] ^ data[starts[:rows] + place]) & 0xFF] ^ (state[:rows] >> np.uint32(8))
    for byte in after:
        state = table[(state ^ np.uint32(byte)) & 0xFF] ^ (state >> np.uint32(8))
    out[order] = ~state
    return out


class Vocabulary:
    """Hashes of words. It keeps none of them, as idle Python workers would go on holding that memory."""

    def rows(self, words):
        """What :func:`word_hashes` gives for each word of an Arrow array, an array of four columns."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words = words.cast(pa.large_string())
        bare = pc.ascii_trim(pc.ascii_lower(words), characters=_ASCII_SIGNS)
        ascii_only = pc.string_is_ascii(words)
        others = words.filter(pc.invert(ascii_only)).to_pylist()
        if others:
            others = pa.array([_EDGES.sub("", word.lower()) for word in others], pa.large_string())
            bare = pc.replace_with_mask(bare, pc.invert(ascii_only), others)
        hashes = [
            _crc32s(bare),
            _crc32s(pc.utf8_slice_codeunits(bare, 0, 4), b"^"),
            _crc32s(pc.utf8_slice_codeunits(bare, 0, 6), b"^^"),
            _crc32s(pc.utf8_slice_codeunits(bare, -4), after=b"$"),
        ]
        out = (1 + np.stack(hashes, axis=1) % np.uint32(BUCKETS - 1)).astype(np.int32)
        out[pc.equal(words, PAD).to_numpy(zero_copy_only=False)] = 0
        return out


def word_codes(texts):
    """Splits an Arrow array of texts at white space.

    Returns the distinct words (the first is the padding), the code of each word with as many paddings behind each text
    as the widest filter needs, and where texts start and how many places of theirs count.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    words = pa.concat_arrays([pa.array([PAD], coded.dictionary.type), coded.dictionary])
    counts = pc.list_value_length(lists).to_numpy()
    pads = WIDTHS[-1] - 1
    starts = np.cumsum(counts + pads) - (counts + pads)
    # The places behind the last text let its last word be a window's first as well.
    codes = np.zeros(int((counts + pads).sum()) + WIDTHS[-1], dtype=np.int64)
    places = np.arange(len(coded.indices)) + np.repeat(np.arange(len(counts)) * pads, counts)
    codes[places] = coded.indices.to_numpy().astype(np.int64) + 1
    return words, codes, starts, counts


@dataclass
class Model:
    """Parameters; ``constant`` replaces them where nothing could be trained."""

    embeddings: object = None
    filters: list = field(default_factory=list)
    filter_bias: list = field(default_factory=list)
    dense: object = None
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def logits(self, texts, vocabulary: Vocabulary):
        """One logit per text. Each distinct word is taken through the filters once; texts add those up."""
        import numpy as np

        words, codes, starts, counts = word_codes(texts)
        vectors = self.embeddings[vocabulary.rows(words)].sum(axis=1)
        edges = np.stack([starts, starts + counts], axis=1).ravel()
        out = np.full(len(starts), self.bias, dtype=np.float64)
        if not len(starts):
            return out
        for number, width in enumerate(WIDTHS):
            weights = self.filters[number]
            length = len(codes) - width + 1
            total = (vectors @ weights[0])[codes[:length]]
            for step in range(1, width):
                total += (vectors @ weights[step])[codes[step : step + length]]
            pooled = np.maximum.reduceat(total, np.minimum(edges, length - 1), axis=0)[::2]
            out += np.maximum(pooled + self.filter_bias[number], 0) @ self.dense[number]
        return out

    def scores(self, texts, vocabulary: Vocabulary):
        import numpy as np

        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(texts, vocabulary) + self.shift, -40, 40)))


@dataclass
class _Weights:
    """What training changes: values, and the sums of their squared gradients."""

    embeddings: object
    embedding_squares: object
    rest: list
    squares: list

    @classmethod
    def start(cls, random) -> _Weights:
        import numpy as np

        # Words that were never seen stay next to zero and say little; the bias keeps every filter open at first.
        embeddings = random.normal(0, 0.01, (BUCKETS, DIMENSIONS)).astype(np.float32)
        embeddings[0] = 0
        filters = [random.normal(0, 0.3, (width, DIMENSIONS, FILTERS)).astype(np.float32) for width in WIDTHS]
        filter_bias = [np.full(FILTERS, 0.1, dtype=np.float32) for _ in WIDTHS]
        dense = [random.normal(0, 0.3, FILTERS).astype(np.float32) for _ in WIDTHS]
        rest = [*filters, *filter_bias, *dense, np.zeros(1, dtype=np.float32)]
        return cls(embeddings, np.full(BUCKETS, 1e-3, dtype=np.float32), rest, [np.full_like(one, 1e-3) for one in rest])

    def model(self) -> Model:
        widths = len(WIDTHS)
        filters, filter_bias, dense = (self.rest[at : at + widths] for at in range(0, 3 * widths, widths))
        return Model(self.embeddings, filters, filter_bias, dense, float(self.rest[-1][0]))

    def table(self):
        """All of it as rows of one length: an embedding and its sum each, then the rest filled up with zeros."""
        import numpy as np

        flat = np.concatenate([one.ravel() for one in (*self.rest, *self.squares)])
        flat = np.pad(flat, (0, -len(flat) % (DIMENSIONS + 1))).reshape(-1, DIMENSIONS + 1)
        return np.concatenate([np.column_stack([self.embeddings, self.embedding_squares]), flat])

    def set(self, table) -> None:
        """Takes over what :meth:`table` gave."""
        self.embeddings[:], self.embedding_squares[:] = table[:BUCKETS, :-1], table[:BUCKETS, -1]
        flat, at = table[BUCKETS:].ravel(), 0
        for one in (*self.rest, *self.squares):
            one[...] = flat[at : at + one.size].reshape(one.shape)
            at += one.size


def _train_network(texts, labels) -> Model:
    """Trains until UPDATES steps are done."""
    import numpy as np

    random = np.random.default_rng(SEED)
    weights = _Weights.start(random)
    batches = -(-len(texts) // BATCH_DOCUMENTS)
    _learn(weights, random, texts, labels, labels.mean(), min(MOST_EPOCHS, -(-UPDATES // batches)))
    return weights.model()


def _learn(weights: _Weights, random, texts, labels, positive, epochs: int) -> None:
    """Adagrad on the logistic loss; positives weigh as much as negatives together do, ``positive`` being their share."""
    import numpy as np

    embeddings, embedding_squares, rest, squares = weights.embeddings, weights.embedding_squares, weights.rest, weights.squares
    widths = len(WIDTHS)
    filters, filter_bias, dense = (rest[at : at + widths] for at in range(0, 3 * widths, widths))
    bias = rest[-1]
    words, codes, starts, counts = word_codes(texts)
    hashes = Vocabulary().rows(words)
    del words
    weight = np.where(labels == 1, 0.5 / max(positive, 1e-6), 0.5 / max(1 - positive, 1e-6))
    order = np.arange(len(texts))
    for _ in range(epochs):
        random.shuffle(order)
        for at in range(0, len(order), BATCH_DOCUMENTS):
            chosen = order[at : at + BATCH_DOCUMENTS]
            spans = [codes[starts[d] : starts[d] + counts[d] + WIDTHS[-1] - 1] for d in chosen]
            places = np.cumsum([0, *map(len, spans)])
            rows = hashes[np.concatenate(spans)]
            vectors = embeddings[rows].sum(axis=1)
            logit = np.full(len(chosen), bias[0])
            pooled, best = [], []
            for number, width in enumerate(WIDTHS):
                length = len(vectors) - width + 1
                total = vectors[:length] @ filters[number][0]
                for step in range(1, width):
                    total += vectors[step : step + length] @ filters[number][step]
                top = np.stack([places[i] + total[places[i] : places[i] + counts[d]].argmax(axis=0) for i, d in enumerate(chosen)])
                value = total[top, np.arange(FILTERS)] + filter_bias[number]
                pooled.append(value)
                best.append(top)
                logit = logit + np.maximum(value, 0) @ dense[number]
            error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
            gradient = np.zeros_like(vectors)
            grads_filter, grads_bias, grads_dense = [], [], []
            for number, width in enumerate(WIDTHS):
                grads_dense.append(np.maximum(pooled[number], 0).T @ error)
                down = error[:, None] * dense[number] * (pooled[number] > 0)
                grads_bias.append(down.sum(axis=0))
                steps = []
                for step in range(width):
                    at_best = best[number] + step
                    steps.append(np.einsum("bf,bfe->ef", down, vectors[at_best]))
                    np.add.at(gradient, at_best, down[:, :, None] * filters[number][step].T)
                grads_filter.append(np.stack(steps))
            for one, square, grad in zip(rest, squares, [*grads_filter, *grads_bias, *grads_dense, error.sum(keepdims=True)]):
                square += grad * grad
                one -= STEP * grad / np.sqrt(square)
            touched = np.flatnonzero(gradient.any(axis=1))
            touched_rows = rows[touched].ravel()
            steps_down = np.repeat(gradient[touched], rows.shape[1], axis=0)
            np.add.at(embedding_squares, touched_rows, (steps_down * steps_down).mean(axis=1))
            np.add.at(embeddings, touched_rows, -STEP * steps_down / np.sqrt(embedding_squares[touched_rows])[:, None])
            embeddings[0] = 0


def _best_threshold(scores, labels) -> float:
    """Of the cuts at which the most rows are right, the middle of the one with the widest gap in scores."""
    import numpy as np

    order = np.argsort(scores, kind="stable")
    return _best_cut(scores[order], labels[order], 1 - labels[order])


def _best_cut(scores, positives, negatives) -> float:
    """The same for rising scores and how many rows of each kind have them."""
    import numpy as np

    # Right if everything from a place on is called positive.
    right = positives[::-1].cumsum()[::-1] + np.concatenate([[0], negatives.cumsum()[:-1]])
    below = np.concatenate([[0.0], scores[:-1]])
    best = np.flatnonzero(right >= right.max())
    place = best[(scores - below)[best].argmax()]
    return float((scores[place] + below[place]) / 2)


def fit(texts, labels: list[int], languages: list[str | None]) -> Model:
    """Trains on bounded lists (texts may be an Arrow array); every CALIBRATION_SHARE-th row calibrates instead."""
    import numpy as np
    import pyarrow as pa

    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    labels = np.array(labels, dtype=np.float32)
    if not len(labels) or labels.min() == labels.max():
        return Model(constant=float(labels.mean()) if len(labels) else 0.0)
    kept_out = np.arange(len(labels)) % CALIBRATION_SHARE == 0
    if labels[~kept_out].min() == labels[~kept_out].max() or labels[kept_out].min() == labels[kept_out].max():
        kept_out[:] = False
    learnt = texts.filter(pa.array(~kept_out))
    empty = 1 + len(learnt) // ROWS_PER_EMPTY
    model = _train_network(
        pa.concat_arrays([learnt, pa.array([""] * empty, texts.type)]), np.concatenate([labels[~kept_out], np.zeros(empty, dtype=np.float32)])
    )
    check = kept_out if kept_out.any() else ~kept_out
    checked = texts.filter(pa.array(check))
    logits = model.logits(checked, Vocabulary())
    # The shift puts the best cut at one half; the scale spreads the logits around it.
    spread = float(np.abs(logits).mean()) or 1.0
    squashed = 1 / (1 + np.exp(-logits / spread))
    cut = np.clip(_best_threshold(squashed, labels[check]), 1e-4, 1 - 1e-4)
    model.scale = 4 / spread
    model.shift = -4 * float(np.log(cut / (1 - cut)))
    scores = 1 / (1 + np.exp(-np.clip(model.scale * logits + model.shift, -40, 40)))
    known = np.array([language or "" for language, used in zip(languages, check) if used])
    for language in np.unique(known):
        own = known == language
        positives = int(labels[check][own].sum())
        if language and LEAST_POSITIVES <= positives < own.sum():
            model.thresholds[str(language)] = float(np.clip(_best_threshold(scores[own], labels[check][own]), 0.2, 0.8))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _fit_batches(batches: Iterator) -> Model:
    """Trains on ``text, lang, label`` until TRAINING_BYTES of text are read."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts, labels, languages, left = [], [], [], TRAINING_BYTES
    for batch in batches:
        sizes = pc.binary_length(batch.column(0)).to_pylist()
        rows = 0
        while rows < len(sizes) and left > 0:
            left -= sizes[rows]
            rows += 1
        texts.append(batch.column(0).slice(0, rows))
        languages += batch.column(1).slice(0, rows).to_pylist()
        labels += batch.column(2).slice(0, rows).to_pylist()
        if left <= 0:
            break
    return fit(pa.concat_arrays(texts) if texts else pa.array([], pa.string()), labels, languages)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Trains on all labelled documents outside the held-out fold: in one task if they fit it, else in shards."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    kind = docs.schema[doc_id].dataType
    usable = usable.select(F.col("doc_id").cast(kind).alias("id"), F.col("toxic").cast("int").alias("label")).distinct()
    language = F.col(lang) if lang in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), language.alias("lang"))
    # Only labelled texts are moved.
    blocks = block_count(usable.count())
    texts = mark_possible(texts, ("id",), key_filter(usable, ("id",), blocks), blocks, "maybe").where("maybe").drop("maybe")
    sizes = texts.select("id", F.octet_length("text").cast("bigint").alias("bytes")).join(usable, "id").groupBy("id", "label").agg(F.max("bytes").alias("bytes"))
    total = sizes.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    shards = max(1, -(-total.rows // TRAINING_ROWS), -(-total.bytes // TRAINING_BYTES))
    # Texts and labels meet in one shuffle by lane. A join would deal both anew, by id and into another number of partitions.
    lanes = max(min(shards, LANES), -(-shards // LANE_SHARDS))
    shard = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards))
    both = texts.where(F.col("id").isNotNull()).select("id", F.struct("text", "lang").alias("row")).unionByName(usable, allowMissingColumns=True)
    rows = (
        both.withColumn("lane", F.pmod(shard, F.lit(lanes)))
        .repartition(PARTITIONS_PER_LANE * lanes, "lane")
        .groupBy("lane", "id")
        .agg(F.min("row").alias("row"), F.collect_set("label").alias("labels"))
        .where(F.col("row").isNotNull())
        .select("row.text", "row.lang", F.explode("labels").alias("label"), "id", "lane")
    )
    order = [F.xxhash64("id"), F.col("id"), F.col("label")]
    if shards == 1:
        return made_in_one_task(rows.drop("lane"), order, _fit_batches)
    rows = rows.withColumn("shard", shard).withColumn("checks", F.pmod(F.xxhash64("id"), F.lit(CALIBRATION_SHARE)) == 0)
    rows = rows.sortWithinPartitions("lane", "shard", *order).persist(StorageLevel.DISK_ONLY)
    try:
        return _fit_spread(rows)
    finally:
        rows.unpersist()


def _fit_spread(rows: DataFrame) -> Model:
    """Trains on ``text, lang, label, id, lane, shard, checks``; ``checks`` tells which rows calibrate.

    A lane is in one partition, sorted by shard.
    """
    import numpy as np

    found = rows.groupBy("checks").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == 1).alias("positives")).collect()
    total, positives = sum(row.rows for row in found), sum(row.positives for row in found)
    if positives in (0, total):
        return Model(constant=positives / total if total else 0.0)
    apart = len(found) == 2 and all(0 < row.positives < row.rows for row in found)
    learnt, checked = (rows.where("NOT checks"), rows.where("checks")) if apart else (rows, rows)
    rows_learnt, positives_learnt = next((row.rows, row.positives) for row in found if not row.checks) if apart else (total, positives)
    weights = _Weights.start(np.random.default_rng(SEED))
    share = np.float32(positives_learnt / (rows_learnt + rows_learnt // ROWS_PER_EMPTY))
    for number in range(SPREAD_PASSES):
        table = weights.table()
        moves = learnt.select("text", "label", "lane", "shard").mapInArrow(_lane_pass(table, share, number), "part int, move binary")
        # Each part of the weights is merged by a task; the driver gets one set of them.
        for row in moves.groupBy("part").applyInArrow(_merged_moves, "part int, move binary").collect():
            part = np.array_split(table, WEIGHT_PARTS)[row.part]
            part += np.frombuffer(row.move, dtype=np.float32).reshape(part.shape)
        weights.set(table)
    return _calibrated(weights.model(), checked)


def _shards(batches):
    """``lane, shard, texts, labels`` of one shard after the other."""
    import numpy as np

    at, texts, labels = None, [], []
    for batch in batches:
        lanes, shards = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        cuts = np.flatnonzero((lanes[1:] != lanes[:-1]) | (shards[1:] != shards[:-1])) + 1
        edges = [0, *cuts.tolist(), len(lanes)] if len(lanes) else []
        for start, stop in zip(edges, edges[1:]):
            if at not in (None, (lanes[start], shards[start])):
                yield *at, texts, labels
                texts, labels = [], []
            at = lanes[start], shards[start]
            texts.append(batch.column(0).slice(start, stop - start))
            labels += batch.column(1).slice(start, stop - start).to_pylist()
    if at is not None:
        yield *at, texts, labels


def _lane_pass(table, share, number: int):
    """One pass over the shards of a lane, each from the same weights; gives the summed moves of the weights by part.

    The last column counts the shards that moved a row of weights.
    """

    def given(total):
        import numpy as np
        import pyarrow as pa

        moves = np.array_split(total, WEIGHT_PARTS)
        parts = [part for part, move in enumerate(moves) if move.any()]
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array([moves[part].tobytes() for part in parts], pa.binary())], names=["part", "move"]
        )

    def work(batches):
        import numpy as np
        import pyarrow as pa

        at = total = None
        for lane, shard, texts, labels in _shards(batches):
            if at not in (None, lane):
                yield given(total)
                total = None
            at = lane
            empty = 1 + len(labels) // ROWS_PER_EMPTY
            texts = pa.concat_arrays([*texts, pa.array([""] * empty, texts[0].type)])
            random = np.random.default_rng([SEED, number, int(shard)])
            weights = _Weights.start(random)
            weights.set(table)
            _learn(weights, random, texts, np.array([*(label == 1 for label in labels), *[0] * empty], dtype=np.float32), share, 1)
            move = weights.table() - table
            move = np.column_stack([move, move.any(axis=1)])
            total = move if total is None else total + move
        if total is not None:
            yield given(total)

    return work


def _merged_moves(moves):
    """The mean move of each row of weights over the shards that moved it, so that a word of few shards counts in full."""
    import numpy as np
    import pyarrow as pa

    total = count = 0
    # In one order, as sums of floats depend on it.
    for move in sorted(moves.column("move").to_pylist()):
        rows = np.frombuffer(move, dtype=np.float32).reshape(-1, DIMENSIONS + 2)
        total, count = total + rows[:, :-1].astype(np.float64), count + rows[:, -1]
    mean = (total / np.maximum(count, 1)[:, None]).astype(np.float32)
    return pa.table({"part": pa.array([moves.column("part")[0].as_py()], pa.int32()), "move": pa.array([mean.tobytes()], pa.binary())})


def _calibrated(model: Model, checked: DataFrame) -> Model:
    """Sets scale, shift and thresholds from all rows of ``checked``, counted by score."""
    import numpy as np
    import pyarrow.compute as pc

    logits = stored(checked.select("lang", (F.col("label") == 1).alias("toxic"), _logit(model)("text").alias("logit")), "toxicity-logits")

    def cut_points(rows: DataFrame, score: Column, places: int, *keys: str) -> DataFrame:
        counted = rows.groupBy(*keys, F.round(score, places).alias("score"))
        return counted.agg(F.count_if("toxic").alias("positives"), F.count_if(~F.col("toxic")).alias("negatives"))

    def best(points) -> float:
        points = points.sort_by("score")
        return _best_cut(*(points.column(name).to_numpy() for name in ("score", "positives", "negatives")))

    # Few digits, which do not depend on the order of adding up.
    spread = float(f"{logits.agg(F.avg(F.abs('logit'))).first()[0]:.6g}") or 1.0
    cut = np.clip(best(cut_points(logits, 1 / (1 + F.exp(-F.col("logit") / F.lit(spread))), CUT_PLACES).toArrow()), 1e-4, 1 - 1e-4)
    model.scale = 4 / spread
    model.shift = -4 * float(np.log(cut / (1 - cut)))
    exponent = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.lit(model.scale) * F.col("logit") + F.lit(model.shift)))
    many = logits.groupBy("lang").agg(F.count_if("toxic").alias("positives"), F.count(F.lit(1)).alias("rows"))
    many = many.where((F.col("lang") != "") & (F.col("positives") >= LEAST_POSITIVES) & (F.col("positives") < F.col("rows"))).select("lang")
    points = cut_points(logits.join(many, "lang"), 1 / (1 + F.exp(-exponent)), LANGUAGE_PLACES, "lang").toArrow()
    for language in sorted(points.column("lang").unique().to_pylist()):
        own = points.filter(pc.equal(points.column("lang"), language))
        model.thresholds[language] = float(np.clip(best(own), 0.2, 0.8))
    return model


def _logit(model: Model):
    """Column function: the logit of a text."""
    @F.arrow_udf("double")
    def logit(texts):
        import numpy as np
        import pyarrow as pa

        parts = [model.logits(texts.slice(start, stop - start), Vocabulary()) for start, stop in _runs(texts)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return logit


def scorer(model: Model):
    """Column function: the score of a text."""
    @F.arrow_udf("double")
    def score(texts):
        import numpy as np
        import pyarrow as pa

        parts = [model.scores(texts.slice(start, stop - start), Vocabulary()) for start, stop in _runs(texts)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return score


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


def threshold(model: Model, lang: Column) -> Column:
    """The score from which a document of this language is rejected."""
    out = F.lit(DEFAULT_THRESHOLD)
    for language, value in sorted(model.thresholds.items()):
        out = F.when(lang == language, F.lit(value)).otherwise(out)
    return out


def toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, score, predicted, rejected`` for every whole text."""
    language = F.col(lang) if lang in docs.columns else F.lit(None).cast("string")
    scored = docs.select(F.col(doc_id).alias("doc_id"), language.alias("lang"), scorer(model)(F.col(text)).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= threshold(model, F.col("lang"))).alias("rejected"),
    )


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    language = F.col(lang) if lang in docs.columns else F.lit(None).cast("string")
    scored = docs.select(F.struct("*").alias("whole"), language.alias("lang"), scorer(model)(F.col(text)).alias("score"))
    return scored.where(F.col("score") < threshold(model, F.col("lang"))).select("whole.*")
