"""Phrases of two and three words that stand together more often than their parts suggest, by direct-address tiling.

1. Each task codes its texts into chunks: the distinct words of a chunk with their counts, and the words as numbers,
   with a mark between pieces. Counts of chunks add up to the words' frequencies.
2. Words with the least frequency or more get ids by falling frequency. Every chunk is given the ids of its own words.
3. Within a chunk the plane of id pairs is cut into square tiles. A tile that many pairs fall into is counted by a dense
   ``bincount`` over its cells, the others as sorted coordinates. The counts go, packed, to buckets by a hash of the
   pair, where those of all chunks are merged. A pair is one entry per chunk, so no bucket holds a hot one; the number
   of buckets follows the number of words, so none grows with the data.
4. Every chunk is given its frequent pairs, which are ranked anew by frequency, and the same tiles count pairs of
   overlapping pairs: the phrases of three words.

A phrase that is frequent has frequent parts, so leaving infrequent words and pairs out loses nothing. Counts and scores
are exact; products are decimals.

A null text is empty, a null language ``und``. Only text and language are read: nulls and repeats in other columns, and
columns of any name, do not matter. Repeated rows count each time. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.storage import stored
from meterline.llm.words import ascii_lower_table, byte_classes, cut_words, slices

# Fixed values of the contract.
NO_LANGUAGE = "und"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_SPACES = b" \t"
LEAST = 10
TOP = 2000
SCALE = 1_000_000
COVERED_PERCENT = 50

# Words of a chunk, about; a longer text is a chunk of its own.
CHUNK_WORDS = 1 << 21
# A tile's side in ids, and from how many pairs on it is counted densely.
TILE = 1024
DENSE_PAIRS = TILE * TILE // 16
# Counts merged in one bucket, about.
BUCKET_PAIRS = 1_500_000

_BREAK = -1
_CHUNKS = "chunk bigint, n bigint, codes binary, lang array<string>, word array<string>, count array<bigint>"
_COUNTS = "chunk bigint, bucket bigint, n bigint, high binary, low binary, count binary"
_PACKED = ("n", "high", "low", "count")
_IDS_BUCKET = -1
_ALL_CHUNKS = -1


def _pack(numbers, ordered: bool = False) -> bytes:
    """Numbers as compressed bytes; of ordered ones the differences, which are small."""
    import numpy as np
    import pyarrow as pa

    numbers = numbers.astype("<i8")
    return pa.compress((np.diff(numbers, prepend=0) if ordered else numbers).tobytes(), codec="zstd", asbytes=True)


def _unpack(packed, n: int, ordered: bool = False):
    import numpy as np
    import pyarrow as pa

    if not n:
        return np.zeros(0, dtype=np.int64)
    numbers = np.frombuffer(pa.decompress(packed, decompressed_size=8 * n, codec="zstd"), dtype="<i8")
    return np.cumsum(numbers) if ordered else numbers


def _packed_counts(chunk: int, bucket: int, high, low, counts) -> tuple:
    """A row of _COUNTS; ``high`` is ordered."""
    return chunk, bucket, len(high), _pack(high, ordered=True), _pack(low), _pack(counts)


def _counts_of(n: int, high, low, counts):
    return _unpack(high, n, ordered=True), _unpack(low, n), _unpack(counts, n)


class _Chunk:
    """Texts of one task coded against the words met so far."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, str], int] = {}
        self.counts: list = []
        self.codes: list = []
        self.words = 0

    def add(self, langs: list[str], texts, classes, letters: bytes) -> None:
        import numpy as np

        cut = cut_words(texts, classes, letters)
        if not len(cut.codes):
            return
        names = sorted(set(langs))
        number = {name: place for place, name in enumerate(names)}
        lang_of = np.array([number[lang] for lang in langs], dtype=np.int64)
        width = len(cut.dictionary)
        both, codes, counts = np.unique(lang_of[cut.text_of] * width + cut.codes, return_inverse=True, return_counts=True)
        words = cut.dictionary.to_pylist()
        local = [self.known.setdefault((names[key // width], words[key % width]), len(self.known)) for key in both.tolist()]
        local = np.array(local, dtype=np.int64)
        self.counts.append((local, counts))
        # A mark where the piece or the text changes, and one before what follows.
        piece = cut.separators_before + cut.text_of
        breaks = np.ones(len(codes), dtype=bool)
        breaks[1:] = piece[1:] != piece[:-1]
        coded = np.full(len(codes) + int(breaks.sum()), _BREAK, dtype=np.int64)
        coded[np.arange(len(codes)) + np.cumsum(breaks)] = local[codes]
        self.codes.append(coded)
        self.words += len(codes)

    def row(self, number: int):
        import numpy as np
        import pyarrow as pa

        counts = np.zeros(len(self.known), dtype=np.int64)
        for local, times in self.counts:
            counts[local] += times
        codes = np.concatenate(self.codes)
        langs, words = zip(*self.known)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([len(codes)], pa.int64()), pa.array([_pack(codes)], pa.binary()),
                pa.array([langs], pa.list_(pa.string())), pa.array([words], pa.list_(pa.string())),
                pa.array([counts], pa.list_(pa.int64())),
            ],
            names=["chunk", "n", "codes", "lang", "word", "count"],
        )


def _code_chunks(batches: Iterator) -> Iterator:
    from pyspark import TaskContext

    classes, letters = byte_classes(WORD_SPACES, PIECE_ENDS), ascii_lower_table()
    number, chunk = TaskContext.get().partitionId() << 32, _Chunk()
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, last in slices(batch.column(1)):
            chunk.add(langs[first:last], batch.column(1).slice(first, last - first), classes, letters)
            if chunk.words >= CHUNK_WORDS:
                yield chunk.row(number)
                number, chunk = number + 1, _Chunk()
    if chunk.words:
        yield chunk.row(number)


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``id``, their place from 0 in this order; sorted by ranges, so no task has all of them."""
    ordered = stored(
        rows.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()),
        "ranked",
    )
    # One row per task of the sort.
    sizes = ordered.groupBy("_part").count()
    before = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    place = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(F.broadcast(before), "_part").withColumn("id", place).drop("_part", "_row", "_before")


def count_pairs(first, second, tile: int = TILE, dense_pairs: int = DENSE_PAIRS):
    """Distinct pairs of ids with their counts, ordered: dense tiles by cells, all others as sorted coordinates."""
    import numpy as np

    tiles = (first // tile) << 32 | second // tile
    order = np.argsort(tiles, kind="stable")
    tiles = tiles[order]
    heads = np.flatnonzero(np.append(True, tiles[1:] != tiles[:-1])) if len(tiles) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(tiles)))
    sparse = np.ones(len(tiles), dtype=bool)
    firsts, seconds, counts = [], [], []
    for head, size in zip(heads[sizes >= dense_pairs].tolist(), sizes[sizes >= dense_pairs].tolist()):
        members = order[head : head + size]
        sparse[head : head + size] = False
        cells = np.bincount(first[members] % tile * tile + second[members] % tile, minlength=tile * tile)
        filled = np.flatnonzero(cells)
        corner = int(tiles[head])
        firsts.append((corner >> 32) * tile + filled // tile)
        seconds.append((corner & 0xFFFFFFFF) * tile + filled % tile)
        counts.append(cells[filled])
    members = order[sparse]
    keys, times = np.unique(first[members] << 32 | second[members], return_counts=True)
    firsts.append(keys >> 32)
    seconds.append(keys & 0xFFFFFFFF)
    counts.append(times)
    return np.concatenate(firsts), np.concatenate(seconds), np.concatenate(counts)


def _bucketed(chunk: int, high, low, counts, buckets: int) -> list[tuple]:
    """Rows of _COUNTS: the counts of one chunk by bucket, ordered within it."""
    import numpy as np

    mixed = (high.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + low.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((low, high, bucket))
    bucket, high, low, counts = bucket[order], high[order], low[order], counts[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    rows = []
    for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        rows.append(_packed_counts(chunk, int(bucket[a]), high[a:z], low[a:z], counts[a:z]))
    return rows


def _count_table(rows: list[tuple]):
    import pyarrow as pa

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = [part.split()[0] for part in _COUNTS.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names)


def _pair_counter(buckets: int):
    """Counts the pairs of a chunk's frequent words, and keeps its words as ids for the next round."""

    def count(chunk, entries):
        import numpy as np

        if not chunk.num_rows or not entries.num_rows:
            return _count_table([])
        number, n = chunk["chunk"][0].as_py(), chunk["n"][0].as_py()
        codes = _unpack(chunk["codes"][0].as_py(), n)
        id_of = np.full(int(codes.max()) + 2, _BREAK, dtype=np.int64)
        id_of[entries["local"].to_numpy()] = entries["id"].to_numpy()
        ids = id_of[codes]
        both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        rows = _bucketed(number, *count_pairs(ids[both], ids[both + 1]), buckets)
        return _count_table([*rows, (number, _IDS_BUCKET, n, _pack(ids), b"", b"")])

    return count


def _phrase_counter(buckets: int):
    """Counts, in a chunk, the phrases of three words whose two pairs are frequent; pairs are ranked anew first."""

    def count(chunk, pairs):
        import numpy as np

        if not chunk.num_rows or not pairs.num_rows:
            return _count_table([])
        number = chunk["chunk"][0].as_py()
        ids = _unpack(chunk["high"][0].as_py(), chunk["n"][0].as_py())
        parts = [_counts_of(*packed) for packed in zip(*(pairs[name].to_pylist() for name in _PACKED))]
        high, low, times = (np.concatenate(column) for column in zip(*parts))
        keys = high << 32 | low
        # By falling frequency over the whole corpus, which is what dense tiles need.
        by_frequency = np.lexsort((keys, -times))
        rank = np.empty(len(keys), dtype=np.int64)
        rank[by_frequency] = np.arange(len(keys))
        ordered = np.argsort(keys)
        here = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        wanted = ids[here] << 32 | ids[here + 1]
        found = np.minimum(np.searchsorted(keys, wanted, sorter=ordered), len(keys) - 1)
        pair_at = np.full(len(ids), _BREAK, dtype=np.int64)
        pair_at[here] = np.where(keys[ordered[found]] == wanted, rank[ordered[found]], _BREAK)
        both = np.flatnonzero((pair_at[:-1] >= 0) & (pair_at[1:] >= 0))
        first, second, counts = count_pairs(pair_at[both], pair_at[both + 1])
        by_rank = keys[by_frequency]
        return _count_table(_bucketed(number, by_rank[first], by_rank[second] & 0xFFFFFFFF, counts, buckets))

    return count


def _merger(least: int, send_back: bool):
    """Adds up the counts of a bucket and keeps the frequent ones: once for the whole, and once for each chunk."""

    def merge(table):
        import numpy as np

        parts = [_counts_of(*packed) for packed in zip(*(table[name].to_pylist() for name in _PACKED))]
        columns = [np.concatenate(column) for column in zip(*parts)]
        bucket = table["bucket"][0].as_py()
        chunk = np.repeat(table["chunk"].to_numpy(), table["n"].to_numpy())
        order = np.lexsort((chunk, columns[1], columns[0]))
        high, low, counts = (column[order] for column in columns)
        new = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
        heads = np.flatnonzero(new)
        total = np.add.reduceat(counts, heads)
        often = total >= least
        rows = []
        if often.any():
            kept = heads[often]
            rows.append(_packed_counts(_ALL_CHUNKS, bucket, high[kept], low[kept], total[often]))
        if send_back:
            total_at = total[np.cumsum(new) - 1]
            back = np.flatnonzero(total_at >= least)
            back = back[np.argsort(chunk[order[back]], kind="stable")]
            owner = chunk[order[back]]
            cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
            for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(owner)]):
                part = back[a:z]
                rows.append(_packed_counts(int(owner[a]), bucket, high[part], low[part], total_at[part]))
        return _count_table(rows)

    return merge


def _unpacked(counts: DataFrame) -> DataFrame:
    """``high, low, f`` rows of packed counts."""

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for packed in zip(*(batch.column(name).to_pylist() for name in _PACKED)):
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in _counts_of(*packed)], names=["high", "low", "f"])

    return counts.select(*_PACKED).mapInArrow(work, "high bigint, low bigint, f bigint")


def _merged(counts: DataFrame, least: int, send_back: bool, purpose: str) -> DataFrame:
    return stored(counts.groupBy("bucket").applyInArrow(_merger(least, send_back), _COUNTS), purpose)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, ...]:
    """Frequent words ``id, lang, word, f``, pairs ``first, second, f``, triples ``first, second, third, f``, by ids of
    words, and the number of words ``lang, n`` of each language."""
    chosen = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    chunks = stored(chosen.mapInArrow(_code_chunks, _CHUNKS), "word-chunks")
    entries = chunks.select("chunk", F.posexplode(F.arrays_zip("lang", "word", "count")).alias("local", "entry")).select(
        "chunk", "local", "entry.lang", "entry.word", "entry.count"
    )
    counted = stored(entries.groupBy("lang", "word").agg(F.sum("count").alias("f")), "word-counts")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    words = stored(ranked(counted.where(F.col("f") >= least), F.desc("f"), F.col("lang"), F.col("word")), "word-ids")
    # No more pairs than words; ids are half of a 64-bit key.
    sizes = totals.agg(F.sum("n")).first()[0] or 0
    if words.count() >= 1 << 31:
        raise ValueError("more frequent words than ids")
    buckets = max(1, -(-sizes // BUCKET_PAIRS))

    known = entries.join(words, ["lang", "word"]).select(F.col("chunk").alias("of_chunk"), F.col("local").cast("bigint").alias("local"), "id")
    coded = chunks.select("chunk", "n", "codes")
    counts = stored(
        coded.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(_pair_counter(buckets), _COUNTS), "pair-counts"
    )
    pairs = _merged(counts.where(F.col("bucket") != _IDS_BUCKET), least, True, "frequent-pairs")
    ids = counts.where(F.col("bucket") == _IDS_BUCKET).select("chunk", "n", "high")
    sent = pairs.where(F.col("chunk") != _ALL_CHUNKS)
    phrases = ids.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(_phrase_counter(buckets), _COUNTS)
    triples = _merged(phrases, least, False, "frequent-triples")
    return (
        words,
        _unpacked(pairs.where(F.col("chunk") == _ALL_CHUNKS)).select(
            F.col("high").alias("first"), F.col("low").alias("second"), "f"
        ),
        _unpacked(triples).select(
            F.shiftright("high", 32).alias("first"), F.col("high").bitwiseAND(F.lit((1 << 32) - 1)).alias("second"),
            F.col("low").alias("third"), "f",
        ),
        totals,
    )


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exact for counts of up to 14 digits."""
    wide = {name: f"cast({name} as decimal(14,0))" for name in (a, left, right)}
    return F.expr(f"({SCALE} * {wide[a]} * {wide[a]}) div ({wide[left]} * {wide[right]})")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    words, pairs, triples, totals = phrase_counts(docs, text, lang, least)
    pairs, triples = stored(pairs, "pairs"), stored(triples, "triples")

    def word(place: str) -> DataFrame:
        names = [F.col("id").alias(place), F.col("word").alias(f"{place}_word"), F.col("f").alias(f"{place}_f")]
        return words.select(*names, *([F.col("lang").alias("lang")] if place == "first" else []))

    def pair(first: str, second: str, name: str) -> DataFrame:
        return pairs.select(F.col("first").alias(first), F.col("second").alias(second), F.col("f").alias(name))

    longest = (
        triples.select("first", "second", "f").unionByName(triples.select(F.col("second").alias("first"), F.col("third").alias("second"), "f"))
        .groupBy("first", "second").agg(F.max("f").alias("longer"))
    )
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    twos = (
        pairs.join(longest, ["first", "second"], "left")
        .where(F.coalesce(100 * F.col("longer") < COVERED_PERCENT * F.col("f"), F.lit(True)))
        .join(word("first"), "first").join(word("second"), "second")
        .select(
            "lang", F.concat_ws(" ", "first_word", "second_word").alias("phrase"), F.col("f").alias("a"),
            F.col("first_f").alias("l"), F.col("second_f").alias("r"),
        )
        .withColumn("score", _score("a", "l", "r"))
        .select(*columns)
    )
    cuts = (
        triples.join(pair("first", "second", "left_f"), ["first", "second"])
        .join(pair("second", "third", "right_f"), ["second", "third"])
        .join(word("first"), "first").join(word("second"), "second").join(word("third"), "third")
        .withColumn("after_one", _score("f", "first_f", "right_f"))
        .withColumn("after_two", _score("f", "left_f", "third_f"))
    )
    later = F.col("after_two") < F.col("after_one")
    threes = cuts.select(
        "lang", F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"), F.col("f").alias("a"),
        F.when(later, F.col("left_f")).otherwise(F.col("first_f")).alias("l"),
        F.when(later, F.col("third_f")).otherwise(F.col("right_f")).alias("r"),
        F.least("after_one", "after_two").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        twos.unionByName(threes)
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        .join(F.broadcast(totals), "lang")
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
