"""Exact copies, found with two passes over a blocked Bloom filter.

Pass one hashes every text and counts how often each of its filter positions is hit; positions hit twice or
more are folded into bitmaps. Pass two looks both positions of each text up in those bitmaps: a text of which
one position was hit only once is certainly unique and passes straight through; only the others are shuffled
and compared by their whole SHA-256. A filter that is too full lets more rows into the shuffle, never fewer.

Texts are equal when identical without the characters U+0020 and U+0009 to U+000D. Of equal texts the row with
the most code points stays, then the smallest id, then (for rows that repeat an id) one of them. A null text is
an empty one; a null id sorts after all others. An empty table gives an empty result. Columns of any name may
come along; :func:`drop_exact_copies` returns them untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.grouping import join_groups
from meterline.llm.storage import stored

WHITE_SPACE = " \t\n\x0b\x0c\r"

# Bits of one bitmap, fixed by Spark's bitmap functions, and of the words it is looked up by.
BLOCK_BITS = 32768
WORD_BITS = 64
# Filter bits per row, and the most bits a filter may have: 128 MB, which is what is broadcast at most.
BITS_PER_ROW = 16
MOST_BITS = 1 << 30


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    value = F.coalesce(text, F.lit(""))
    for character in WHITE_SPACE:
        value = F.replace(value, F.lit(character), F.lit(""))
    return value


def fingerprint(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as lower-case hex."""
    return F.sha2(normalised(text), 256)


def _bit(keys: tuple[str, ...], probe: int) -> Column:
    """A key's bit in its block."""
    return F.pmod(F.xxhash64(*[F.col(key) for key in keys], F.lit(probe)), F.lit(BLOCK_BITS))


def _position(keys: tuple[str, ...], blocks: int, probe: int) -> Column:
    """Place of a key's bit in the filter: one block for both probes."""
    return _block(keys, blocks) * BLOCK_BITS + _bit(keys, probe)


def _block(keys: tuple[str, ...], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(key) for key in keys]), F.lit(blocks))


def block_count(rows: int) -> int:
    """Blocks of the filter for so many rows: a power of two, within the bound on what is broadcast."""
    blocks = 1
    while blocks * BLOCK_BITS < min(rows * BITS_PER_ROW, MOST_BITS):
        blocks *= 2
    return blocks


def _positions(rows: DataFrame, keys: tuple[str, ...], blocks: int) -> DataFrame:
    return rows.select(F.explode(F.array(*[_position(keys, blocks, probe) for probe in (1, 2)])).alias("position"))


def _bitmaps(positions: DataFrame) -> DataFrame:
    # Spark's bitmap functions count positions from 1.
    place = F.col("position") + 1
    return positions.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def key_filter(rows: DataFrame, keys: tuple[str, ...], blocks: int) -> DataFrame:
    """Bitmaps ``(block, bits)`` of the positions that ``rows`` hit: at most ``blocks`` rows of 4 KB."""
    return _bitmaps(_positions(rows, keys, blocks))


def repeat_filter(rows: DataFrame, keys: tuple[str, ...], blocks: int) -> DataFrame:
    """Bitmaps of the positions that two or more of ``rows`` hit."""
    return _bitmaps(_positions(rows, keys, blocks).groupBy("position").count().where("count > 1"))


def _words(bits: Column) -> Column:
    """A bitmap as 64-bit words, the first byte of each uppermost. A row that looks a word up copies no bitmap, as it would bytes."""
    half = lambda at: F.conv(F.hex(F.substr(bits, at, F.lit(4))), 16, 10).cast("bigint")
    places = F.sequence(F.lit(1), F.lit(BLOCK_BITS // 8), F.lit(WORD_BITS // 8))
    return F.transform(places, lambda place: F.shiftleft(half(place), 32).bitwiseOR(half(place + 4)))


def _is_set(words: Column, bit: Column) -> Column:
    word = F.get(words, F.floor(bit / WORD_BITS).cast("int"))
    # Bytes of a word come uppermost first, bits of a byte lowest first.
    return F.getbit(word, F.pmod(bit, F.lit(WORD_BITS)).cast("int").bitwiseXOR(F.lit(WORD_BITS - 8))) == 1


def mark_possible(rows: DataFrame, keys: tuple[str, ...], bitmaps: DataFrame, blocks: int, flag: str) -> DataFrame:
    """Adds ``flag``: false where the filter proves that it does not have this key."""
    looked_up = F.broadcast(bitmaps.select(F.col("block").alias("_block"), _words(F.col("bits")).alias("_words")))
    hit = F.lit(True)
    for probe in (1, 2):
        hit = hit & _is_set(F.col("_words"), _bit(keys, probe))
    return (
        rows.join(looked_up, _block(keys, blocks) + 1 == F.col("_block"), "left")
        .withColumn(flag, F.coalesce(hit, F.lit(False)))
        .drop("_block", "_words")
    )


def _rank(points: str, doc_id: str) -> list[Column]:
    return [(-F.col(points)).alias("points"), F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id")]


def exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    prints = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.coalesce(F.length(text), F.lit(0)).alias("points"),
            F.unhex(fingerprint(F.col(text))).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "fingerprints",
    )
    rows = prints.count()
    blocks = block_count(rows)
    marked = mark_possible(prints, ("key",), repeat_filter(prints, ("key",), blocks), blocks, "maybe")
    digest = F.lower(F.hex("key")).alias("text_sha256")
    alone = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), digest,
    )
    candidates = marked.where("maybe")
    groups = stored(
        candidates.groupBy("key").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct(*_rank("points", "doc_id"), F.col("row"))).alias("stays"),
        ),
        "copy-groups",
    )
    decided = join_groups(candidates, groups, "key", "group_size", rows).select(
        "doc_id", F.col("stays.id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"), digest
    )
    return alone.unionByName(decided)


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Copies are combined per task before they are shuffled."""
    rows = docs.select(F.struct("*").alias("whole"), F.unhex(fingerprint(F.col(text))).alias("key"))
    keys = stored(rows.select("key"), "fingerprints")
    blocks = block_count(keys.count())
    marked = mark_possible(rows, ("key",), repeat_filter(keys, ("key",), blocks), blocks, "maybe")
    order = F.struct(
        -F.coalesce(F.length(f"whole.`{text}`"), F.lit(0)),
        F.col(f"whole.`{doc_id}`").isNull(),
        F.col(f"whole.`{doc_id}`"),
        F.col(f"whole.`{text}`"),
    )
    survivors = marked.where("maybe").groupBy("key").agg(F.min_by("whole", order).alias("whole")).select("whole.*")
    return marked.where(~F.col("maybe")).select("whole.*").unionByName(survivors)
