"""Words of many texts at once, cut by the class of each byte.

Every byte is a word's, a space's or a separator's. All separators here are ASCII, so no character of several bytes is
cut in two. A word ends at its text's end even if the next text begins with a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

WORD, SPACE, SEPARATOR = 0, 1, 2
# U+0020 and U+0009 to U+000D, by which the contracts cut words.
BLANKS = b" \t\n\x0b\x0c\r"

# Bytes of text cut at a time.
SLICE_BYTES = 4_000_000


def byte_classes(spaces: bytes, separators: bytes = b""):
    """A table from byte to class."""
    import numpy as np

    table = np.full(256, WORD, dtype=np.uint8)
    table[list(spaces)] = SPACE
    table[list(separators)] = SEPARATOR
    return table


def ascii_lower_table() -> bytes:
    return bytes(range(256)).lower()


def slices(texts, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` bytes of text each; a longer text is a run of its own."""
    import numpy as np
    import pyarrow.compute as pc

    if not len(texts):
        return
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(sizes) - sizes
    cuts = np.flatnonzero(np.diff(before // most)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)])


@dataclass
class Words:
    """All words of the texts in a row: codes into ``dictionary``, the row of each word's text, and how many separators
    stand before it in all texts."""

    codes: object
    dictionary: object
    text_of: object
    separators_before: object


def cut_words(texts, classes, letters: bytes | None = None, signs: bytes = b"") -> Words:
    """Words of an Arrow string array; null texts have none. ``letters`` maps bytes before the words are read.

    A word of small ASCII letters with one of ``signs`` behind them counts as two.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends_buffer, data_buffer = texts.buffers()
    bounds = np.frombuffer(ends_buffer, dtype=np.int64, count=texts.offset + len(texts) + 1)[texts.offset :]
    data = b"" if data_buffer is None else data_buffer.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).to_pybytes()
    bounds = bounds - bounds[0]
    raw = np.frombuffer(data.translate(letters) if letters else data, dtype=np.uint8)
    kinds = classes[raw]
    inside = kinds == WORD
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    # Texts lie side by side; a word at the border of two belongs to one of them only.
    borders = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(raw))]
    begins[borders] = inside[borders]
    finishes[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    text_of = np.searchsorted(bounds, starts, side="right") - 1
    separators = np.searchsorted(np.flatnonzero(kinds == SEPARATOR), starts)
    packed = raw[inside]
    if signs and len(starts):
        others = np.add.reduceat((packed < ord("a")) | (packed > ord("z")), offsets[:-1], dtype=np.int64)
        two = np.flatnonzero((others == 1) & np.isin(packed[offsets[1:] - 1], list(signs)) & (np.diff(offsets) > 1))
        offsets = np.insert(offsets, two + 1, offsets[two + 1] - 1)
        text_of, separators = np.insert(text_of, two, text_of[two]), np.insert(separators, two, separators[two])
    words = pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
    ).dictionary_encode()
    return Words(words.indices.to_numpy(zero_copy_only=False), words.dictionary, text_of, separators)
