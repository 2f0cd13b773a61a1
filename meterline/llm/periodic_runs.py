"""Periodic runs of words, found on a Re-Pair grammar.

The words of a slice of documents are numbered and the numbers compressed by Re-Pair: in rounds, pairs that occur twice
or more become nonterminals, an occurrence giving way to an overlapping one of a more frequent pair, until no pair
repeats. What is left of each document is made binary by halving. So every stretch of words has one lowest node of the
derivation that holds it, and it crosses that node's boundary. Runs are therefore looked for at boundaries only, once for
each nonterminal however often it is derived, are carried to all positions it is derived at, and those that neighbouring
words extend are dropped there, since a node above holds them whole.

At a boundary a run of length max(24, 3 periods) has half its length on one side, which is at least one and a half
periods and twelve words. So the four words next to the boundary stand again one period further on that side. Only such
distances are candidates, and each is verified word by word. Nothing is left to hashing but the search for candidates.

A null text, or one without words, has no runs. A null id leaves the words as they are. Repeated ids and rows are kept,
each row on its own; an empty table gives an empty result. Only id and text are read, so further columns of any name
may be there. Rows move nowhere: each task works on its documents in slices of a few megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.words import BLANKS, byte_classes, cut_words, slices

# Fixed values of the contract: a run has at least so many words and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3

# Words next to a boundary that recur one period on: half the shortest run, and half a period beyond the period itself.
GRAM = 4
# Words compared in one step, over all candidates.
STEP_CELLS = 2_000_000

RUN_COLUMNS = (
    "n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


@dataclass
class Grammar:
    """Nonterminals of a slice by the words they stand for, and what is left of each document.

    ``first``, ``left`` and ``length`` give each nonterminal's first position in the words, the words of its left part
    and all its words. ``places`` has the positions it is derived at, from ``place_ends[rule - 1]`` to
    ``place_ends[rule]``. ``rest`` has the start of each symbol left, and ``rest_ends`` where each document's end.
    """

    first: object
    left: object
    length: object
    places: object
    place_ends: object
    rest: object
    rest_ends: object


def _chosen(keys, where):
    """Which pair occurrences to replace: of overlapping ones that of the more frequent pair.

    ``keys`` are pairs and ``where`` their places in the sequence, ascending. Returns places, and the number of each
    one's pair, without pairs that would be replaced once only.
    """
    import numpy as np

    none = np.zeros(0, dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    pair = np.cumsum(new) - 1
    counts = np.bincount(pair)
    if not len(counts) or counts.max() < 2:
        return none, none
    # Pairs by rising frequency: a rank above zero for those that occur twice.
    rank = np.empty(len(counts), dtype=np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(1, len(counts) + 1)
    rank[counts < 2] = 0
    rank_at = np.empty(len(keys), dtype=np.int64)
    rank_at[order] = rank[pair]
    kept = np.flatnonzero(rank_at)
    where, rank_at = where[kept], rank_at[kept]
    # In a stretch of one symbol the same pair overlaps itself; every second occurrence counts.
    touches = np.zeros(len(where), dtype=bool)
    touches[1:] = where[1:] == where[:-1] + 1
    same = touches.copy()
    same[1:] &= rank_at[1:] == rank_at[:-1]
    heads = np.maximum.accumulate(np.where(same, 0, np.arange(len(where))))
    even = (np.arange(len(where)) - heads) % 2 == 0
    where, rank_at = where[even], rank_at[even]
    taken_places, taken_ranks = [], []
    while len(where):
        touches = np.zeros(len(where) + 1, dtype=bool)
        touches[1:-1] = where[1:] == where[:-1] + 1
        beats = np.ones(len(where), dtype=bool)
        beats[1:] &= ~touches[1:-1] | (rank_at[1:] > rank_at[:-1])
        beats[:-1] &= ~touches[1:-1] | (rank_at[:-1] > rank_at[1:])
        taken_places.append(where[beats])
        taken_ranks.append(rank_at[beats])
        gone = beats.copy()
        gone[1:] |= touches[1:-1] & beats[:-1]
        gone[:-1] |= touches[1:-1] & beats[1:]
        where, rank_at = where[~gone], rank_at[~gone]
    places, ranks = np.concatenate(taken_places), np.concatenate(taken_ranks)
    uses = np.bincount(ranks)
    often = uses[ranks] > 1
    places, ranks = places[often], ranks[often]
    order = np.argsort(places)
    return places[order], ranks[order]


def compress(words, text_ends) -> Grammar:
    """Re-Pair over word numbers; ``text_ends`` says where each document's words end. No pair spans two documents."""
    import numpy as np

    symbols = np.asarray(words, dtype=np.int64)
    starts = np.arange(len(symbols), dtype=np.int64)
    last = np.zeros(len(symbols), dtype=bool)
    filled = text_ends[np.diff(text_ends, prepend=0) > 0]
    last[filled - 1] = True
    size = int(symbols.max()) + 1 if len(symbols) else 0
    rules = [(np.zeros(0, np.int64),) * 3]
    derived: list = []
    made = 0
    active = np.arange(max(len(symbols) - 1, 0))
    while len(active):
        active = active[~last[active]]
        places, ranks = _chosen(symbols[active] << 32 | symbols[active + 1], active)
        if not len(places):
            break
        _, first, number = np.unique(ranks, return_index=True, return_inverse=True)
        ends = np.append(starts[1:], len(words))
        finishes = ends[places + 1]
        head = places[first]
        rules.append((starts[head], starts[head + 1] - starts[head], ends[head + 1] - starts[head]))
        longish = finishes - starts[places] >= LEAST_WORDS
        derived.append((number[longish] + made, starts[places][longish]))
        symbols[places] = number + size
        last[places] |= last[places + 1]
        stays = np.ones(len(symbols), dtype=bool)
        stays[places + 1] = False
        now = np.cumsum(stays)[places] - 1
        symbols, starts, last = symbols[stays], starts[stays], last[stays]
        made += len(first)
        size += len(first)
        # Only pairs with a new symbol can have become frequent.
        active = np.unique(np.concatenate([now - 1, now]))
        active = active[(active >= 0) & (active < len(symbols) - 1)]
    first, left, length = (np.concatenate(parts) for parts in zip(*rules))
    rule_of = np.concatenate([part[0] for part in derived]) if derived else np.zeros(0, np.int64)
    at = np.concatenate([part[1] for part in derived]) if derived else np.zeros(0, np.int64)
    order = np.argsort(rule_of, kind="stable")
    place_ends = np.cumsum(np.bincount(rule_of, minlength=made)) if made else np.zeros(0, np.int64)
    return Grammar(first, left, length, at[order], place_ends, starts, np.searchsorted(starts, text_ends))


def _halves(grammar: Grammar, text_ends):
    """Boundaries of the binary tree over what is left of each document: ``low, boundary, high``, in words."""
    import numpy as np

    starts = np.append(grammar.rest, text_ends[-1] if len(text_ends) else 0)
    low, high = np.append(0, grammar.rest_ends[:-1]), grammar.rest_ends
    found = []
    while len(low):
        large = (high - low > 1) & (starts[high] - starts[low] >= LEAST_WORDS)
        low, high = low[large], high[large]
        middle = (low + high) // 2
        found.append((starts[low], starts[middle], starts[high]))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
    return tuple(np.concatenate(parts) for parts in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _grams(words):
    """A 64-bit hash of each four words in a row; equal words give equal hashes."""
    import numpy as np

    mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x7F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    out = np.zeros(max(len(words) - GRAM + 1, 0), dtype=np.uint64)
    for place in range(GRAM):
        out = out * np.uint64(0xBF58476D1CE4E5B9) + mixed[place : place + len(out)]
    return out


def _agreeing(words, at, distance, room, step: int):
    """How many words in a row agree with those ``distance`` on, from ``at`` forwards (1) or backwards (-1)."""
    import numpy as np

    agreed = np.zeros(len(at), dtype=np.int64)
    going = np.flatnonzero(room > 0)
    width = 16
    while len(going):
        rest = []
        share = max(STEP_CELLS // width, 1)
        reach = np.arange(width, dtype=np.int64)
        for part in (going[k : k + share] for k in range(0, len(going), share)):
            here = reach + agreed[part, None]
            inside = here < room[part, None]
            place = at[part, None] + step * np.where(inside, here, 0)
            equal = (words[place] == words[place + distance[part, None]]) & inside
            all_equal = equal.all(axis=1)
            agreed[part] += np.where(all_equal, width, equal.argmin(axis=1))
            rest.append(part[all_equal])
        going = np.concatenate(rest)
        going = going[agreed[going] < room[going]]
        width = min(width * 2, 4096)
    return agreed


def _candidates(words, low, boundary, high):
    """``node, anchor, period``: distances at which the words beside a boundary recur; the anchor is the earlier place."""
    import numpy as np

    grams = _grams(words)
    order = np.argsort(grams, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = grams[order[1:]] != grams[order[:-1]]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    span = np.int64(len(words) + 1)
    ordered = group[order] * span + order
    found = []
    for forwards in (True, False):
        gram_at = boundary if forwards else boundary - GRAM
        usable = np.flatnonzero((gram_at >= low) & (gram_at + GRAM <= high))
        at = gram_at[usable]
        # One and a half periods lie on this side of the boundary.
        if forwards:
            least, most = at + 1, np.minimum(at + (high - boundary)[usable] * 2 // 3, high[usable] - GRAM)
        else:
            least, most = np.maximum(at - (boundary - low)[usable] * 2 // 3, low[usable]), at - 1
        begin = np.searchsorted(ordered, group[at] * span + least)
        end = np.searchsorted(ordered, group[at] * span + most, side="right")
        number = np.maximum(end - begin, 0)
        node = np.repeat(np.arange(len(usable)), number)
        other = order[np.repeat(begin - (np.cumsum(number) - number), number) + np.arange(number.sum())]
        period = np.abs(other - at[node])
        node = usable[node]
        anchor = boundary[node] if forwards else boundary[node] - period
        # On this side so many words agree at least.
        needed = np.maximum(LEAST_WORDS // 2, (3 * period + 1) // 2) - period
        near = np.minimum(needed, 16)
        if forwards:
            agreed = _agreeing(words, anchor, period, np.minimum(near, high[node] - anchor - period), 1)
        else:
            agreed = _agreeing(words, anchor - 1, period, np.minimum(near, anchor - low[node]), -1)
        keep = agreed >= near
        found.append((node[keep] * 2 + forwards, anchor[keep], period[keep]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _verified(words, sides, anchor, period, low, high):
    """Runs ``node, start, end, period`` among candidates, bounded by their node.

    Smaller periods come first, and multiples of a period already found whose run holds them are left out, as they
    would give the same stretch again: each pass takes four times as many candidates of a side as the one before.
    """
    import numpy as np

    order = np.lexsort((period, sides))
    sides, anchor, period = sides[order], anchor[order], period[order]
    out = []
    share = 1
    while len(sides):
        heads = np.searchsorted(sides, sides)
        now = np.arange(len(sides)) - heads < share
        node, at, far = sides[now] // 2, anchor[now], period[now]
        ends = at + far + _agreeing(words, at, far, high[node] - at - far, 1)
        starts = at - _agreeing(words, at - 1, far, at - low[node], -1)
        good = ends - starts >= np.maximum(LEAST_WORDS, LEAST_PERIODS * far)
        out.append((node[good], starts[good], ends[good], far[good]))
        found_sides, found_periods, found_starts, found_ends = sides[now][good], far[good], starts[good], ends[good]
        sides, anchor, period = sides[~now], anchor[~now], period[~now]
        # The smallest period found on a side; several rounds are rare, as further ones come in later passes.
        first = np.ones(len(found_sides), dtype=bool)
        first[1:] = found_sides[1:] != found_sides[:-1]
        at_side = np.searchsorted(found_sides[first], sides)
        if first.any() and len(sides):
            at_side = np.minimum(at_side, first.sum() - 1)
            known = found_sides[first][at_side] == sides
            base, start, end = found_periods[first][at_side], found_starts[first][at_side], found_ends[first][at_side]
            again = known & (period % base == 0) & (anchor >= start) & (anchor + period < end)
            sides, anchor, period = sides[~again], anchor[~again], period[~again]
        share *= 4
    return tuple(np.concatenate(parts) for parts in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def find_runs(words, text_ends):
    """All runs of a slice, ``start, end, period`` in words of the slice, ordered by start and period."""
    import numpy as np

    grammar = compress(words, text_ends)
    long_rules = np.flatnonzero(grammar.length >= LEAST_WORDS)
    first = grammar.first[long_rules]
    tops = _halves(grammar, text_ends)
    low = np.concatenate([first, tops[0]])
    boundary = np.concatenate([first + grammar.left[long_rules], tops[1]])
    high = np.concatenate([first + grammar.length[long_rules], tops[2]])
    if not len(low):
        return (np.zeros(0, np.int64),) * 3
    node, start, end, period = _verified(words, *_candidates(words, low, boundary, high), low, high)
    # To every place at which the nonterminal is derived; the nodes above stand at one place.
    is_rule = node < len(long_rules)
    rule = long_rules[np.where(is_rule, node, 0)] if len(long_rules) else np.zeros(len(node), np.int64)
    ends_at = np.append(0, grammar.place_ends)
    times = np.where(is_rule, ends_at[rule + 1] - ends_at[rule], 1) if len(long_rules) else np.ones(len(node), np.int64)
    row = np.repeat(np.arange(len(node)), times)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    shift = np.zeros(len(row), dtype=np.int64)
    moved = is_rule[row]
    shift[moved] = grammar.places[ends_at[rule[row[moved]]] + turn[moved]] - low[node[row[moved]]]
    start, end, period = start[row] + shift, end[row] + shift, period[row]
    # Where a neighbouring word keeps the period, a node above has the whole run.
    text = np.searchsorted(text_ends, start, side="right")
    text_low, text_high = np.append(0, text_ends)[text], text_ends[text]
    longer = (start > text_low) & (words[start - 1] == words[start - 1 + period])
    after = np.minimum(end, len(words) - 1)
    longer |= (end < text_high) & (words[after] == words[after - period])
    start, end, period = start[~longer], end[~longer], period[~longer]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[fresh], end[fresh], period[fresh]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def rewritten(doc_ids: list, text_ends):
    """For each word of a slice, the word that stands in its place: every tenth document by hash repeats its end."""
    import zlib

    import numpy as np

    source = np.arange(text_ends[-1] if len(text_ends) else 0)
    low = 0
    for doc_id, high in zip(doc_ids, text_ends.tolist()):
        n = high - low
        if n and doc_id is not None:
            hashed = zlib.crc32(str(doc_id).encode())
            if hashed % 10 == 0:
                a = hashed // 10 % n
                period = 1 + (n - a) // (3 + hashed // 10 % 8)
                source[low + a : high] = low + a + np.arange(n - a) % period
        low = high
    return source


def _digests(words, dictionary, text_ends) -> list[str]:
    """SHA-256 of each document's words joined by one space."""
    import hashlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    chosen = dictionary.take(pa.array(words))
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, text_ends), pa.int64()), chosen)
    joined = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))
    _, bounds, data = joined.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64, count=len(joined) + 1).tolist()
    view = memoryview(b"" if data is None else data)
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])]


def _documents(doc_ids: list, texts, rewrite: bool) -> list[list]:
    """Columns of :data:`RUN_COLUMNS` for a slice of documents."""
    import hashlib

    import numpy as np

    cut = cut_words(texts, byte_classes(BLANKS))
    text_ends = np.searchsorted(cut.text_of, np.arange(len(texts)), side="right")
    words = cut.codes[rewritten(doc_ids, text_ends)] if rewrite else cut.codes
    start, end, period = find_runs(words, text_ends)
    text = np.searchsorted(text_ends, start, side="right")
    text_low = np.append(0, text_ends)
    # Words behind the first period of some run go.
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    stays = np.cumsum(change[:-1]) == 0
    kept_ends = np.append(0, np.cumsum(stays))[text_ends]
    collapsed = _digests(words[stays], cut.dictionary, kept_ends)
    n_words = np.diff(text_ends, prepend=0)
    n_runs = np.bincount(text, minlength=len(texts))
    empty = hashlib.sha256(b"").hexdigest()
    best: list = [[None] * len(texts) for _ in range(4)]
    digests = [empty] * len(texts)
    ends_of_runs = np.cumsum(n_runs)
    for row in np.flatnonzero(n_runs).tolist():
        part = slice(ends_of_runs[row] - n_runs[row], ends_of_runs[row])
        runs = list(zip((start[part] - text_low[row]).tolist(), (end[part] - start[part]).tolist(), period[part].tolist()))
        digests[row] = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        top = runs[0]
        for run in runs[1:]:
            if run[1] * top[2] > top[1] * run[2]:
                top = run
        for column, value in zip(best, (*top, 1000 * top[1] // top[2])):
            column[row] = value
    return [n_words.tolist(), n_runs.tolist(), *best, digests, collapsed]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite: bool = False) -> DataFrame:
    """Per document its words, its runs, the run with the greatest exponent, and digests of all runs and of the words
    that are left without the repeats. ``rewrite`` first repeats the end of every tenth document, as a stated test."""

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        names = [part.split()[0] for part in RUN_COLUMNS.split(", ")]
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                columns = _documents(part.column(0).to_pylist(), part.column(1), rewrite)
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=["doc_id", *names])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(work, f"doc_id {kind}, {RUN_COLUMNS}")
