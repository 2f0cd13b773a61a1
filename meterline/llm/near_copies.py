"""Similarity join of documents on word n-grams, with an R-tree over count vectors.

A document is the set of its distinct n-grams of words (lower-cased A-Z, split at U+0020 and U+0009 to U+000D); with
fewer than n words the whole sequence is its only one, without words the set is empty and linked with nothing. Two
documents link when ``100 * intersection >= percent * union``.

* Equal sets are one from the start. Each set is hashed into GROUPS groups of tokens; the counts of its groups are its
  point. The sum of the smaller coordinates of two points bounds their overlap from above.
* Sets that link differ in few tokens. Dealt into more blocks than that, at least one block has the same tokens in
  both (and ``spare`` blocks more than one), so only sets with an equal block of their size class are compared. Each set
  leaves out its ``spare`` commonest blocks, empty ones and those of passages that many texts share, without losing a link.
* Among the sets that share a block, an R-tree over the points finds those within the bound. What it connects is a
  candidate group; a spanning forest is enough, so no bucket emits its pairs.
* Within a candidate group the R-tree gives each set the partners within the bound, and the sets themselves decide.
  Sets already reached are not asked again. Groups too large for one task are solved in parts; the sets that the parts
  leave apart are then held, block by block, against the whole group.

Null text counts as empty. Rows that repeat an id are each a document. A null id takes part, but a component is named
after its smallest id that is not null. An empty table gives an empty result. Only the id and the text are read, so
other columns of any name may be there; :func:`drop_near_copies` returns them untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.exact_copies import block_count, key_filter, mark_possible
from meterline.llm.grouping import components, join_groups
from meterline.llm.storage import small_batches, stored

GROUPS = 128
LEAF_POINTS = 64
# Rows that search the tree at a time, which bounds the pairs held at once.
WAVE_ROWS = 64
# A size class ends where sets are this much larger than its smallest.
CLASS_RATIO = 1.4
# Buckets of more sets than this are not searched in one task: their sets are one candidate group as they are.
MOST_IN_BUCKET = 100_000
# Tokens of the sets that one task compares; larger candidate groups are solved in parts.
GROUP_TOKENS = 8_000_000
# Tokens of the sets that are held against a whole group at a time.
BLOCK_TOKENS = 1_000_000
BATCH_BYTES = 1_000_000

PROFILE = "n bigint, set_key binary, points array<int>, keys array<struct<class:int,key:bigint>>"


def need(a, b, percent: int):
    """Least intersection with which sets of sizes ``a`` and ``b`` link."""
    return -(-percent * (a + b) // (100 + percent))


def size_classes(n: int, percent: int) -> list[tuple[int, int]]:
    """The classes a set of ``n`` tokens belongs to, and how many blocks each has.

    Its own class, and those whose smallest sets it may link with as the smaller one.
    """
    found, low, number = [], 1, 0
    while 100 * n >= percent * low:
        above = max(low + 1, int(low * CLASS_RATIO))
        if n < above:
            differing = 2 * (above - 1) * (100 - percent) // (100 + percent)
            if differing:
                found.append((number, differing + 1 + spare_blocks(differing)))
        low, number = above, number + 1
    return found


def spare_blocks(differing: int) -> int:
    return 1 + differing // 8


def _class_spares(percent: int, classes: int = 80) -> list[int]:
    spares, low = [], 1
    for _ in range(classes):
        above = max(low + 1, int(low * CLASS_RATIO))
        spares.append(spare_blocks(2 * (above - 1) * (100 - percent) // (100 + percent)))
        low = above
    return spares


def _mix(values):
    """Spreads 64-bit numbers; a fixed public mixing function (two multiplications and shifts)."""
    import numpy as np

    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def token_sets(texts, width: int):
    """Tokens of each text of an Arrow array, distinct and sorted: all in a row, and where each text's end."""
    import numpy as np
    import pyarrow.compute as pc
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(word) for word in distinct), dtype=np.uint64, count=len(distinct))
    words = hashes[coded.indices.to_numpy()]
    no_word = np.array([word == "" for word in distinct], dtype=bool)[coded.indices.to_numpy()]
    ends = np.cumsum(pc.list_value_length(lists).to_numpy())
    parts, sizes, start = [], [], 0
    for end in ends:
        own = words[start:end][~no_word[start:end]] if end - start == 1 else words[start:end]
        start = end
        if len(own) == 0:
            sizes.append(0)
            continue
        span = min(width, len(own))
        tokens = np.full(len(own) - span + 1, np.uint64(span))
        for step in range(span):
            tokens = _mix(tokens * np.uint64(0x9E3779B97F4A7C15) + own[step : len(own) - span + 1 + step])
        tokens = np.unique(tokens)
        parts.append(tokens)
        sizes.append(len(tokens))
    return np.concatenate([np.zeros(0, dtype=np.uint64), *parts]), np.cumsum(np.array(sizes, dtype=np.int64))


def count_points(tokens, ends):
    """The point of each set: how many of its tokens fall in each group."""
    import numpy as np

    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    cells = owner * GROUPS + (tokens % np.uint64(GROUPS)).astype(np.int64)
    return np.bincount(cells, minlength=len(ends) * GROUPS).reshape(len(ends), GROUPS).astype(np.int32)


def block_keys(tokens, ends, percent: int):
    """For each set its keys ``(class, key)``: one per block of each of its classes, the same for the same tokens."""
    import numpy as np

    starts = ends - np.diff(ends, prepend=0)
    mixes = _mix(tokens ^ np.uint64(0xD6E8FEB86659FD93))
    places = (tokens >> np.uint64(7)).astype(np.int64)
    known: dict[int, list[tuple[int, int]]] = {}
    out = []
    for start, end in zip(starts, ends):
        n = int(end - start)
        if n not in known:
            known[n] = size_classes(n, percent) if n else []
        own = []
        for number, blocks in known[n]:
            sums = np.zeros(blocks, dtype=np.uint64)
            np.add.at(sums, places[start:end] % blocks, mixes[start:end])
            label = np.arange(blocks, dtype=np.uint64) + np.uint64(number << 32)
            own.append((number, _mix(sums + _mix(label + np.uint64(1))).view(np.int64)))
        out.append(own)
    return out


def profiles(docs: DataFrame, width: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_1, text_2`` (two hashes of the text) and the profile of the set of each document."""

    def work(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        pair = pa.struct([("class", pa.int32()), ("key", pa.int64())])
        for batch in batches:
            for start, stop in _runs(batch.column(3)):
                rows = batch.slice(start, stop - start)
                tokens, ends = token_sets(rows.column(3), width)
                starts = ends - np.diff(ends, prepend=0)
                points = count_points(tokens, ends)
                cells = pa.array(np.arange(0, points.size + 1, GROUPS, dtype=np.int32))
                keys = block_keys(tokens, ends, percent)
                sizes = [sum(len(values) for _, values in own) for own in keys]
                classes = [np.full(len(values), number, dtype=np.int32) for own in keys for number, values in own]
                flat = [values for own in keys for _, values in own]
                pairs = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([np.zeros(0, np.int32), *classes])), pa.array(np.concatenate([np.zeros(0, np.int64), *flat]))],
                    fields=list(pair),
                )
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                digests = [hashlib.blake2b(tokens[a:b].tobytes(), digest_size=16).digest() for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0), rows.column(1), rows.column(2), pa.array(ends - starts),
                        pa.array(digests, pa.binary()), pa.ListArray.from_arrays(cells, pa.array(points.ravel())),
                        pa.ListArray.from_arrays(offsets, pairs),
                    ],
                    names=["doc_id", "text_1", "text_2", "n", "set_key", "points", "keys"],
                )

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    return _with_text_hash(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select(
        "doc_id", "text_1", "text_2", "text"
    ).mapInArrow(work, f"doc_id {kind}, text_1 bigint, text_2 bigint, {PROFILE}")


def _with_text_hash(docs: DataFrame) -> DataFrame:
    value = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("*", F.xxhash64(value).alias("text_1"), F.xxhash64(F.lit(1), value).alias("text_2"))


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


class CountTree:
    """R-tree over count vectors, packed by halving the widest coordinate; points can be taken out of it."""

    def __init__(self, points, sizes, percent: int):
        import numpy as np

        self.np, self.points, self.sizes, self.percent = np, points, sizes, percent
        self.nodes: list[tuple] = []
        self.leaf_of = np.zeros(len(sizes), dtype=np.int64)
        self.parent: list[int] = []
        self.alive: list[int] = []
        self.present = np.ones(len(sizes), dtype=bool)
        self._build(np.arange(len(sizes)), -1)

    def _build(self, rows, parent: int) -> int:
        np = self.np
        number = len(self.nodes)
        own = self.points[rows]
        high = own.max(axis=0)
        self.nodes.append((high, int(self.sizes[rows].min()), int(self.sizes[rows].max()), rows, []))
        self.parent.append(parent)
        self.alive.append(len(rows))
        spread = high - own.min(axis=0)
        if len(rows) > LEAF_POINTS and spread.any():
            axis = int(spread.argmax())
            half = np.argpartition(own[:, axis], len(rows) // 2)
            for part in (half[: len(rows) // 2], half[len(rows) // 2 :]):
                child = self._build(rows[np.sort(part)], number)
                self.nodes[number][4].append(child)
        else:
            self.leaf_of[rows] = number
        return number

    def remove(self, rows) -> None:
        self.present[rows] = False
        for leaf, count in zip(*self.np.unique(self.leaf_of[rows], return_counts=True)):
            node = int(leaf)
            while node >= 0:
                self.alive[node] -= int(count)
                node = self.parent[node]

    def within(self, point, size: int):
        """Points still in the tree that may link with this one: the summed minima reach the needed overlap."""
        np, percent = self.np, self.percent
        found, open_nodes = [], [0]
        while open_nodes:
            node = open_nodes.pop()
            high, least, most, rows, children = self.nodes[node]
            if not self.alive[node] or 100 * most < percent * size or percent * least > 100 * size:
                continue
            smallest = max(least, -(-percent * size // 100))
            if int(np.minimum(point, high).sum()) < need(size, smallest, percent):
                continue
            if children:
                open_nodes += children
                continue
            rows = rows[self.present[rows]]
            bound = np.minimum(point, self.points[rows]).sum(axis=1)
            found.append(rows[bound >= need(size, self.sizes[rows], percent)])
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def pairs_within(self, rows):
        """Pairs of the given rows and rows still in the tree that may link: many searches in one walk."""
        np, percent = self.np, self.percent
        left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        open_nodes = [(0, np.asarray(rows, dtype=np.int64))]
        while open_nodes:
            node, asked = open_nodes.pop()
            high, least, most, own, children = self.nodes[node]
            if not self.alive[node]:
                continue
            sizes = self.sizes[asked]
            asked = asked[(100 * most >= percent * sizes) & (percent * least <= 100 * sizes)]
            sizes = self.sizes[asked]
            smallest = np.maximum(least, -(-percent * sizes // 100))
            asked = asked[np.minimum(self.points[asked], high).sum(axis=1) >= need(sizes, smallest, percent)]
            if not len(asked):
                continue
            if children:
                open_nodes += [(child, asked) for child in children]
                continue
            present = own[self.present[own]]
            # All points of a leaf may be the same and so more than a leaf's worth; both sides are taken in parts.
            for at in range(0, len(asked), LEAF_POINTS):
                some = asked[at : at + LEAF_POINTS]
                for to in range(0, len(present), LEAF_POINTS):
                    there = present[to : to + LEAF_POINTS]
                    bound = np.minimum(self.points[some][:, None, :], self.points[there][None, :, :]).sum(axis=2)
                    a, b = np.nonzero(bound >= need(self.sizes[some][:, None], self.sizes[there][None, :], percent))
                    left.append(some[a])
                    right.append(there[b])
        return np.concatenate(left), np.concatenate(right)


def bound_groups(points, sizes, percent: int):
    """Labels of the points that chains within the bound connect."""
    return _spread(points, sizes, percent, lambda reached, others: others)


def link_groups(sets: list, percent: int):
    """Labels of the sets that chains of links connect."""
    import numpy as np

    ends = np.cumsum([len(own) for own in sets])
    flat = np.concatenate(sets)
    sizes = np.diff(ends, prepend=0)

    def linked(reached, others):
        """Of the pairs within the bound, the others that link with one of theirs."""
        order = np.argsort(others, kind="stable")
        reached, others = reached[order], others[order]
        found = []
        starts = np.flatnonzero(np.diff(others, prepend=-1))
        for start, stop in zip(starts, [*starts[1:], len(others)]):
            other = int(others[start])
            own = sets[other]
            for row in reached[start:stop]:
                places = np.searchsorted(sets[row], own)
                places[places == len(sets[row])] = 0
                if int((sets[row][places] == own).sum()) >= need(int(sizes[row]), len(own), percent):
                    found.append(other)
                    break
        return np.array(found, dtype=np.int64)

    return _spread(count_points(flat, ends), sizes, percent, linked)


def _spread(points, sizes, percent: int, accept):
    """Grows groups wave by wave, a wave being a bounded number of reached rows; a row is taken out of the tree once it is reached.

    ``accept`` is given the pairs of a wave within the bound, reached rows and others, and says which others it reaches.
    """
    import numpy as np

    tree = CountTree(points, sizes, percent)
    labels = np.full(len(sizes), -1, dtype=np.int64)
    for seed in range(len(sizes)):
        if labels[seed] >= 0:
            continue
        labels[seed] = seed
        pending = np.array([seed])
        tree.remove(pending)
        while len(pending) and tree.alive[0]:
            wave, pending = pending[:WAVE_ROWS], pending[WAVE_ROWS:]
            reached, others = tree.pairs_within(wave)
            found = np.unique(accept(reached, others)) if len(others) else others
            if len(found):
                labels[found] = seed
                tree.remove(found)
                pending = np.concatenate([pending, found])
    return labels


def _least_common(shared: DataFrame, percent: int) -> DataFrame:
    """Of the blocks ``node, class, key, sharing`` those that are left when each set spares its commonest ones.

    Sets that link have more than ``spare`` equal blocks. Of these the least common comes after ``spare`` others in the
    order of both sets, which is one order for all, so it stays in both. A set with no more shared blocks than it can
    spare links with nothing.
    """
    spares = F.array(*[F.lit(spare) for spare in _class_spares(percent)])
    place = F.row_number().over(Window.partitionBy("node", "class").orderBy(F.desc("sharing"), "key"))
    return shared.withColumn("place", place).where(F.col("place") > F.get(spares, F.col("class"))).select("node", "class", "key")


def _bucket_edges(rows: DataFrame, percent: int) -> DataFrame:
    """Edges among the sets of each bucket that chains within the bound connect, a bucket at a time."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        def solve(nodes, points, sizes):
            labels = bound_groups(points, sizes, percent)
            far = labels != np.arange(len(labels))
            return pa.RecordBatch.from_arrays([pa.array(nodes[labels[far]]), pa.array(nodes[far])], names=["a", "b"])

        held = None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in (0, 1)], axis=1)
            nodes = batch.column(2).to_numpy()
            sizes = batch.column(3).to_numpy()
            points = batch.column(4).flatten().to_numpy().reshape(-1, GROUPS)
            if held is not None:
                keys, nodes, sizes, points = (np.concatenate(pair) for pair in zip(held, (keys, nodes, sizes, points)))
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges = [0, *cuts]
            for start, stop in zip(edges, edges[1:]):
                yield solve(nodes[start:stop], points[start:stop], sizes[start:stop])
            last = edges[-1]
            held = keys[last:], nodes[last:], sizes[last:], points[last:]
        if held is not None and len(held[0]):
            yield solve(*(held[k] for k in (1, 3, 2)))

    ordered = rows.select("class", "key", "node", "n", "points").repartition("class", "key").sortWithinPartitions("class", "key")
    return ordered.mapInArrow(work, "a bigint, b bigint")


def _within_bound(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` whose summed coordinate minima reach the needed overlap."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("points").alias("at_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("points").alias("at_b"))
    minima = F.aggregate(F.zip_with("at_a", "at_b", lambda a, b: F.least(a, b)), F.lit(0), lambda total, one: total + one)
    enough = (100 + percent) * minima >= percent * (F.col("n_a") + F.col("n_b"))
    return pairs.join(left, "a").join(right, "b").where(enough).select("a", "b")


def candidate_edges(keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between nodes of ``sets`` whose components hold every pair that may link.

    ``keys`` has the blocks of each set, ``node, class, key``.
    """
    counts = stored(_sharing(keys), "shared-blocks")
    by_two = counts.where("sharing = 2").select(F.explode(F.array("first", "last")).alias("node"), "class", "key", "sharing")
    several = stored(counts.where("sharing > 2").select("class", "key", "sharing"), "buckets")
    blocks = block_count(several.count())
    maybe = mark_possible(keys, ("class", "key"), key_filter(several, ("class", "key"), blocks), blocks, "maybe")
    by_several = maybe.where("maybe").join(several, ["class", "key"]).select(*by_two.columns)
    kept = stored(_least_common(by_two.unionByName(by_several), percent), "kept-blocks")
    buckets = stored(_sharing(kept), "kept-buckets")
    pairs = buckets.where("sharing = 2").select(F.col("first").alias("a"), F.col("last").alias("b")).distinct()
    pairs = _within_bound(pairs, sets, percent)
    shared = kept.join(buckets.where("sharing > 2").select("class", "key", "sharing", "first"), ["class", "key"])
    searched = shared.where(F.col("sharing") <= MOST_IN_BUCKET).join(sets.select("node", "n", "points"), "node")
    as_they_are = shared.where(F.col("sharing") > MOST_IN_BUCKET).select(F.col("first").alias("a"), F.col("node").alias("b"))
    return pairs.unionByName(_bucket_edges(searched, percent)).unionByName(as_they_are.where("a <> b")).distinct()


def _sharing(keys: DataFrame) -> DataFrame:
    """``class, key`` that several nodes share, how many do, the first and the last of them."""
    shared = keys.groupBy("class", "key").agg(
        F.count(F.lit(1)).alias("sharing"), F.min("node").alias("first"), F.max("node").alias("last")
    )
    return shared.where("sharing > 1")


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int, text: str) -> DataFrame:
    """``node, group, n, tokens`` for the wanted sets, their texts found again by two hashes."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for start, stop in _runs(batch.column(3)):
                rows = batch.slice(start, stop - start)
                tokens, ends = token_sets(rows.column(3), width)
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), pa.ListArray.from_arrays(offsets, pa.array(tokens.view(np.int64)))],
                    names=["node", "group", "n", "tokens"],
                )

    blocks = block_count(wanted.count())
    texts = _with_text_hash(docs.select(F.col(text).alias("text")))
    maybe = mark_possible(texts, ("text_1", "text_2"), key_filter(wanted, ("text_1", "text_2"), blocks), blocks, "maybe")
    once = maybe.where("maybe").groupBy("text_1", "text_2").agg(F.first("text").alias("text"))
    found = once.join(wanted, ["text_1", "text_2"]).select("node", "group", "n", F.coalesce("text", F.lit("")).alias("text"))
    return found.mapInArrow(work, "node bigint, group bigint, n bigint, tokens array<bigint>")


def _arrays(lists) -> list:
    """The token sets of a column of lists, without a copy of each."""
    import numpy as np

    chunks = lists.chunks if hasattr(lists, "chunks") else [lists]
    sets: list = []
    for chunk in chunks:
        flat = chunk.values.to_numpy().view(np.uint64)
        edges = chunk.offsets.to_numpy().tolist()
        sets += [flat[a:b] for a, b in zip(edges, edges[1:])]
    return sets


def _solve(rows: DataFrame, by: list[str], percent: int) -> DataFrame:
    """Edges that connect the linked sets of each group; a group is one task's."""

    def work(key, table):
        import numpy as np
        import pyarrow as pa

        nodes = table.column("node").to_numpy()
        sets = _arrays(table.column("tokens"))
        labels = link_groups(sets, percent)
        far = labels != np.arange(len(labels))
        return pa.table({"a": nodes[labels[far]], "b": nodes[far]})

    # As many parts as a shuffle has, however small the groups are: the work is in comparing, not in the bytes.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *by).groupBy(*by).applyInArrow(work, "a bigint, b bigint")


def _solve_large(rows: DataFrame, parts: DataFrame, percent: int, group_tokens: int) -> DataFrame:
    """Edges of candidate groups too large for one task: parts first, then what the parts leave apart.

    Only pairs of different results can still be missing, so the sets outside the largest result of their group are held
    against the whole group.
    """
    parted = rows.join(parts, "group").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    inner = stored(_solve(parted, ["group", "part"], percent), "part-links")
    # A few sets of each result stand for it where results of different parts are joined; that misses some, not all.
    label = F.coalesce("label", F.col("node"))

    def labelled(edges):
        return stored(rows.select("node", "group", "n").join(components(edges), "node", "left").withColumn("label", label), "part-labels")

    first = labelled(inner)
    place = F.row_number().over(Window.partitionBy("group", "label").orderBy(F.xxhash64("node"), "node"))
    stands = first.withColumn("place", place).where("place <= 4")
    held = F.sum("n").over(Window.partitionBy("group").orderBy("place", F.xxhash64("node"), "node"))
    stands = stands.withColumn("held", held).where(F.col("held") <= group_tokens).select("node")
    outer = stored(_solve(rows.join(stands, "node", "left_semi"), ["group"], percent), "outer-links")
    links = inner.unionByName(outer)
    second = labelled(links)
    results = second.groupBy("group", "label").agg(F.sum("n").alias("tokens"))
    largest = results.groupBy("group").agg(F.max_by("label", F.struct("tokens", "label")).alias("largest"))
    apart = stored(second.join(largest, "group").where("label <> largest").select("group", "node", "n"), "sets-apart")
    return links.unionByName(_held_against(rows.join(second.select("node", "label"), "node"), apart, percent, group_tokens))


def _held_against(rows: DataFrame, apart: DataFrame, percent: int, group_tokens: int) -> DataFrame:
    """Links between the sets apart and the sets of their groups with another label.

    One shuffled job: a task has a block of the sets apart, in memory, and a slice of the whole group, which passes by.
    Both are bounded; how many there are grows with the group and with what is apart.
    """
    block_tokens = min(BLOCK_TOKENS, group_tokens)
    blocks = apart.groupBy("group").agg(F.ceil(F.sum("n") / block_tokens).alias("blocks"))
    slices = rows.groupBy("group").agg(F.ceil(F.sum("n") / group_tokens).alias("slices"))
    cut = rows.join(blocks.join(slices, "group"), "group")
    columns = [F.col(name) for name in ("group", "node", "label", "tokens")]
    block, slice_ = F.pmod(F.xxhash64("node"), "blocks"), F.pmod(F.xxhash64("node", F.lit(1)), "slices")
    held = cut.join(apart.select("node"), "node", "left_semi").select(
        *columns, block.alias("block"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("passing")
    )
    passing = cut.select(
        *columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), slice_.alias("slice"), F.lit(1).alias("passing")
    )

    def work(batches):
        import numpy as np
        import pyarrow as pa

        place = own = tree = None
        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy().astype(np.int64) for name in ("group", "block", "slice", "passing")], axis=1)
            nodes, labels = batch.column("node").to_numpy(), batch.column("label").to_numpy()
            sets = _arrays(batch.column("tokens"))
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            found = []
            for start, stop in zip(edges, edges[1:]):
                here = tuple(keys[start, :3])
                if not keys[start, 3]:
                    if here != place:
                        place, own, tree = here, ([], [], []), None
                    own[0].extend(nodes[start:stop])
                    own[1].extend(labels[start:stop])
                    own[2].extend(tokens.copy() for tokens in sets[start:stop])
                    continue
                if here != place:
                    continue
                if tree is None:
                    sizes = np.array([len(tokens) for tokens in own[2]])
                    tree = CountTree(count_points(np.concatenate(own[2]), np.cumsum(sizes)), sizes, percent)
                for row in range(start, stop):
                    size = len(sets[row])
                    for other in tree.within(count_points(sets[row], np.array([size]))[0], size):
                        if own[1][other] == labels[row]:
                            continue
                        overlap = len(np.intersect1d(sets[row], own[2][other], assume_unique=True))
                        if overlap >= need(size, len(own[2][other]), percent):
                            found.append((nodes[row], own[0][other]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
            )

    by = ["group", "block", "slice"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = held.unionByName(passing).repartition(parts, *by).sortWithinPartitions(*by, "passing")
    return dealt.mapInArrow(work, "a bigint, b bigint")


def near_copies(
    docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document, and ``set_key``, the digest of its set."""
    with small_batches(docs.sparkSession):
        rows = stored(profiles(docs, width, percent, doc_id, text).withColumn("node", F.monotonically_increasing_id()), "profiles")
    # Rows of the same set agree in everything but the id and the text; one of them stands for the set.
    sets = stored(
        rows.where("n > 0")
        .groupBy("set_key")
        .agg(
            F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("first_id"), F.first("n").alias("n"),
            F.first("points").alias("points"), F.min(F.struct("text_1", "text_2")).alias("text"), F.min("node").alias("node"),
        ),
        "sets",
    )
    # Keys stay where they were written. The filter may let a row pass that stands for no set; no set is joined to it.
    blocks = block_count(sets.count())
    keys = mark_possible(rows.where("n > 0"), ("node",), key_filter(sets, ("node",), blocks), blocks, "maybe").where("maybe")
    keys = keys.select("node", F.explode("keys").alias("part")).select("node", "part.class", "part.key")
    groups = components(candidate_edges(keys, sets, percent)).withColumnRenamed("label", "group")
    wanted = stored(
        sets.select("node", "n", "text.text_1", "text.text_2").join(groups, "node"), "candidate-sets"
    )
    with small_batches(docs.sparkSession):
        found = stored(_sets_of(docs, wanted, width, text), "candidate-tokens")
    tokens = found.groupBy("group").agg(F.sum("n").alias("tokens"))
    large = stored(
        tokens.where(F.col("tokens") > group_tokens).select("group", F.ceil(F.col("tokens") * 2 / group_tokens).alias("parts")),
        "large-groups",
    )
    if large.isEmpty():
        links = _solve(found, ["group"], percent)
    else:
        in_large = stored(found.join(large, "group", "left_semi"), "large-group-tokens")
        links = _solve(found.join(large, "group", "left_anti"), ["group"], percent).unionByName(
            _solve_large(in_large, large, percent, group_tokens)
        )
    labels = components(links)
    named = sets.select("set_key", "documents", "first_id", "node").join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    firsts = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = stored(named.join(firsts, "label").select("set_key", "documents", "component_id"), "set-components")
    narrow = rows.select("doc_id", F.col("n").alias("n_shingles"), "set_key")
    filled = join_groups(narrow.where("n_shingles > 0"), named, "set_key", "documents", rows.count())
    empty = narrow.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return filled.drop("documents").unionByName(empty)


def drop_near_copies(
    docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The document with the smallest id of each component, with all its columns; all documents without words stay.

    Of rows that repeat that id with the same set one stays.
    """
    numbered = stored(docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("row")), "numbered")
    narrow = numbered.select("row", F.col(f"whole.`{doc_id}`").alias("id"), F.col(f"whole.`{text}`").alias("text"))
    ranked = narrow.select(F.struct(F.col("id").isNull().alias("no_id"), "id", "row").alias("place"), "text")
    found = near_copies(ranked, width, percent, "place", "text")
    first = found.where("n_shingles = 0 OR component_id = doc_id").select("doc_id.row")
    return numbered.join(first, "row", "left_semi").select("whole.*")
