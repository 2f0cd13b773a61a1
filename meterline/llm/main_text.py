"""Main text of web pages: structure first, then the difference to the page with the nearest URL.

A page is read into blocks. What stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or
reader comments (by element, role, whole class or id) is left out; a class or id leaves out no element that holds the
article. Blocks within an element that marks the article are certain, the others are open.
Every page is then compared with a neighbour: within each host pages are ordered by URL path, and of the one before and
the one after the one that shares the longer start of the path is taken (the one before on a tie). Pages of one path,
like those that differ in their query, are neighbours of each other only on a host without another path; else they take
the neighbour of the first of them. The whole lists of blocks, those left out included, are aligned by a longest common
subsequence, and shared open blocks are deleted as parts of the template. Certain blocks stay even if shared, as two pages may carry
the same article. Where the shared blocks are most of the text of one of the two pages, these are near copies and
nothing is deleted. On a page with certain blocks the open ones go, unless what several marked elements hold is less than
the open text that the comparison leaves: then those are cards beside a story that is not marked.

A block is a run of text between block elements; character references are decoded, white space becomes one space, ends
are trimmed, and blocks are joined by an empty line. A null or empty page has an empty text. A null url has no host and
no neighbour; the page is taken by its structure alone. Rows may repeat. An empty table gives an empty result. Only the
id, url and html are read, so other columns of any name may be there.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from html import unescape

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.exact_copies import block_count, key_filter, mark_possible
from meterline.llm.storage import stored

BATCH_BYTES = 2_000_000

# Kinds of blocks.
LEFT, OPEN, CERTAIN = 0, 1, 2
# Bytes of a block's digest.
DIGEST = 12
# Two pages are near copies if shared blocks hold so many hundredths of the text of one of them, or more.
NEAR_COPY = 80

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object canvas".split())
# Of these, a tag that ends with a slash is the whole element.
RAW_EMPTY = frozenset("svg object canvas".split())
LEFT_OUT = frozenset("nav footer aside form menu dialog button select head audio video annotation annotation-xml".split()) | RAW
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
ARTICLE = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
# Classes and ids that name what is no article; those made of such words do as well, like cookie-notice.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus replies respond share "
    "sharing social newsletter subscribe subscription signup login popup modal related footer masthead copyright".split()
)
# These name a part of the article when they stand within it.
OUTSIDE_ONLY = frozenset(("header",))
# Words that may stand before or behind them, like site-footer and share-buttons. Others say something else: has-sidebar.
LEADS = frozenset(("site",))
PARTS = frozenset("area bar box button buttons icon icons item items link links list posts slot unit".split())
# What is named so may hold articles of its own, such as comments and teasers.
OTHER_ARTICLES = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus promo promotion related replies respond sidebar "
    "sponsor sponsored".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|object|canvas)(?=[\s/>])"
    r"(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
# One attribute at a time, so that nothing within a value passes for a name.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
_WORDS = re.compile(r"[a-z]+")
_COMMENT = re.compile(r"(?:[a-z]+-)?comments?(?:-(?:body|content|item|\d+))?")


def _attributes(rest: str) -> Iterator[tuple[str, str]]:
    """Names and values of a tag's attributes, in lower case."""
    for match in _ATTRIBUTE.finditer(rest):
        if match[1]:
            yield match[1].lower(), (match[2] or match[3] or match[4] or "").lower()


def _unwanted(tag: str, rest: str, in_article: bool) -> bool:
    """Whether an element is no part of the article, by its element name, its role or because it is hidden."""
    if tag in LEFT_OUT or (tag in OUTSIDE_ONLY and not in_article):
        return True
    if not rest.strip(" /") or tag in ("html", "body") or tag in ARTICLE:
        return False
    return any(name == "hidden" or name == "role" and value.strip() in ROLES for name, value in _attributes(rest))


def _named(tag: str, rest: str, in_article: bool) -> set[str]:
    """Words by which whole classes or the id of an element name it as no article."""
    if not rest.strip(" /") or tag in ("html", "body", "main"):
        return set()
    found: set[str] = set()
    for name, value in _attributes(rest):
        if name not in ("class", "id"):
            continue
        for token in value.split():
            if tag in ARTICLE:
                if _COMMENT.fullmatch(token):
                    found.add("comment")
                continue
            words = _WORDS.findall(token)
            if len(words) > 1 and words[0] in LEADS:
                del words[0]
            while len(words) > 1 and words[-1] in PARTS:
                del words[-1]
            if words and all(word in NAMES or word in OUTSIDE_ONLY and not in_article for word in words):
                found.update(words)
    return found


def page_blocks(html: str | None) -> tuple[list[tuple[str, int]], int]:
    """Blocks of a page in order with their kind, LEFT, OPEN or CERTAIN, and how many outermost elements mark an article."""
    if not html:
        return [], 0
    # Each line is its parts of source, each with the named elements it stands in (none if it is left out), and whether
    # the line is marked.
    lines: list[tuple[list[tuple[str, tuple[int, ...] | None]], bool]] = []
    pending: list[tuple[str, tuple[int, ...] | None]] = []
    marks = 0
    open_tags: list[str] = []
    # Depths at which unwanted and article elements were opened.
    unwanted: list[int] = []
    article: list[int] = []
    # Depths and numbers of open named elements; of all of them, what names them and which article elements they hold.
    named: list[tuple[int, int]] = []
    within: tuple[int, ...] = ()
    names: list[set[str]] = []
    held: list[set[str]] = []

    def flush() -> None:
        nonlocal pending
        if pending:
            lines.append((pending, bool(article)))
            pending = []

    def close(depth: int) -> None:
        nonlocal within
        del open_tags[depth:]
        while unwanted and unwanted[-1] >= depth:
            unwanted.pop()
        while article and article[-1] >= depth:
            article.pop()
        if named and named[-1][0] >= depth:
            while named and named[-1][0] >= depth:
                named.pop()
            within = tuple(number for _, number in named)

    at = 0
    while match := _TOKEN.search(html, at):
        if match.start() > at:
            pending.append((html[at : match.start()], None if unwanted else within))
        at = match.end()
        if raw := match["raw"]:
            if raw.lower() in RAW_EMPTY and match[0].endswith("/>"):
                continue
            end = re.compile(rf"</{raw}\s*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
            continue
        tag = (match["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        elif tag in ("br", "td", "th"):
            pending.append((" ", None if unwanted else within))
        if match["end"]:
            if tag in open_tags:
                close(len(open_tags) - 1 - open_tags[::-1].index(tag))
            continue
        if tag in VOID or match["rest"].endswith("/"):
            continue
        if tag in BLOCKS and "p" in open_tags:
            # A block ends an open paragraph, and what was left open in it.
            depth = len(open_tags) - 1 - open_tags[::-1].index("p")
            if not any(name in BLOCKS for name in open_tags[depth + 1 :]):
                close(depth)
        if tag == "li" and open_tags and open_tags[-1] == "li":
            close(len(open_tags) - 1)
        depth = len(open_tags)
        open_tags.append(tag)
        if unwanted:
            continue
        if _unwanted(tag, match["rest"], bool(article)):
            unwanted.append(depth)
            continue
        if words := _named(tag, match["rest"], bool(article)):
            named.append((depth, len(names)))
            within = (*within, len(names))
            names.append(words)
            held.append(set())
        if tag in ARTICLE:
            marks += not article
            article.append(depth)
            for number in within:
                # An article that is itself a comment is the article of what holds comments at most.
                if not words or names[number] & OTHER_ARTICLES:
                    held[number].add(tag)
    if at < len(html):
        pending.append((html[at:], None if unwanted else within))
    flush()
    # A name leaves out no element that holds the article. Comments and teasers are the article only if there is no other.
    kept = {number for number, tags in enumerate(held) if "main" in tags or tags and not names[number] & OTHER_ARTICLES}

    def wanted(inside: tuple[int, ...] | None) -> bool:
        return inside is not None and kept.issuperset(inside)

    if not any(marked and wanted(inside) and part.strip() for parts, marked in lines for part, inside in parts):
        kept.update(number for number, tags in enumerate(held) if tags)
    blocks = []
    for parts, marked in lines:
        if text := _plain(part for part, inside in parts if wanted(inside)):
            blocks.append((text, CERTAIN if marked else OPEN))
        elif text := _plain(part for part, _ in parts):
            blocks.append((text, LEFT))
    return blocks, marks


def _plain(parts: Iterable[str]) -> str:
    return " ".join(unescape("".join(parts)).split())


def page_lines(html: str | None) -> list[tuple[str, bool]]:
    """Blocks of a page that structure alone takes for the text, and whether each stands in the marked article."""
    blocks, _ = page_blocks(html)
    top = max((kind for _, kind in blocks), default=LEFT)
    return [(text, kind == CERTAIN) for text, kind in blocks if kind == top != LEFT]


def shared_lines(left: list[str], right: list[str]) -> set[int]:
    """Positions in ``left`` of a longest common subsequence with ``right``."""
    start = 0
    while start < min(len(left), len(right)) and left[start] == right[start]:
        start += 1
    end = 0
    while end < min(len(left), len(right)) - start and left[-1 - end] == right[-1 - end]:
        end += 1
    places: dict[str, list[int]] = {}
    for place in range(len(right) - end - 1, start - 1, -1):
        places.setdefault(right[place], []).append(place)
    tops: list[int] = []
    ends: list[tuple] = []
    for place in range(start, len(left) - end):
        for other in places.get(left[place], ()):
            length = bisect_left(tops, other)
            chain = (place, ends[length - 1] if length else None)
            if length == len(tops):
                tops.append(other)
                ends.append(chain)
            else:
                tops[length] = other
                ends[length] = chain
    shared = {*range(start), *range(len(left) - end, len(left))}
    chain = ends[-1] if ends else None
    while chain:
        shared.add(chain[0])
        chain = chain[1]
    return shared


def _runs(values) -> Iterator[tuple[int, int]]:
    """Runs of rows with about BATCH_BYTES of html each."""
    import pyarrow.compute as pc

    start = total = 0
    for position, size in enumerate(pc.fill_null(pc.binary_length(values), 0).to_pylist()):
        total += size
        if total >= BATCH_BYTES:
            yield start, position + 1
            start, total = position + 1, 0
    if start < len(values):
        yield start, len(values)


def _read_pages(pages: DataFrame) -> DataFrame:
    """The blocks of ``page_id, url, html``: texts of those not left out, and digests, sizes and kinds of all of them.

    Digests are of 96 bits each, one behind the other; ``size`` is how many characters the texts have.
    """

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            for start, stop in _runs(batch.column(2)):
                rows = batch.slice(start, stop - start)
                texts, digests, sizes, kinds, marks, size = [], [], [], [], [], []
                for value in rows.column(2):
                    blocks, marked = page_blocks(value.as_py())
                    texts.append([text for text, kind in blocks if kind != LEFT])
                    digests.append(b"".join(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=DIGEST).digest() for text, _ in blocks))
                    sizes.append([len(text) for text, _ in blocks])
                    kinds.append([kind for _, kind in blocks])
                    marks.append(marked)
                    size.append(sum(map(len, texts[-1])))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0), rows.column(1), pa.array(texts, pa.list_(pa.string())), pa.array(digests, pa.binary()),
                        pa.array(sizes, pa.list_(pa.int32())), pa.array(kinds, pa.list_(pa.int8())), pa.array(marks, pa.int32()),
                        pa.array(size, pa.int64()),
                    ],
                    names=["page_id", "url", "lines", "digests", "sizes", "kinds", "marks", "size"],
                )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(
        work,
        f"page_id {kind}, url string, lines array<string>, digests binary, sizes array<int>, kinds array<tinyint>, marks int, size bigint",
    )


def kept_blocks(kinds: list[int], sizes: list[int], marks: int, shared: set[int], other_size: int) -> list[bool]:
    """For each block not left out whether it is text, given which ones a neighbour with ``other_size`` characters shares."""
    places = [place for place, kind in enumerate(kinds) if kind != LEFT]
    common = sum(sizes[place] for place in places if place in shared)
    own_size = sum(sizes[place] for place in places)
    if 100 * common >= NEAR_COPY * min(own_size, other_size):
        shared = set()
    differing = {place for place in places if kinds[place] == OPEN and place not in shared}
    certain = {place for place in places if kinds[place] == CERTAIN}
    story = marks > 1 and sum(sizes[place] for place in differing) > sum(sizes[place] for place in certain)
    kept = differing if story or not certain else certain
    return [place in kept for place in places]


def nearest_pages(pages: DataFrame) -> DataFrame:
    """``row, other``: for each row of ``row, page_id, host, path`` the row of the page with the nearest path of its host.

    Pages are put in one order by host and path. The order is cut into ranges of like size, so that a host with a third
    of all pages is spread; a range gets the rows just outside it from the first and last rows of all ranges.
    """
    order = ("host", "path", "page_id", "row")
    ranged = stored(
        pages.where("host IS NOT NULL").select(*order).repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
        "page-order",
    )
    here = F.struct(*order)
    # One row per range.
    edges = ranged.groupBy("part").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    across = Window.partitionBy(F.lit(0)).orderBy("part")
    edges = edges.select("part", F.lag("last").over(across).alias("outer_before"), F.lead("first").over(across).alias("outer_after"))
    within = Window.partitionBy("part").orderBy(*order)
    beside = (
        ranged.withColumn("before", F.lag(here).over(within))
        .withColumn("after", F.lead(here).over(within))
        .join(F.broadcast(edges), "part")
        .select("row", "host", "path", F.coalesce("before", "outer_before").alias("before"), F.coalesce("after", "outer_after").alias("after"))
    )

    def start_shared(other: str):
        """Characters two paths have in common from the start, -1 on another host."""
        # Paths are short, so every start is compared.
        lengths = F.sequence(F.lit(0), F.least(F.length("path"), F.length(f"{other}.path")))
        shared = F.array_max(F.filter(lengths, lambda n: F.left("path", n) == F.left(F.col(f"{other}.path"), n)))
        return F.when(F.col(f"{other}.host") == F.col("host"), shared).otherwise(-1)

    measured = beside.withColumn("near_before", F.coalesce(start_shared("before"), F.lit(-1))).withColumn(
        "near_after", F.coalesce(start_shared("after"), F.lit(-1))
    )
    other = F.when(
        F.greatest("near_before", "near_after") >= 0,
        F.when(F.col("near_before") >= F.col("near_after"), F.col("before.row")).otherwise(F.col("after.row")),
    )
    return measured.select("row", other.alias("other"))


def _path_neighbours(places: DataFrame) -> DataFrame:
    """``row, other``: the neighbour of every row of ``row, page_id, host, path``, of another path wherever the host has one."""
    first = F.min(F.struct("page_id", "row"))
    paths = places.where("host IS NOT NULL").groupBy("host", "path").agg(first.alias("first")).select("host", "path", "first.*")
    of_paths = nearest_pages(paths).where("other IS NOT NULL").withColumnRenamed("row", "first_row")
    firsts = paths.select("host", "path", F.col("row").alias("first_row"))
    found = places.join(firsts, ["host", "path"]).join(of_paths, "first_row", "left").select(*places.columns, "other")
    found = stored(found, "page-neighbours")
    # Hosts with one path.
    alone = nearest_pages(found.where("other IS NULL").drop("other")).where("other IS NOT NULL")
    return found.where("other IS NOT NULL").select("row", "other").unionByName(alone)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    read = stored(_read_pages(chosen).withColumn("row", F.monotonically_increasing_id()), "page-lines", "zstd")
    rest = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", 1)
    places = read.select(
        "row", "page_id", F.lower(F.nullif(rest, F.lit(""))).alias("host"),
        F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", 2).alias("path"),
    )
    # Blocks are compared by their digests, so that no texts are sent to neighbours.
    own = read.select("row", "digests", "sizes", "kinds", "marks")
    others = read.select(F.col("row").alias("other"), F.col("digests").alias("other_digests"), F.col("size").alias("other_size"))
    compared = own.join(_path_neighbours(places), "row", "left").join(others, "other", "left")

    def work(batches):
        import pyarrow as pa

        def parts(digests):
            return [digests[at : at + DIGEST] for at in range(0, len(digests), DIGEST)]

        for batch in batches:
            kept = []
            for digests, sizes, kinds, marks, other_digests, other_size in zip(*(column.to_pylist() for column in batch.columns[1:])):
                shared = shared_lines(parts(digests), parts(other_digests or b""))
                kept.append(kept_blocks(kinds, sizes, marks, shared, other_size or 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.list_(pa.bool_()))], names=["row", "kept"])

    judged = compared.select("row", "digests", "sizes", "kinds", "marks", "other_digests", "other_size").mapInArrow(
        work, "row bigint, kept array<boolean>"
    )
    # Only the texts of pages that lose a block are moved to what is known about them.
    losing = stored(judged.where(F.exists("kept", lambda one: ~one)), "page-losses")
    blocks = block_count(losing.count())
    texts = read.select("row", "page_id", "url", "lines")
    texts = mark_possible(texts, ("row",), key_filter(losing, ("row",), blocks), blocks, "maybe")
    left = F.when(F.col("kept").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda line, place: F.get("kept", place)))
    cut = texts.where("maybe").join(losing, "row", "left").select("page_id", "url", left.alias("lines"))
    found = texts.where("NOT maybe").select("page_id", "url", "lines").unionByName(cut)
    text = F.array_join("lines", "\n\n")
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars"))
