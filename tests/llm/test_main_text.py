"""Main text: structure, differences between neighbours, odd pages."""

from __future__ import annotations

import random
import re
from html import unescape

import pytest

from meterline.llm import main_text as main

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>Site</header>'
    '<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><div class="cookie-notice">Ok?</div>'
    "<article><header><h1>Head &amp; line</h1></header><p><b>One  two<br>three<p>Four &lt;b&gt;\n five</p>"
    '<div id="comments"><p>First!</p></div><form>Mail <input name="m"></form></article><aside>More</aside><footer>&copy; me</footer>'
)


def texts(html):
    return [text for text, _ in main.page_lines(html)]


def test_article_without_what_stands_around_it():
    assert texts(PAGE) == ["Head & line", "One two three", "Four <b> five"]


def test_page_cut_off_anywhere_does_not_fail():
    for end in range(len(PAGE)):
        main.page_lines(PAGE[:end])


@pytest.mark.parametrize(
    "html, expected",
    [
        (None, []), ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
        ("a < b", ["a < b"]), ("<script>x", []), ("<p title='>'>a</p>", ["a"]), ("<div role=navigation>a</div>b", ["b"]),
        ("<table><tr><td>a</td><td>b</td></tr></table>", ["a b"]), ("<p>a</p>&nbsp;<p>b", ["a", "b"]), ("<p hidden>a</p>b", ["b"]),
        ("<!-- a", []), ("<p>" + "x " * 50_000 + "</p>", ["x " * 49_999 + "x"]),
    ],
)
def test_odd_pages(html, expected):
    assert texts(html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        # Only an attribute of that name hides; what stands in values is no attribute.
        ('<div style="overflow:hidden">a</div>', ["a"]), ('<p><a href="/the-hidden-river">a</a></p>', ["a"]),
        ('<p title="hidden costs">a</p>', ["a"]), ('<p aria-hidden="false">a</p>', ["a"]), ('<p><a href="?id=ad">a</a></p>', ["a"]),
        ('<p title="x" hidden>a</p>b', ["b"]), ("<p HIDDEN=''>a</p>b", ["b"]), ('<p "hidden">a</p>', ["a"]),
        # Whole classes, and none that holds the article.
        ('<div class="post has-sidebar"><p>a</p></div>', ["a"]), ('<div class="no-sidebar">a</div>', ["a"]),
        ('<div class="share-enabled">a</div>', ["a"]), ('<div class="x cookie-notice">a</div>b', ["b"]),
        ('<p>a<span class="share-buttons">b</span>c</p><div id=site-footer>d</div>', ["ac"]),
        ('<div class="sidebar"><main><p>a</p><p class="ad">b</p></main></div>', ["a"]),
        ('<div class="social"><article>a</article></div><div class="related"><article>b</article></div>', ["a"]),
        ('<article class="post comments-open">a<div id="comments"><article class="comment-body">b</article></div></article>', ["a"]),
        ('<div class="related"><article>a</article></div>b', ["a"]),
        # Elements that are closed in their own tag, and formulas.
        ("<p>a<svg/>b</p><p>c</p><svg></svg>", ["ab", "c"]), ('<p>a<object data="x" />b</p><object></object>', ["ab"]),
        ("<p>a<canvas/>b<math/>c</p><canvas></canvas><math></math>", ["abc"]), ("<p>a<svg><text>b</text></svg>c</p>", ["ac"]),
        ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> b</p>", ["a x=1 b"]),
        ("<style-guide>a</style-guide>b", ["ab"]),
    ],
)
def test_rules_leave_out_no_article_text(html, expected):
    assert texts(html) == expected


def common_length(left, right):
    table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    draw = random.Random(4)
    for _ in range(300):
        left, right = ([draw.choice("abcd") for _ in range(draw.randint(0, 12))] for _ in (0, 1))
        shared = sorted(main.shared_lines(left, right))
        rest = iter(right)
        assert len(shared) == common_length(left, right)
        assert all(left[place] in rest for place in shared)


def plain(lines):
    return "<body>" + "".join(f"<p>{line}</p>" for line in lines) + "</body>"


def run(spark, rows, schema="page_id bigint, url string, html string"):
    found = main.main_text(spark.createDataFrame(rows, schema)).collect()
    return {row.page_id: row.text for row in found}, found


def test_shared_lines_of_neighbours_go(spark):
    rows = [
        (1, "http://a.org/n/10", plain(["Top", "x one", "Bottom"])),
        (2, "http://A.org/n/11", plain(["Top", "x two", "Bottom"])),
        (3, "http://a.org/z", plain(["Top", "z", "Other"])),
        (4, "http://b.org/n/10", plain(["Top", "alone", "Bottom"])),
        (5, None, plain(["Top", "no url"])),
        (6, "http://c.org/1", plain(["same", "page"])),
        (7, "http://c.org/2", plain(["same", "page"])),
        (8, "http://d.org/1", "<article><p>kept</p></article>"),
        (9, "http://d.org/2", "<article><p>kept</p></article>"),
        (10, "http://d.org/3", None),
    ]
    assert run(spark, rows)[0] == {
        1: "x one", 2: "x two", 3: "z\n\nOther", 4: "Top\n\nalone\n\nBottom", 5: "Top\n\nno url", 6: "same\n\npage",
        7: "same\n\npage", 8: "kept", 9: "kept", 10: "",
    }


def test_nearest_pages_in_one_order(spark):
    draw = random.Random(5)
    rows = [
        (n, n % 50, draw.choice(["a", "a", "b", None]), "/" + "".join(draw.choice("xyz/") for _ in range(draw.randint(0, 6))))
        for n in range(300)
    ]
    pages = spark.createDataFrame(rows, "row bigint, page_id bigint, host string, path string")
    found = {row.row: row.other for row in main.nearest_pages(pages).collect()}
    order = sorted((host, path, page, row) for row, page, host, path in rows if host is not None)

    def start(a, b):
        return next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))

    expected = {}
    for place, (host, path, _, row) in enumerate(order):
        near = [(start(path, order[k][1]), order[k][3]) for k in (place - 1, place + 1) if 0 <= k < len(order) and order[k][0] == host]
        expected[row] = max(near, key=lambda one: one[0])[1] if near else None
    assert found == expected


def test_empty_table_and_repeated_rows(spark):
    assert run(spark, [])[1] == []
    rows = [(1, "http://a.org/x", "<p>a</p>", "t")] * 2
    found = run(spark, rows, "page_id bigint, url string, html string, text string")[1]
    assert [(row.page_id, row.text, row.n_chars) for row in found] == [(1, "a", 1)] * 2


def test_pages(spark, sf_dir):
    rows = {row.page_id: row.html for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = main.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    assert len(found) == len(rows)
    for row in found:
        article = rows[row.page_id].partition("<article>")[2].partition("</article>")[0].partition("<footer>")[0]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", " ", part)).split()) for part in re.split("</?(?:p|h1)>", article))
        assert row.text == "\n\n".join(filter(None, blocks))
        assert row.n_chars == len(row.text)


def test_every_page_is_compared_with_its_neighbour(spark):
    story = [f"the story goes on in line {n} of it" for n in range(9)]
    cards = "".join(f"<article><p>card {n}</p></article>" for n in range(2))
    rows = [
        (1, "http://a.org/a/1", plain(["Menu", "another story altogether", "Foot"])),
        # Near copies under one path, which leave nothing to tell menu and story apart by.
        (2, "http://a.org/a/2", plain(["Menu", *story, "Foot"])),
        (3, "http://a.org/a/2?page=2", plain(["Menu", *story, "extra", "Foot"])),
        # A story beside marked cards; its template is told by a page that marks its article.
        (4, "http://b.org/1", f"<body><p>Menu</p>{cards}<p>{story[0]}</p><p>Foot</p></body>"),
        (5, "http://b.org/2", "<body><p>Menu</p><article><p>marked</p></article><p>Foot</p></body>"),
        # Near copies under paths of their own.
        (6, "http://c.org/1", plain(["Menu", *story])),
        (7, "http://c.org/1/print", plain(["Menu", *story, "printed"])),
        (8, "http://d.org/1", plain(["Menu", "one"])),
        (9, "http://d.org/1?x", plain(["Menu", "two"])),
    ]
    whole = "\n\n".join(story)
    assert run(spark, rows)[0] == {
        1: "another story altogether", 2: whole, 3: f"{whole}\n\nextra", 4: story[0], 5: "marked",
        6: f"Menu\n\n{whole}", 7: f"Menu\n\n{whole}\n\nprinted", 8: "one", 9: "two",
    }


def test_blocks_left_out_are_compared_as_well():
    assert main.page_blocks('<nav><p>Menu</p></nav><article><p>a<button>b</button></p></article><p>c</p>') == (
        [("Menu", main.LEFT), ("a", main.CERTAIN), ("c", main.OPEN)], 1,
    )
