"""Main text of pages where links, forms, comments and short lines stand near it."""

from __future__ import annotations

import duckdb
import pytest

from fieldsignal.llm import pages

WORDS = "The river rose by two metres in the night and the village had to leave its houses before the morning came. "
MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
RELATED = "<ul><li><a href='/c'>Other floods</a></li><li><a href='/d'>More rain ahead</a></li></ul>"


@pytest.fixture(scope="module")
def tree(spark):
    return pages.train(spark)


def main_text(spark, tree, html):
    frame = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    return pages.extract(frame, tree).first().text.split("\n")


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        (f"<article><p>First part.</p><p>Last part.</p></article>{MENU}", ["First part.", "Last part."]),
        (f"<article><p>First part.</p><p>Last part.</p>{RELATED}</article>", ["First part.", "Last part."]),
        (
            "<article><p>First part.</p><p><a href='/m'>See the map</a></p><p>Last part.</p></article>",
            ["First part.", "See the map", "Last part."],
        ),
        (f"{MENU}<div><p>{WORDS}</p><p>No.</p></div>{MENU}", [WORDS.strip(), "No."]),
        (f"{RELATED}<p>{WORDS}</p>{RELATED}", [WORDS.strip()]),
        (
            f"<div><h1>The flood of May</h1><p>{WORDS}</p><p>Why?</p><p>Rain.</p><p>{WORDS}</p></div>",
            ["The flood of May", WORDS.strip(), "Why?", "Rain.", WORDS.strip()],
        ),
        (f"<p>{WORDS}</p><ul><li>boats</li><li>sand</li></ul><p>{WORDS}</p>", [WORDS.strip(), "boats", "sand", WORDS.strip()]),
        (
            f"<p>{WORDS}</p><table><tr><td>May</td><td>2 m</td></tr><tr><td>June</td><td>1 m</td></tr></table>",
            [WORDS.strip(), "May", "2 m", "June", "1 m"],
        ),
    ],
)
def test_text_beside_links_and_short_lines_stays(spark, tree, html, expected):
    assert main_text(spark, tree, html) == expected


PARTS = [
    "<aside><p>{}</p></aside>", "<form><p>{}</p></form>", "<div class='comments'><p>{}</p></div>", "<div class='ad'>{}</div>",
    "<div class='ad widget'><p>{}</p></div>", "<div class='widget'><div class='sidebar'>{}</div></div>",
    "<div class='sidebar'><div class='widget'>{}</div></div>", "<section id=comments><article><p>{}</p></article></section>",
]


@pytest.mark.parametrize("inside", [True, False])
def test_other_parts_of_any_length_go(spark, tree, inside):
    rows = []
    for part in PARTS:
        for size in (1, 6, 20):
            other = part.format("Please buy one of these boats today. " * size)
            html = f"<article><p>{WORDS}</p>{other if inside else ''}<p>End.</p></article>{'' if inside else other}"
            rows.append((len(rows), part, html))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    wrong = {x.url for x in pages.extract(frame, tree).collect() if x.text != f"{WORDS.strip()}\nEnd."}
    assert wrong == set()


def test_two_fits_agree(spark, tree):
    assert pages.train(spark) == tree


def test_given_pages_keep_their_articles(spark, tree):
    """The blocks of the article element of every page, found by their marks alone."""
    path = "/root/testdata/sf0.01/pages.parquet"
    expected = {
        page_id: "\n".join(text for text, own in pages.blocks(html or "") if own[2] and not own[4])
        for page_id, html in duckdb.sql(f"SELECT page_id, html FROM '{path}'").fetchall()
    }
    found = pages.extract(spark.read.parquet(path), tree)
    assert {x.page_id: x.text for x in found.collect()} == expected
