"""Main text of web pages: flat text blocks, judged by a decision tree.

A page is cut at its block tags into flat blocks of text. Each block has the share of its
characters that stand in links and its number of words, those of the blocks before and after it,
and in what it stands: an article, a heading, a part of the page that its tag or its class names
as something else, firmly or by a loose name. A decision tree, trained on the small table below,
tells text from the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsignal.llm.common import longs, map_arrow

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "article", "heading", "aside", "loose"
)
#: What can stand before and after a block: words and links of nothing, a short block, a text, a link.
NEIGHBOURS = ((-1, 0.0), (1, 0.0), (40, 0.0), (1, 1.0))
_FEW, _MANY = (1, 3, 6), (10, 25, 60, 110, 120, 300)
_ALWAYS, _NEVER = "1111 1111 1111 1111", "0000 0000 0000 0000"
# A small labelled table of kinds of blocks. Words and shares of links of the kind, then whether it
# stands in an article, a heading, another part, a part of a loose name; then 1 for text by its neighbours: four
# groups for nothing, short, text, link before it, in each the same four after it.
KINDS = [
    # an article: running text and headings at any place, a link alone, but not a run of short links
    (_FEW + _MANY, (0.0, 0.2, 0.6), 1, 0, 0, 0, _ALWAYS),
    (_FEW + _MANY, (0.0, 0.2, 0.6, 1.0), 1, 1, 0, 0, _ALWAYS),
    (_FEW + (10,), (1.0,), 1, 0, 0, 0, "1110 1110 1110 0000"),
    (_MANY[1:], (1.0,), 1, 0, 0, 0, _ALWAYS),
    # pages without an article tag: text, also short lines, items and cells, but not leftovers among links
    (_MANY, (0.0, 0.2), 0, 0, 0, 0, _ALWAYS),
    (_MANY[2:], (0.6,), 0, 0, 0, 0, _ALWAYS),
    (_FEW, (0.0, 0.2), 0, 0, 0, 0, "1110 1111 1111 0110"),
    (_FEW + (10, 25), (0.6,), 0, 0, 0, 0, "0000 0110 0110 0000"),
    (_FEW + _MANY, (1.0,), 0, 0, 0, 0, "0000 0110 0110 0000"),
    # their headings, but not the short ones of lists of links
    ((6, *_MANY), (0.0, 0.2, 0.6, 1.0), 0, 1, 0, 0, _ALWAYS),
    ((1, 3), (0.0, 0.2, 0.6, 1.0), 0, 1, 0, 0, "0110 0110 0110 0110"),
    # menus, bars, notices, adverts, forms, comments of any length, in an article or not
    (_FEW + _MANY, (0.0, 0.2, 0.6, 1.0), 0, 0, 1, 0, _NEVER),
    (_FEW + _MANY, (0.0, 0.2, 0.6, 1.0), 1, 0, 1, 0, _NEVER),
    (_FEW + _MANY, (0.0, 0.2, 0.6, 1.0), 0, 1, 1, 0, _NEVER),
    (_FEW + _MANY, (0.0, 0.2, 0.6, 1.0), 1, 1, 1, 0, _NEVER),
    # names that builders of pages also give to wrappers of text: long unlinked text of an article alone
    (_FEW + _MANY, (0.0, 0.2, 0.6, 1.0), 0, 0, 1, 1, _NEVER),
    (_FEW + _MANY, (0.0, 0.2, 0.6, 1.0), 0, 1, 1, 1, _NEVER),
    (_FEW + _MANY, (0.0, 0.2, 0.6, 1.0), 1, 1, 1, 1, _NEVER),
    (_FEW + _MANY[:4], (0.0, 0.2, 0.6, 1.0), 1, 0, 1, 1, _NEVER),
    (_MANY[4:], (0.0, 0.2), 1, 0, 1, 1, _ALWAYS),
    (_MANY[4:], (0.6, 1.0), 1, 0, 1, 1, _NEVER),
]
#: The table as rows of FEATURES and the label.
LABELLED = [
    (words, share, *before, *after, article, heading, aside, loose, int(label))
    for sizes, shares, article, heading, aside, loose, labels in KINDS
    for words in sizes
    for share in shares
    for (before, after), label in zip(product(NEIGHBOURS, NEIGHBOURS), labels.replace(" ", ""))
]
# Tags without text, tags that cut blocks, tags of other parts of a page, void tags,
# and words in class, id or role that name such parts.
SILENT = set("noscript template title svg math iframe object select textarea button canvas audio video".split())
#: Tags that can stand in a head; any other one ends it.
IN_HEAD = SILENT | set("html head meta link base script style".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
ASIDES = set("nav footer aside form header menu dialog fieldset".split())
#: An article inside one of these is not reset to text.
APART = ("article", "nav", "footer", "aside", "menu", "dialog")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Names that say what a box is, not that it is apart from the text.
LOOSE = set("widget side header masthead legal".split())
_PARTS = (
    r"nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|side|aside|widget|banner|"
    r"cookies?|consent|notice|alert|popup|modal|overlay|ads?|advert|adverts|advertisement|advertising|sponsor|sponsored|"
    r"promo|promotion|newsletter|subscribe|signup|login|search|form|social|share|sharing|related|recommended|comments?|"
    r"respond|replies|reply|disqus|pagination|pager|toolbar|copyright|legal|complementary|contentinfo"
)
# A name says so by itself or by its last part, places, kinds of boxes and numbers aside, unless it tells what a
# wrapper has or lacks, or its topic.
_STATE = r"(?!(?:has|have|no|not|with|without|is|show|hide|category|tag|topic)[_-])"
_PLACE = (
    r"(?:[_-](?:left|right|top|bottom|list|items?|links?|slot|unit|box|area|bar|body|"
    r"text|title|posts|articles|buttons?|icons?|widgets?|container|wrapper|wrap|inner|\d+))*"
)
NAMED = re.compile(rf"(?<!\S){_STATE}(?:\S*[_-])?({_PARTS}){_PLACE}(?!\S)", re.I)
_COMMENT = re.compile(rf"(?<!\S){_STATE}(?:\S*[_-])?(?:comments?|reply|replies){_PLACE}(?!\S)", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)(?![\w:-])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[/!?a-zA-Z][^>]*>?",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:\s|^)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: The top of an empty stack.
OUTSIDE = ("", False, False, False, False, False)
#: Closing one of these closes what is open inside it; an opened one closes an open one of its own.
_SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th"}


def silent_ends(tokens: list[re.Match]) -> dict[int, int]:
    """The ends of the silent elements that are closed, by the starts of their opening tags."""
    opened: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for token in tokens:
        tag = (token.group(3) or "").lower()
        if tag not in SILENT:
            continue
        if not token.group(2):
            if not (tag in ("svg", "math") and token.group(4).endswith("/")):
                opened.setdefault(tag, []).append(token.start())
        elif opened.get(tag):
            ends[opened[tag].pop()] = token.end()
    return ends


def blocks(html: str) -> list[tuple[str, tuple[float, ...]]]:
    """The text blocks of a page in order: text with single spaces, and its features but the neighbours'.

    Features: words, links, article, heading, aside, loose (aside by a loose name alone).
    """
    out: list[tuple[str, tuple[float, ...]]] = []
    # Tag, in an article, a heading, another part, one of a loose name, comments.
    stack: list[tuple[str, bool, bool, bool, bool, bool]] = []
    parts: list[str] = []
    standing: dict[str, int] = {}  # how often each tag is open
    linked = anchors = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                _, article, heading, aside, loose, _ = stack[-1] if stack else OUTSIDE
                solid = max(1, len(text.replace(" ", "")))
                out.append((text, (text.count(" ") + 1, min(1.0, linked / solid), article, heading, aside, loose)))
            parts.clear()
        linked = 0

    tokens = list(_TOKEN.finditer(html))
    ends = silent_ends(tokens)
    at = 0
    head = mute = False  # mute: up to the next tag
    for token in tokens:
        start = token.start()
        if start < at:
            continue
        if start > at and not (head or mute):
            text = html[at:start]
            parts.append(text)
            if anchors:
                linked += len("".join(unescape(text).split()))
        at = token.end()
        tag = token.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        mute = False
        if tag == "head":
            head = not token.group(2)
            continue
        head = head and (bool(token.group(2)) or tag in IN_HEAD)
        if tag in SILENT or tag == "option":
            if not token.group(2) and not (tag in ("svg", "math") and token.group(4).endswith("/")):
                # Without its closing tag the element, as an option always, ends at the next tag.
                at = ends.get(start, at)
                mute = start not in ends
            continue
        if token.group(2):
            if tag in BLOCKS:
                flush()
            while standing.get(tag):
                closed = stack.pop()[0]
                standing[closed] -= 1
                if closed == tag:
                    break
            if tag == "a":
                anchors = max(0, anchors - 1)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            anchors += 1
            continue
        if tag in BLOCKS:
            flush()
            anchors = 0  # a link that was never closed ends with its block
        elif not token.group(4):
            continue
        if tag in VOID or token.group(4).rstrip().endswith("/"):
            continue
        if tag in _SELF_CLOSING and stack and stack[-1][0] == tag:
            standing[stack.pop()[0]] -= 1
        _, article, heading, aside, loose, comment = stack[-1] if stack else OUTSIDE
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(token.group(4)))
        named = [x.lower() for x in NAMED.findall(names) if not (article and x.lower() == "header")]
        if tag == "main":
            article, aside, loose, comment = True, False, False, False
        elif tag == "article":
            # It is the text of whatever its wrappers are named, but not one beside the text of another
            # article, in a part that a tag sets apart, or a comment.
            comment = comment or bool(_COMMENT.search(names))
            aside = comment or (aside and any(standing.get(x) for x in APART))
            article, loose = True, aside and loose and not comment
        elif tag in ASIDES and not (tag == "header" and article):
            aside, loose = True, False
        elif tag not in ("html", "body") and named:
            loose = (loose or not aside) and LOOSE.issuperset(named)
            aside, comment = True, comment or bool(_COMMENT.search(names))
        standing[tag] = standing.get(tag, 0) + 1
        stack.append((tag, article, heading or tag in ("h1", "h2", "h3", "h4", "h5", "h6"), aside, loose, comment))
    if at < len(html) and not (head or mute):
        parts.append(html[at:])
        if anchors:
            linked += len("".join(unescape(html[at:]).split()))
    flush()
    return out


def features(found: list[tuple[str, tuple[float, ...]]]) -> np.ndarray:
    """A row of FEATURES for each block."""
    own = np.array([f for _, f in found], dtype=float).reshape(-1, 6)
    edge = np.array([[-1.0, 0.0]])
    around = np.concatenate([edge, own[:, :2], edge])
    return np.concatenate([own[:, :2], around[:-2], around[2:], own[:, 2:]], axis=1)


def train(spark: SparkSession, rows: list[tuple] = LABELLED, depth: int = 14) -> list[tuple]:
    """The nodes of a decision tree: (feature, threshold, left, right, label), feature -1 for leaves."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    schema = ", ".join(f"{name} double" for name in (*FEATURES, "label"))
    table = spark.createDataFrame([tuple(map(float, r)) for r in rows], schema).coalesce(1)
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    model = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(table)
    nodes: list[tuple] = []

    def walk(node) -> int:
        at = len(nodes)
        nodes.append(())
        if node.subtreeDepth() == 0:
            nodes[at] = (-1, 0.0, 0, 0, int(node.prediction()))
        else:
            split = node.split()
            left, right = walk(node.leftChild()), walk(node.rightChild())
            nodes[at] = (split.featureIndex(), split.threshold(), left, right, 0)
        return at

    walk(model._java_obj.rootNode())
    return nodes


def classify(nodes: list[tuple], rows: np.ndarray) -> np.ndarray:
    """The label of each row by the tree."""
    at, table = np.zeros(len(rows), dtype=np.int64), np.array(nodes, dtype=float)
    while True:
        feature = table[at, 0].astype(np.int64)
        inner = np.flatnonzero(feature >= 0)
        if not len(inner):
            return table[at, 4].astype(np.int64)
        low = rows[inner, feature[inner]] <= table[at[inner], 1]
        at[inner] = np.where(low, table[at[inner], 2], table[at[inner], 3]).astype(np.int64)


def extract(pages: DataFrame, nodes: list[tuple] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row; a null html is empty, and an empty page has no text.

    Each page is read by itself and whole, repeated rows too; ``nodes`` is a tree from train().
    """
    nodes = nodes or train(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html in batch.column(2).to_pylist():
                found = blocks(html) if html else []
                good = classify(nodes, features(found)) if found else ()
                texts.append("\n".join(text for (text, _), label in zip(found, good) if label))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, type=pa.string()), longs([len(x) for x in texts])],
                names=["page_id", "url", "text", "n_chars"],
            )

    chosen = pages.select(F.col("page_id").cast("long"), "url", "html")
    return map_arrow(chosen, run, "page_id long, url string, text string, n_chars long")
