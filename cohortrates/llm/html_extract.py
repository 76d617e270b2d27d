"""Main text of web pages: flat text blocks, classified by a decision tree over neighbouring blocks.

A page is cut into blocks at block-level tags. Of each block and of two neighbours on either side the number of
words and the share of them inside links are known; of the block also its element and how much
text its section holds. A decision tree, trained here on a small labelled table of pages, tells main
text from the rest. Names of classes and ids are never read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sheltered, text_of

#: Elements that end a block where they begin and where they end.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html legend li main menu nav ol option p pre section select summary table tbody td template tfoot th thead title tr ul".split()
)

#: Elements whose content is not markup, and no text of the page.
SILENT = frozenset("script style textarea iframe noembed noframes xmp".split())

#: Elements that hold a part of a page; the text of a section is that of its blocks, not of sections inside.
SECTIONS = frozenset("article aside body details dialog div fieldset figure footer form header main nav section td".split())

#: Elements that hold no main text, and those that mark it.
APART = frozenset("aside button dialog fieldset footer form head header legend menu nav option select title".split())
MAIN = frozenset(("article", "main"))

#: The kind of a block by its element: APART, bare text, list items and cells, paragraphs, headings; 4 more in MAIN.
KINDS = dict.fromkeys("caption dd dt figcaption li summary td th".split(), 2) | dict.fromkeys("blockquote p pre".split(), 3) | {f"h{i}": 4 for i in range(1, 7)}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Elements that end an open one of a kind, as unclosed paragraphs and items are common.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "a": ("a",)}

#: How far up an end tag looks for its inline element, which keeps odd nesting linear.
REACH = 64

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
QUOTE = re.compile(r"[>\"']")
NO_COMMENT, COMMENT_END = re.compile(r"-?>"), re.compile(r"--!?>")
SPACES = re.compile(r"\s+")
SPACE = " \t\n\f\r"
CLOSED = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in SILENT}


class Block(NamedTuple):
    """A piece of text: its words, those inside links, the kind of its element, and its section's number."""

    text: str
    words: int
    linked: int
    kind: int
    section: int


def _tag_end(page: str, at: int) -> int:
    """Where the tag whose name ends at ``at`` ends: behind its ">", or -1 if the page ends first.

    A quote opens a value only behind "="; an unclosed one reaches to the end of the page. Never looks back further
    than the last quote.
    """
    while found := QUOTE.search(page, at):
        place = found.start()
        if page[place] == ">":
            return place + 1
        before = place - 1
        while before >= at and page[before] in SPACE:
            before -= 1
        if before >= at and page[before] == "=":
            place = page.find(page[place], place + 1)
            if place < 0:
                return -1
        at = place + 1
    return -1


def tags(page: str) -> Iterator[tuple[str, str, bool]]:
    """The page as (text before, name of the tag or "", whether it is an end tag), to its end.

    Names are lower-cased. Comments, declarations and the content of SILENT elements are left out. Goes through the
    page once, whatever the markup: what is not closed takes all the rest, as in a browser.
    """
    begin, at, end = 0, 0, len(page)
    text: list[str] = []
    while at < end:
        place = page.find("<", at)
        if place < 0 or place + 1 >= end:
            break
        sign = page[place + 1]
        if sign in "!?" or (sign == "/" and not NAME.match(page, place + 2)):
            text.append(page[begin:place])
            if page.startswith("<!--", place):
                ending = NO_COMMENT.match(page, place + 4) or COMMENT_END.search(page, place + 4)
                close = ending.end() if ending else -1
            else:
                close = page.find(">", place + 2) + 1 or -1
            if close < 0:
                begin = end
                break
            begin = at = close
            continue
        is_end = sign == "/"
        name = NAME.match(page, place + 1 + is_end)
        if not name:
            at = place + 1
            continue
        text.append(page[begin:place])
        close = _tag_end(page, name.end())
        if close < 0:
            begin = end
            break
        begin = at = close
        tag = name[0].lower()
        if tag in SILENT and not is_end:
            found = CLOSED[tag].search(page, at)
            close = _tag_end(page, found.end()) if found else -1
            if close < 0:
                begin = end
                break
            begin = at = close
            continue
        yield "".join(text), tag, is_end
        text.clear()
    text.append(page[begin:])
    yield "".join(text), "", False


class _Open(NamedTuple):
    name: str
    kind: int
    apart: bool
    main: bool
    section: int


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Takes time in proportion to its length, whatever the markup."""
    found: list[Block] = []
    text: list[str] = []
    linked = sections = 0
    stack = [_Open("", 1, False, False, 0)]
    depth: dict[str, int] = {}
    around = [0]  # of each section the one it is in

    def end_block() -> None:
        nonlocal linked
        shown = SPACES.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if shown:
            own = stack[-1]
            words = shown.count(" ") + 1
            kind = 0 if own.apart else own.kind + 4 * own.main
            # a section that is text itself, as a bare div is, counts for the one around it
            section = around[own.section] if kind in (1, 5) else own.section
            found.append(Block(shown, words, min(linked, words), kind, section))
        linked = 0

    def close(name: str) -> None:
        if name in BLOCK_TAGS:
            while len(stack) > 1:
                top = stack.pop()
                depth[top.name] -= 1
                if top.name == name:
                    return
        for place in range(len(stack) - 1, max(0, len(stack) - 1 - REACH), -1):
            if stack[place].name == name:
                del stack[place]
                depth[name] -= 1
                return

    for before, name, is_end in tags(page):
        if before:
            text.append(before)
            if depth.get("a"):
                linked += len(before.split())
        if not name:
            break
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCK_TAGS:
            end_block()
        if is_end:
            if depth.get(name):
                close(name)
            continue
        if name in BLOCK_TAGS and depth.get("p"):
            inner = len(stack) - 1
            while inner > 0 and stack[inner].name not in BLOCK_TAGS:
                inner -= 1
            if stack[inner].name == "p":
                close("p")
        for other in CLOSES.get(name, ()):
            if depth.get(other) and (stack[-1].name == other or stack[-1].name not in BLOCK_TAGS):
                close(other)
        if name in VOID:
            continue
        over = stack[-1]
        section = over.section
        if name in SECTIONS:
            sections += 1
            around.append(over.section)
            section = sections
        kind = KINDS.get(name, 1 if name in BLOCK_TAGS else over.kind)
        stack.append(_Open(name, kind, over.apart or name in APART, over.main or name in MAIN, section))
        depth[name] = depth.get(name, 0) + 1
    end_block()
    return found


#: Neighbours whose words and link share are features.
NEAR = (-2, -1, 1, 2)

FEATURES = (
    *("words", "link_share", "kind", "section_words", "section_share", "section_links"),
    *(f"{name}_{'before' if k < 0 else 'after'}_{abs(k)}" for k in NEAR for name in ("words", "links")),
)


def block_features(found: list[Block]) -> np.ndarray:
    """One row per block: its own measures, those of its section, and the words and link shares of its neighbours."""
    made = np.zeros((len(found), len(FEATURES)))
    if not found:
        return made
    words = np.array([b.words for b in found], dtype=float)
    linked = np.array([b.linked for b in found], dtype=float)
    share = linked / words
    made[:, 0], made[:, 1] = words, share
    kind = np.array([b.kind for b in found], dtype=float)
    # where a page has an article, what is outside of it ranks below all else
    made[:, 2] = np.where((kind < 5) & (kind >= 5).any(), kind / 10, kind)
    section = np.array([b.section for b in found])
    free, all_words = np.bincount(section, words - linked), np.bincount(section, words)
    made[:, 3], made[:, 4] = free[section], free[section] / max(free.max(), 1)
    made[:, 5] = 1 - free[section] / all_words[section]
    for at, k in enumerate(NEAR):
        near = slice(-k, None) if k < 0 else slice(None, -k)
        other = slice(None, k) if k < 0 else slice(k, None)
        if len(found) > abs(k):
            made[near, 6 + 2 * at], made[near, 7 + 2 * at] = words[other], share[other]
    return made


class Tree:
    """A classification tree by Gini impurity. Leaves hold the share of main text."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 10):
        self.nodes: list[tuple[int, float, int, int, float]] = []
        self._grow(rows, labels, depth, least)

    def _grow(self, rows: np.ndarray, labels: np.ndarray, depth: int, least: int) -> int:
        place = len(self.nodes)
        self.nodes.append((-1, 0.0, 0, 0, float(labels.mean())))
        n, ones = len(labels), labels.sum()
        best = (labels.mean() * (1 - labels.mean()) - 1e-9, -1, 0.0)
        if depth and n >= 2 * least and 0 < ones < n:
            left = np.arange(1, n)
            for f in range(rows.shape[1]):
                order = np.argsort(rows[:, f], kind="stable")
                values, before = rows[order, f], labels[order].cumsum()[:-1]
                a, b = before / left, (ones - before) / (n - left)
                cost = (left * a * (1 - a) + (n - left) * b * (1 - b)) / n
                cost[(values[1:] <= values[:-1]) | (left < least) | (n - left < least)] = 1.0
                i = int(cost.argmin())
                if cost[i] < best[0]:
                    best = (float(cost[i]), f, float(values[i] + values[i + 1]) / 2)
            if best[1] >= 0:
                low = rows[:, best[1]] <= best[2]
                a = self._grow(rows[low], labels[low], depth - 1, least)
                b = self._grow(rows[~low], labels[~low], depth - 1, least)
                self.nodes[place] = (best[1], best[2], a, b, self.nodes[place][4])
        return place

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Whether each row is main text."""
        made = np.zeros(len(rows), dtype=bool)
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            place, own = waiting.pop()
            feature, cut, left, right, share = self.nodes[place]
            if feature < 0:
                made[own] = share > 0.5
            elif len(own):
                low = rows[own, feature] <= cut
                waiting += [(left, own[low]), (right, own[~low])]
        return made


def main_text(page: str, tree: Tree) -> str:
    """The blocks that the tree takes for main text, joined by empty lines. Elements APART hold none by definition."""
    found = blocks(page)
    kept = tree.predict(block_features(found))
    return "\n\n".join(b.text for b, keep in zip(found, kept, strict=True) if keep and b.kind)


def trained(pages: list[tuple[str, str]]) -> Tree:
    """A tree from labelled pages: (markup, one letter per block, + for main text and - for the rest)."""
    rows, labels = [], []
    for markup, marks in pages:
        found = blocks(markup)
        if len(found) != len(marks):
            raise ValueError(f"{len(marks)} labels for {len(found)} blocks: {[b.text[:30] for b in found]}")
        rows.append(block_features(found))
        labels += [m == "+" for m in marks]
    return Tree(np.concatenate(rows), np.array(labels, dtype=float))


def extract(pages: DataFrame, labelled: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per row of ``pages``: page_id, url, text and n_chars.

    A null or empty page, and one without main text, has an empty text. Equal rows get equal texts, each
    its own. Only page_id, url and html are read. A page is one value of one row, and only one is parsed
    at a time.
    """
    from .html_labels import LABELLED

    tree = trained(labelled or LABELLED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = pa.array([main_text(page, tree) for page in part.column(2).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], ["page_id", "url", "text"])

    pages, _ = sheltered(pages, "page_id", "url", "html")
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    named = pages.select("page_id", "url", text_of("html").alias("html"))
    made = named.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
    return made.withColumn("n_chars", F.char_length("text").cast("long"))
