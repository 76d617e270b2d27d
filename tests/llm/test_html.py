"""Main text of pages: the scanner, the tree on layouts it has not seen, and odd markup."""

from __future__ import annotations

import re
import time
from html.parser import HTMLParser
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from cohortrates.llm import html_extract
from cohortrates.llm.html_labels import LABELLED, _layouts, _marked, _Words

LONG = "The river rose in the spring, and the lower meadows stayed under water for a month and more. " * 3
CHAT = "I think this is quite a fine page, thank you very much for it."


@pytest.fixture(scope="module")
def tree():
    return html_extract.trained(LABELLED)


def test_layouts_with_other_words_are_told_apart(tree):
    """No page has a class or id, so all of the answer comes from the blocks and their neighbours."""
    pages = [_marked(m) for number in range(100, 130) for m in _layouts(_Words(number))]
    assert not any(re.search(r"\b(class|id|role)=", m) for m, _ in pages)
    rows = np.concatenate([html_extract.block_features(html_extract.blocks(m)) for m, _ in pages])
    wanted = np.array([s == "+" for _, marks in pages for s in marks])
    assert len(wanted) > 5000 and (tree.predict(rows) == wanted).mean() > 0.98


def test_neighbours_and_words_decide(tree):
    used = {html_extract.FEATURES[f] for f, *_ in tree.nodes if f >= 0}
    assert {"words", "link_share"} <= used and all(any(f.startswith(n) for f in used) for n in ("words_before", "words_after", "links_"))
    assert html_extract.FEATURES[tree.nodes[0][0]] != "kind"
    # what the element alone would say is wrong on many blocks
    found = [(html_extract.blocks(m), marks) for m, marks in LABELLED]
    by_kind = [(b.kind, s == "+") for blocks, marks in found for b, s in zip(blocks, marks, strict=True)]
    best = sum(max(sum(1 for k, y in by_kind if k == kind and y == z) for z in (True, False)) for kind in {k for k, _ in by_kind})
    assert best / len(by_kind) < 0.95


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<body><div class="page social-history"><h1>A Title</h1><p>{LONG}</p><p>{LONG}</p></div>', ["A Title", LONG, LONG]),
        (f'<body><div class="search-results-page"><h1>A Title</h1><p>{LONG}</p><p><a href="/">{CHAT}</a></p><p>{LONG}</p></div>', ["A Title", LONG, CHAT, LONG]),
        (
            f"<body><div><h1>A Title</h1><p>{LONG}</p><p>{LONG}</p><p>Go on.</p></div><div class='x7'><div>Ann</div><div>{CHAT}</div></div><div class='x7'><div>Bob</div><div>{CHAT}</div></div></body>",
            ["A Title", LONG, LONG, "Go on."],
        ),
        (f"<noscript><p>{LONG}</p></noscript><object><p>{LONG}</p></object><template><p>{LONG}</p></template>", [LONG] * 3),
        (f"<article><p>{LONG}</p><div>Buy new boots</div><p>{LONG}</p></article><form><p>{LONG}</p></form><footer>{LONG}</footer><nav>{LONG}</nav>", [LONG, LONG]),
        (f"<article><p>{LONG}</p><p class=\"x>Hello</p><p>gone</p></article>", [LONG]),
        (f"<article><p>{LONG}</p><p class=\"x>Hello</p><p title=\"y\">{LONG}</p></article>", [LONG, LONG]),
        (f"<article><p title='a>b' data-x=\"c<d\" e=f'g>{LONG}</p></article>", [LONG]),
        (f"<article><p>{LONG}<!-- <p>no</p> --><![CDATA[ no ]]><?no?></p><!-->{CHAT}<!-- no --!> {CHAT}", [LONG, CHAT + " " + CHAT]),
        (f"<article><p>a < b, 3 <4 and <> too &lt;p&gt; &amp;amp; &#x41;&nbsp;B.</p><p>{LONG}</p></article>", ["a < b, 3 <4 and <> too <p> &amp; A B.", LONG]),
        (f"<article><p>null\0byte here</p><p>{LONG}</p><script>'</p>'</SCRIPT ><style>p{{}}</style><p>{LONG}</p>", ["null\0byte here", LONG, LONG]),
        (f"<ARTICLE><P>{LONG}<UL><LI>One<LI>Two <B>bold</B></UL><TABLE><TR><TD>x<TD>y<TR><TD>z</TABLE></ARTICLE>", [LONG, "One", "Two bold", "x", "y", "z"]),
        ("<script>" + LONG, []),
        ("\0", ["\0"][:0]),
    ],
)
def test_pages(tree, page, want):
    assert html_extract.main_text(page, tree) == "\n\n".join(" ".join(w.split()) for w in want)


class _Article(HTMLParser):
    """Text of the article element as the standard library reads it, cut at tags of blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.parts[-1] += " " if tag == "br" else ""
        if tag in ("p", "h1"):
            self.parts.append("")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.parts.append("")
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.parts[-1] += data


def test_given_pages_against_a_plain_reading(tree):
    rows = pq.read_table(Path(entry.SMOKE_DIR) / "pages.parquet").to_pylist()
    assert len(rows) > 20
    for row in rows:
        plain = _Article()
        plain.feed(row["html"])
        assert html_extract.main_text(row["html"], tree) == "\n\n".join(t for p in plain.parts if (t := " ".join(p.split())))


@pytest.mark.parametrize(
    "made",
    [
        lambda n: "<a " * n + '"', lambda n: '<a b="' * n, lambda n: "<a b='x' " * n, lambda n: "<" * n, lambda n: "</" * n, lambda n: "<!--" * n, lambda n: "<!" * n, lambda n: "<b>" * n,
        lambda n: "<p>" * n, lambda n: "<b>" * n + "<i>" * n + "</b>" * n, lambda n: "<script>" * n, lambda n: "&" * n, lambda n: "<a =   '" * n, lambda n: "<div>" * n + "</p>" * n, lambda n: "<li><b>" * n,
        lambda n: "<a href>x" * n, lambda n: "<p x = '" + " " * n + "'>" + "= " * n,
    ],
)
def test_time_grows_with_length(made):
    def seconds(n):
        page, best = made(n), 9.0
        for _ in range(2):
            begin = time.perf_counter()
            html_extract.blocks(page)
            best = min(best, time.perf_counter() - begin)
        return best

    assert seconds(40_000) < 30 * seconds(4_000) + 0.3
