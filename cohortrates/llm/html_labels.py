"""The small labelled table that the block tree is trained on: pages, and a mark for each of their blocks.

The first pages are written out with a mark per block. The others are page layouts filled with running words, in which
blocks of main text begin with a sign. Their classes and ids say nothing, as on pages not seen before.
"""

import random

_LONG = "Early in the spring the river rose over its banks and the lower meadows stayed under water for a month and more"
_MID = "Nobody had seen it coming, and few were ready"

#: (markup, + for a block of main text and - for any other)
_WRITTEN: list[tuple[str, str]] = [
    (
        f"""<html><head><title>High water</title></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li>
        <li><a href="/s">Sport</a></li></ul></nav><div class="ad">Buy new boots today at half the price</div><article><h1>High water</h1>
        <p>{_LONG}.</p><p>So it went.</p><p>{_MID}.</p><p>Quite.</p><p>{_LONG}, with <a href="/x">one link</a> in it.</p></article>
        <footer>&copy; The Daily Letter &middot; all rights reserved.</footer></body></html>""",
        "-----++++++-",
    ),
    (
        f"""<body><header><div>The Daily Letter</div><div>Monday edition</div></header><div id="cookie-notice"><p>We use cookies to make this
        site work and to count our visitors. <a href="/c">More</a></p><button>Accept</button></div><main><h2>A walk</h2><p>{_LONG}</p>
        <blockquote>{_MID}</blockquote><ul><li>Boots</li><li>A map</li><li>Bread and cheese</li></ul><p>Go.</p></main>
        <aside class="sidebar"><h3>Most read</h3><p><a href="/1">Storm over the bay last night</a></p><p>Sign up for our weekly letter and
        never miss a story again.</p></aside><section id="comments"><h3>Comments</h3><p>Ann: {_LONG}</p><p>Nice!</p></section></body>""",
        "----+++++++------",
    ),
    (
        f"""<body><div class="menu"><a href="/a">Start</a> <a href="/b">About us</a> <a href="/c">Contact</a></div><div><h1>Bees</h1>
        <p>{_LONG}.</p><p>{_LONG}. {_MID}.</p><p>{_MID}.</p></div><form><p>Name</p><p>Your message to the editors of this page</p></form>
        <div class="related"><p><a href="/q">Ten ways to keep bees at home</a></p></div><p>Copyright 2001</p></body>""",
        "-++++----",
    ),
    (
        f"""<body><p><a href="/">Home</a> | <a href="/news">News</a> | <a href="/more">More</a></p><h1>Plain page</h1><p>{_LONG}</p><p>{_MID}</p>
        <p>{_LONG}. <a href="/f">{_MID}</a>.</p><p><a href="/p">Previous page</a></p><p><a href="/n">Next page</a></p></body>""",
        "-++++--",
    ),
    (
        f"""<div id="nav"><p>Section index</p></div><div class="post-content"><p>{_MID}</p><p>End.</p><h2>Why</h2><p>{_LONG}</p>
        <p><a href="/s">A source</a></p><div class="advert">Our sponsors make this page possible, so please visit them</div><p>{_MID}</p>
        <div class="share">Share this story</div></div><div class="comment">{_LONG}</div><div class="comment"><p>{_MID}</p></div>""",
        "-+++++-+---",
    ),
    (
        f"""<body><article><header><h1>Title of it</h1><p>By a writer, today</p></header><p>One.</p><p>{_LONG}</p><p>Two words</p><table><tr><td>Year</td>
        <td>Rain</td></tr><tr><td>1901</td><td>12</td></tr></table><aside>Read also our report from last week about the bridge</aside><p>{_MID}</p>
        </article><div class="newsletter">Get the best of our stories in your mail every week</div></body>""",
        "--+++++++-+-",
    ),
    (
        f"""<body><div>{_LONG}</div><div>{_LONG}. {_LONG}.</div><div><a href="/1">One</a></div><div><a href="/2">Two</a></div><div>{_LONG}</div>
        <div>{_MID}</div><div><a href="/3">Terms</a> <a href="/4">Privacy</a> <a href="/5">Imprint</a></div></body>""",
        "++--++-",
    ),
]

_WORDS = (
    "about after again along among and another around because before began between both bridge came carried city clear closed cold could country day"
    " down early every field first found from garden great had harbour have heard her high his house into its large last later left light little long made"
    " many market might more morning most mountain near never night north often only other over path people place quiet rain road seen several she side"
    " small some stone street summer than that the their then there they through town two under until upon valley wall was water well were when where which"
    " while white wind winter with without word work year"
).split()

#: Begins a block of main text in a layout.
_SIGN = "§"


class _Words:
    """Running words: sentences, names and links, the same for the same number."""

    def __init__(self, number: int):
        self.rng = random.Random(number)
        # pages differ in the length of their words and in how many marks they set, in text and elsewhere alike
        self.long, self.marks = self.rng.random() ** 2, self.rng.random() ** 2

    def some(self, least: int, most: int) -> str:
        def word() -> str:
            made = self.rng.choice(_WORDS)
            while self.rng.random() < self.long / 2:
                made += self.rng.choice(_WORDS)
            return made + self.rng.choice([".", ",", "!", "###", "|"]) if self.rng.random() < self.marks / 3 else made

        return " ".join(word() for _ in range(self.rng.randint(least, most)))

    def text(self, least: int, most: int) -> str:
        """Sentences of up to 18 words, with commas."""
        words = self.some(least, most).split()
        made = []
        while words:
            n = self.rng.randint(1, 18)
            part, words = words[:n], words[n:]
            if len(part) > 6:
                part[len(part) // 2] += ","
            made.append(" ".join(part).capitalize() + ".")
        return " ".join(made)

    def link(self, least: int = 1, most: int = 3) -> str:
        return f'<a href="/{self.rng.randrange(999)}">{self.some(least, most).capitalize()}</a>'

    def paragraphs(self, n: int, tag: str = "p", short: float = 0.25) -> str:
        """Blocks of main text, some of them short, some with a link, a few a link alone."""
        made = []
        for _ in range(n):
            chance = self.rng.random()
            inside = self.text(1, 6) if chance < short else self.text(12, 90)
            if chance > 0.85:
                inside += " " + self.link() + " " + self.text(2, 8)
            elif chance > 0.75:
                inside = self.link(6, 14)
            made.append(f"<{tag}>{_SIGN}{inside}</{tag}>")
        return "".join(made)

    def list_of(self, n: int, links: bool = True) -> str:
        return "<ul>" + "".join(f"<li>{self.link() if links else self.some(2, 7).capitalize()}</li>" for _ in range(n)) + "</ul>"


def _layouts(w: _Words) -> list[str]:
    n = w.rng.randint
    title, copy = w.some(3, 9).capitalize(), f"&copy; {n(1995, 2025)} {w.some(2, 5)}"
    comments = "".join(f"<div><div>{w.some(1, 2).capitalize()}</div><div>{w.text(4, 40)}</div></div>" for _ in range(n(2, 5)))
    notes = "".join(f"<section><h4>{w.some(1, 2).capitalize()}, {n(1, 28)} May</h4><p>{w.text(5, 30)}</p>{w.link(1, 1)}</section>" for _ in range(n(2, 4)))
    menu = "".join(f"<div>{w.link()}</div>" for _ in range(n(3, 7)))
    cookies = f"<div><p>{w.text(8, 20)} {w.link(1, 2)}</p><button>{w.some(1, 2)}</button></div>"
    advert = f"<div>{w.some(4, 12).capitalize()}</div>"
    return [
        # menu, advert, article, footer, with elements that say so
        f"<head><title>{title}</title></head><body><nav>{w.list_of(n(4, 8))}</nav><div>{w.text(4, 22)}</div><article><h1>{_SIGN}{title}</h1><p><b>{_SIGN}{title} {w.some(0, 20)}<br>"
        f"{w.paragraphs(n(1, 9))}</article><footer>{copy} &middot; {w.text(4, 14)}</footer>",
        f"<body><nav>{w.list_of(n(4, 8))}</nav><div>{w.text(4, 22)}</div><article><h1>{_SIGN}{w.some(1, 2).capitalize()}</h1><p><b>{_SIGN}{w.text(1, 3)}<br>{w.paragraphs(n(0, 2), short=0.9)}</article>"
        f"<footer>{copy} {w.text(4, 20)}</footer>",
        # the same with bare containers only
        f"<body><div>{w.list_of(n(4, 8))}</div><div>{w.text(4, 22)}</div><div><h1>{_SIGN}{title}</h1>{w.paragraphs(n(3, 9))}</div><div>{copy} {w.text(3, 12)}</div>",
        # comments below, each in containers of its own
        f"<body>{menu}<div><h1>{_SIGN}{title}</h1><div>{w.some(2, 5)}</div>{w.paragraphs(n(4, 10))}</div><div><h3>{n(2, 40)} {w.some(1, 1)}</h3>{comments}</div><div>{copy}</div>",
        f"<body>{cookies}<div>{w.list_of(n(3, 6))}</div><div><div><h2>{_SIGN}{title}</h2>{w.paragraphs(n(4, 9))}</div><div>{w.link()} {w.link()} {w.link()}</div></div>{notes}<p>{copy}</p>",
        f"<body><article><h1>{_SIGN}{title}</h1>{w.paragraphs(n(1, 4))}<div>{w.some(2, 9).capitalize()}</div>{w.paragraphs(n(1, 4))}<div>{w.some(2, 9).capitalize()}</div>{w.paragraphs(n(1, 3))}</article><footer>{w.text(3, 40)}</footer>",
        # comments inside the article's element, after sharing links
        f"<body><nav>{w.list_of(n(3, 6))}</nav><article><header><h1>{title}</h1><p>{w.some(2, 6)}</p></header>{w.paragraphs(n(3, 8))}<div>{w.link()} {w.link()}</div><div>{comments}</div></article>"
        f"<footer>{w.list_of(n(2, 5))}{copy}</footer>",
        # an article of a few words and longer comments outside of it
        f"<body><nav>{w.link()} {w.link()}</nav><article><h1>{_SIGN}{title}</h1><p>{_SIGN}{w.text(2, 9)}</p><p>{_SIGN}{w.text(1, 4)}</p></article><div><p>{w.text(9, 30)}</p></div><div><p>{w.text(9, 40)}</p></div>",
        # adverts between paragraphs, lists and tables in the text, a side column
        f"<body><div><p>{w.link()} &gt; {w.link()}</p></div><div><h1>{_SIGN}{title}</h1>{w.paragraphs(n(2, 4))}{advert}{w.paragraphs(n(2, 4))}<ul>{w.paragraphs(3, 'li', 0.6)}</ul>{advert}"
        f"{w.paragraphs(2)}</div><div><h3>{w.some(1, 3).capitalize()}</h3>{w.list_of(n(3, 6))}<p>{w.text(6, 14)}</p></div><div>{copy}</div>",
        f"<body><main><h1>{_SIGN}{title}</h1>{w.paragraphs(n(2, 5))}<table><tr><td>{_SIGN}{w.some(1, 3)}</td><td>{_SIGN}{n(1, 99)}</td></tr><tr><td>{_SIGN}{w.some(1, 3)}</td><td>{_SIGN}{n(1, 99)}</td></tr></table>"
        f"{w.paragraphs(2)}</main><aside><h3>{w.some(1, 3)}</h3><p>{w.text(5, 30)}</p></aside><form><p>{w.some(3, 8)}</p></form>",
        # text in containers instead of paragraphs, links between
        f"<body><div>{w.link()}</div><div>{w.link()}</div>{w.paragraphs(n(3, 7), 'div', 0.0)}<div>{w.link()} {w.link()} {w.link()}</div><div>{copy}</div>",
        # no containers at all
        f"<body><p>{w.link()} | {w.link()} | {w.link()}</p><h1>{_SIGN}{title}</h1>{w.paragraphs(n(3, 8))}<p>{w.link()}</p><p>{w.link()}</p>",
        f"<h2>{_SIGN}{title}</h2>{w.paragraphs(n(2, 6))}",
        # text alone, and none at all
        f"{_SIGN}{w.text(12, 60)}",
        f"{_SIGN}{w.some(12, 30)}",
        f"<div>{w.text(1, 10)}</div><footer>{copy}</footer>",
        w.text(1, 9),
        f"<body><div>{w.text(1, 5)}</div><div>{w.text(1, 11)}</div>",
        # text of an article without paragraphs, and with lists and tables
        f"<body><div>{w.link()} {w.link()}</div><article>{_SIGN}{w.text(15, 40)}<h2>{_SIGN}{title}</h2>{w.paragraphs(n(1, 5), 'div', 0.0)}</article>{advert}",
        f"<body><nav>{w.list_of(4)}</nav><article>{w.paragraphs(n(1, 3))}<ul>{w.paragraphs(n(1, 4), 'li', 0.8)}</ul><table><tr><th>{_SIGN}{w.some(1, 2)}<td>{_SIGN}{w.some(1, 3)}<tr><th>{_SIGN}{n(1, 99)}"
        f"<td>{_SIGN}{n(1, 99)}</table></article><footer>{copy}</footer>",
        f"<body><nav>{w.list_of(n(4, 9))}</nav><div>{w.text(4, 22)}</div><footer>{copy} {w.link()}</footer>",
        # teasers of other pages below and beside
        f"<body><div>{menu}</div><section><h1>{_SIGN}{title}</h1>{w.paragraphs(n(4, 8))}</section>"
        + "".join(f"<div><h4>{w.link(3, 8)}</h4><p>{w.text(5, 16)} {w.link(2, 2)}</p></div>" for _ in range(n(2, 4)))
        + f"<div>{copy} {w.link()}</div>",
        # sections of an article, each a container of its own
        f"<body><header><p>{w.some(2, 4)}</p>{w.list_of(3)}</header><div><h1>{_SIGN}{title}</h1>{w.paragraphs(2)}<section><h2>{_SIGN}{w.some(2, 5)}</h2>{w.paragraphs(n(2, 4), short=0.1)}</section><section><h2>{_SIGN}{w.some(2, 5)}</h2>"
        f"{w.paragraphs(n(2, 4), short=0.1)}</section></div><div><p>{w.some(3, 6)}</p><p>{w.link()}</p></div>",
    ]


def _marked(markup: str) -> tuple[str, str]:
    from .html_extract import blocks

    marks = "".join("+" if b.text.startswith(_SIGN) else "-" for b in blocks(markup))
    return markup.replace(_SIGN, ""), marks


LABELLED: list[tuple[str, str]] = _WRITTEN + [_marked(m) for number in range(32) for m in _layouts(_Words(number))]
