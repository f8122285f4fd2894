"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at block tags into flat blocks. Each has its word count and link density, those of its neighbours, and whether it
stands in a part of the page that its markup calls main or not. A tree, grown on a labelled table that ``labelled`` makes from page
fragments with known answers, says which blocks are the article. Its first question is fixed: does the markup name a main part at
all? If so, that part decides; if not, words and links of the block and of its neighbours do. For those pages the table holds every
labelled page also with its main part, and with all its parts, as plain ``div``.

Cases: null and empty html, and pages without article, give an empty text; unclosed tags, attributes and comments end with the
page, and after a quote that nothing closes tags end at the next ``>``; character references are decoded once; white space inside a
block becomes one space; pages of any length are read once and nothing is capped; a leaf of equal shares counts as article; repeated
rows are extracted each; a column named like the result is replaced, other columns pass; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
LOOSE = re.compile(r"""<!--.*?(?:-->|\Z)|(?!)()()()|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
UNCLOSED = re.compile("<!--")
NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
RAW = frozenset("script style noscript template svg iframe object title textarea select math canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4"
    " h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul button".split()
)
HOLD = frozenset("article aside body center details dialog div dl fieldset figure footer form header main menu nav ol search section table td ul button p li span".split())
OUTER = frozenset("aside button dialog fieldset footer form menu nav search".split())
#: Fixed words of class names and ids that mark what is not the article, and what is.
OTHER_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner bottom breadcrumb breadcrumbs byline comment comments commentlist consent contentinfo"
    " cookie cookies copyright dialog disclaimer disqus feedback foot footer footnotes gdpr header legal links login masthead menu modal nav navbar navigation"
    " navlinks newsletter notice notification overlay pager pagination paywall popup privacy promo promotion reactions recommended related replies reply"
    " respond responses search share sharing side sidebar signup site-footer skip social sponsor sponsored subscribe subscription tagcloud teaser toolbar"
    " topbar trending warning widget widgets alert announcement complementary discussion".split()
)
MAIN_WORDS = frozenset("article main post entry story content maincontent articlebody body text".split())
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "other", "main", "heading", "page_main")


def _kind(tag: str, attributes: str, in_main: bool) -> int:
    """1: not the article, 2: main part, 0: says nothing."""
    named = {p.lower() for m in NAMES.finditer(attributes) for p in PART.findall(m[1] or m[2] or m[3] or "")} if "=" in attributes else set()
    if tag in OUTER or named & OTHER_WORDS and not (in_main and named & {"header"}):
        return 1
    if tag == "header" and not in_main:
        return 1
    return 2 if tag in ("article", "main") or named & MAIN_WORDS else 0


def blocks(html: str) -> tuple[list[str], np.ndarray]:
    """Texts of the flat blocks, and a row of ``FEATURES`` for each."""
    texts: list[str] = []
    rows: list[tuple] = []
    held: list[tuple[str, int]] = []  # open containers with their kind
    opened: Counter[str] = Counter()  # how many of them by tag
    kinds: list[int] = []  # of those that say something
    mains = 0  # how many of these are main parts
    heading, link, pieces, linked = 0, 0, [], []
    # a quote that nothing closes would be sought to the end again and again: after one, tags end at the next ``>``
    at, end, last, token = 0, len(html), html.rfind(">"), TOKEN

    def leave() -> str:
        nonlocal mains
        t, kind = held.pop()
        opened[t] -= 1
        if kind:
            mains -= kinds.pop() == 2
        return t

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                n = text.count(" ") + 1
                other = bool(kinds) and kinds[-1] == 1
                rows.append((n, min(1.0, len("".join(linked).split()) / n), other, not other and mains > 0, heading))
                texts.append(text)
            pieces.clear()
            linked.clear()

    def said(text: str) -> None:
        pieces.append(text)
        if link:
            linked.append(text)

    while at < end:
        m = token.search(html, at) if at <= last else UNCLOSED.search(html, at)
        if m is None:
            said(html[at:])
            break
        if m.start() > at:
            said(html[at : m.start()])
        at = m.end()
        if m.re is UNCLOSED:
            break
        if m[5]:
            token = LOOSE
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        if tag in RAW:
            if not closing and not (m[3] or m[6] or "").endswith("/"):
                close = re.compile(f"</{tag}\\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else end
            continue
        if tag in BLOCK:
            flush()
        elif tag in ("br", "img", "input"):
            said(" ")
        if tag == "a":
            link = 0 if closing else 1
        elif tag[0] == "h" and len(tag) == 2 and tag[1].isdigit():
            heading = 0 if closing else 1
        if tag in HOLD:
            if not closing:
                kind = _kind(tag, m[3] or m[6] or "", mains > 0)
                if tag in ("p", "li"):  # these end with the next one or with their parent
                    while held and held[-1][0] in ("span", tag):
                        leave()
                held.append((tag, kind))
                opened[tag] += 1
                if kind:
                    kinds.append(kind)
                    mains += kind == 2
            elif opened[tag]:
                while leave() != tag:
                    pass
                link = 0 if tag in BLOCK else link
    flush()
    if not rows:
        return texts, np.zeros((0, len(FEATURES)))
    own = np.array(rows, float)
    near = np.zeros((len(own) + 2, 2))
    near[1:-1] = own[:, :2]
    return texts, np.column_stack([own[:, :2], near[:-2], near[2:], own[:, 2:], np.full(len(own), own[:, 3].any())])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> tuple | float:
    """A tree of (feature, limit, at most, above); a leaf is the share of articles. Splits lower the Gini impurity most."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return share
    best = (share * (1 - share) * len(y) - 1e-9, None, None)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones, n = x[order, f], np.cumsum(y[order]), np.arange(1, len(y) + 1)
        left, right = ones[:-1] / n[:-1], (ones[-1] - ones[:-1]) / (len(y) - n[:-1])
        cost = left * (1 - left) * n[:-1] + right * (1 - right) * (len(y) - n[:-1])
        cost[(v[1:] == v[:-1]) | (n[:-1] < least) | (len(y) - n[:-1] < least)] = np.inf
        k = int(np.argmin(cost))
        if cost[k] < best[0]:
            best = (cost[k], f, (v[k] + v[k + 1]) / 2)
    if best[1] is None:
        return share
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def predict(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    low = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[low], out[~low] = predict(tree[2], x[low]), predict(tree[3], x[~low])
    return out


def unnamed_main(html: str) -> str:
    """Main parts as plain ``div``."""

    def plain(m: re.Match) -> str:
        return "" if MAIN_WORDS & {p.lower() for p in PART.findall(m[0])} else m[0]

    return re.sub(r"<(/?)(?:article|main|section)\b([^>]*)>", r"<\1div\2>", re.sub(NAMES, plain, html))


def unnamed(html: str) -> str:
    """All parts as plain ``div`` without names: only words and links are left to tell."""
    return re.sub(r"<(/?)(?:article|main|section|nav|aside|footer|header|form|button)\b[^>]*>", r"<\1div>", re.sub(NAMES, "", html))


def labelled(seed: int = 7, views: tuple[Callable[[str], str], ...] = (str,)) -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: blocks of pages put together from fragments whose answer is known, each page in every view."""
    draw = random.Random(seed)

    def words(least: int, most: int) -> str:
        return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(draw.randint(least, most)))

    def links(n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="#">{words(1, 3)}</a></{tag}>' for _ in range(n))

    def article(heading: bool = True) -> str:
        body = f"<h1>{words(3, 9)}</h1>" if heading else ""
        for _ in range(draw.randint(3, 7)):
            body += draw.choice((f"<p>{words(25, 120)}</p>", f"<p>{words(25, 90)} <a href='#'>{words(1, 4)}</a> {words(5, 20)}</p>", f"<p>{words(1, 6)}</p>", f"<p>{words(30, 80)}</p>", f"<h2>{words(2, 6)}</h2><p>{words(20, 60)}</p>"))
        return body

    def list_of() -> str:
        return "<ul>" + "".join(f"<li>{words(3, 15)}</li>" for _ in range(4)) + "</ul>"

    pages = []
    for k in range(60):
        menu, foot, ad = links(draw.randint(4, 8)), f"&copy; {words(2, 12)}", words(4, 20)
        long = "".join(f"<p>{words(1, 400) if draw.random() < 0.8 else words(1, 12)}</p>" for _ in range(draw.randint(1, 6))) + f"<p>{words(25, 200)}</p>"
        plain = [
            [("<nav><ul>" + menu + '</ul></nav><div class="ad">' + words(3, 25) + "</div>", 0), ("<article><h1>" + words(2, 16) + "</h1>" + long + "</article>", 1), ("<footer>" + words(3, 25) + "</footer>", 0)],
            [("<nav><ul>" + menu + "</ul></nav><header>" + words(1, 6) + '</header><div class="ad">' + ad + "</div>", 0), ("<article>" + article() + list_of() + "</article>", 1), ("<footer>" + foot + "</footer>", 0)],
            [('<div id="header"><h1>' + words(1, 4) + '</h1></div><div class="main-menu"><ul>' + menu + "</ul></div>", 0), ('<div id="content" class="post">' + article() + "</div>", 1), ('<div class="sidebar"><h3>' + words(1, 3) + "</h3><p>" + words(8, 40) + "</p><ul>" + links(5) + '</ul></div><div class="comments"><h3>Comments</h3><p>' + words(10, 60) + "</p><p>" + words(5, 50) + '</p></div><div id="footer"><p>' + foot + "</p></div>", 0)],
            [("<table><tr><td>" + links(6, "p") + "</td></tr></table><p>" + words(1, 4) + "</p>", 0), ("<div>" + "".join(f"<p>{words(25, 110)}</p>" for _ in range(5)) + "</div>", 1), ("<div>" + links(4, "p") + "<p>" + words(2, 7) + "</p></div>", 0)],
            [('<div class="cookie-notice"><p>' + words(10, 45) + "</p></div><main>", 0), (article(), 1), ('<aside class="promo"><p>' + words(6, 45) + "</p></aside><form><p>" + words(2, 12) + "</p><button>" + words(1, 2) + "</button></form>", 0), (f"<p>{words(20, 60)}</p><p>{words(2, 6)}</p>", 1), ('<section class="comments"><article class="comment"><p>' + words(10, 70) + "</p></article></section></main><footer><p>" + foot + "</p></footer>", 0)],
        ]
        pages.append(plain[k % len(plain)])
    pages = [[(view(h), label) for h, label in page] for page in pages for view in views]
    x, y = [], []
    for page in pages:
        _, rows = blocks("<html><body>" + "".join(h for h, _ in page) + "</body></html>")
        # each fragment ends a block, so its number of blocks is what the page gains by it
        sizes = [len(blocks("".join(h for h, _ in page[:i]))[0]) for i in range(len(page) + 1)]
        x.append(rows)
        y.append(np.concatenate([np.full(b - a, label, float) for a, b, (_, label) in zip(sizes[:-1], sizes[1:], page, strict=True)]))
    return np.concatenate(x), np.concatenate(y)


@cache
def tree() -> tuple | float:
    """The first question is fixed: whether the page's markup names a main part. Both answers have a grown tree."""
    x, y = labelled(views=(str, unnamed_main, unnamed))
    named = x[:, FEATURES.index("page_main")] > 0.5
    return FEATURES.index("page_main"), 0.5, grow(x[~named], y[~named], least=8), grow(x[named], y[named])


def main_text(html: str | None) -> str:
    texts, x = blocks(html or "")
    if not texts:
        return ""
    return "\n".join(t for t, p in zip(texts, predict(tree(), x), strict=True) if p >= 0.5)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """All columns but the html, and the article's text in ``out``."""
    rest = [c for c in pages.columns if c not in (html, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(x.as_py()) for x in b.column(len(rest))], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], texts], names=[*rest, out])

    return pages.select(*rest, F.col(html)).mapInArrow(run, pages.select(*rest, F.lit("").alias(out)).schema)
