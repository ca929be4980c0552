"""Main text of web pages by tag-path ratios.

A page is read as a sequence of blocks (runs of inline content between block-level tags), each
with the path of tags from the root to it. Text length and punctuation are totalled per path and
divided by its number of blocks; the ratios are smoothed along the page, fused, and paths above
a threshold hold the content. The smallest element that holds all of that content is the article;
what it contains in page order is the text, without the parts that are never content (menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles). If only the body
holds it, the text reaches from the first block of content to the last. Headings before the text
belong to it, and beside blocks of the body lists and tables that are not mostly links.

Defined cases: a null or empty html, or one without content, gives an empty text; tags left open
are closed by what follows, as browsers do; broken markup never fails; repeated rows and null
ids or urls are kept; further columns are carried along.
"""

from __future__ import annotations

import html as references
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
    nav ol option p pre search section summary table tbody td tfoot th thead tr ul""".split())
CLOSES = {  # an element of the key's kind ends an open one of these (up to the given borders)
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, set()),
}
# Elements that are never part of the article, and words in class, id or role that mark others.
NEVER = frozenset("""head script style noscript template nav footer aside form button select textarea iframe
    svg canvas object embed audio video menu dialog input datalist search""".split())
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising advertorial adsense adsbygoogle leaderboard
    outbrain taboola sponsor sponsored promo promotion banner announcement copyright legal dialog
    nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside rail footer foot header masthead
    topbar toolbar cookie cookies consent gdpr notice notices alert disclaimer popup modal overlay newsletter
    subscribe subscription signup login paywall comment comments commentlist disqus reply replies respond discussion
    share sharing social related recommended recommendations teaser widget widgets pagination pager tags
    complementary contentinfo search hidden""".split())
CONTENT_MARKS = frozenset("article content main post entry story body text".split())
STRONG_MARKS = MARKS & frozenset("""ad ads advert advertisement comment comments commentlist disqus sponsored
    replies respond related""".split())
# Words beside which "sidebar" names the layout of a page and not the sidebar.
LAYOUT_MARKS = frozenset("layout wrapper container has with no page grid row columns".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")

SMOOTH = (0.25, 0.5, 0.25)   # along the sequence of blocks
THRESHOLD = 0.35             # of the best path's fused ratio
WRAPPED_CHARS = 400          # text that only a marked wrapper of the page would hold
NAMED = 16.0                 # added to the ratios of paths inside the only article or main


class _Element:
    __slots__ = ("tag", "parent", "path", "skip", "inside", "depth")

    def __init__(self, tag, parent, skip):
        self.tag, self.parent = tag, parent
        self.path = f"{parent.path}/{tag}" if parent else tag
        self.depth = parent.depth + 1 if parent else 0
        self.inside = bool(parent and (parent.inside or tag in ("article", "main")))  # of an article
        self.skip = skip


def _marked(tag: str, attributes: str, inside: bool, strict: bool) -> bool:
    """Whether an element is one of the parts that are never content. Words that also name the
    state of a whole page count only if ``strict``. Ids of sections, and of all elements of an
    article, are often made of their titles: they count as a whole, and those of headings never."""
    if tag in NEVER or (tag == "header" and not inside):
        return True
    if not attributes.strip() or tag in ("html", "body", "main"):
        return False
    words, names = set(), []
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif tag in HEADINGS and (inside or name == "id"):
            continue
        elif name == "id" and (inside or tag == "section"):
            words.update({value.strip().lower()} & MARKS)
        elif name in ("class", "id", "role"):
            words.update(w.lower() for w in _WORDS.findall(value))
            names += value.split()
    if tag == "article":  # a comment or a related card; a post may say that its comments are open
        starts = {w[0].lower() for w in map(_WORDS.findall, names) if w}
        return bool(starts & STRONG_MARKS and not {n.lower() for n in names} & CONTENT_MARKS)
    if tag in HEADINGS:
        words.discard("header")
    if words & LAYOUT_MARKS:
        words -= {"sidebar", "sidebars"}
    return bool(words & STRONG_MARKS or (strict and words & MARKS and not words & CONTENT_MARKS))


def blocks_of(page: str, strict: bool = True) -> list[tuple[_Element, str, int]]:
    """``(element, text, characters in links)`` of every block that may be content."""
    root = _Element("", None, False)
    top, out, run, links = root, [], [], 0

    def flush():
        nonlocal links
        if run:
            text = " ".join("".join(run).split())
            if text and not top.skip:
                out.append((next_block(top), text, min(links, len(text))))
            run.clear()
        links = 0

    def next_block(e):
        while e.parent and e.tag not in BLOCK:
            e = e.parent
        return e

    def close(tags, borders):
        """Leave the innermost open element of ``tags`` unless a border lies before it."""
        nonlocal top
        e = top
        while e.parent and e.tag not in tags and e.tag not in borders:
            e = e.parent
        if e.parent and e.tag in tags:
            top = e.parent

    def text(s):
        nonlocal links
        if s and not top.skip:
            s = references.unescape(s)
            run.append(s)
            e = top
            while e.parent and e.tag not in BLOCK:
                if e.tag == "a":
                    links += len(s.strip())
                    break
                e = e.parent

    at = 0
    while (m := _TOKEN.search(page, at)):
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = m[1] or m[4]
        if tag == "br":
            run.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if closing:
            close({tag}, {"article", "main", "body", "td", "table"} - {tag} if tag not in ("article", "main", "body", "html", "table")
                  else set())
            continue
        if tag in BLOCK and tag not in ("html", "body"):
            close({"p"}, {"article", "main", "section", "div", "td", "li", "blockquote", "body", "table", "form"})
        if tag in CLOSES:
            close(*CLOSES[tag])
        attributes = m[3] or m[6] or ""
        element = _Element(tag, top, top.skip or _marked(tag, attributes, top.inside, strict))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            at = end.end()
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            top = element
        elif tag not in VOID and tag in BLOCK:
            top = element  # a slash does not close an HTML element
    text(page[at:])
    flush()
    return out


def _ratios(blocks) -> dict[str, float]:
    """Fused, smoothed text and punctuation ratio of every tag path."""
    totals: dict[str, list[float]] = {}
    for element, text, links in blocks:
        t = totals.setdefault(element.path, [0, 0.0, 0.0])
        t[0] += 1
        t[1] += len(text) - links
        t[2] += len(_PUNCTUATION.findall(text)) * (1 - links / len(text))
    length = [totals[e.path][1] / totals[e.path][0] for e, _, _ in blocks]
    marks = [totals[e.path][2] / totals[e.path][0] for e, _, _ in blocks]

    def smooth(values):
        padded = [values[0], *values, values[-1]]
        return [sum(w * padded[i + k] for k, w in enumerate(SMOOTH)) for i in range(len(values))]

    fused: dict[str, list[float]] = {}
    for (element, _, _), x, y in zip(blocks, smooth(length), smooth(marks)):
        fused.setdefault(element.path, []).append(math.log1p(x) * (1 + math.log1p(y)))
    # A page with one article or main names its text; several are a list, which says nothing.
    outermost = {id(e) for e in (_outermost(element) for element, _, _ in blocks) if e}
    named = {e.path for e, _, _ in blocks if e.inside} if len(outermost) == 1 else ()
    return {path: sum(v) / len(v) + (NAMED if path in named else 0.0) if totals[path][1] > 0 else 0.0
            for path, v in fused.items()}


def _outermost(element: _Element) -> _Element | None:
    """The outermost article or main around an element."""
    found = None
    while element:
        if element.tag in ("article", "main"):
            found = element
        element = element.parent
    return found


def extract(page: str | None) -> str:
    """The article's blocks, joined by line breaks."""
    blocks = blocks_of(page or "")
    if not blocks and page:
        # Nothing but marked parts: either there is no article, or a wrapper of the whole page
        # carries a word such as "nav-open".
        wrapped = blocks_of(page, strict=False)
        if sum(len(t) - links for _, t, links in wrapped) >= WRAPPED_CHARS:
            blocks = wrapped
    if not blocks:
        return ""
    ratios = _ratios(blocks)
    line = THRESHOLD * max(ratios.values())
    chosen = [i for i, (e, _, _) in enumerate(blocks) if ratios[e.path] >= line and ratios[e.path] > 0]
    if not chosen:
        return ""
    best = blocks[chosen[0]][0]
    for i in chosen[1:]:
        best = _common(best, blocks[i][0])
    while best.parent and best.tag in ("p", "li", "blockquote", *HEADINGS):
        best = best.parent
    e = best
    while e and e.tag not in ("article", "main"):
        e = e.parent
    best = e or best  # an article that the page names is taken whole
    whole = best.tag not in ("", "html", "body")
    held = [i for i, (e, _, _) in enumerate(blocks) if _common(e, best) is best] if whole else chosen
    first, last = held[0], held[-1]  # an element's blocks follow one another

    def beside(i: int) -> bool:
        """Whether a block next to the text belongs to it."""
        element, text, links = blocks[i]
        return element.tag in HEADINGS or (not whole and links * 2 <= len(text) and _in_list(element))

    while first and beside(first - 1):
        first -= 1
    while not whole and last + 1 < len(blocks) and beside(last + 1):
        last += 1
    return "\n".join(text for _, text, _ in blocks[first:last + 1])


def _common(a: _Element, b: _Element) -> _Element:
    """The innermost element that holds both."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a


def _in_list(element: _Element) -> bool:
    while element and element.tag not in ("ul", "ol", "dl", "table"):
        element = element.parent
    return element is not None


def extract_pages(pages: DataFrame) -> DataFrame:
    """``pages(html, …)`` with ``text`` and ``n_chars`` in place of ``html``."""
    @F.pandas_udf("string")
    def main_text(column: pd.Series) -> pd.Series:
        return column.map(extract)

    carried = [F.col(f"`{c}`") for c in pages.columns if c not in ("html", "text", "n_chars")]
    made = pages.select(*carried, main_text(F.col("html").cast("string")).alias("text"))
    return made.withColumn("n_chars", F.char_length("text").cast("long"))
