"""Main text of web pages by classifying flat text blocks.

A page is cut into flat blocks at block-level tags.  Each block is described by
its own and its neighbours' word count and link density and by what encloses it
(navigation-like elements, telling class names, an article, a heading, a list
item).  A decision tree over these features, grown on a small labelled table,
says which blocks are main text; they are joined in page order.

A class name tells something only where nothing in it says otherwise (``no-sidebar``, ``has-banner``,
``tags-open`` do not), and an enclosing form or telling name that holds
the page's text itself is a wrapper: the words inside it, without those that other marks set
apart, are compared with the unmarked sentences outside.  Names that many authors give to whole pages
(``reader``, ``more``, ``share``, or any beside ``content``, ``main``, ``post``) are taken for wrappers when little is left outside, clear
ones (``comments``, ``sidebar``) only when nothing is and an article or main heading lies inside.

The labelled table is built from the page outlines below: words are counted,
not quoted, so an outline stands for pages of any language.  The tree is grown
once a process by a fixed rule; nothing in it depends on the pages at hand.

Cases: null and empty pages and pages without main text give the empty text;
markup may be unclosed or wrongly nested; scripts, styles, comments and
form controls never count as text; an unclosed comment or script runs to the end,
an unclosed button or drawing to the end of the block around it;
a quote that never closes does not hide the tag's end; rows that repeat are extracted
each; an empty table gives an empty table; other columns are passed through.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from .catalog import query, table
from .text import text_array

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[\"'=])*+)(?:>|\Z))",
    re.S,
)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
# Element and class names of HTML pages.
RAW = {"script", "style", "textarea", "title", "iframe"}  # text up to their own end tag, or to the end of the page
CONCEALED = {"noscript", "template", "svg", "select", "button", "object", "canvas", "datalist"}
BLOCKS = set(
    "p div article section main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre"
    " nav header footer aside form fieldset legend label figure figcaption address details summary body html head hr menu dialog center".split()
)
BOUNDS = set("nav header footer aside form fieldset menu dialog article main section div ul ol table blockquote figure details".split())
APART = {"nav", "footer", "aside", "menu", "dialog"}
FORMS = {"form", "fieldset"}
CUES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored banner sidebar widget"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer copyright cookie cookies consent gdpr"
    " popup modal overlay newsletter related recommended comment comments disqus contentinfo complementary"
    " outbrain taboola paywall".split()
)
VAGUE_CUES = set(
    "promo promotion side rail foot legal notice notices alert subscribe subscription signup login register share sharing social more"
    " reply replies respond discussion reader readers feedback masthead topbar toolbar search form skip disclaimer tags".split()
)
BEFORE = {"no", "non", "not", "has", "have", "with", "without", "hide", "show", "is"}  # no-sidebar, has-banner
BEHIND = {"open", "opened", "closed", "visible", "enabled", "disabled", "active", "ready", "loaded", "on", "off"}  # tags-open
CONTENT = {"content", "main", "article", "post", "entry", "story", "body", "layout", "page", "wrapper", "container", "site", "app"}
VAGUE, CLEAR, HIDDEN = 1, 2, 3
SENTENCE, SHARE, TEXTUAL = 10, 0.3, 40  # words of a block that counts as text outside; largest share outside a vague wrapper; least words inside
FEATURES = (
    "apart", "cue", "article", "heading", "item", "words", "links", "first", "last", "words_before", "links_before", "words_after", "links_after"
)
MANY = 25  # longer blocks count as this long


class Container:
    """An open element: what its names tell, whether it sets its text apart, and whether an article or main heading lies inside."""

    __slots__ = ("name", "cue", "apart", "holds", "wraps")

    def __init__(self, name: str, cue: int):
        self.name, self.cue, self.holds, self.wraps = name, cue, False, False
        self.apart = CLEAR if name in APART else VAGUE if name in FORMS else 0


class Block:
    __slots__ = ("parts", "linked", "marks", "header", "article", "heading", "item")

    def __init__(self, marks, header, article, heading, item):
        self.parts, self.linked = [], 0
        self.marks, self.header, self.article, self.heading, self.item = marks, header, article, heading, item


def tells(attributes: str) -> int:
    """How clearly a tag's class, id or role names something that is not main text: 0, ``VAGUE``, ``CLEAR``, or ``HIDDEN``."""
    if not attributes:
        return 0
    if _HIDDEN.search(attributes):
        return HIDDEN
    found = 0
    for m in _NAMED.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
            for i, word in enumerate(words):
                if word not in CUES and word not in VAGUE_CUES or not BEFORE.isdisjoint(words[:i]) or i + 1 < len(words) and words[i + 1] in BEHIND:
                    continue
                found = max(found, CLEAR if word in CUES and CONTENT.isdisjoint(words) else VAGUE)
    return found


def find_wrappers(rows: list[tuple[Block, int]]) -> None:
    """Mark the containers that hold the page's own text; rows are (block, words outside links)."""
    outside = sum(n for b, n in rows if not b.marks and not b.header and n >= SENTENCE)
    reach: dict[int, list] = {}  # container, first and last block, words
    for i, (b, n) in enumerate(rows):
        for c in b.marks:
            known = reach.setdefault(id(c), [c, i, i, 0])
            known[2], known[3] = i, known[3] + n
    decided: dict[tuple, bool] = {}
    # From the outside in: what an outer wrapper has freed counts as unmarked for the inner ones.
    for c, first, last, words in reach.values():
        vague, least = c.cue <= VAGUE, 0 if c.holds and c.cue <= VAGUE else TEXTUAL
        if c.cue == HIDDEN or c.apart == CLEAR or not (vague or c.holds) or not words or words < least or outside > SHARE * words:
            continue
        key = (first, last, vague, c.holds)
        if key not in decided:
            own = [(b, n) for b, n in rows[first : last + 1] if any(m is c for m in b.marks)]
            inside = sum(n for b, n in own if not b.header and all(m is c or m.wraps or m.cue <= VAGUE and m.apart <= VAGUE for m in b.marks))
            decided[key] = inside > 0 and inside >= least and outside <= (SHARE * inside if vague else 0)
        c.wraps = decided[key]


def raw_end(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
    return end.end() if end else len(page)


def concealed_end(page: str, name: str, at: int, outside: Counter) -> int:
    """Where a concealed element ends: behind its own end tag, or before that of a block that was open around it."""
    depth, inside = 1, Counter()
    while tag := _TAG.search(page, at):
        at = tag.end()
        if tag[2] is None:
            continue
        found, closing = tag[2].lower(), bool(tag[1])
        if found == name:
            if closing:
                depth -= 1
            elif name == "button":
                return tag.start()  # a button in a button ends the first
            elif not tag[0].endswith("/>"):
                depth += 1
            if not depth:
                return at
        elif found in RAW and not closing:
            if not tag[0].endswith("/>"):
                at = raw_end(page, found, at)
        elif found in BLOCKS:
            if not closing:
                inside[found] += 1
            elif inside[found]:
                inside[found] -= 1
            elif outside[found]:
                return tag.start()
    return len(page)


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """(text, own features) of the blocks that hold text."""
    open_: list[Container] = []
    heading = item = ""
    linked, at, n = 0, 0, len(page)
    around: Counter = Counter()  # blocks open at this place
    out: list[Block] = []
    current: Block | None = None

    def start() -> Block:
        inside = any(c.name in ("article", "main") for c in open_)
        header = not inside and any(c.name == "header" for c in open_)
        return Block([c for c in open_ if c.cue or c.apart], header, inside, bool(heading), bool(item))

    def add(text: str) -> None:
        nonlocal current
        if not text.strip():
            if current is not None and text:
                current.parts.append(" ")
            return
        if current is None:
            current = start()
            out.append(current)
        if linked:
            current.linked += len(text.split())
        current.parts.append(text)

    while at < n:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name, closing = tag[2].lower(), bool(tag[1])
        if name in RAW and not closing:
            if not tag[0].endswith("/>"):
                at = raw_end(page, name, at)
            continue
        if name in CONCEALED:
            if not closing and not tag[0].endswith("/>"):
                at = concealed_end(page, name, at, around)
            continue
        if name in BLOCKS:
            around[name] = max(0, around[name] + (-1 if closing else 1))
        if name == "a":
            linked = 0 if closing else 1
        elif name == "br":
            add(" ")
        elif name in BLOCKS:
            current, linked = None, 0
            if name in ("h1", "article", "main") and not closing:
                for c in open_:
                    c.holds = True
            if re.fullmatch("h[1-6]", name):
                heading = "" if closing else name
            elif name in ("li", "dt", "dd"):
                item = "" if closing else name
            elif name in ("ul", "ol", "dl", "p", "div"):
                heading = ""
                item = "" if name != "p" else item
            if name in BOUNDS or name == "p" or name == "li":
                if closing:
                    for k in range(len(open_) - 1, -1, -1):
                        if open_[k].name == name:
                            del open_[k:]
                            break
                        if open_[k].name in ("article", "main", "body") and name in ("p", "li"):
                            break
                elif name in ("p", "li"):
                    if open_ and open_[-1].name == name:
                        open_.pop()
                    if cue := tells(tag[3]):
                        open_.append(Container(name, cue))
                elif not tag[0].endswith("/>"):
                    open_.append(Container(name, tells(tag[3])))
    texts = [(b, " ".join(html.unescape("".join(b.parts)).split())) for b in out]
    sized = [(b, text, len(text.split())) for b, text in texts if text]
    find_wrappers([(b, max(0, words - b.linked)) for b, _, words in sized])
    rows = []
    for b, text, words in sized:
        apart = b.header or any(c.apart and not c.wraps for c in b.marks)
        cue = any(c.cue and not c.wraps for c in b.marks)
        rows.append((text, [words, min(1.0, b.linked / words), apart, cue, b.article, b.heading, b.item]))
    return rows


def features(rows: list[tuple[str, list[float]]]) -> np.ndarray:
    """One row a block, columns as in ``FEATURES``."""
    own = np.array([f for _, f in rows], dtype=float).reshape(-1, 7)
    n = len(own)
    own[:, 0] = np.minimum(own[:, 0], MANY)
    ends, before, after = (np.zeros((n, 2)) for _ in range(3))
    before[1:], after[:-1] = own[:-1, :2], own[1:, :2]
    if n:
        ends[0, 0] = ends[-1, 1] = 1
    return np.hstack([own[:, 2:], own[:, :2], ends, before, after])


# Outlines of labelled pages.  Each line: opening tags, words, linked words, closing tags, main text or not.
_MENU = [("<nav><ul><li><a>", 1, 1, "</a></li>", 0), ("<li><a>", 2, 2, "</a></li>", 0), ("<li><a>", 1, 1, "</a></li></ul></nav>", 0)]
_FLAT_MENU = [("<div><a>", 1, 1, "</a></div>", 0), ("<div><a>", 2, 2, "</a></div>", 0), ("<div><a>", 1, 1, "</a></div>", 0)]
_TEXT = [("<h1>", 7, 0, "</h1>", 1), ("<p>", 40, 0, "</p>", 1), ("<p>", 1, 0, "</p>", 1), ("<p>", 25, 4, "</p>", 1), ("<p>", 90, 0, "</p>", 1)]
_LIST = [("<h2>", 3, 0, "</h2>", 1), ("<p>", 12, 0, "</p>", 1), ("<ul><li>", 6, 0, "</li>", 1), ("<li>", 9, 1, "</li></ul>", 1), ("<blockquote>", 20, 0, "</blockquote>", 1)]
_SHORT = [("<h1>", 4, 0, "</h1>", 1), ("<p>", 2, 0, "</p>", 1)]
_AD = [('<div class="ad">', 9, 0, "</div>", 0)]
_LONG_AD = [('<div class="ad">', 45, 0, "</div>", 0)]
_NOTICE = [('<div class="cookie">', 24, 2, "</div>", 0)]
_SIDE = [("<aside><h3>", 2, 0, "</h3>", 0), ("<p>", 30, 0, "</p>", 0), ("<ul><li><a>", 5, 5, "</a></li></ul></aside>", 0)]
_SIDE_CLASS = [('<div class="sidebar"><h3>', 2, 0, "</h3>", 0), ("<p>", 60, 1, "</p></div>", 0)]
_FORM = [("<form><p>", 8, 0, "</p>", 0), ("<label>", 2, 0, "</label></form>", 0)]
_COMMENTS = [('<section class="comments"><h2>', 2, 0, "</h2>", 0), ("<p>", 30, 0, "</p>", 0), ("<p>", 70, 0, "</p></section>", 0)]
_HEAD = [("<header><h2>", 3, 0, "</h2>", 0), ("<p>", 8, 0, "</p></header>", 0)]
_FOOT = [("<footer>", 12, 0, "</footer>", 0)]
_LONG_FOOT = [("<footer><p>", 50, 4, "</p></footer>", 0)]
_FLAT_FOOT = [("<div>", 6, 3, "</div>", 0)]
_PLAIN_FOOT = [("<div>", 5, 0, "</div>", 0)]


def _within(tag: str, *groups: list) -> list:
    """The lines of all groups inside one element."""
    lines = [line for group in groups for line in group]
    (start, *first), (*last, end, label) = lines[0], lines[-1]
    if len(lines) == 1:
        return [(f"<{tag}>{start}", first[0], first[1], f"{end}</{tag}>", label)]
    return [(f"<{tag}>{start}", *first), *lines[1:-1], (*last, f"{end}</{tag}>", label)]


OUTLINES = (
    _MENU + _AD + _within("article", _TEXT) + _FOOT,
    _MENU + _within("article", _SHORT) + _FOOT,
    _within("article", _TEXT),
    _HEAD + _MENU + _within("main", _LIST) + _SIDE + _LONG_FOOT,
    _NOTICE + _MENU + _within("article", _TEXT) + _COMMENTS + _FOOT,
    _MENU + _FORM + _within("article", _TEXT, _LONG_AD, _LIST) + _SIDE_CLASS + _FOOT,
    _HEAD + _within("main", _within("article", _TEXT, _SIDE, _LIST), _COMMENTS) + _FOOT,
    _within("article", _HEAD[:0] + _SHORT, _NOTICE, _TEXT, _FORM, _COMMENTS) + _LONG_FOOT,
    _within("main", _within("article", _LIST, _AD, _LIST, _FOOT), _SIDE_CLASS, _MENU),
    _within("article", _TEXT, _SIDE_CLASS, _LONG_AD, _AD, _LONG_FOOT),
    _within("main", _SHORT, _COMMENTS, _FORM),
    _FLAT_MENU + _within("div", _TEXT) + _FLAT_FOOT,
    _FLAT_MENU + _TEXT + _PLAIN_FOOT,
    _FLAT_MENU + _within("div", _LIST) + _FLAT_FOOT,
    _within("div", _TEXT) + _COMMENTS,
    _TEXT + _SIDE_CLASS + _FLAT_FOOT,
    _HEAD + _LONG_AD + _within("article", _TEXT) + _FORM + _LONG_FOOT,
    _FLAT_MENU + _within("div", _TEXT) + _SIDE + _FLAT_FOOT,
    _HEAD + _MENU + _within("div", _SHORT, _TEXT) + _FOOT,
    _MENU + _TEXT + _AD + _FOOT,
    _within("main", _LIST),
    _within("div", _TEXT),
    _FLAT_MENU + _within("div", _TEXT),
    [("<p>", 60, 0, "</p>", 1)],
    _MENU + _within("article", _TEXT, _SHORT),
    _within("article", _TEXT, [("<p>", 8, 0, "</p>", 1)]),
    _MENU + _within("main", _TEXT, [("<p>", 3, 0, "</p>", 1)]),
    _within("article", _SHORT),
    _HEAD + _within("main", _LIST, _SHORT),
)
# Names of whole-page wrappers; every second one is kept out of growing (``HELD_OUT``) and only tested.
WRAPPERS = (
    'div class="content no-sidebar"', 'div class="layout-with-sidebar"', 'div class="post has-banner"', 'div class="article-form"', 'div class="main-content more"',
    'div class="wrapper reader"', 'div class="page-with-comments"', 'div id="more-news"', 'div class="post tags-open share"', 'form id="aspnetForm"',
    'div class="no-ads"', 'div id="page" class="menu-open"', 'div class="site has-cookie-notice"', 'div class="reader-view"', 'section class="story social"',
    'div class="hide-sidebar"', 'form class="page-form" id="mainForm"', 'div class="search-page"', 'div class="container login-on"', 'div id="readers"',
    'div class="legal"', 'div class="with-newsletter"', 'main class="post comments-closed"', 'div class="is-modal-open"', 'div class="discussion"',
    'div class="entry side-rail-off"', 'div class="app share"', 'div class="subscribe-ready content"', 'section id="notice"', 'div class="non-sponsored post"',
    'div class="sidebar-layout"', 'div class="feedback-story"',
)
OUTLINES += tuple(
    _within(name, *inside) + after
    for name, inside, after in zip(
        WRAPPERS[::2],
        ((_MENU, _TEXT), (_FLAT_MENU, _TEXT, _COMMENTS), (_HEAD, _TEXT, _SIDE), (_NOTICE, _TEXT), (_TEXT, _SIDE_CLASS, _FOOT), (_MENU, _LIST, _LIST, _AD)) * 3,
        ([], _FOOT, _PLAIN_FOOT) * 6,
    )
)
HELD_OUT = WRAPPERS[1::2]
SCALES = (0.4, 1, 2.5)  # every outline with shorter and longer blocks


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of the outlines."""
    x, y = [], []
    for scale in SCALES:
        for outline in OUTLINES:
            page = ""
            for start, words, linked, end, label in outline:
                n = words if linked == words else max(1, round(words * scale))
                page += start + ("w " * n if linked in (0, words) else "w " * max(1, n - linked) + "<a>" + "w " * linked + "</a>") + end
                y.append(label)
            x.append(features(blocks(f"<body>{page}</body>")))
    return np.vstack(x), np.array(y)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 3):
    """A binary decision tree by Gini impurity: (feature, threshold, low, high) or a share of main text."""
    if depth == 0 or y.min() == y.max():
        return float(y.mean())
    best = (np.inf, 0, 0.0)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, j] <= t
            if min(low.sum(), (~low).sum()) < least:
                continue
            score = sum(s.sum() * y[s].mean() * (1 - y[s].mean()) for s in (low, ~low))
            if score < best[0] - 1e-12:
                best = (score, j, float(t))
    if not np.isfinite(best[0]):
        return float(y.mean())
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


@lru_cache(maxsize=1)
def tree():
    return grow(*labelled_table())


def is_main(row: list[float], node) -> bool:
    while not isinstance(node, float):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node >= 0.5


def main_text(page: str) -> str:
    rows = blocks(page)
    model = tree()
    return "\n\n".join(text for (text, _), x in zip(rows, features(rows).tolist()) if is_main(x, model))


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """All columns but the page source, and the main text."""
    names = [c for c in pages.columns if c != html_col]
    if text_col in names:
        raise ValueError(f"the table has a column {text_col}; name another one")

    def run(batches):
        for batch in batches:
            source = text_array(batch.column(batch.schema.get_field_index(html_col)))
            out = pa.array([main_text(page) for page in source.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], out], [*names, text_col])

    fields = [f for f in pages.schema.fields if f.name != html_col]
    return pages.mapInArrow(run, StructType([*fields, StructField(text_col, StringType())]))


@query("op3_html")
def op3_html(spark, sf_dir):
    from pyspark.sql import functions as F

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
