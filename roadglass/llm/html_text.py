"""Main text of web pages by the maximum-scoring contiguous region.

A page becomes a sequence of runs of words and of tags. A word scores by where
it stands: the innermost block element and whether in a link (its place), and
the names that the elements around it have (classes, ids, roles). Tags cost
something. All these weights are log odds counted on labelled pages, those of
whose words an ``article`` or ``main`` element holds half or more: first of the
names, then of the places and tags over what the names leave. The page's own
mark is one more feature: on a page marked so a word gets up to ``MARKED`` more
inside that element and as much less outside, by the share of words it holds. One
linear scan (Kadane) finds the region with the highest sum, and its words are
the text.

A region is contiguous, but adverts and comments also stand in the middle of
texts. So what an element's names weigh ``DROPPED`` or less scores nothing and
is left out, inside the region as well. Names that no labelled page has shown
have a weight to begin with: that of the fixed list below for names of menus,
adverts, comments and the like, else 0. Labels can't raise those of the list,
since adverts inside an article are labelled as text. Fixed, by element, is what
never is text: scripts, styles, navigation, headers, footers, asides, forms, and
what a page hides. Headings and paragraphs are never weighed by name.

Inside a block white space becomes one space; blocks are joined by one space;
character references are decoded.

Results by case: a null, empty or markup-only page has an empty text; broken
markup is read to its end, a tag cut off by the end of the page is dropped;
without labelled pages the default weights hold; page texts of any length and
any depth of nesting are read whole, in linear time; of regions with equal sums
the one that ends first counts; repeated rows give repeated results; an empty
table gives none; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<([!?][^>]*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>"[^"]*"|'[^']*'|[^>])*+)(?:>|\Z)|([^<]+|<)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ALONE = frozenset("li dt dd tr td th option".split())  # one ends where the next of its kind starts
MAIN = frozenset(("article", "main"))
#: Elements, roles and parts of class names that hold no main text.
SKIPPED = frozenset("head nav footer aside form menu button select svg canvas object template dialog audio video map datalist".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar tablist form".split())
SKIPPED_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer masthead topbar "
    "cookie cookies consent gdpr notice notices notification banner popup modal overlay newsletter subscribe subscription signup login paywall comment comments commentlist disqus reply replies respond "
    "share sharing social related recommended recommendations pagination pager widget widgets toc toolbar skip disclaimer "
    "alert alerts announcement copyright search searchform aside rail sidenav adslot adbox adunit discussion".split()
)
#: Those that also name parts of a text, and don't make a container by themselves.
UNSURE_PARTS = frozenset("discussion notice notices alert alerts announcement search menu copyright disclaimer skip social rail respond recommended recommendation recommendations".split())
#: What else the whole name of a container may have.
CONTAINER_PARTS = frozenset("area bar block box button buttons container content desktop footer form global google group header icons inner item items left link links list mobile outer page panel post posts right section site slot story stories thread top bottom unit wrap wrapper".split())
#: Ids of one part that aren't made from headings; others need two parts or more.
SKIPPED_IDS = frozenset("adbox adslot adunit adsense ads breadcrumb breadcrumbs disqus footer masthead nav navbar pager paywall searchform sidebar sidenav topbar".split())
#: Elements that no class or id leaves out.
NAMED_FREELY = frozenset("p h1 h2 h3 h4 h5 h6".split())
SKIPPED_ARTICLES = frozenset("comment comments reply replies ad ads advert advertisement sponsored promo related teaser".split())
#: Whole class names of page headers; "article-header" and the like hold titles.
SKIPPED_CLASSES = frozenset("header site-header page-header main-header global-header top-header".split())
#: What may stand before a part in a class name without making it one ("no-sidebar").
MODIFIERS = frozenset("has with without no not is show hide hidden js".split())
#: Most that standing inside the marked main part adds, or outside it takes; the words' own weights reach further.
MARKED = 2.0
#: Weights without labelled pages: of a word by place, and of a tag.
DEFAULT_WORDS = {"p": 2.0, "h1": 2.0, "h2": 1.5, "h3": 1.5, "blockquote": 1.5, "pre": 1.5, "td": 0.5, "div": 0.5, "section": 0.5, "li": 0.5}
DEFAULT_WORD, DEFAULT_LINK, DEFAULT_TAG = 0.3, -2.0, -0.4
#: Of a name in the list, and of one of which only a part is.
LISTED, DOUBTED = -3.0, -2.5
#: An element whose names weigh this or less is left out.
DROPPED = -2.75
#: Bounds of the log odds of words and tags.
WORD_RANGE, TAG_RANGE = (-3.0, 3.0), (-0.6, -0.05)
#: Observations that a default weighs as much as, and pages that must show a name before it counts.
PRIOR, LEAST_PAGES = 50, 5
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _container(parts: list[str]) -> bool:
    """Whether the parts are the whole name of a container without main text."""
    return all(p in SKIPPED_PARTS or p in CONTAINER_PARTS for p in parts) and any(p in SKIPPED_PARTS and p not in UNSURE_PARTS for p in parts)


def _listed(kind: str, word: str, tag: str, inside: bool) -> float:
    """Weight of a name before any is learned; ``inside`` a marked main part."""
    if kind == "role":
        return LISTED if word.lower() in SKIPPED_ROLES else 0.0
    if tag in MAIN:
        return LISTED if kind == "class" and word.lower() in SKIPPED_ARTICLES else 0.0
    if kind == "class" and word.lower() in SKIPPED_CLASSES and not inside:
        return LISTED
    parts = [p.lower() for p in PART.findall(word)]
    if not parts or parts[0] in MODIFIERS:
        return 0.0
    if kind == "id":
        return LISTED if tag != "section" and (_container(parts) if len(parts) > 1 else parts[0] in SKIPPED_IDS) else 0.0
    if _container(parts):
        return LISTED
    return DOUBTED if not inside and tag not in INLINE and any(p in SKIPPED_PARTS for p in parts) else 0.0


def _named(tag: str, attributes: str, inside: bool) -> tuple[bool, list[tuple[str, float]]]:
    """Whether an element is left out whatever the weights, and its names with their listed weights."""
    if tag in SKIPPED or tag == "header" and not inside:
        return True, []
    names: list[tuple[str, float]] = []
    if not attributes or tag in ("html", "body"):
        return False, names
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true" or kind == "style" and HIDDEN.search(value):
            return True, []
        if kind == "role" or kind in ("class", "id") and tag not in NAMED_FREELY:
            names += [(f"{kind}={word.lower()}", _listed(kind, word, tag, inside)) for word in value.split()]
    return False, names


class _Open:
    """An open element: its tag, and what holds for the words inside it."""

    __slots__ = ("tag", "gone", "marked", "block", "block_at", "link", "low", "high", "names", "words")

    def __init__(self, tag: str, up: _Open | None, at: int):
        self.tag, self.names, self.words = tag, (), [0, 0]
        self.gone, self.marked, self.link, self.low, self.high = (up.gone, up.marked, up.link, up.low, up.high) if up else (False, False, False, 0.0, 0.0)
        self.block, self.block_at = (tag, at) if tag not in INLINE else (up.block, up.block_at) if up else ("body", -1)


def units(page: str, words: dict[str, float], tally: Counter | None = None) -> list[tuple[str, str, str, float, bool]]:
    """(kind, text or tag, place, weight of the names, marked) in page order, without what is left out.

    Kinds: ``w`` words, ``t`` a tag. ``words`` are weights of names. With a
    ``tally`` no name leaves anything out, and the words under each name are counted in it, by mark.
    """
    out: list = []
    stack: list[_Open] = []
    count: Counter = Counter()  # open elements by tag

    def close(to: int) -> None:
        while len(stack) > to:
            e = stack.pop()
            count[e.tag] -= 1
            if tally is not None:
                for name in e.names:
                    for inside in (False, True):
                        tally["n", name, inside] += e.words[inside]
                if stack:
                    stack[-1].words[0] += e.words[0]
                    stack[-1].words[1] += e.words[1]

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        tag, top = m[3], stack[-1] if stack else None
        if m[5] is not None:
            if top is None:
                out.append(("w", m[5], "body", 0.0, False))
            elif not top.gone:
                out.append(("w", m[5], place(top.block, top.link), top.low if top.low < 0 else top.high, top.marked))
                if tally is not None:
                    top.words[top.marked] += len(m[5].split())
            continue
        if tag is None:
            continue  # a comment or declaration
        tag, gone = tag.lower(), top is not None and top.gone
        if m[2]:
            if tag not in VOID and count[tag]:
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
        else:
            if top is not None and top.block_at >= 0 and (tag in CLOSES_P and top.block == "p" or tag in ALONE and top.block == tag):
                close(top.block_at)
                top = stack[-1] if stack else None
                gone = top is not None and top.gone
            here = _Open(tag, top, len(stack))
            left_out, names = _named(tag, m[4], here.marked)
            if tally is None:
                for name, listed in names:
                    weight = listed if listed <= DROPPED else words.get(name, listed)
                    here.low, here.high = min(here.low, weight), max(here.high, weight)
                left_out |= here.low <= DROPPED
            here.names = tuple({name for name, _ in names})
            here.gone = gone or left_out
            if tag in RAW:
                closing = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = closing.end() if closing else end
            elif tag not in VOID and not m[4].endswith("/"):
                if tag in MAIN and not here.gone:
                    here.marked = True
                if here.marked and here.low == DOUBTED:
                    here.low = 0.0
                here.link |= tag == "a"
                stack.append(here)
                count[tag] += 1
        if not gone:
            out.append(("t", tag, "", 0.0, top is not None and top.marked))
    close(0)
    return out


def place(block: str, link: bool) -> str:
    return f"{block}:a" if link else block


def default_word(where: str) -> float:
    return DEFAULT_LINK if where.endswith(":a") else DEFAULT_WORDS.get(where, DEFAULT_WORD)


def marked_share(found: list[tuple[str, str, str, float, bool]]) -> float:
    """Share of the words that the marked part holds."""
    n = Counter()
    for kind, text, _, _, marked in found:
        if kind == "w":
            n[marked] += len(text.split())
    return n[True] / max(1, n.total())


def count_names(page: str) -> Counter:
    """(``n``, name, inside the marked part) -> words, for a page of whose words such a part holds half or more; else nothing."""
    tally: Counter = Counter()
    return tally if marked_share(units(page, {}, tally)) >= 0.5 else Counter()


def count_places(page: str, names: dict[str, float] | None = None) -> Counter:
    """(``w``, place, inside) -> words and (``t``, tag, inside) -> tags, for the same pages, without what names leave out."""
    found = units(page, names or {})
    if marked_share(found) < 0.5:
        return Counter()
    out: Counter = Counter()
    for kind, text, where, _, marked in found:
        if kind == "w":
            out["w", where, marked] += len(text.split())
        else:
            out["t", text, marked] += 1
    return out


def _counted(sample: DataFrame, html_col: str, count: Callable[[str], Counter], least_pages: int) -> dict[tuple[str, str], list[int]]:
    """(what, item) -> [number outside, inside] over the sample, of items on ``least_pages`` pages or more."""

    def make():
        def work(rows):
            total: Counter = Counter()
            pages: Counter = Counter()
            for page in rows[html_col]:
                found = count(page)
                total.update(found)
                pages.update({k[:2] for k in found})
            keys = sorted({k[:2] for k in total})
            return {"what": [k[0] for k in keys], "item": [k[1] for k in keys], "outside": [total[(*k, False)] for k in keys], "inside": [total[(*k, True)] for k in keys], "pages": [pages[k] for k in keys]}

        return work

    counted = common.map_texts(sample, [html_col], "what string, item string, outside long, inside long, pages long", make)
    rows = counted.groupBy("what", "item").agg(*[F.sum(c).alias(c) for c in ("outside", "inside", "pages")]).where(F.col("pages") >= least_pages)
    return {(r["what"], r["item"]): [r["outside"], r["inside"]] for r in rows.collect()}


def _odds(outside: int, inside: int, default: float, span: tuple[float, float]) -> float:
    odds = min(span[1], max(span[0], math.log((inside + 1) / (outside + 1))))
    return (odds * (inside + outside) + default * PRIOR) / (inside + outside + PRIOR)


def fit_weights(df: DataFrame, pages: int = 4000, html_col: str = "html", id_col: str = "page_id") -> tuple[dict[str, float], dict[str, float]]:
    """Weights of places and names, and of tags, from about ``pages`` labelled pages, chosen by a hash of the id.

    The driver gets the counts of what these pages show on LEAST_PAGES of them or more. A page is labelled if it has an article or main element.
    """
    labelled = df.where(F.col(html_col).rlike(r"(?i)<(article|main)[\s>]"))
    share = min(1.0, pages / max(1, labelled.count()))
    sample = labelled.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / (1 << 30) < share)
    words = {item: _odds(*n, 0.0, WORD_RANGE) for (_, item), n in _counted(sample, html_col, count_names, LEAST_PAGES).items() if sum(n)}
    tags = {}
    for (what, item), n in _counted(sample, html_col, lambda page: count_places(page, words), LEAST_PAGES).items():
        if what == "w":
            words[item] = _odds(*n, default_word(item), WORD_RANGE)
        else:
            tags[item] = _odds(*n, DEFAULT_TAG, TAG_RANGE)
    return words, tags


def main_text(page: str | None, words: dict[str, float], tags: dict[str, float]) -> str:
    """Text of the best region."""
    found = units(page or "", words)
    mark = MARKED * max(0.0, 2 * marked_share(found) - 1)
    best = total = 0.0
    start, span = 0, (0, 0)
    for i, (kind, text, where, names, marked) in enumerate(found):
        if kind == "w":
            total += (words.get(where, default_word(where)) + names + (mark if marked else -mark)) * len(text.split())
        else:
            total += tags.get(text, DEFAULT_TAG)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, span = total, (start, i + 1)
    pieces = [html.unescape(text) if kind == "w" else "" if text in INLINE else " " for kind, text, _, _, _ in found[slice(*span)]]
    return " ".join("".join(pieces).split())


def extract(df: DataFrame, weights: tuple[dict[str, float], dict[str, float]] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    words, tags = fit_weights(df, html_col=html_col, id_col=id_col) if weights is None else weights

    def make():
        def work(rows):
            texts = [main_text(p, words, tags) for p in rows[html_col]]
            return {"page_id": rows[id_col], "url": rows[url_col], "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    return common.map_texts(df, [id_col, url_col, html_col], "page_id long, url string, text string, n_chars long", make)
