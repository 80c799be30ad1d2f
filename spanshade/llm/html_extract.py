"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: block elements, and under them one leaf for each run of
text. Every node is content or not. Its own evidence (tag, names in class and
id, text length, links, punctuation) gives a unary potential, and each
parent-child edge a potential over the two labels. Sum-product messages go
from the leaves up and from the root down, which yields each node's exact
content marginal; the text leaves above one half are the main text. All pages
of a batch share the passes: one vector operation per tree depth.

The potentials are fitted by gradient ascent on the likelihood of labelled
pages (observed minus expected counts; the expectations come from the same
messages). Labelled pages are a bounded sample of the table's different pages (80, of a million
characters at most): pages that mark their article with ``<article>`` or ``<main>`` label themselves, and each is shown a
second time with that mark taken away, so that the model also learns pages
without it. Inside a marked article only structure (menus, asides, forms, footers, reader comments, hidden parts) labels
furniture; words in names are evidence, surer where the whole name says furniture. Made pages add common furniture (menus, side bars, notices, forms,
reader comments) around and inside their sentences. Tables of tag groups and
name words are fixed values.

Scoring is one pass without a shuffle; the model is a few hundred numbers.

Defined results: a null or empty page, or one without content, has the empty
text; scripts, styles, templates, comments and the head never have text; broken
markup is read leniently (unclosed tags end with their parent, a stray end tag
is ignored, a script or style without its end tag ends at the next block tag,
a template without its end tag hides nothing, and a head also ends where
something stands that only a body can have); the content of an iframe is no
markup of the page and has no text either, that of other embedded elements
(formulas, drawings, fallbacks) is judged like any; repeated rows get equal
results; an empty table gives an empty
result (without labelled pages the model is fitted on the furniture around
plain filler); other columns pass through, a column named like the output is
replaced.
"""

from __future__ import annotations

import bisect
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import received, sent, slices

# ---- fixed values: tag groups and words of class, id and role names --------
GROUPS = {
    "text": (), "article": ("article", "main"), "menu": ("nav", "menu"), "header": ("header", "hgroup"),
    "footer": ("footer",), "aside": ("aside", "dialog"),
    "form": ("form", "fieldset", "select", "option", "optgroup", "textarea", "button", "label", "legend", "datalist"),
    "section": ("section", "details", "summary"), "div": ("div", "center"), "p": ("p",),
    "heading": ("h1", "h2", "h3", "h4", "h5", "h6"), "item": ("li", "dt", "dd"), "list": ("ul", "ol", "dl"),
    "table": ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"),
    "quote": ("blockquote", "pre", "figure", "figcaption", "address"), "page": ("html", "body"), "hr": ("hr",),
}
GROUP_OF = {t: i for i, ts in enumerate(GROUPS.values()) for t in ts}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup: it runs to their own end tag, whatever stands before.
RAW = frozenset("script style title iframe textarea".split())
SILENT = frozenset("script style template title iframe".split())
#: What stands inside or beside these is apart from the words around.
APART = frozenset("br noscript svg text math mtr mtd object canvas audio video".split())
IN_HEAD = frozenset("base basefont bgsound html head link meta noframes noscript script style template title".split())
CLOSED_BY_SAME = frozenset("li dt dd tr td th option".split())
#: Words of names that hardly ever stand on content, those that may, and those that say nothing.
FURNITURE = re.compile(
    r"ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|copyright|discuss\w*|disqus|footer|gdpr|login|masthead|"
    r"menu|modal|nav\w*|newsletter|outbrain|pager|pagination|popup|popular|promo\w*|recommended|related|replies|respond|"
    r"rss|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|subscription|taboola|toolbar|topbar|trending|widgets?|"
    r"complementary|contentinfo|alertdialog", re.I)
DOUBTFUL = re.compile(
    r"alert|byline|contact|form|header|hidden|meta|notice|notification|reply|search|side|tags?|tools", re.I)
NEUTRAL = frozenset(
    "area bar block box bottom column container group holder inner item items left link links list main outer page panel "
    "right row section site title top wrap wrapper".split())
COMMENTS = re.compile(r"comments?|discuss\w*|disqus|replies|respond", re.I)
BODY = frozenset("article body content copy entry main page post story text prose richtext blog".split())

TAG_NAME = re.compile(r"[a-zA-Z][^\s/><]*")
SPECIAL = re.compile(r"[>\"']")
#: A number longer than this names no character.
LONG_NUMBER = re.compile(r"&#[0-9]{100,};?")
NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style|data-sample-label)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
#: Where a raw element without an end tag is left: a block tag that no quote precedes.
BLOCK = re.compile(r"(?<![\"'`\\])</?(?:head|" + "|".join(GROUP_OF) + r")(?=[\s/>])", re.I)
N_GROUPS = len(GROUPS)
N_FEATURES = N_GROUPS + 13
#: Elements that are none of the article they stand in.
ASIDE_GROUPS = frozenset(list(GROUPS).index(g) for g in ("menu", "footer", "aside", "form"))
FORM_TAGS = frozenset(GROUPS["form"])


class Page:
    """Nodes in page order (parents before children)."""

    __slots__ = ("parent", "group", "named", "text", "link")

    def __init__(self):
        self.parent, self.group, self.named, self.text, self.link = [], [], [], [], []

    def node(self, parent: int, group: int, named: int, text: str = "", link: int = 0) -> int:
        self.parent.append(parent)
        self.group.append(group)
        self.named.append(named)
        self.text.append(text)
        self.link.append(link)
        return len(self.parent) - 1


def _words_of(value: str) -> int:
    """What a class, id or role says: 1 furniture, 2 a body of text, 32 furniture in doubt, 64 reader comments."""
    out, doubt = 0, False
    for name in value.split():
        words = [w for w in re.split(r"[_-]+|(?<=[a-z])(?=[A-Z])", name) if w]
        sure = [w for w in words if FURNITURE.fullmatch(w)]
        rest = [w for w in words if not FURNITURE.fullmatch(w) and w.lower() not in NEUTRAL and not w.isdigit()]
        in_doubt = [w for w in rest if DOUBTFUL.fullmatch(w)]
        # a furniture word beside words of other meaning (cookies-recipe) proves nothing
        out |= 1 if sure and len(rest) == len(in_doubt) else 0
        doubt |= bool(sure or in_doubt)
        out |= 2 if any(w.lower() in BODY for w in words) else 0
        out |= 64 if any(COMMENTS.fullmatch(w) for w in sure) and len(rest) == len(in_doubt) else 0
    return out | (32 if doubt and not out & 1 else 0)


def _named(attrs: str) -> int:
    """``_words_of`` the names; 4: hidden; 8 and 16: labelled content, or not (training)."""
    out = 0
    for key, value in NAMES.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            out |= 4
        elif key == "style":
            out |= 4 if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) else 0
        elif key == "data-sample-label":
            out |= 8 if value == "1" else 16
        elif key in ("class", "id", "role"):
            out |= _words_of(value)
    return out


class Tags:
    """Where tags end. Each quote that a search for an end has gone through in vain is remembered, and so is the next
    quote or ``>``, so all searches together are linear in the page."""

    def __init__(self, source: str):
        self.source, self.vain = source, set()
        self.from_, self.at = 0, -1
        self.last = {c: source.rfind(c) for c in "\"'>"}

    def _special(self, at: int) -> int:
        if not (self.from_ <= at <= self.at):
            m = SPECIAL.search(self.source, at) if at <= max(self.last.values()) else None
            self.from_, self.at = at, m.start() if m else -1
        return self.at

    def end(self, at: int) -> int:
        """Behind the ``>`` that ends the tag whose attributes begin at ``at`` (-1: there is none).

        A ``>`` between quotes does not; a quote without a second one is an ordinary character.
        """
        seen = []
        while (s := self._special(at)) >= 0 and s not in self.vain:
            c = self.source[s]
            if c == ">":
                return s + 1
            seen.append(s)
            at = (self.source.find(c, s + 1) if s < self.last[c] else s) + 1
        self.vain.update(seen)
        return -1


def tokens(source: str, tags: Tags):
    """``(text, closing, tag, attributes, end)``: text, or a tag and where it ends. A place sent back is gone on from."""
    at, n = 0, len(source)
    while at < n:
        to, found = source.find("<", at), None
        if to != at:
            to = n if to < 0 else to
            found = (source[at:to], False, None, "", to)
        elif source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        else:
            closing = source.startswith("/", at + 1)
            m = TAG_NAME.match(source, at + 1 + closing)
            end = tags.end(m.end()) if m else -1
            if end >= 0:
                found = (None, closing, m[0].lower(), source[m.end():end - 1], end)
            elif source[at + 1:at + 2] in ("!", "?", "/") and at < tags.last[">"]:
                at = source.find(">", at) + 1
                continue
            else:
                found = ("<", False, None, "", at + 1)
        moved = yield found
        at = found[4] if moved is None else moved
        if moved is not None:
            yield None  # the answer to send


class Ends:
    """Where the elements of one page end whose content is not read as tags; each search is linear in the page."""

    def __init__(self, source: str, tags: Tags):
        self.source, self.tags, self.pairs, self.open = source, tags, {}, set()

    def raw(self, tag: str, at: int) -> tuple[int, int]:
        """The end of the content of a raw element that begins at ``at``, and of its end tag (-1: it has none)."""
        if tag not in self.open:
            m = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(self.source, at)
            if m:
                return m.start(), m.end()
            self.open.add(tag)
        m = BLOCK.search(self.source, at)
        return (m.start() if m else len(self.source)), -1

    def nested(self, tag: str, at: int) -> int:
        """Behind the end tag that belongs to the start tag that ends at ``at`` (-1: it has none)."""
        if tag not in self.pairs:
            pairs, begun = self.pairs.setdefault(tag, {}), []
            for m in re.finditer(rf"<(/?){tag}(?=[\s/>])", self.source, re.I):
                end = self.tags.end(m.end())
                if end < 0:
                    continue
                if not m[1]:
                    if self.source[end - 2] != "/":
                        begun.append(end)
                elif begun:
                    pairs[begun.pop()] = end
        return self.pairs[tag].get(at, -1)


class Open:
    """The open block elements, and for each tag the places where it is open."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("body", 0)]
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, node))

    def cut(self, upto: int) -> None:
        for tag, _ in self.stack[upto:]:
            self.places[tag].pop()
        del self.stack[upto:]

    def top(self, tags) -> int:
        """The highest place of any of the tags (0: none is open)."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def first_above(self, tags, place: int) -> int:
        """The lowest place of any of the tags above ``place`` (0: none)."""
        own = (self.places.get(t, []) for t in tags)
        return min((ps[k] for ps in own if (k := bisect.bisect_right(ps, place)) < len(ps)), default=0)


#: What an end tag cannot reach out of, and the end tags that can.
CELLS, REACH_OUT = ("td", "th", "table"), frozenset("table tr tbody thead tfoot article main div section".split())
#: What the start of an item cannot close from inside, and what the end of a paragraph cannot.
ITEM_BOUNDS = ("ul", "ol", "dl", "table", "select", "div", "article")
PARAGRAPH_BOUNDS = ("td", "th", "div", "article", "section", "li")
ITEM_PAIRS = {"dt": ("dt", "dd"), "dd": ("dd", "dt"), "td": ("td", "th"), "th": ("th", "td")}


def parse(source: str) -> Page:
    page = Page()
    page.node(-1, GROUP_OF["body"], 0)
    open_ = Open()
    inline: list[str] = []  # open links
    run: list[str] = []
    linked = 0

    def say(s: str):
        nonlocal linked
        if "&" in s:
            s = html.unescape(LONG_NUMBER.sub("\ufffd", s) if len(s) > 100 else s)
        run.append(s)
        if inline:
            linked += len(s)

    def flush():
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                page.node(open_.stack[-1][1], 0, 0, text, min(linked, len(text)))
            run.clear()
        linked = 0

    def close(upto: int):
        flush()
        open_.cut(upto)

    tags = Tags(source)
    ends = Ends(source, tags)
    head = False
    stream = tokens(source, tags)
    for text, closing, tag, attrs, end in stream:
        if tag is None:
            if not (head and text.isspace()):
                head = False
                say(text)
            continue
        if head:
            if tag not in IN_HEAD or closing and tag in ("head", "html"):
                head = False
            elif closing:
                continue
        if closing:
            if tag == "a":
                inline.clear()
            elif tag in APART:
                run.append(" ")
            elif tag in GROUP_OF:
                k = open_.top((tag,))
                if k and (tag in REACH_OUT or k >= open_.top(CELLS)):
                    close(k)
            continue
        if tag == "head":
            head = True
            continue
        if tag in SILENT or head and tag == "noscript":
            if not attrs.endswith("/"):
                behind = max(ends.raw(tag, end)) if tag in RAW else ends.nested(tag, end)
                if behind >= 0:
                    stream.send(behind)
            continue
        if tag in APART:
            run.append(" ")
        elif tag == "a":
            inline.append(tag)
        elif tag in ("html", "body"):
            flush()
            page.named[0] |= _named(attrs) & 28
        elif tag in GROUP_OF:
            flush()
            if tag == "tr":
                bound = open_.top(ITEM_BOUNDS)
                k = open_.top(("tr",))
                k = k if k > bound else open_.first_above(("td", "th"), bound)
                if k:
                    close(k)
            elif tag in CLOSED_BY_SAME:
                k = open_.top(ITEM_PAIRS.get(tag, (tag,)))
                if k > open_.top(ITEM_BOUNDS):
                    close(k)
            elif tag not in FORM_TAGS or tag == "form":
                k = open_.top(("p",))  # a block ends an open paragraph
                if k > open_.top(PARAGRAPH_BOUNDS):
                    close(k)
            me = page.node(open_.stack[-1][1], GROUP_OF[tag], _named(attrs) if attrs else 0)
            if tag not in VOID:
                open_.push(tag, me)
            if tag in RAW and ends.raw(tag, end)[1] >= 0:  # a text area: its text, and behind it
                to, behind = ends.raw(tag, end)
                say(source[end:to])
                close(len(open_.stack) - 1)
                stream.send(behind)
    flush()
    return page


class Forest:
    """The trees of many pages side by side, with node features and depths."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.parent) for p in pages]
        base = np.cumsum([0, *sizes])[:-1]
        self.page = np.repeat(np.arange(len(pages)), sizes)
        self.begin = base
        join = lambda f: np.array([x for p in pages for x in getattr(p, f)], np.int64)
        parent = join("parent")
        self.root = parent < 0
        self.parent = parent + base[self.page]
        self.parent[self.root] = -1
        self.group, named, link = join("group"), join("named"), join("link")
        texts = [t for p in pages for t in p.text]
        self.texts = texts
        n = len(texts)
        chars = np.array([len(t) for t in texts], np.float64)
        marks = np.array([t.count(".") + t.count(",") + t.count("!") + t.count("?") if t else 0 for t in texts], np.float64)
        words = np.array([t.count(" ") + 1 if t else 0 for t in texts], np.float64)
        depth = np.zeros(n, np.int64)
        for p, b in zip(pages, base):
            d = []
            for up in p.parent:
                d.append(0 if up < 0 else d[up] + 1)
            depth[b:b + len(d)] = d
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth, minlength=1))[:-1])
        self.place = np.empty(n, np.int64)  # of a node in its level
        for rows in self.levels:
            self.place[rows] = np.arange(len(rows))
        all_chars, all_link, all_marks, runs = chars.copy(), link.astype(float), marks.copy(), (chars > 0).astype(float)
        for d in range(len(self.levels) - 1, 0, -1):
            for x in (all_chars, all_link, all_marks, runs):
                self.add_up(d, x, x[self.levels[d]])
        whole = all_chars[base][self.page]
        x = np.zeros((n, N_FEATURES))
        x[np.arange(n), self.group] = 1
        k = N_GROUPS
        x[:, k] = 1
        x[:, k + 1], x[:, k + 2], x[:, k + 3] = (named & 1) > 0, (named & 2) > 0, (named & 4) > 0
        x[:, k + 4] = np.log1p(all_chars) / 8
        x[:, k + 5] = all_link / np.maximum(1, all_chars)
        x[:, k + 6] = np.minimum(1, 20 * all_marks / np.maximum(1, all_chars))
        x[:, k + 7] = all_chars / np.maximum(1, whole)
        x[:, k + 8] = np.log1p(all_chars / np.maximum(1, runs)) / 6
        x[:, k + 9] = words >= 12
        x[:, k + 10] = [t[-1:] in ".!?:" if t else 0 for t in texts]
        x[:, k + 11] = all_chars == 0
        x[:, k + 12] = (named & 32) > 0
        self.x = x

    def add_up(self, d: int, x: np.ndarray, values: np.ndarray) -> None:
        """Add what the nodes of level ``d`` hold to their parents' ``x``; the cost is that of the two levels."""
        above = self.levels[d - 1]
        x[above] += np.bincount(self.place[self.parent[self.levels[d]]], values, len(above))


class TreeModel:
    """Unary weights, and edge potentials by the child's tag group."""

    def __init__(self):
        self.w = np.zeros(N_FEATURES)
        self.edge = np.zeros((N_GROUPS, 2, 2))  # [child's group, parent's label, child's label]

    def messages(self, f: Forest):
        """Log beliefs of nodes (n, 2) and, per node, the upward message to its parent and the belief without it."""
        n = len(f.group)
        unary = np.zeros((n, 2))
        unary[:, 1] = f.x @ self.w
        inside, up = unary.copy(), np.zeros((n, 2))
        for d in range(len(f.levels) - 1, 0, -1):
            rows = f.levels[d]
            s = self.edge[f.group[rows]] + inside[rows, None, :]
            up[rows] = np.logaddexp(s[:, :, 0], s[:, :, 1])
            for k in (0, 1):
                f.add_up(d, inside[:, k], up[rows, k])
        belief, apart = inside.copy(), np.zeros((n, 2))
        for rows in f.levels[1:]:
            p = f.parent[rows]
            apart[rows] = belief[p] - up[rows]
            s = self.edge[f.group[rows]] + apart[rows][:, :, None]
            belief[rows] = inside[rows] + np.logaddexp(s[:, 0, :], s[:, 1, :])
        return inside, belief, apart

    def marginals(self, f: Forest) -> np.ndarray:
        _, belief, _ = self.messages(f)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))

    def fit(self, f: Forest, y: np.ndarray, rounds: int = 120, l2: float = 2e-4, rate: float = 0.1) -> None:
        n = len(y)
        inner = np.flatnonzero(~f.root)
        of = np.zeros((N_GROUPS, len(inner)))
        of[f.group[inner], np.arange(len(inner))] = 1 / n  # sums by the child's group
        seen_w = f.x.T @ y / n
        pair = np.zeros((len(inner), 4))
        pair[np.arange(len(inner)), 2 * y[f.parent[inner]] + y[inner]] = 1
        seen_e = (of @ pair).reshape(-1, 2, 2)
        theta = [self.w, self.edge]
        moment = [(np.zeros_like(t), np.zeros_like(t)) for t in theta]
        for t in range(1, rounds + 1):
            inside, belief, apart = self.messages(f)
            p = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
            pair = self.edge[f.group[inner]] + apart[inner][:, :, None] + inside[inner][:, None, :]
            pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            want_e = (of @ pair.reshape(-1, 4)).reshape(-1, 2, 2)
            for k, g in enumerate((seen_w - f.x.T @ p / n - l2 * self.w, seen_e - want_e - l2 * self.edge)):
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                theta[k] += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)


def extract(sources: list[str], model: TreeModel) -> list[str]:
    if not sources:
        return []
    f = Forest([parse(s) for s in sources])
    keep = model.marginals(f) > 0.5
    out: list[list[str]] = [[] for _ in sources]
    for i in np.flatnonzero(keep & (f.group == 0)).tolist():
        out[f.page[i]].append(f.texts[i])
    return ["\n".join(ts) for ts in out]


# ---- labelled pages -------------------------------------------------------
# Furniture of common pages; {t} is a short text, {s} a sentence.
AROUND = (
    '<header class="site-header"><a href="/">{t}</a><p>{s}</p></header>', '<header><h1>{t}</h1></header>',
    '<nav><ul><li><a href="/a">{t}</a></li><li><a href="/b">{t}</a></li><li><a href="/c">{t}</a></li></ul></nav>',
    '<div class="menu"><a href="/a">{t}</a> <a href="/b">{t}</a></div>', '<ul id="main-nav"><li><a href="/a">{t}</a></li></ul>',
    '<div class="breadcrumb"><a href="/">{t}</a> &gt; <a href="/x">{t}</a></div>',
    '<div class="cookie-notice"><p>{s}</p><button>{t}</button></div>', '<div id="consent" role="dialog"><p>{s}</p></div>',
    '<div class="ad">{s}</div>', '<div class="advert"><p>{s}</p></div>', '<div class="banner promo">{s}</div>',
    '<aside class="sidebar"><h2>{t}</h2><ul><li><a href="/r">{t}</a></li><li><a href="/q">{t}</a></li></ul></aside>',
    '<div class="sidebar"><h3>{t}</h3><p>{s}</p></div>', '<aside><p>{s}</p></aside>',
    '<div id="related"><h3>{t}</h3><a href="/r">{s}</a></div>',
    '<form action="/s"><label>{t}</label><input name="q"><button>{t}</button></form>',
    '<div class="newsletter"><form><p>{s}</p><input><button>{t}</button></form></div>',
    '<section id="comments"><h2>{t}</h2><div class="comment"><p>{s} {s}</p></div><div class="comment"><p>{s}</p></div></section>',
    '<div class="comments"><h3>{t}</h3><ol><li><p>{s} {s}</p></li><li><p>{s}</p></li></ol></div>',
    '<footer>&copy; {t} &middot; {s}</footer>', '<footer><p>{s}</p><a href="/p">{t}</a></footer>',
    '<div id="footer"><p>{s}</p></div>', '<div class="share"><a href="#">{t}</a><a href="#">{t}</a></div>',
    '<div hidden><p>{s}</p></div>', '<div class="notice"><p>{s}</p></div>', '<section class="subscribe"><p>{s}</p></section>',
)
WRAPS = (
    '<div class="content" data-sample-label="1">{b}</div>', '<div id="main"><div class="post-body" data-sample-label="1">{b}</div></div>', '<main data-sample-label="1">{b}</main>',
    '<article data-sample-label="1">{b}</article>', '<div><div data-sample-label="1">{b}</div></div>', '<section class="entry-content" data-sample-label="1">{b}</section>', '<div data-sample-label="1">{b}</div>',
    '<main><article data-sample-label="1">{b}</article></main>', '<td class="text" data-sample-label="1">{b}</td>',
)
INNER = (
    "<p>{s}</p>", "<p>{s} {s}</p>", "<h2>{t}</h2><p>{s}</p>", "<ul><li>{s}</li><li>{s}</li></ul>",
    "<blockquote><p>{s}</p></blockquote>", "<p>{s} <a href='/x'>{t}</a> {s}</p>", "<pre>{s}</pre>", "<h3>{t}</h3>",
    "<table><tr><td>{t}</td><td>{s}</td></tr></table>", "<p>{t}.</p>", "<div>{s}</div>", "<p><b>{s}<br><p>{s}</p>",
)
#: Content whose tag or name looks like furniture, and other less common content.
ODD_INNER = (
    "<address>{s}</address>", "<details><summary>{t}</summary><p>{s}</p></details>", "<header><h1>{t}</h1></header>",
    '<header><h2>{t}</h2><p>{s}</p></header>', '<div class="tools"><p>{s}</p><p>{s}</p></div>', '<div class="search"><p>{s}</p></div>',
    '<section id="search"><h2>{t}</h2><p>{s} {s}</p></section>', '<div class="cookies-recipe"><p>{s}</p></div>',
    '<section class="contact-lenses"><h2>{t}</h2><p>{s}</p></section>', '<div id="side-effects"><p>{s}</p><ul><li>{t}</li><li>{s}</li></ul></div>',
    '<p class="byline">{s}</p>', '<div class="meta"><p>{s}</p></div>', "<figure><img><figcaption>{s}</figcaption></figure>",
    "<dl><dt>{t}</dt><dd>{s}</dd><dt>{t}</dt><dd>{s}</dd></dl>", "<p>{t}</p>", "<h4>{t}</h4><p>{t}.</p>", '<div class="form"><p>{s}</p></div>',
)
FILLER = ("The river was low that year, and the boats stayed in the harbour. Nobody minded much. "
          "A letter came from the north in the spring; it asked for news of the children. "
          "They wrote back at once, and said that all was well, that the roof would hold another winter.")


def labelled(samples: list[str], seed: int = 11, made: int = 300) -> tuple[list[Page], list[np.ndarray]]:
    """Pages and the labels of their nodes: 1 for a labelled element and all below it, up to one labelled 0."""
    rng = np.random.RandomState(seed)
    pages, labels = [], []
    sentences = re.findall(r"[^.!?]+[.!?]", FILLER)
    for s in samples:
        for mark in ("article", "div"):
            p = parse(re.sub(r"(?i)(</?)(?:article|main)\b", lambda m: m[1] + mark + ("" if "/" in m[1] else ' data-sample-label="1"'), s))
            y = _labels(p)
            pages.append(p), labels.append(y)
        sentences += [t for t, k in zip(p.text, y) if k and t]
    pick = lambda: sentences[rng.randint(len(sentences))].strip()

    def fill(x: str) -> str:
        x = re.sub(r"\{s\}", lambda _: html.escape(pick()), x)
        return re.sub(r"\{t\}", lambda _: html.escape(" ".join(pick().split()[:rng.randint(1, 5)])), x)

    def none(x: str) -> str:
        return re.sub(r"^<(\w+)", r'<\1 data-sample-label="0"', x)

    for _ in range(made):
        inner = ["<h1>{t}</h1>"] * (rng.rand() < 0.7) + [INNER[k] for k in rng.randint(len(INNER), size=rng.randint(1, 9))]
        for _ in range(rng.randint(3) if rng.rand() < 0.6 else 0):
            inner.insert(rng.randint(len(inner) + 1), ODD_INNER[rng.randint(len(ODD_INNER))])
        if rng.rand() < 0.4:  # furniture inside the article
            inner.insert(rng.randint(len(inner) + 1), none(AROUND[rng.randint(6, len(AROUND))]))
        wrap = WRAPS[rng.randint(len(WRAPS))]
        before, after = ("".join(none(AROUND[k]) for k in rng.randint(len(AROUND), size=rng.randint(0, 4))) for _ in range(2))
        body = "<body data-sample-label='1'>" if wrap == "{b}" else "<body>"
        p = parse(fill(f"{body}{before}{wrap.replace('{b}', ''.join(inner))}{after}</body>"))
        pages.append(p), labels.append(_labels(p))
    return pages, labels


def _labels(p: Page) -> np.ndarray:
    """Below a labelled element all is content but what says by its structure that it is not: menus, asides, forms,
    footers, reader comments and hidden parts. Names are evidence, not labels."""
    y = np.zeros(len(p.parent), np.int64)
    for i, up in enumerate(p.parent):
        named = p.named[i]
        if named & 24:
            y[i] = named & 8 > 0
        elif up >= 0 and y[up]:
            y[i] = p.group[i] not in ASIDE_GROUPS and not named & 68
    return y


def train(pages: DataFrame, html_col: str = "html", sample: int = 80, page_chars: int = 1_000_000) -> TreeModel:
    """Fit on ``sample`` different pages of the table that mark their article (all, if it has fewer), and on made pages.

    That is the bound of the sample; longer pages than ``page_chars`` do not train, so it holds in bytes too.
    The pages with the smallest hashes are taken. Hashes go first; of the pages
    chosen, copies are dropped in two steps, so that no task gets all of a page's.
    """
    marked = pages.where(F.col(html_col).rlike("(?i)<(article|main)[ >]") & (F.length(html_col) <= page_chars)).select(
        F.xxhash64(html_col).alias("hash"), F.col(html_col).alias("h"))
    least = [r.hash for r in marked.select("hash").distinct().orderBy("hash").limit(sample).collect()]
    rows = marked.where(F.col("hash").isin(least)).withColumn("slot", F.spark_partition_id() % 256)
    for keys in (["hash", "slot"], ["hash"]):
        rows = rows.groupBy(*keys).agg(F.min("h").alias("h"))
    nodes, y = labelled(sorted(r.h for r in rows.collect()) if least else [])
    model = TreeModel()
    model.fit(Forest(nodes), np.concatenate(y))
    return model


SLICE_BYTES = 1_000_000


def main_text(pages: DataFrame, model: TreeModel, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each page."""
    pages = pages.select(*[c for c in pages.columns if c != out_col])
    held = sent(pages.sparkSession, model)
    at, names = pages.columns.index(html_col), [*pages.columns, out_col]

    def run(batches):
        model = received(held, TreeModel)
        for whole in batches:
            for b in slices(whole, at, SLICE_BYTES):
                texts = extract([h or "" for h in b.column(at).to_pylist()], model)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names)

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(out_col, T.StringType())]))
