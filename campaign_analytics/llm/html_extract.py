"""Main text of web pages: boosted trees over DOM nodes, decoded so that ancestors and descendants agree."""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Trees, boost
from .common import shared_object
from .words import text_bytes

SAMPLE_PAGES = 300  # pages that give their texts for training
TRAINING_PAGES = 450  # layouts made from them
PAGES_AT_ONCE = 200
CHARS_AT_ONCE = 2_000_000

# Elements of HTML by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "template", "textarea", "title", "iframe", "select"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr"}, "tbody": {"thead", "tr"},
}
BARRIER = {"table", "ul", "ol", "dl", "body", "article", "section", "div", "aside", "nav", "main", "form", "blockquote"}
TAGS = [
    {"article"}, {"main"}, {"section"}, {"div"}, {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}, {"ul", "ol", "dl"},
    {"li", "dt", "dd"}, {"table", "tbody", "thead", "tr", "td", "th"}, {"nav"}, {"header"}, {"footer"}, {"aside"},
    {"form", "fieldset", "button"}, {"blockquote", "pre", "figure", "figcaption"}, {"body", "html"}, {"#text"}, {"head", "dialog"},
]
FAMILIES = [
    re.compile(p)
    for p in (
        r"^(nav|navbar|navigation|menu|menubar|breadcrumbs?|crumbs|toc|pager|pagination|tabs?)$",
        r"^(header|masthead|topbar|top|head|logo|branding|banner)$",
        r"^(footer|foot|bottom|copyright|legal|colophon|imprint)$",
        r"^(side|sidebar|aside|rail|widgets?|column|right|left|secondary|complementary)$",
        r"^(ads?|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|adsense|dfp)$",
        r"^(cookie|cookies|consent|gdpr|notice|alert|warning|popup|modal|overlay|toast|dialog|message|subscribe|paywall)$",
        r"^(form|newsletter|signup|login|search|contact|register|subscription|email|input)$",
        r"^(share|sharing|social|related|recommended|more|popular|trending|follow|links|tags|tag|meta|author|byline)$",
        r"^(comment|comments|commentlist|respond|reply|replies|discussion|disqus|reader|responses)$",
        r"^(article|articlebody|content|post|entry|body|main|story|text|maincontent|page|prose|copy)$",
    )
]
HOLDERS = ["nav", "header", "footer", "aside", "form", "article", "main"]

START = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
PLAIN = re.compile(r"[^>\"']*>")
EDGE = re.compile(r"[>\"']")
ATTRIBUTES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPACE = re.compile(r"\s+")


class Tags:
    """The tags of a page one after another: where each begins and ends, its name and what stands in it.

    A tag ends at the first ``>`` outside quotes. One that never does, as a quote is not closed or the page ends, is
    text. Where a search for an end has failed before, it is not made again, so that a page of nothing but broken
    tags takes as long as any other of its length.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ">\"'"}
        self.dead: set[int] = set()  # places outside quotes from which no end is reached

    def _end(self, at: int) -> int:
        plain = PLAIN.match(self.html, at) if at <= self.last[">"] else None
        if plain:
            return plain.end()
        passed = []
        while at <= self.last[">"] and at not in self.dead:
            passed.append(at)
            edge = EDGE.search(self.html, at)
            if edge[0] == ">":
                return edge.end()
            if edge.end() > self.last[edge[0]]:
                break
            at = self.html.index(edge[0], edge.end()) + 1
        self.dead.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name (empty for comments and declarations), whether it closes, and the attributes' text."""
        while at <= self.last[">"]:
            found = START.search(self.html, at)
            if found is None:
                return None
            if found[1]:
                end = self.html.find("-->", found.end())
                return found.start(), end + 3 if end >= 0 else len(self.html), "", False, ""
            if found[2]:
                end = self.html.find(">", found.end())
                return (found.start(), end + 1, "", False, "") if end >= 0 else None
            end = self._end(found.end())
            if end >= 0:
                return found.start(), end, found[4].lower(), bool(found[3]), self.html[found.end() : end - 1]
            at = found.start() + 1
        open_comment = self.html.find("<!--", at)
        return None if open_comment < 0 else (open_comment, len(self.html), "", False, "")


class Open:
    """The open elements, with the places of each name, so that the nearest of some names is found at once."""

    def __init__(self, root: int):
        self.nodes, self.names = [root], ["#root"]
        self.places: dict[str, list[int]] = {}

    def push(self, node: int, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.nodes))
        self.nodes.append(node)
        self.names.append(name)

    def cut(self, depth: int) -> None:
        for name in self.names[depth:]:
            self.places[name].pop()
        del self.nodes[depth:], self.names[depth:]

    def nearest(self, names: set[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def inside(self, wanted: set[str], stop: set[str]) -> int:
        """Depth of the nearest open element of these names, 0 where there is none or a barrier stands before it."""
        depth = self.nearest(wanted)
        return depth if depth and depth >= self.nearest(stop) else 0


class Page:
    """Elements and text blocks of a page in page order; a node's parent comes before it."""

    def __init__(self) -> None:
        self.tag, self.parent, self.words_of = [], [], []
        self.text: list[str] = []
        self.linked: list[int] = []
        self.inputs: list[int] = []
        self.depth: list[int] = []

    def add(self, tag: str, parent: int, tokens: list[str], text: str = "", linked: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.words_of.append(tokens)
        self.text.append(text)
        self.linked.append(linked)
        self.inputs.append(0)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        return len(self.tag) - 1


def _tokens(attributes: str) -> list[str]:
    """Lower-case parts of class, id and role."""
    return [t for value in ATTRIBUTES.findall(attributes) for t in re.findall(r"[a-z]+", "".join(value).lower())]


def parse(html: str) -> Page:
    """A page's blocks. Markup errors are mended the way browsers do in common cases; nothing is dropped but the
    content of elements that hold no text of the page, ``RAW``."""
    page = Page()
    stack = Open(page.add("#root", -1, []))
    tags = Tags(html)
    pieces: list[str] = []
    links = 0
    linked = 0
    closers: dict[str, re.Pattern] = {}
    without_end: set[str] = set()

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", entities.unescape("".join(pieces))).strip()
        pieces.clear()
        if text:
            page.add("#text", stack.nodes[-1], [], text, min(linked, len(text)))
        linked = 0

    def leave(depth: int) -> None:
        nonlocal links
        flush()
        stack.cut(depth)
        links = 0

    at = 0
    size = len(html)
    while at < size:
        tag = tags.next(at)
        if tag is None:
            pieces.append(html[at:])
            break
        start, end, name, closing, attributes = tag
        if start > at:
            pieces.append(html[at:start])
            if links:
                linked += start - at
        at = end
        if not name:
            continue
        if closing:
            if name == "a":
                links = max(0, links - 1)
            if name in INLINE:
                continue
            d = stack.nearest({name})
            if d:
                leave(d)
            elif name == "p":
                flush()
            continue
        if name in RAW:
            closer = closers.setdefault(name, re.compile(rf"</{re.escape(name)}\s*>", re.I))
            found = None if name in without_end else closer.search(html, at)
            if found is None:
                without_end.add(name)
            at = found.end() if found else size
            pieces.append(" ")
            continue
        if name == "a":
            links += 1
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
            continue
        if name in ("input", "button"):
            page.inputs[stack.nodes[-1]] += 1
        if name in VOID:
            if name == "hr":
                flush()
            continue
        d = stack.inside({"p"}, {"table", "button"})
        if d:
            leave(d)
        else:
            flush()
        if name in CLOSES:
            d = stack.inside(CLOSES[name], BARRIER)
            if d:
                leave(d)
        stack.push(page.add(name, stack.nodes[-1], _tokens(attributes)), name)
        links = 0
    flush()
    return page


def _family_flags(tokens: list[str]) -> int:
    flags = 0
    for token in tokens:
        for i, family in enumerate(FAMILIES):
            if family.match(token):
                flags |= 1 << i
    return flags


HOLDER_FLAG = {t: 1 << i for i, t in enumerate(HOLDERS)}
_FLAGS: dict[tuple[str, ...], int] = {}
TAG_GROUP = {t: i for i, group in enumerate(TAGS) for t in group}


class Nodes:
    """The nodes of several pages in one set of arrays; ``levels`` lists them by depth, so that what is inherited
    or summed goes level by level."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.tag) for p in pages])
        self.first = np.cumsum(sizes) - sizes
        self.root = np.repeat(self.first, sizes)
        parent = np.concatenate([p.parent for p in pages])
        self.parent = np.where(parent < 0, 0, parent) + self.root
        depth = np.concatenate([p.depth for p in pages])
        order = np.argsort(depth, kind="stable")
        self.depth = depth.astype(np.float64)
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def _own_flags(page: Page) -> list[int]:
    out = []
    for tokens in page.words_of:
        key = tuple(tokens)
        if key not in _FLAGS:
            if len(_FLAGS) > 50_000:
                _FLAGS.clear()
            _FLAGS[key] = _family_flags(tokens)
        out.append(_FLAGS[key])
    return out


def features(pages: list[Page], nodes: Nodes) -> np.ndarray:
    """One row per node: its kind and names, those of its ancestors, its subtree, place and siblings."""
    up = nodes.parent
    tags = [t for p in pages for t in p.tag]
    n = len(tags)
    group = np.array([TAG_GROUP.get(t, len(TAGS)) for t in tags])
    own = np.array([f for p in pages for f in _own_flags(p)])
    holder = np.array([HOLDER_FLAG.get(t, 0) for t in tags])
    texts = [t for p in pages for t in p.text]
    length = np.array([len(t) for t in texts], np.float64)
    linked = np.concatenate([p.linked for p in pages]).astype(np.float64)
    stops = np.array([t.count(".") + t.count(",") if t else 0 for t in texts], np.float64)
    inputs = np.concatenate([p.inputs for p in pages]).astype(np.float64)
    running = np.cumsum(length) - length
    begin = running - running[nodes.root]
    is_text = group == TAG_GROUP["#text"]
    sums = np.stack([length, linked, stops, is_text, group == TAG_GROUP["p"], group == TAG_GROUP["li"], inputs], 1).astype(np.float64)
    longest = length.copy()
    inherited, inside = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for level in nodes.levels[1:]:
        inherited[level] = inherited[up[level]] | own[up[level]]
        inside[level] = inside[up[level]] | holder[up[level]]
    for level in nodes.levels[:0:-1]:
        np.add.at(sums, up[level], sums[level])
        np.maximum.at(longest, up[level], longest[level])
    siblings = np.bincount(up, minlength=n).astype(np.float64)
    chars = sums[:, 0]
    all_chars = np.maximum(chars[nodes.root], 1)
    before = np.r_[0, group[:-1]]
    before[nodes.first] = 0
    columns = [
        group,
        np.log1p(chars), np.log1p(longest), sums[:, 1] / np.maximum(chars, 1), sums[:, 2] / np.maximum(chars, 1),
        np.log1p(sums[:, 3]), chars / np.maximum(sums[:, 3], 1), np.log1p(sums[:, 4]), np.log1p(sums[:, 5]), sums[:, 6],
        nodes.depth, begin / all_chars, chars / all_chars, chars / np.maximum(chars[up], 1), siblings[up],
        (chars[up] - chars) / np.maximum(siblings[up] - 1, 1), group[up], before,
    ]
    flags = [group == g for g in range(len(TAGS))]
    flags += [(own >> i) & 1 for i in range(len(FAMILIES))]
    flags += [(inherited >> i) & 1 for i in range(len(FAMILIES))]
    flags += [(inside >> i) & 1 for i in range(len(HOLDERS))]
    return np.stack(columns + flags, 1).astype(np.float64)


def decode(nodes: Nodes, odds: np.ndarray) -> np.ndarray:
    """The likeliest labels in which every node below a dropped one is dropped too.

    Bottom up, the gain of keeping a node is its log-odds and the gains of its children where positive; it is kept
    if that is positive and its parent is kept.
    """
    gain = odds.astype(np.float64).copy()
    for level in nodes.levels[:0:-1]:
        np.add.at(gain, nodes.parent[level], np.maximum(gain[level], 0))
    keep = np.zeros(len(odds), bool)
    keep[nodes.first] = True
    for level in nodes.levels[1:]:
        keep[level] = keep[nodes.parent[level]] & (gain[level] > 0)
    return keep


def main_texts(pages: list[str], trees: Trees) -> list[str]:
    parsed = [parse(h) for h in pages]
    nodes = Nodes(parsed)
    keep = decode(nodes, trees.log_odds(features(parsed, nodes)))
    out = []
    for page, first in zip(parsed, nodes.first, strict=True):
        out.append("\n".join(page.text[i] for i in np.flatnonzero(keep[first : first + len(page.tag)]) if page.text[i]))
    return out


def _layout(rng: random.Random, blocks: list[str], other: list[str]) -> tuple[str, set[str]]:
    """A page in a random layout around the given article, and the marks of its article blocks.

    Every block carries a mark (a private-use character and a number) that training takes off again.
    """
    wanted: set[str] = set()
    count = 0

    def say(text: str, article: bool = False) -> str:
        nonlocal count
        count += 1
        if article:
            wanted.add(str(count))
        return f"\ue000{count}\ue001{entities.escape(text, quote=False)}"

    def words(low: int, high: int) -> str:
        text = rng.choice(other).split()
        at = rng.randrange(max(1, len(text)))
        return " ".join(text[at : at + rng.randint(low, high)]) or "more"

    def links(n: int, low: int = 1, high: int = 3) -> str:
        items = "".join(f'<li><a href="/x">{say(words(low, high))}</a></li>' for _ in range(n))
        return f"<ul>{items}</ul>"

    def box(names: list[str], body: str, tags: tuple[str, ...] = ("div", "div", "section")) -> str:
        tag, name = rng.choice(tags), rng.choice(names)
        how = rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name} c{rng.randint(1, 9)}"', f' class="{name}-wrap"'])
        return f"<{tag}{how}>{body}</{tag}>"

    nav = lambda: rng.choice([f"<nav>{links(rng.randint(3, 8))}</nav>", box(["menu", "nav", "navbar", "breadcrumb", "main-menu"], links(rng.randint(3, 9)))])
    header = lambda: rng.choice([f"<header>{rng.choice(['', '<h1>' + say(words(1, 4)) + '</h1>'])}<p>{say(words(2, 8))}</p></header>", box(["header", "masthead", "top-bar"], f"<p>{say(words(2, 8))}</p>" + nav())])
    footer = lambda: rng.choice([f"<footer>{say('© ' + words(3, 25))}</footer>", f"<footer><p>{say(words(3, 30))}</p>{links(3)}</footer>", box(["footer", "copyright", "legal", "site-footer"], f"<p>{say(words(4, 30))}</p>")])
    advert = lambda: box(["ad", "ads", "advert", "sponsored", "promo", "ad-banner"], rng.choice([say(words(3, 30)), f"<p>{say(words(5, 40))}</p>", f'<a href="/b">{say(words(3, 12))}</a>']), ("div", "div", "aside", "section"))
    side = lambda: rng.choice([f"<aside>{'<h3>' + say(words(1, 4)) + '</h3>'}{links(rng.randint(2, 6), 2, 9)}<p>{say(words(5, 40))}</p></aside>", box(["sidebar", "side", "widget", "right-rail"], f"<h3>{say(words(1, 3))}</h3><p>{say(words(4, 40))}</p>" + links(rng.randint(2, 6), 2, 8))])
    notice = lambda: box(["cookie-notice", "notice", "consent", "alert", "gdpr", "banner-message", "popup"], f"<p>{say(words(5, 30))}</p><button>{say('ok')}</button>")
    form = lambda: rng.choice([f'<form action="/s"><label>{say(words(2, 9))}</label><input name="q"><button>{say("go")}</button></form>', box(["newsletter", "signup", "login"], f"<h4>{say(words(2, 6))}</h4><form><p>{say(words(3, 20))}</p><input><input type=submit></form>")])
    related = lambda: box(["related", "share", "social", "tags", "recommended", "more-links"], f"<h3>{say(words(1, 4))}</h3>" + links(rng.randint(2, 6), 1, 10), ("div", "section", "aside"))

    def comments() -> str:
        one = lambda: rng.choice([f'<div class="comment"><p>{say(words(5, 70))}</p></div>', f"<li><b>{say(words(1, 2))}</b><p>{say(words(5, 60))}</p></li>", f'<article class="comment"><p>{say(words(6, 60))}</p></article>'])
        body = f"<h3>{say(words(1, 3))}</h3>" + "".join(one() for _ in range(rng.randint(1, 8)))
        return box(["comments", "comment-list", "discussion", "respond", "reader-comments"], body, ("div", "section", "section", "ol"))

    style = rng.randrange(4)
    body = []
    if rng.random() < 0.8:
        body.append(f"<h1>{say(blocks[0][:60], True)}</h1>")
    for i, text in enumerate(blocks):
        r = rng.random()
        if style == 0 and i % 8 == 0:
            body.append(f"<p><b>{say(text, True)}<br>")
        elif style == 1:
            body.append(f"<div>{say(text, True)}</div>")
        elif r < 0.06:
            body.append(f"<h2>{say(words(2, 6), True)}</h2><p>{say(text, True)}</p>")
        elif r < 0.10:
            body.append("<ul>" + "".join(f"<li>{say(words(3, 25), True)}</li>" for _ in range(rng.randint(2, 6))) + f"</ul><p>{say(text, True)}</p>")
        elif r < 0.13:
            body.append(f"<blockquote><p>{say(text, True)}</p></blockquote>")
        elif r < 0.15:
            body.append(f"<table><tr><td>{say(words(1, 6), True)}</td><td>{say(words(1, 6), True)}</td></tr></table><p>{say(text, True)}</p>")
        else:
            body.append(f"<p>{say(text, True)}" + rng.choice(["</p>", "</p>", ""]))
        if rng.random() < 0.04:
            body.append(rng.choice([advert, related, form, side])())
    inner = "".join(body)
    tail = "".join(f() for f in (related, form, comments, advert) if rng.random() < 0.25)
    shape = rng.randrange(6)
    if shape <= 1:
        whole = f"<article>{inner}{tail if rng.random() < 0.4 else ''}</article>" + tail
    elif shape == 2:
        whole = f"<main>{inner}</main>" + tail
    elif shape == 3:
        whole = box(["content", "post", "entry-content", "article-body", "story", "main"], inner, ("div",)) + tail
    elif shape == 4:
        whole = f"<main><article><header>{body[0]}</header>{''.join(body[1:])}</article>{tail}</main>"
    else:
        whole = f"<div><div>{inner}</div></div>" + tail
    parts = [f() for f in (header, nav, advert, notice) if rng.random() < 0.45]
    rng.shuffle(parts)
    after = [f() for f in (side, related, comments, form, notice, advert) if rng.random() < 0.3]
    if rng.random() < 0.3:
        whole = box(["container", "wrapper", "page", "layout", "row"], (side() if rng.random() < 0.4 else "") + whole, ("div",))
    end = footer() if rng.random() < 0.85 else ""
    return "<html><body>" + "".join(parts) + whole + "".join(after) + end + rng.choice(["</body></html>", ""]), wanted


MARK = re.compile("\ue000(\\d+)\ue001")


def training_set(articles: list[list[str]], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of random layouts; a node is kept if its subtree holds article text."""
    rng = random.Random(seed)
    other = [b for blocks in articles for b in blocks]
    x, y = [], []
    for k in range(TRAINING_PAGES):
        blocks = articles[k % len(articles)]
        if rng.random() < 0.35:  # short articles, which what surrounds them may outweigh
            blocks = [" ".join(blocks[0].split()[: rng.randint(3, 60)])]
        html, wanted = _layout(rng, blocks[:30], other)
        page = parse(html)
        label = np.zeros(len(page.tag))
        for i, text in enumerate(page.text):
            marks = MARK.findall(text)
            if marks:
                label[i] = float(marks[0] in wanted)
                page.text[i] = MARK.sub("", text)
                page.linked[i] = min(page.linked[i], len(page.text[i]))
        for i in range(len(page.tag) - 1, 0, -1):
            label[page.parent[i]] = max(label[page.parent[i]], label[i])
        x.append(features([page], Nodes([page])))
        y.append(label)
    return np.concatenate(x), np.concatenate(y)


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Trees | None:
    """Fit the trees on layouts made from the paragraphs of a bounded sample of pages, the first by hash.

    At most ``sample_pages`` pages reach the driver. Without labelled pages the labels come from construction: paragraphs of the sample are laid out anew with
    navigation, notices, adverts, forms, sidebars, comments and footers around them.
    """
    rows = pages.filter("html is not null").select("html", F.xxhash64("html").alias("h"))
    # The hashes alone find the last one of the sample; then only its pages are read, one of equal ones.
    hashes = [r.h for r in rows.select("h").orderBy("h").limit(sample_pages).collect()]
    chosen = rows.filter(F.col("h") <= (hashes[-1] if hashes else 0)).dropDuplicates(["h"])
    sample = [r.html for r in sorted(chosen.collect(), key=lambda r: r.h)]
    articles = []
    for html in sample:
        page = parse(html)
        blocks = [t for t, p in zip(page.text, page.parent, strict=True) if t and page.tag[p] in ("p", "article")]
        if blocks:
            articles.append(blocks)
    if not articles:
        articles = [["A short text stands here, so that something can be laid out.", "And another one."]]
    return boost(*training_set(articles))


def extract_main_text(pages: DataFrame, trees: Trees) -> DataFrame:
    """page_id, url and text of each row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block becomes one blank, blocks are joined by line
    breaks in page order. Scripts, styles, templates, frames, choices and text fields of forms and comments in the
    markup are no text; the trees judge everything else. A null or empty page, or one without article, has an empty
    text. Whole pages are read, however long, in time that goes with their length. Repeated rows
    are treated one by one; an empty table gives no rows; other columns are ignored.
    """
    load = shared_object(pages.sparkSession, trees)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema if f.name in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = load()
        for batch in batches:
            column = batch.column(2)
            _, offsets = text_bytes(column)
            row = 0
            while row < batch.num_rows:
                end = int(np.searchsorted(offsets, offsets[row] + CHARS_AT_ONCE, side="right")) - 1
                end = min(max(end, row + 1), row + PAGES_AT_ONCE, batch.num_rows)
                texts = main_texts(column.slice(row, end - row).fill_null("").to_pylist(), fitted)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )
                row = end

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
