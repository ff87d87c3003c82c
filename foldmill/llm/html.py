"""Main text of web pages: boosted trees over DOM nodes, decoded over the hierarchy.

A page becomes a tree of elements and text runs. Each node has features of its tag and attribute tokens, its ancestors, its
subtree (text, links, punctuation, blocks, density), its depth and its siblings. Boosted trees give each node log-odds of being main
text. Decoding picks for each element one of three states: outside (main text may begin below), main text, excluded. Below an excluded
element all is excluded, main text only contains main text and excluded parts, so ancestors and descendants never contradict each other; among all
consistent choices the one with the largest sum of log-odds is taken, in one pass up and one down the tree. Reading, features and decoding take time linear in
the page, whatever is nested or left unclosed.

Trees are fitted on at most ``SAMPLE`` pages of the table, the first in the order of a hash of page_id among those of at most ``SAMPLE_CHARS``, and on
layouts composed around their own paragraphs (``compose``), whose parts are known. Whole pages are extracted whatever their length.

Null or empty html gives an empty text. Character references are decoded, white space in a block (line breaks too) becomes one blank, blocks are
joined by one newline. Repeated rows give equal rows; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmill.llm import trees
from foldmill.llm.common import ready, slices, stored

SAMPLE = 150
SAMPLE_CHARS = 20_000
COMPOSED = 600

#: HTML's void elements, block-level elements, and the ones whose content is never shown as text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
HIDDEN = frozenset("script style noscript template head title svg math canvas iframe object audio video select textarea button datalist".split())
RAW = frozenset("script style textarea title".split())
#: An opening tag that ends open elements of these names.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
_STOPS = frozenset("article aside body div fieldset footer form header html main nav ol section table td ul blockquote".split())

TAGS = ("#text", "article", "main", "section", "div", "p", "h", "list", "li", "a", "nav", "footer", "header", "aside", "form", "table", "quote", "inline")
_TAG_OF = {
    **{t: t for t in TAGS}, **{f"h{i}": "h" for i in range(1, 7)}, **dict.fromkeys(("ul", "ol", "dl", "menu"), "list"), **dict.fromkeys(("li", "dt", "dd"), "li"), **dict.fromkeys(("form", "input", "label", "fieldset", "legend"), "form"),
    **dict.fromkeys(("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"), "table"), **dict.fromkeys(("blockquote", "pre", "code", "figure", "figcaption"), "quote"), "body": "div", "html": "div",
}
#: Parts of class, id and role names, by what they tell.
TOKENS = {
    "text": "article articlebody content entry main post story body text blog prose page",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs topbar",
    "ad": "ad ads adv advert adverts advertisement adsbygoogle banner promo sponsor sponsored adbox",
    "side": "sidebar side aside widget widgets rail complementary",
    "comment": "comment comments commentlist reply replies respond discussion disqus",
    "notice": "cookie cookies notice consent gdpr alert popup modal overlay warning disclaimer",
    "foot": "footer foot copyright colophon legal contentinfo",
    "head": "header head masthead logo branding",
    "more": "share social related recommended popular trending tags newsletter subscribe login signup search form meta byline",
}
_GROUP = {word: i for i, words in enumerate(TOKENS.values()) for word in words.split()}
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_MARKUP = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:"[^"]*+"|'[^']*+')?+)*+)>?|[^<]+|<""", re.S)


def attribute_groups(attributes: str) -> int:
    """Bit set of the token groups that an element's class, id, role and itemprop name."""
    found = 0
    for match in _NAMED.finditer(attributes):
        for word in _WORD.findall(match[1] or match[2] or match[3] or ""):
            group = _GROUP.get(word.lower())
            if group is not None:
                found |= 1 << group
    return found


class Page:
    """Nodes in page order: parent, depth, tag, attribute groups, and for text runs the text and its block's number. Node 0 is the page itself.

    Beside the stack of open elements the places of each name on it are kept, and those of the names that end a search. So an end tag, or an opening one
    that ends others, finds its element at once, and reading takes time linear in the page however deep or badly closed it is.
    """

    def __init__(self, source: str):
        self.parent, self.depth, self.tag, self.groups, self.text, self.block = [-1], [0], ["div"], [0], [None], [0]
        self._stack, self._names, self._places, self._stops, self._hidden = [0], [""], {}, [0], 0
        at, block = 0, 0
        match_at = _MARKUP.match
        while at < len(source):
            match = match_at(source, at)
            at = match.end()
            tag = match[2]
            if tag is None:
                if source[match.start()] == "<" and at - match.start() > 1:
                    continue
                if self._hidden == 0:
                    self._node("#text", 0, html.unescape(match[0]), block)
                continue
            tag = tag.lower()
            if tag in BLOCKS:
                block += 1
            if match[1]:
                i = self._highest((tag,))
                if i and (tag in _STOPS or tag == "head" or self._stops[-1] <= i):
                    self._cut(i)
                continue
            if tag == "br":
                if self._hidden == 0:
                    self._node("#text", 0, "\n", block)
                continue
            if tag in VOID:
                continue
            closes = ("p",) if tag in BLOCKS and tag not in _CLOSES else _CLOSES.get(tag, ())
            while (i := self._highest(closes)) and i >= self._stops[-1]:
                self._cut(i)
                if tag != "tr":
                    break
            if tag in RAW:
                end = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                at = end.start() if end else len(source)
                continue
            node = self._node(tag, attribute_groups(match[3]) if match[3] else 0, None, block)
            if not match[3].endswith("/") or tag in BLOCKS:
                self._places.setdefault(tag, []).append(len(self._stack))
                if tag in _STOPS:
                    self._stops.append(len(self._stack))
                self._stack.append(node)
                self._names.append(tag)
                self._hidden += tag in HIDDEN

    def _highest(self, names) -> int:
        """The place on the stack of the last open element of one of these names, 0 if there is none."""
        return max((places[-1] for places in map(self._places.get, names) if places), default=0)

    def _cut(self, i: int) -> None:
        """End the open elements from place ``i`` on."""
        for tag in self._names[i:]:
            self._places[tag].pop()
            self._hidden -= tag in HIDDEN
        while self._stops[-1] >= i:
            self._stops.pop()
        del self._stack[i:], self._names[i:]

    def _node(self, tag: str, groups: int, text: str | None, block: int) -> int:
        parent = self._stack[-1]
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tag.append(tag)
        self.groups.append(groups)
        self.text.append(text)
        self.block.append(block)
        return len(self.parent) - 1

    def main_text(self, kept) -> str:
        """The kept text runs as blocks."""
        blocks: dict[int, list[str]] = {}
        for node, text in enumerate(self.text):
            if text is not None and kept[node]:
                blocks.setdefault(self.block[node], []).append(text)
        return "\n".join(x for x in (" ".join("".join(parts).split()) for parts in blocks.values()) if x)


def _grid(x):
    """Numbers as multiples of 2^-20, whose sums are exact in any order."""
    return np.round(np.ldexp(x, 20)) / (1 << 20)


#: Each separate start of main text costs, so an article is taken whole rather than in pieces; passing a node by costs a little.
ENTER, BEGIN_BELOW = float(_grid(0.8)), float(_grid(0.05))
#: What it costs to leave a node out of main text; a paragraph or a piece of a sentence is rarely anything else than the text around it.
PRUNE, PRUNE_PIECE = 1.0, 4.0


class Forest:
    """The nodes of several pages as arrays, parents before their children: a subtree is the range from its root to ``end``."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.parent) for p in pages])
        self.first = np.cumsum(sizes) - sizes
        self.root = np.repeat(self.first, sizes)
        self.parent = np.concatenate([np.array(p.parent) for p in pages]) + self.root
        self.parent[self.first] = self.first
        tags = {t: i for i, t in enumerate(TAGS)}
        inline = tags["inline"]
        self.tag = np.array([tags.get(_TAG_OF.get(t, ""), inline) for p in pages for t in p.tag])
        self.groups = np.array([g for p in pages for g in p.groups])
        texts = [t or "" for p in pages for t in p.text]
        self.chars = np.array([len(t) - t.count(" ") - t.count("\n") for t in texts], float)
        self.words = np.array([len(t.split()) for t in texts], float)
        self.marks = np.array([t.count(".") + t.count(",") + t.count("?") + t.count("!") for t in texts], float)
        self.is_text = self.tag == 0
        self.depth = np.concatenate([np.array(p.depth) for p in pages])
        self.end = np.arange(len(self.parent)) + self._sizes()

    def _sizes(self) -> np.ndarray:
        size, parent = [1] * len(self.parent), self.parent.tolist()
        for i in range(len(size) - 1, -1, -1):
            if parent[i] != i:
                size[parent[i]] += size[i]
        return np.array(size)

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees; exact for whole numbers and for those of :func:`_grid`."""
        before = np.concatenate([[0.0], np.cumsum(values.astype(float))])
        return before[self.end] - before[:-1]

    def down(self, values: np.ndarray) -> np.ndarray:
        """Sums over proper ancestors: what began before, less what ended; exact as :meth:`up`."""
        ended = np.cumsum(np.bincount(self.end, values, minlength=len(values) + 1))[:-1]
        return np.cumsum(values.astype(float)) - values - ended

    def features(self) -> np.ndarray:
        n = len(self.parent)
        tag = np.zeros((n, len(TAGS)))
        tag[np.arange(n), self.tag] = 1
        groups = (self.groups[:, None] >> np.arange(len(TOKENS)) & 1).astype(float)
        link = self.chars * (self.down(tag[:, TAGS.index("a")]) > 0)
        nodes, chars, words, marks, links = (self.up(v) for v in (np.ones(n), self.chars, self.words, self.marks, link))
        paragraphs = self.up(tag[:, TAGS.index("p")])
        blocks = self.up(tag[:, [TAGS.index(t) for t in ("p", "li", "h", "div")]].sum(axis=1))
        runs = self.up(self.is_text & (self.chars > 0))
        top = self.root
        page = np.maximum(chars[top], 1)
        before = np.cumsum(self.chars) - self.chars
        begins = (before - before[top]) / page
        siblings = np.bincount(self.parent, minlength=n)[self.parent]
        place = np.arange(n)
        rank = np.zeros(n)
        order = np.lexsort((place, self.parent))
        new = np.r_[True, np.diff(self.parent[order]) != 0]
        rank[order] = np.arange(n) - np.flatnonzero(new)[np.cumsum(new) - 1]
        family = self.parent * len(TAGS) + self.tag
        alike = np.unique(family, return_inverse=True, return_counts=True)
        alike = alike[2][alike[1]] / np.maximum(siblings, 1)
        share = chars / np.maximum(chars[self.parent], 1)
        heading = tag[:, TAGS.index("h")]
        near_heading = np.bincount(self.parent, heading, minlength=n)[self.parent]
        columns = [
            np.log1p(chars), np.log1p(words), links / np.maximum(chars, 1), marks / np.maximum(words, 1), np.log1p(chars / nodes), np.log1p(words / np.maximum(runs, 1)), paragraphs, np.log1p(chars / np.maximum(blocks, 1)),
            self.depth, np.log1p(siblings), rank / np.maximum(siblings, 1), alike, share, chars / page, begins, begins + chars / page, near_heading, self.up(heading), np.log1p(page),
        ]
        told = [self.down(groups[:, g]) for g in range(groups.shape[1])]
        inside = [self.down(tag[:, TAGS.index(t)]) for t in ("article", "main", "nav", "footer", "header", "aside", "form", "a", "list", "table", "p")]
        below = [self.up(groups[:, g]) - groups[:, g] for g in range(groups.shape[1])]
        below += [self.up(tag[:, TAGS.index(t)]) for t in ("article", "main", "nav", "footer", "form")]
        return np.column_stack([*columns, tag, groups, *told, *inside, *below])

    def decode(self, odds: np.ndarray) -> np.ndarray:
        """Which nodes are main text, by the best consistent states."""
        return self.states(self.gains(odds)) == 1

    def gains(self, odds: np.ndarray) -> np.ndarray:
        """What each node adds as main text and costs as excluded: log-odds, weighted by text."""
        weight = np.where(self.is_text, np.log1p(self.chars) / 2, 0.25)
        gain = _grid(np.clip(odds, -6, 6) * weight)
        gain[self.is_text & (self.chars == 0)] = 0.0
        return gain

    def states(self, gain: np.ndarray) -> np.ndarray:
        """The best consistent states: 0 outside, 1 main text, 2 excluded."""
        best_free, best_within = self._choices(gain)
        state, parent = best_free.tolist(), self.parent.tolist()
        for i, within in enumerate(best_within.tolist()):
            if parent[i] != i and (above := state[parent[i]]):
                state[i] = within if above == 1 else 2
        return np.array(state)

    def _choices(self, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each node's best state below an outside parent and below one in main text, from the largest sums of its subtree."""
        excluded = -self.up(gain)
        cut = excluded - np.where(np.isin(self.tag, [TAGS.index(t) for t in ("inline", "p", "h", "a")]), PRUNE_PIECE, PRUNE)
        inside, outside = gain.tolist(), np.where(self.is_text, -np.inf, -BEGIN_BELOW).tolist()
        for i, (parent, text, gone, pruned) in enumerate(zip(self.parent[::-1].tolist(), self.is_text[::-1].tolist(), excluded[::-1].tolist(), cut[::-1].tolist())):
            i = len(inside) - 1 - i
            if parent != i:
                inside[parent] += inside[i] if text else max(inside[i], pruned)
                outside[parent] += max(inside[i] - ENTER, gone, outside[i])
        inside, outside = np.array(inside), np.array(outside)
        free = np.argmax(np.column_stack([outside, inside - ENTER, excluded]), axis=1)
        return free, np.where(self.is_text | (inside >= cut), 1, 2)


_IN, _OUT = "<!--in-->", "<!--out-->"
#: A private-use character, put before the text runs of main text while training pages are read.
_SIGN = "\ue000"
_FILL = "home about contact news login register more read search menu archive tags help terms privacy shop cart next previous top blog video photos sports travel".split()


def compose(rng: random.Random, paragraphs: list[str], short: list[str]) -> str:
    """A page of a random layout; main text is marked by an attribute ``data-main`` that the features don't see."""
    esc = html.escape
    say = lambda: esc(rng.choice(paragraphs))
    word = lambda: rng.choice(_FILL) if rng.random() < 0.5 else esc(rng.choice(short))
    named = lambda *names: rng.choice([f' class="{x}"' for x in names] + [f' id="{x}"' for x in names])
    links = lambda k: "".join(f'<li><a href="/{i}">{word()}</a></li>' for i in range(k))

    def wrap(names: list[str], inner: str, plain: tuple[str, ...] = ("div", "section")) -> str:
        tag = rng.choice(plain)
        return f"<{tag}{named(*names)}>{inner}</{tag}>"

    def menu() -> str:
        inner = f"<ul>{links(rng.randint(3, 9))}</ul>" if rng.random() < 0.8 else " | ".join(f"<a href='/'>{word()}</a>" for _ in range(6))
        return f"<nav>{inner}</nav>" if rng.random() < 0.6 else wrap(["menu", "nav", "navbar", "main-menu", "breadcrumbs"], inner, ("div", "ul"))

    def header() -> str:
        inner = f"<a href='/'>{word()}</a>" + (f"<p>{word()} {word()}</p>" if rng.random() < 0.5 else "") + (menu() if rng.random() < 0.4 else "")
        return f"<header>{inner}</header>" if rng.random() < 0.6 else wrap(["header", "masthead", "site-header", "top-header"], inner)

    def footer() -> str:
        inner = f"&copy; {word()} &middot; " + (say() if rng.random() < 0.7 else word())
        return f"<footer>{inner}</footer>" if rng.random() < 0.6 else wrap(["footer", "site-footer", "copyright"], inner)

    def advert() -> str:
        return wrap(["ad", "ads", "advert", "promo", "sponsored", "ad-banner", "advertisement"], say() if rng.random() < 0.6 else f"<a href='/x'>{word()}</a> {word()}", ("div", "aside", "ins"))

    def side() -> str:
        inner = f"<h3>{word()}</h3><ul>{links(4)}</ul>" + (f"<p>{say()}</p>" if rng.random() < 0.5 else "")
        return f"<aside>{inner}</aside>" if rng.random() < 0.5 else wrap(["sidebar", "widget", "side-bar", "right-sidebar"], inner)

    def notice() -> str:
        return wrap(["cookie-notice", "cookies", "notice", "consent", "gdpr-banner", "alert"], (f"<p>{say()}</p>" if rng.random() < 0.6 else say()) + "<button>OK</button>")

    def comments() -> str:
        one = lambda: f"<{t}{named('comment', 'comment-body', 'reply')}><b>{word()}</b><p>{say()}</p></{t}>"
        t = rng.choice(["div", "li", "article"])
        return wrap(["comments", "comment-list", "comments-area", "discussion", "user-comments"], f"<h3>{word()}</h3>" + "".join(one() for _ in range(rng.randint(1, 6))), ("div", "section", "ol"))

    def form() -> str:
        inner = f"<label>{word()}</label><input name='q'><p>{say() if rng.random() < 0.5 else word()}</p><button>{word()}</button>"
        return f"<form>{inner}</form>" if rng.random() < 0.7 else wrap(["newsletter", "login", "subscribe"], inner)

    def more() -> str:
        return wrap(["related", "share", "social", "recommended", "popular"], f"<h4>{word()}</h4><ul>{links(4)}</ul>" if rng.random() < 0.6 else f"{word()} {word()}")

    def paragraph() -> str:
        x, kind = say(), rng.random()
        if kind < 0.1:
            return f"<p><b>{x}<br>"
        if kind < 0.2:
            a, _, b = x.partition(" ")
            return f"<p><a href='/w'>{a}</a> <em>{b}</em></p>"
        if kind < 0.27:
            return f"<blockquote><p>{x}</p></blockquote>"
        if kind < 0.34:
            return "<ul>" + "".join(f"<li>{say() if rng.random() < 0.4 else word()}</li>" for _ in range(rng.randint(2, 4))) + "</ul>"
        if kind < 0.39:
            return f"<h2>{word()} {word()}</h2>"
        if kind < 0.43:
            return f"<div>{x}</div>"
        if kind < 0.46:
            return f"<table><tr><td>{word()}</td><td>{x}</td></tr></table>"
        return f"<p>{x}</p>" if rng.random() < 0.8 else f"<p>{x}"

    parts = [paragraph() for _ in range(rng.randint(1, 10))]
    if rng.random() < 0.8:
        parts.insert(0, f"<h1>{esc(rng.choice(paragraphs)[:60])}</h1>")
    for extra in (advert, more, form, comments, side, notice):
        if rng.random() < 0.1:
            parts.insert(rng.randint(0, len(parts)), "<!--out-->" + extra() + "<!--in-->")
    body = "".join(parts)
    tag = rng.choice(["article", "article", "article", "main", "div", "div", "section"])
    kind = rng.random()
    attributes = named("content", "post", "entry-content", "article-body", "main-content", "story", "post-body") if kind < (0.35 if tag in ("article", "main") else 0.85) else ""
    body = f"<{tag}{attributes}><!--in-->{body}<!--out--></{tag}>"
    if rng.random() < 0.3:
        body = f"<main>{body}</main>" if rng.random() < 0.5 else f"<div{named('container', 'wrapper', 'page')}>{body}</div>"
    bare = rng.random()
    if bare < 0.06:  # no layout at all
        return f"{_IN}{''.join(parts[: rng.randint(1, 3)])}{_OUT}"
    if bare < 0.1:
        return f"<body>{_IN}<span>{say()}</span>{_OUT}"
    if bare < 0.16:
        body = f"{_IN}{''.join(parts)}{_OUT}"
    first = [f() for f in (header, menu, notice, advert, side, form) if rng.random() < 0.4]
    last = [f() for f in (comments, more, side, advert, form, notice, footer, footer) if rng.random() < 0.4]
    rng.shuffle(first)
    return f"<html><head><title>{word()}</title></head><body>{''.join(first)}{body}{''.join(last)}</body></html>"




def known_parts(source: str) -> tuple[Page, np.ndarray]:
    """A composed page and which of its text runs are main text: runs between the marks, found by a sign put around them."""
    pieces = re.split(f"({_IN}|{_OUT})", source)
    depth_in, out = False, []
    for piece in pieces:
        if piece in (_IN, _OUT):
            depth_in = piece == _IN
        else:
            out.append(re.sub(r">([^<]+)(?=<|$)", f">{_SIGN}\\1", piece) if depth_in else piece)
    page = Page("".join(out))
    main = np.array([t is not None and _SIGN in t for t in page.text])
    page.text = [None if t is None else t.replace(_SIGN, "") for t in page.text]
    return page, main


def marked_article(source: str) -> str | None:
    """A page of the table with marks in its article, if it has one article."""
    marked = re.sub(r"(<article\b[^>]*>)(.*?)(</article>)", rf"\1{_IN}\2{_OUT}\3", source, flags=re.S | re.I)
    return re.sub(r"<!--(?!in-->|out-->).*?-->", "", marked, flags=re.S) if marked.count(_IN) == 1 else None


def training_page(i: int, sources: list[str], said: list[str], short: list[str], seed: int = 5) -> tuple[Page, np.ndarray] | None:
    """The i-th training page: first the pages of the table that mark their article, then composed ones around their paragraphs."""
    source = marked_article(sources[i]) if i < len(sources) else compose(random.Random(seed * 1_000_003 + i), said, short)
    return None if source is None else known_parts(source)


def training_rows(pages: list[tuple[Page, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of nodes that are clearly in or out: at least nine tenths of their text."""
    forest = Forest([p for p, _ in pages])
    main = np.concatenate([m for _, m in pages])
    total, inside = forest.up(forest.chars), forest.up(forest.chars * main)
    share = inside / np.maximum(total, 1)
    clear = (total > 0) & ((share <= 0.1) | (share >= 0.9))
    return forest.features()[clear], (share[clear] >= 0.9).astype(int)


def fitted(pages: DataFrame) -> trees.Boosted:
    """Boosted trees from the bounded sample of ``pages``."""
    usable = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).where(F.col("page_id").isNotNull() & (F.length("html") <= SAMPLE_CHARS))
    # ids first: what a task sends is then bounded by SAMPLE numbers rather than SAMPLE pages
    ids = [r["page_id"] for r in usable.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE).collect()]
    rows = usable.where(F.col("page_id").isin(ids)).groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id").collect()  # a row for each id
    if not rows:
        return trees.Boosted()
    sources = [r["html"] for r in rows]
    said = [html.unescape(x) for source in sources for x in re.findall(r"<p[^>]*>([^<]{20,600})", source)]
    said = said or [" ".join(_FILL), "Read more about this. It is what it was, and more."]
    short = [" ".join(p.split()[:2]) for p in said[:2000]]
    spark = ready(pages.sparkSession)
    shared = spark.sparkContext.broadcast((sources, said, short))  # SAMPLE * SAMPLE_CHARS characters at most

    def run(batches):
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for at in range(0, len(numbers), 25):
                found = [training_page(i, *shared.value) for i in numbers[at : at + 25]]
                if found := [x for x in found if x is not None]:
                    x, y = training_rows(found)
                    ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel())), pa.array(y, pa.int32())], names=["features", "label"])

    made = spark.range(0, len(sources) + COMPOSED, 1, 6).mapInArrow(run, "features array<double>, label int")
    return trees.fit(stored(made, "nodes").coalesce(2), rounds=16, depth=4)


def extracted(pages: DataFrame, model: trees.Boosted) -> DataFrame:
    """page_id, url, text of all pages."""

    def run(batches):
        for batch in batches:
            texts: list[str] = []
            sources = [x or "" for x in batch.column(2).to_pylist()]
            for a, b in slices([len(x) for x in sources], 1_000_000):
                found = [Page(x) for x in sources[a:b]]
                forest = Forest(found)
                kept = forest.decode(2 * model.margins(forest.features()))
                texts += [page.main_text(kept[at : at + len(page.parent)]) for page, at in zip(found, forest.first.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    ready(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string")


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    return extracted(pages, fitted(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
