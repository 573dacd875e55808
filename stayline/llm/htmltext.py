"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page becomes its blocks of text in order, each with the tags, classes and ids of its ancestors and a
few facts about its text. A two-state chain, content or not, is fitted on labelled pages by maximum
likelihood (forward-backward, AdaGrad) and decoded by Viterbi. The labelled pages are made here from
layouts in common use, with random words: the features never look at a word of the text.

A wrapper that holds ``WIDE`` of the page's text or more says little about a block in it: its classes often
name what the page has elsewhere (``has-sidebar``, ``comments-open``). Of such elements, and of ``PAGE_LEVEL``
ones, only classes of one word count, those of the latter apart for every tag; of others, every word of every class.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.store import small_batches

PAGES = 800
WIDE = 0.5
STEPS = 160

# HTML's elements without content, elements whose text is not text, and those that break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript head title svg math iframe object canvas".split())
RAW = frozenset("script style textarea title".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())  # all others close an open head
BREAKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
    "p": BREAKS - {"br", "button", "option", "optgroup", "select", "textarea"},
}
BOXES = frozenset("article aside body dialog div footer form header main menu nav ol section table ul".split())
WRAPPERS = frozenset(["html", "body", "main", "article", "div", "section"])
PAGE_LEVEL = frozenset(["html", "body", "main", "article"])
SCOPES = frozenset(["ul", "ol", "dl", "table", "select", "menu", "td", "th", "article", "section", "body", "div", "main", "aside"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+|[A-Z]+[a-z]*")


@dataclass
class Block:
    text: str
    features: list[str]


@dataclass(eq=False)
class _Element:
    tag: str
    above: _Element | None = None
    names: frozenset = frozenset()  # parts of its classes and ids
    plain: frozenset = frozenset()  # classes and ids of one part only
    silent: bool = False
    link: bool = False
    block_tag: str = "html"
    box: _Element | None = None  # the nearest box around
    chars: int = 0  # of text, first its own, in the end with all below
    wide: bool = False
    headed: bool = False  # has a main heading in it
    features: frozenset = frozenset()


@dataclass
class _Open:
    parts: list[str] = field(default_factory=list)
    at: _Element | None = None
    link_chars: int = 0


def blocks(page: str) -> list[Block]:
    """The blocks of a page with text, in order; white space in a block is one space."""
    root = _Element("html")
    stack, every, opened, now = [root], [root], [], _Open()

    def finish() -> None:
        nonlocal now
        if now.parts:
            text = " ".join("".join(now.parts).split())
            if text:
                now.at.chars += len(text)
                opened.append((text, now))
            now = _Open()

    def say(text: str) -> None:
        top = stack[-1]
        if top.silent or not text:
            return
        if now.at is None and not text.isspace():
            now.at = top
        now.parts.append(text)
        if top.link:
            now.link_chars += len(text)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        kind = m.lastgroup
        if kind == "text":
            raw = m["text"]
            if stack[-1].tag == "head" and not raw.isspace():
                stack.pop()
            say(entities.unescape(raw) if "&" in raw else raw)
            continue
        if kind == "cdata":
            say(m["cdata"])
            continue
        name = m["tag"] or m["tag2"]
        if not name:
            continue
        tag = name.lower()
        if tag in BREAKS:
            finish()
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        # The end tag of a head may be left out.
        if tag == "body" and any(e.tag == "head" for e in stack):
            del stack[[e.tag for e in stack].index("head") :]
        elif stack[-1].tag == "head" and tag not in IN_HEAD:
            stack.pop()
        for i in range(len(stack) - 1, 0, -1):
            if tag in CLOSED_BY.get(stack[i].tag, ()):
                del stack[i:]
                break
            if stack[i].tag in SCOPES:
                break
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in VOID or attrs.endswith("/") and tag not in BREAKS and tag not in RAW:
            continue
        top, names, plain = stack[-1], set(), set()
        if "=" in attrs:
            for a, b, c in _NAMED.findall(attrs):
                for name in (a or b or c).split():
                    parts = [p.lower() for p in _PARTS.findall(name)]
                    names.update(parts)
                    plain.update(parts if len(parts) == 1 else ())
        element = _Element(tag, top, frozenset(names), frozenset(plain), top.silent or tag in SILENT, top.link or tag == "a", tag if tag in BREAKS else top.block_tag)
        element.box = element if tag in BOXES else top.box
        every.append(element)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if not element.silent:
                stack.append(element)
                say(entities.unescape(page[at : close.start() if close else size]))
                finish()
                stack.pop()
            at = close.start() if close else size
            continue
        stack.append(element)
    finish()
    _set_features(every)
    return [Block(text, _facts(text, now)) for text, now in opened]


def _set_features(every: list[_Element]) -> None:
    """Tags and names of an element and of all above it; elements come after the ones they are in."""
    for element in reversed(every):
        if element.above:
            element.above.chars += element.chars
            element.above.headed |= element.headed or element.tag == "h1"
    whole = every[0].chars
    for element in every:
        tag, element.wide = element.tag, element.chars >= WIDE * whole
        element.wide = element.wide and tag in WRAPPERS
        own = {f"w:{tag}" if element.wide else f"t:{tag}"}
        if tag in PAGE_LEVEL:
            own.update(f"w:{tag}:{n}" for n in element.plain)
        else:
            own.update(f"c:{n}" for n in (element.plain if element.wide else element.names))
        above = element.above.features if element.above else frozenset()
        element.features = above if own <= above else above | own


def _box_facts(box: _Element | None) -> list[str]:
    if box is None:
        return []
    if box.tag in PAGE_LEVEL:
        return [f"n:{box.tag}:{box.wide}:{box.headed}", *(f"m:{box.tag}:{n}" for n in box.plain)]
    return [f"n:{box.tag}:{box.wide}:{box.headed}", *(f"m:{n}" for n in (box.plain if box.wide else box.names))]


def _facts(text: str, opened: _Open) -> list[str]:
    element = opened.at
    n_words = text.count(" ") + 1
    linked = opened.link_chars / max(1, len(text))
    facts = [
        *element.features,
        *_box_facts(element.box),
        f"b:{element.block_tag}",
        f"k:{min(5, n_words.bit_length())}",
        f"l:{0 if linked < 0.2 else 1 if linked < 0.6 else 2}",
        f"e:{text[-1] in '.!?…'}",
        f"s:{text[-1] in '.!?…' and n_words > 7 and linked < 0.6}",
    ]
    if "©" in text:
        facts.append("copyright")
    return facts


# --- labelled pages ---------------------------------------------------------------------------

CONTENT, OTHER = "\ue001", "\ue000"  # marks in front of every text that say what it is


class _Maker:
    """Pages of many layouts; every text carries its label as a first character."""

    def __init__(self, seed: int):
        self.draw = random.Random(seed)

    def words(self, low: int, high: int, sentence: bool = True) -> str:
        made = ["".join(self.draw.choices("abcdefghiklmnoprstuvw", k=self.draw.randint(2, 9))) for _ in range(self.draw.randint(low, high))]
        text = " ".join(made).capitalize()
        return text + self.draw.choice(("", ".", ".", ".", ".", "!", "?", "***", " |")) if sentence else text

    def named(self, *names: str) -> str:
        """A class or id out of the names, often with something around it, sometimes none."""
        if self.draw.random() < 0.12:
            return ""
        name = self.draw.choice(names)
        name = self.draw.choice((name, name, f"site-{name}", f"{name}-box", f"{name} wide", f"page_{name}"))
        return f' {self.draw.choice(("class", "class", "id"))}="{name}"'

    def states(self, *names: str) -> str:
        """Classes of a body, a wrapper or an article, which often name what the page has elsewhere."""
        d = self.draw
        things = ("sidebar", "comments", "comment", "menu", "nav", "header", "footer", "ads", "ad", "banner", "newsletter", "cookie", "popup", "search", "form", "widget", "related", "subscribe", "promo", "notice", "modal", "login")
        shapes = ("has-{}", "no-{}", "with-{}", "{}-open", "{}-closed", "{}-free", "{}-left", "{}-right", "{}-fixed", "{}-enabled", "right-{}", "content-{}-wrap", "is-{}-visible", "hide-{}")
        made = [d.choice(names)] if names and d.random() < 0.7 else []
        made += [d.choice(shapes).format(d.choice(things)) for _ in range(d.choice((0, 1, 1, 2, 3)))]
        made += [d.choice(("single", "single-post", "home", "post-template", "dark", "js", "hentry", "type-post", "status-publish", "category-news"))] if d.random() < 0.4 else []
        d.shuffle(made)
        return f' class="{" ".join(made)}"' if made else ""

    def links(self, n: int, mark: str = OTHER) -> str:
        items = [f'<a href="/{i}">{mark}{self.words(1, 3, False)}</a>' for i in range(n)]
        shape = self.draw.randrange(3)
        if shape == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | " if shape == 1 else " ").join(items)

    def menu(self) -> str:
        inner = self.links(self.draw.randint(3, 9))
        if self.draw.random() < 0.7:
            return f"<nav{self.named('nav', 'menu', 'navigation', 'navbar')}>{inner}</nav>"
        return f'<div class="{self.draw.choice(("nav", "menu", "navbar", "breadcrumbs", "topnav"))}">{inner}</div>'

    def header(self) -> str:
        inner = self.draw.choice(("h1", "div", "p", "span"))
        tag = "header" if self.draw.random() < 0.7 else "div"
        named = self.named("header", "masthead", "top", "banner", "logo") if tag == "header" else ' class="header"'
        return f"<{tag}{named}><{inner}>{OTHER}{self.words(1, 8, self.draw.random() < 0.4)}</{inner}>{self.menu() if self.draw.random() < 0.4 else ''}</{tag}>"

    def prose_box(self, tags: tuple[str, ...], names: tuple[str, ...], low: int = 2, high: int = 30, most: int = 3) -> str:
        tag, name = self.draw.choice(tags), self.draw.choice(names)
        inner = "".join(
            self.draw.choice((f"<p>{OTHER}{self.words(low, high)}</p>", f"{OTHER}{self.words(low, high)}<br>", f"<div>{OTHER}{self.words(low, high, False)}</div>"))
            for _ in range(self.draw.randint(1, most))
        )
        if tag == "p":  # ends at the first block in it
            inner = f"{OTHER}{self.words(low, high)}<br>{OTHER}{self.words(low, high)}"
        elif self.draw.random() < 0.3:
            inner = f"<h3>{OTHER}{self.words(1, 4, False)}</h3>" + inner
        return f'<{tag} {self.draw.choice(("class", "class", "id"))}="{name}">{inner}</{tag}>'

    def advert(self) -> str:
        return self.prose_box(("div", "div", "aside", "section", "p"), ("ad", "ads", "advert", "advertisement", "ad-slot", "sponsor", "sponsored", "promo", "banner", "adbox"))

    def notice(self) -> str:
        return self.prose_box(("div", "section", "aside"), ("cookie", "cookie-notice", "notice", "consent", "alert", "gdpr", "newsletter", "popup", "subscribe", "modal", "paywall", "disclaimer"))

    def sidebar(self) -> str:
        if self.draw.random() < 0.6:
            prose = "".join(f"<p>{OTHER}{self.words(3, 30)}</p>" for _ in range(self.draw.choice((1,) * 11 + (25,))))
            return f"<aside{self.named('sidebar', 'side', 'related', 'widget')}>{prose}{self.links(self.draw.randint(0, 5))}</aside>"
        return self.prose_box(("div", "section"), ("sidebar", "side", "widget", "related", "recommended", "more", "trending", "popular"), most=self.draw.choice((3,) * 11 + (25,)))

    def form(self) -> str:
        return (
            f"<form{self.named('search', 'login', 'signup')}><label>{OTHER}{self.words(1, 6, False)}</label><input name=q>"
            f"<p>{OTHER}{self.words(2, 20)}</p><select><option>{OTHER}{self.words(1, 1, False)}<option>{OTHER}{self.words(1, 2, False)}</select>"
            f"<button>{OTHER}{self.words(1, 2, False)}</button></form>"
        )

    def comments(self) -> str:
        tag, name = self.draw.choice(("section", "div", "ol", "ul", "div")), self.draw.choice(("comments", "comment-list", "reader-comments", "discussion", "replies", "responses", "comment"))
        item = "li" if tag in ("ol", "ul") else self.draw.choice(("div", "article", "p"))
        each = [f"<{item}{self.named('comment', 'reply')}>{'<p>' if item != 'p' else ''}{OTHER}{self.words(2, 60)}{'</p>' if item != 'p' else ''}</{item}>" for _ in range(self.draw.randint(1, self.draw.choice((5,) * 11 + (30,))))]
        heading = f"<h2>{OTHER}{self.words(1, 3, False)}</h2>" if self.draw.random() < 0.5 and tag in ("div", "section") else ""
        return f'<{tag} {self.draw.choice(("class", "id"))}="{name}">{heading}{"".join(each)}</{tag}>'

    def footer(self) -> str:
        words = OTHER + self.draw.choice(("&copy; ", "&copy; 2020 ", "")) + self.words(2, 16)
        if self.draw.random() < 0.75:
            return f"<footer{self.named('footer', 'bottom')}>{words}{self.links(self.draw.randint(0, 4))}</footer>"
        return f'<div {self.draw.choice(("class", "id"))}="{self.draw.choice(("footer", "bottom", "copyright", "legal"))}">{words}</div>'

    def paragraph(self) -> str:
        d, w = self.draw, self.words
        size = (1, 3) if d.random() < 0.12 else (4, 90)
        inline = f"{CONTENT}{w(*size)}" if d.random() < 0.7 else f"{CONTENT}{w(1, 12)} <a href='#'>{w(1, 3, False)}</a> <b>{w(1, 6)}</b> {w(*size)}"
        shape = d.random()
        if shape < 0.62:
            return f"<p>{inline}</p>" if d.random() < 0.8 else f"<p><b>{inline}<br>"
        if shape < 0.70:
            return f"<h{d.choice('234')}>{CONTENT}{w(1, 9, False)}</h2>"
        if shape < 0.78:
            tag = d.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(f"<li>{CONTENT}{w(1, 25)}</li>" for _ in range(d.randint(1, 5))) + f"</{tag}>"
        if shape < 0.84:
            return f"<blockquote>{inline}</blockquote>"
        if shape < 0.88:
            return f"<pre>{CONTENT}{w(3, 30)}</pre>"
        if shape < 0.92:
            return "<table>" + "".join(f"<tr><td>{CONTENT}{w(1, 3, False)}</td><td>{CONTENT}{w(1, 8, False)}</td></tr>" for _ in range(d.randint(1, 4))) + "</table>"
        if shape < 0.95:
            return f"<figure><img src=x><figcaption>{CONTENT}{w(2, 14)}</figcaption></figure>"
        return f"<div>{inline}</div>"

    def article(self) -> str:
        d = self.draw
        parts = [self.paragraph() for _ in range(d.randint(1, 14))]
        for _ in range(d.choice((0, 0, 0, 1, 2))):
            parts.insert(d.randint(0, len(parts)), d.choice((self.advert, self.notice, self.sidebar, self.form))())
        if d.random() < 0.2:
            parts.append(self.comments())
        body = "".join(parts)
        if d.random() < 0.75:
            head = f"<h1>{CONTENT}{self.words(1, 12, d.random() < 0.5)}</h1>"
            body = (f"<header>{head}</header>" if d.random() < 0.12 else head) + body
        tag = d.choice(("article", "article", "article", "main", "div", "div", "section"))
        named = self.named("content", "article", "post", "entry", "story", "main", "body", "text") if tag != "article" or d.random() < 0.4 else ""
        if d.random() < 0.35:
            named = self.states("content", "article", "post", "entry", "story", "main") if tag != "section" else named
        if d.random() < 0.04:
            return body  # right below the body or a wrapper
        body = f"<{tag}{named}>{body}</{tag}>"
        return f"<main{self.states() if d.random() < 0.5 else ''}>{body}</main>" if d.random() < 0.2 and tag != "main" else body

    def page(self) -> str:
        d = self.draw
        before = [m() for m in (self.notice, self.header, self.menu, self.advert, self.form, self.sidebar) if d.random() < 0.4]
        after = [m() for m in (self.comments, self.sidebar, self.advert, self.form, self.menu, self.notice) if d.random() < 0.35]
        d.shuffle(before)
        d.shuffle(after)
        body = "".join([*before, self.article(), *after, self.footer() if d.random() < 0.75 else ""])
        if d.random() < 0.4:
            outer = f' class="{d.choice(("wrapper", "container", "page", "layout"))}"' if d.random() < 0.5 else self.states("wrapper", "container", "page", "layout", "site")
            body = f"<div{outer}>{body}</div>"
        states = self.states() if d.random() < 0.5 else ""
        return f"<!DOCTYPE html><html{self.states() if d.random() < 0.2 else ''}><head><title>x</title><style>p{{}}</style></head><body{states}>{body}</body></html>"


def labelled_pages(count: int = PAGES, seed: int = 5) -> list[str]:
    maker = _Maker(seed)
    return [maker.page() for _ in range(count)]


def labelled_blocks(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a page whose texts carry marks; a block's first mark counts."""
    marks = [re.search(f"[{CONTENT}{OTHER}]", block.text) for block in blocks(page)]
    plain = blocks(re.sub(f"[{CONTENT}{OTHER}]", "", page))
    return [b.features for b in plain], [int(m[0] == CONTENT) for m in marks]


# --- the chain --------------------------------------------------------------------------------


@dataclass
class Chain:
    """Weights in favour of content by feature, and of each step between the states."""

    weights: dict[str, float]
    steps: np.ndarray  # [from, to], 0 other, 1 content
    first: np.ndarray  # [2]

    def decode(self, page_blocks: list[Block]) -> list[bool]:
        """The likeliest sequence of states (Viterbi)."""
        if not page_blocks:
            return []
        get = self.weights.get
        (oo, oc), (co, cc) = self.steps.tolist()
        other, content = self.first.tolist()
        back = []
        for i, block in enumerate(page_blocks):
            gain = sum(get(f, 0.0) for f in block.features)
            if i:
                from_o, from_c = content + co > other + oo, content + cc > other + oc
                back.append((from_o, from_c))
                other, content = (content + co if from_o else other + oo), (content + cc if from_c else other + oc)
            content += gain
        state, out = content > other, []
        for came in reversed(back):
            out.append(state)
            state = came[state]
        out.append(state)
        return out[::-1]


def fit(pages: list[str], steps: int = STEPS, penalty: float = 0.02) -> Chain:
    """Maximum likelihood of the labels by forward-backward over all pages at once."""
    sequences = [s for s in map(labelled_blocks, pages) if s[1]]
    index: dict[str, int] = {}
    longest, n = max(len(y) for _, y in sequences), len(sequences)
    ids, owner, labels, length = [], [], np.zeros((n, longest), dtype=int), np.array([len(y) for _, y in sequences])
    for p, (features, y) in enumerate(sequences):
        labels[p, : len(y)] = y
        for t, names in enumerate(features):
            for name in names:
                ids.append(index.setdefault(name, len(index)))
                owner.append(p * longest + t)
    ids, owner = np.array(ids), np.array(owner)
    real = np.arange(longest) < length[:, None]
    both = real[:, 1:] & real[:, :-1]
    seen_step = np.array([[((labels[:, :-1] == a) & (labels[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)], dtype=float)
    seen_first = np.bincount(labels[:, 0], minlength=2).astype(float)
    w, step, first = np.zeros(len(index)), np.zeros((2, 2)), np.zeros(2)
    sums = [np.full_like(x, 1e-8) for x in (w, step, first)]
    for _ in range(steps):
        gain = np.bincount(owner, weights=w[ids], minlength=n * longest).reshape(n, longest)
        emit = np.stack([np.zeros_like(gain), gain], axis=2)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            forward[:, t] = np.logaddexp(forward[:, t - 1, :1] + step[0], forward[:, t - 1, 1:] + step[1]) + emit[:, t]
        for t in range(longest - 2, -1, -1):
            after = backward[:, t + 1] + emit[:, t + 1]
            value = np.logaddexp(step[:, 0] + after[:, :1], step[:, 1] + after[:, 1:])
            backward[:, t] = np.where(real[:, t + 1, None], value, 0)
        total = np.logaddexp(*forward[np.arange(n), length - 1].T)
        state = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        grad_w = np.bincount(ids, weights=((labels - state[:, :, 1]) * real).ravel()[owner], minlength=len(index)) - penalty * w
        pair = forward[:, :-1, :, None] + step + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]
        grad_step = seen_step - (np.exp(pair) * both[:, :, None, None]).sum(axis=(0, 1)) - penalty * step
        grad_first = seen_first - state[:, 0].sum(axis=0) - penalty * first
        for x, g, s in zip((w, step, first), (grad_w, grad_step, grad_first), sums, strict=True):
            s += g * g
            x += 0.5 * g / np.sqrt(s)
    return Chain({name: float(w[i]) for name, i in index.items()}, step, first)


def extract(page: str | None, chain: Chain) -> str:
    """The main text of a page: its content blocks in order, joined by one space."""
    found = blocks(page or "")
    return " ".join(b.text for b, use in zip(found, chain.decode(found), strict=True) if use)


def main_texts(pages: DataFrame, chain: Chain) -> DataFrame:
    """page_id, url, text, n_chars: one row per page.

    A null page counts as empty; a page without content gives an empty text. Rows that share a page_id
    are separate pages. Other columns are ignored.
    """

    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([extract(page, chain) for page in batch.to_pylist()], pa.string())

    text = F.arrow_udf(read, "string")
    found = small_batches(pages).select("page_id", "url", text(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
