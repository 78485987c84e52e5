"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of tags and of blocks of words between block-level tags. A word scores the log odds that words in its place
are content: a logistic regression over the features of all block-level elements open around it (tag, tokens of class, id and
role, tag under tag), the share of link text in its block, and whether what looks like content is elsewhere on the page. A tag
scores the log odds that it stands inside the content region, never above zero. Both are learnt from labelled pages in several
templates (pages()). One linear scan finds the contiguous region with the largest sum.

Other matter inside content (an advert, a form, comments in an article) is an island: an element whose words turn to other matter
while those around it are content. It counts as its own tag however long it is, so it cannot cut the region in two, and nothing
in it is output. Inline elements never end a block; their classes count only if they enclose all of a block's words.

Every step is linear in the length of the page, also on unterminated tags and on deep nesting.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from html import unescape
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SIMPLE = re.compile(r"<(/?)([a-zA-Z][\w:-]*+)([^<>\"']*+)>")
_QUOTED = re.compile(r"<(/?)([a-zA-Z][\w:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_START = re.compile(r"<(/?)([a-zA-Z][\w:-]*+)")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+")
_PART = re.compile(r"[a-z]+")
_UNSEEN = re.compile(r"display\s*+:\s*+none", re.I)
#: elements whose content is no text
_RAW = frozenset("script style noscript template textarea svg iframe select title object video audio canvas".split())
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*+>?", re.I) for name in _RAW}
_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
#: elements that are parts of what is around them, whatever that is
_SMALL = frozenset("p h1 h2 h3 h4 h5 h6 li dl dt dd pre blockquote figure figcaption table caption".split())
#: elements that hold anything
_GENERIC = frozenset("html body div section center table tbody tr td ul ol li dl dt dd span a hr".split())
_SCOPE = frozenset("article body main html".split())
#: parts of class tokens that say how something looks or what goes with it, not what it is
_STATE = frozenset("has have with without no not is in on off show hide hidden enabled active layout wrapper wrap container page js col row grid theme".split())

Features = tuple[str, ...]


def features(name: str, attributes: str, parent: str = "") -> Features:
    """What is known about an element: its tag and its tag under its parent's, if they say something, and tokens of class, id
    and role."""
    if name in ("html", "body"):  # their classes are about the page
        return ()
    out = [name] if name not in _GENERIC else []
    if out and parent and parent not in _GENERIC:
        out.append(f"{parent}>{name}")
    for m in _ATTRIBUTE.finditer(attributes) if attributes and not attributes.isspace() else ():
        key = m[1].lower()
        if key == "hidden" or key == "aria-hidden" and "true" in (m[2] or "") or key == "style" and _UNSEEN.search(m[2] or ""):
            out.append("hidden")
        elif key in ("class", "id", "role", "aria-label", "itemprop"):
            for token in re.sub(r"([a-z])([A-Z])", r"\1-\2", (m[2] or "").strip("\"'")).lower().split():
                parts = _PART.findall(token)
                if not _STATE.intersection(parts):
                    out += [f".{p}" for p in parts]
                elif len(parts) == 1:
                    out.append(f".{parts[0]}")
    return tuple(out)


def tokens(html: str):
    """("text", text), or ("open" or "close", name, attributes), in linear time. Comments and raw elements give nothing."""
    at, n, quoted = 0, len(html), True
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            yield "text", html[at:], ""
            return
        if lt > at:
            yield "text", html[at:lt], ""
        nxt = html[lt + 1 : lt + 2]
        if nxt in ("!", "?"):
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        m = _SIMPLE.match(html, lt)
        if m is None and quoted and _START.match(html, lt):
            m = _QUOTED.match(html, lt)
            quoted = m is not None  # else a quote or the tag stays open to the end, and would for every later tag that gets here
        if m is not None:
            closes, name, attributes, at = m[1], m[2].lower(), m[3], m.end()
        elif s := _START.match(html, lt):
            end = html.find(">", s.end())
            if end < 0:
                yield "text", "", ""
                return
            closes, name, attributes, at = s[1], s[2].lower(), "", end + 1
        else:
            yield "text", "<", ""
            at = lt + 1
            continue
        if not closes and name in _RAW and not attributes.endswith("/"):
            end = _RAW_END[name].search(html, at)
            at = n if end is None else end.end()
            continue
        yield ("close" if closes else "open"), name, attributes


class _Open:
    """An open block-level element. `counted` holds the number of open elements by name that end tags like its own can reach,
    `inner` the number of those that end tags within it can reach. `content`: it or one around it looks like content."""

    __slots__ = ("best", "content", "counted", "features", "inner", "island", "name", "opens")

    def __init__(self, name: str, features: Features, best: float, island: bool, content: bool, opens: bool, counted: Counter, inner: Counter):
        self.name, self.features, self.best, self.island = name, features, best, island
        self.content, self.opens, self.counted, self.inner = content, opens, counted, inner


def walk(html: str, weights: dict[str, float], bias: float = 0.0, learning: bool = False):
    """Events of a page: ("tag", name, in island) and ("block", text, score, in island, share of words in links, features, content).

    The score of the elements around is kept up as they open and close; a feature counts once however many of them have it.
    Features come with a block if learning. No class speaks against the article that holds most of the page's words. Where elements that look like content hold PART of the page's words, all else has the
    feature OUTSIDE.
    """
    events = list(tokens(html))
    body = frozenset(i for i in _holders(events) if _may_be_body(*events[i][1:], weights))
    words = Counter()
    for e in _events(events, weights, bias, False, False, body):
        if e[0] == "block" and not e[3]:
            words[e[6]] += e[1].count(" ") + 1
    return _events(events, weights, bias, learning, words[True] > PART * words.total(), body)


def _holders(events: list) -> list[int]:
    """Where the elements start that hold more than half of the page's words outside links. They are nested in each other."""
    total, names = 0, Counter()
    open_: list[tuple[str, int, int]] = []  # name, event, words before it
    held: list[tuple[int, int]] = []

    def pop() -> str:
        name, at, before = open_.pop()
        names[name] -= 1
        held.append((total - before, at))
        return name

    for i, (kind, name, _) in enumerate(events):
        if kind == "text":
            total += 0 if names["a"] else len(name.split())
        elif kind == "open" and name not in _VOID:
            if name == "a" and names["a"]:
                continue
            open_.append((name, i, total))
            names[name] += 1
        elif kind == "close" and names[name]:
            while pop() != name:
                pass
    while open_:
        pop()
    return [at for n, at in held if 2 * n > total]


def _may_be_body(name: str, attributes: str, weights: dict[str, float]) -> bool:
    """Whether an element that holds most of the page is its article: by its tag, or by a whole class that speaks for content."""
    if name in ("article", "main"):
        return True
    whole = (t for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() in ("class", "id") for t in (m[2] or "").strip("\"'").lower().split())
    return name in _GENERIC and any(weights.get(f".{t}", 0.0) > LOOKS for t in whole)


def _events(events: list, weights: dict[str, float], bias: float, learning: bool, outside: bool, body: frozenset[int]):
    active: Counter = Counter()
    scopes: Counter = Counter()
    score = bias

    def add(fs):
        nonlocal score
        for f in fs:
            active[f] += 1
            if active[f] == 1:
                score += weights.get(f, 0.0)

    def drop(fs):
        nonlocal score
        for f in fs:
            active[f] -= 1
            if not active[f]:
                del active[f]
                score -= weights.get(f, 0.0)

    apart = (OUTSIDE,) if outside else ()
    add(apart)
    surely = score + SURE
    stack = [_Open("", (), score, False, False, False, Counter(), Counter())]
    inline: list[tuple[str, Features]] = []  # open inline elements of the running block
    first: list[tuple[str, Features]] = []  # those around its first word
    parts: list[str] = []
    common = lowest = links = linked = words = 0  # common: how many of `first` enclose all words so far

    def flush():
        nonlocal parts, words, linked
        text = " ".join(unescape("".join(parts)).split()) if words else ""
        share = linked / words if words else 0.0
        parts, words, linked = [], 0, 0
        if text:
            around = [f for _, fs in first[:common] for f in fs]
            add(around)
            sure = stack[-1].best > surely
            share = 0.0 if sure else share  # in content, a linked paragraph is as good as any
            yield "block", text, score, stack[-1].island or sure and score < 0, share, tuple(active) if learning else (), stack[-1].content
            drop(around)

    def pop():
        top = stack.pop()
        drop(top.features)
        top.counted[top.name] -= 1
        if top.opens:
            add(apart)

    for at, (kind, name, attributes) in enumerate(events):
        if kind == "text":
            parts.append(name)
            if (k := len(name.split())) > 0:
                if not words:
                    first, common = inline[:], len(inline)
                common = min(common, lowest) if words else common
                lowest = len(inline)
                words += k
                linked += k if links else 0
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in _BLOCK:
            if kind == "open" and name not in _VOID:
                inline.append((name, features(name, attributes)))
                links += name == "a"
            elif kind == "close":
                for i in range(len(inline) - 1, max(-1, len(inline) - 9), -1):  # as far as misnested ends are looked for
                    if inline[i][0] == name:
                        links -= sum(x[0] == "a" for x in inline[i:])
                        del inline[i:]
                        break
                lowest = min(lowest, len(inline))
            continue
        yield from flush()
        inline, links = [], 0
        if kind == "close":
            reach = scopes if name in _SCOPE else stack[-1].inner
            if reach[name] > 0:
                while stack[-1].name != name:
                    pop()
                pop()
            yield "tag", name, stack[-1].island
            continue
        if stack[-1].name == "p" or stack[-1].name in _CLOSES.get(name, ()):
            pop()
            if stack[-1].name in _CLOSES.get(name, ()):
                pop()
        outer = stack[-1]
        yield "tag", name, outer.island
        if name in _VOID:
            continue
        own = features(name, attributes, outer.name)
        if at in body:  # its classes name the article's topic or the page's parts; they don't speak against it
            own = tuple(f for f in own if not f.startswith(".") or weights.get(f, 0.0) >= 0)
        add(own)
        looks = name in ("article", "main") or name not in _SMALL and sum(weights.get(f, 0.0) for f in {*own}) > LOOKS
        content = looks and score - (weights.get(OUTSIDE, 0.0) if active[OUTSIDE] else 0.0) >= 0
        opens = content and not outer.content and not outer.island
        if opens:
            drop(apart)
        scope = name in _SCOPE
        counted = scopes if scope else outer.inner
        counted[name] += 1
        # a header may hold the title: what is in it decides
        turns = outer.best > surely and score < 0 and name != "header"
        stack.append(_Open(name, own, max(outer.best, score), outer.island or turns, outer.content or content, opens, counted, Counter() if scope else outer.inner))
    yield from flush()


class Weights:
    """Log odds of a word by the features around it, with a bias, and scores of tags."""

    def __init__(self, words: dict[str, float], bias: float, tags: dict[str, float]):
        self.words, self.bias, self.tags = words, bias, tags


#: by how much an element must raise the log odds to be content for sure, so that other matter in it is an island
SURE = 1.0
LIMIT = 4.0
LINK, OUTSIDE = "share of link text", "outside content"
#: an element looks like content by its own features from so many log odds on; the share of words that such elements must hold
LOOKS, PART = 0.5, 0.4
#: the score of a tag that no labelled page has, and of an island
UNSEEN, ISLAND = -0.5, -1.0

# what classes, ids and roles are called, by the kind of matter
KINDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager skip toc navi hauptmenue menue navegacion".split(),
    "head": "header masthead banner branding logo hero kopf kopfzeile entete cabecera encabezado".split(),
    "foot": "footer copyright legal colophon contentinfo imprint impressum fuss fusszeile pied pie".split(),
    "side": "sidebar aside widget related recommended recommendations trending popular complementary archive tagcloud tags teaser seitenleiste randspalte lateral laterale".split(),
    "note": "notice cookie cookies consent gdpr alert privacy disclaimer popup modal overlay dialog toast paywall".split(),
    "ad": "ad ads advert advertisement adbox adsbygoogle sponsor sponsored promo promotion commercial".split(),
    "form": "form newsletter subscribe signup login search register contact poll".split(),
    "talk": "comment comments reply replies discussion disqus respond feedback thread responses reactions kommentar kommentare commentaire commentaires comentario comentarios".split(),
    "share": "share social sharing follow byline meta author tools print".split(),
    "good": "content article post entry main story body text document prose primary blog news single inhalt beitrag artikel contenu contenido texte texto".split(),
}
PAGES = 60


class _Page:
    """Pieces of a labelled page. Words of content begin with c, other words with x."""

    def __init__(self, seed: int):
        self.r = Random(seed)

    def words(self, kind: str, low: int, high: int) -> str:
        return " ".join(f"{kind}{self.r.randrange(1000)}" for _ in range(self.r.randint(low, high)))

    def unknown(self) -> str:
        """A name that says nothing."""
        return "".join(self.r.choice("bcdfghjklmnpqrstvwxz") + self.r.choice("aeiou") for _ in range(4))

    def mark(self, kind: str) -> str:
        """A class or id of the kind, at times with a second part or token; or none at all."""
        if kind == "odd":
            return f' class="{self.unknown()}"'
        if self.r.random() < 0.15:
            return ""
        name = self.r.choice(KINDS[kind])
        name = self.r.choice([name, name, f"{name}-{self.r.randrange(99)}", f"site-{name}", f"{name} {self.unknown()}", f"{name}-list", f"{name}_{self.r.choice(KINDS[kind])}"])
        return f' {self.r.choice(["class", "class", "id"])}="{name}"'

    def state(self) -> str:
        """A class that says what goes with an element, not what it is."""
        other = self.r.choice([k for kind in ("side", "talk", "ad", "menu") for k in KINDS[kind]])
        return self.r.choice([f"has-{other}", f"with-{other}", f"no-{other}", f"{other}-layout", f"{other}-on"])

    def run(self) -> str:
        """Words of content with inline elements."""
        out = []
        for _ in range(self.r.randint(1, 4)):
            w = self.words("c", 1, 14)
            out.append(self.r.choice([w, w, w, f"<b>{w}</b>", f"<a href=u>{self.words('c', 1, 4)}</a> {w}", f"<em>{w}</em>", f'<span class="{self.r.choice(KINDS[self.r.choice(list(KINDS))])}">{self.words("c", 1, 3)}</span> {w}', f"{w}<br>"]))
        return " ".join(out)

    def title(self) -> str:
        """A heading, alone or in a header of its own; a class of a heading may hold any word, as topics do."""
        name, any_ = self.r.choice(KINDS["good"]), self.r.choice(KINDS[self.r.choice(list(KINDS))])
        tag, mark = self.r.choice(["h1", "h1", "h2"]), self.r.choice(["", "", f' class="{name}-title"', f' class="{any_}-title"'])
        head = f"<{tag}{mark}>{self.words('c', 2, 8)}</{tag}>"
        around = self.r.choice(["header", "div"])
        return self.r.choice([head, head, f'<{around} class="{name}-header">{head}</{around}>'])

    def content(self) -> str:
        parts = [self.title()] if self.r.random() < 0.8 else []
        for _ in range(self.r.randint(2, 9)):
            kind = self.r.random()
            if kind < 0.65:
                parts.append(f"<p>{self.run()}</p>")
            elif kind < 0.75:
                tag = self.r.choice(["h2", "h3"])
                parts.append(f"<{tag}>{self.words('c', 1, 6)}</{tag}>")
            elif kind < 0.85:
                tag = self.r.choice(["ul", "ol"])
                parts.append(f"<{tag}>" + "".join(f"<li>{self.run()}</li>" for _ in range(self.r.randint(1, 5))) + f"</{tag}>")
            elif kind < 0.9:
                parts.append("<table>" + "".join(f"<tr><td>{self.words('c', 1, 3)}</td><td>{self.words('c', 1, 3)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.95:
                parts.append(f"<blockquote><p>{self.run()}</p></blockquote><pre>{self.words('c', 2, 9)}</pre>")
            else:
                parts.append(f"<figure><img src=i><figcaption>{self.words('c', 2, 8)}</figcaption></figure><dl><dt>{self.words('c', 1, 2)}</dt><dd>{self.run()}</dd></dl>")
        return "".join(parts)

    def links(self, low: int = 2, high: int = 7) -> str:
        return "<ul>" + "".join(f"<li><a href=u>{self.words('x', 1, 3)}</a></li>" for _ in range(self.r.randint(low, high))) + "</ul>"

    def other(self, kind: str, tag: str | None = None) -> str:
        """Matter of a kind other than content: under its own tag, or under one that says nothing with a class that does."""
        own = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "note": "dialog", "form": "form"}.get(kind)
        tag = tag or (own if own and self.r.random() < 0.5 else self.r.choice(["div", "div", "section"]))
        mark = self.mark(kind) if tag == own else ""
        while tag != own and not mark:
            mark = self.mark(kind)
        x = lambda low, high: self.words("x", low, high)
        inner = {
            "menu": lambda: self.r.choice([self.links(), f"<a href=u>{x(1, 2)}</a> <a href=u>{x(1, 2)}</a>", x(1, 4)]),
            "head": lambda: self.r.choice([f"<a href=u>{x(1, 3)}</a>", f"<h1>{x(1, 3)}</h1><p>{x(2, 6)}</p>", x(1, 5)]),
            "foot": lambda: self.r.choice([x(3, 30), f"<p>{x(3, 30)}</p>", f"<p>{x(2, 9)}</p>{self.links()}"]),
            "side": lambda: self.r.choice([f"<h3>{x(1, 3)}</h3>{self.links()}", f"<p>{x(5, 40)}</p>", x(3, 20), f"<h2>{x(1, 4)}</h2><p>{x(5, 20)}</p>"]),
            "note": lambda: self.r.choice([x(3, 30), f"<p>{x(3, 30)}</p><button>{x(1, 2)}</button>"]),
            "ad": lambda: self.r.choice([x(3, 30), f"<p>{x(3, 30)}</p>", f"<a href=u>{x(2, 9)}</a>"]),
            "form": lambda: f"<label>{x(1, 4)}</label><input name=q><p>{x(1, 20)}</p><button>{x(1, 2)}</button>",
            "talk": lambda: f"<h3>{x(1, 2)}</h3>" * self.r.randint(0, 1) + "".join(f"<{t}{self.mark('talk')}><p>{x(3, 40)}</p></{t}>" for t in [self.r.choice(["div", "article", "li"])] for _ in range(self.r.randint(1, 5))),
            "share": lambda: self.r.choice([self.links(2, 4), x(2, 6), f"<p>{x(2, 6)}</p>"]),
            "odd": lambda: self.r.choice([x(2, 30), f"<p>{x(2, 30)}</p>", f"<h3>{x(1, 4)}</h3>{self.links()}"]),
        }[kind]()
        if kind in ("note", "menu", "odd") and self.r.random() < 0.15:
            mark += self.r.choice([" hidden", ' style="display: none"', ' aria-hidden="true"'])
        return f"<{tag}{mark}>{inner}</{tag}>"

    def some(self, *kinds: str, share: float = 0.6) -> str:
        return "".join(self.other(k) for k in kinds if self.r.random() < share)

    def mixed(self) -> str:
        """Content with other matter in it."""
        parts = re.split(r"(?=<p>)", self.content())
        for kind in ("ad", "share", "form", "note", "side", "talk", "menu"):
            if self.r.random() < 0.2:
                parts.insert(self.r.randint(1, len(parts)), self.other(kind))
        return "".join(parts)


def _semantic(p: _Page) -> str:
    head = f"<header><h1>{p.words('c', 2, 8)}</h1></header>" if p.r.random() < 0.3 else ""
    return f"<body>{p.some('head', 'menu', 'note', 'ad', 'odd')}<article{p.mark('good')}>{head}{p.mixed()}</article>{p.some('talk', 'side', 'share', 'odd', 'foot')}</body>"


def _classes(p: _Page) -> str:
    tag, mark = p.r.choice(["div", "section"]), ""
    while not mark:
        mark = p.mark("good")
    head = f"<header class='{p.r.choice(KINDS['good'])}-header'><h1>{p.words('c', 2, 8)}</h1></header>" if p.r.random() < 0.3 else ""
    return f"<body><div>{p.some('head', 'menu')}</div><div>{head}<{tag}{mark}><div>{p.mixed()}</div></{tag}>{p.some('odd', 'side', 'talk', 'ad')}</div>{p.some('form', 'note', 'foot')}</body>"


def _main(p: _Page) -> str:
    return f"<body{p.mark('good')}>{p.some('menu', 'head', 'ad')}<main><section>{p.mixed()}</section>{p.some('talk', 'form', 'share')}</main>{p.some('odd', 'side', 'foot', 'note')}</body>"


def _bare(p: _Page) -> str:
    """No class says anything: menus are lists of links, content is paragraphs."""
    return f"<body>{p.links(4, 9)}<div><div>{p.content()}</div></div>{p.links(4, 9)}</body>"


def _table(p: _Page) -> str:
    return f"<body><table><tr><td>{p.links(4, 9)}</td><td>{p.content()}</td><td>{p.some('ad', 'side', share=0.9)}</td></tr></table>{p.some('foot')}</body>"


def _blog(p: _Page) -> str:
    return f'<body class="{p.state()}"><div class="{p.state()} {p.state()}">{p.some("menu", "head")}<article class="{p.r.choice(KINDS["good"])} {p.state()}">{p.mixed()}</article>{p.some("side", "talk", "odd", share=0.9)}</div>{p.some("foot")}</body>'


def _plain(p: _Page) -> str:
    return f"<body>{p.some('note', 'ad')}{p.r.choice([p.content(), p.run(), p.words('c', 20, 60)])}{p.some('foot', 'talk')}</body>"


TEMPLATES = (_semantic, _classes, _main, _bare, _table, _blog, _plain)


def pages(templates=TEMPLATES, count: int = PAGES) -> list[str]:
    """`count` labelled pages of each template, the same ones every time."""
    return [t(_Page(1000 * i + k)) for i, t in enumerate(TEMPLATES) if t in templates for k in range(count)]


def is_content(word: str) -> bool:
    return word.startswith("c")


def learn(labelled: list[str], rounds: int = 2) -> Weights:
    """A ridge logistic regression over the blocks of labelled pages, then tag scores by where tags stand in them. What is content
    for sure, and so whether link text counts, follows from the weights of the round before."""
    weights = Weights({}, 0.0, {})
    for _ in range(rounds):
        weights = _learn(labelled, weights)
    return weights


def _learn(labelled: list[str], before: Weights) -> Weights:
    rows, good, tags = [], [], {True: Counter(), False: Counter()}
    for html in labelled:
        events = list(walk(html, before.words, before.bias, learning=True))
        says = [e[0] == "block" and is_content(e[1]) for e in events]
        region = range(says.index(True), len(says) - says[::-1].index(True)) if any(says) else range(0)
        for i, e in enumerate(events):
            if e[0] == "tag":
                tags[i in region][e[1]] += not e[2]
            else:
                rows.append((e[5], e[4]))
                good.append(says[i])
    many = Counter(f for fs, _ in rows for f in fs)
    names = sorted(f for f, c in many.items() if c > 2)
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 2))
    for i, (fs, share) in enumerate(rows):
        x[i, [at[f] for f in fs if f in at]] = 1
        x[i, -2:] = share, 1
    y, w = np.array(good, float), np.zeros(x.shape[1])
    ridge = np.append(np.full(len(names) + 1, 0.1), 1e-6)
    for _ in range(12):
        prob = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (prob * (1 - prob))[:, None]).T @ x + np.diag(ridge) + 1e-9 * np.eye(len(w))
        w += np.clip(np.linalg.solve(hess, x.T @ (y - prob) - ridge * w), -3, 3)
    totals = {side: sum(c.values()) + len(tags[True] | tags[False]) for side, c in tags.items()}
    odds = {t: math.log((tags[True][t] + 1) / totals[True]) - math.log((tags[False][t] + 1) / totals[False]) for t in tags[True] | tags[False]}
    return Weights({f: float(w[i]) for f, i in at.items()} | {LINK: float(w[-2])}, float(w[-1]), {t: min(-0.05, v) for t, v in odds.items()})


@cache
def model() -> Weights:
    return learn(pages())


def best_region(scores: list[float]) -> tuple[int, int]:
    """(first, last + 1) of the contiguous region with the largest sum above zero, the earliest and shortest of equals; else (0, 0)."""
    best, first, last, total, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, first, last = total, start, i + 1
    return first, last


def extract(html: str | None, weights: Weights | None = None) -> str:
    """The text of the best region: blocks in page order, joined by two line ends; nothing found: empty."""
    if not html:
        return ""
    weights = weights or model()
    texts: list[str | None] = []
    scores: list[float] = []
    inside = False  # an island counts once
    for event in walk(html, weights.words, weights.bias):
        if event[0] == "tag":
            if not event[2]:
                inside = False
                texts.append(None)
                scores.append(weights.tags.get(event[1], UNSEEN))
            continue
        _, text, score, island, share, _, _ = event
        if island:
            if not inside:
                texts.append(None)
                scores.append(ISLAND)
            inside = True
            continue
        score = max(-LIMIT, min(LIMIT, score + share * weights.words[LINK]))
        texts.append(text if score > 0 else None)
        scores.append(score * (text.count(" ") + 1))
    first, last = best_region(scores)
    return "\n\n".join(t for t in texts[first:last] if t is not None)


def extract_pages(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """pages with `out`: each row's main text. A null html gives an empty text; every column but html passes through.

    Repeated rows, null ids and empty tables need no care, pages being independent of each other; nothing is shuffled.
    """
    from pyspark.sql.types import StringType, StructType

    rest = [f for f in pages.schema.fields if f.name not in (html_col, out)]
    schema = StructType([*rest, *StructType().add(out, StringType()).fields])
    weights = model()

    def run(batches):
        for batch in batches:
            texts = pa.array([extract(h, weights) for h in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], texts], names=[*batch.schema.names[1:], out])

    return pages.select(html_col, *[f"`{f.name}`" for f in rest]).mapInArrow(run, schema)


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    found = extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
