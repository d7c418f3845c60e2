"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into its leaf blocks: runs of text between block-level tags, each with the tags and
class names of its ancestors. A block's features are those names and what its text looks like
(length, links, punctuation). The field has two labels, main and other, and weights for features
and for label pairs; it is trained by maximum likelihood on labelled pages, and the best labels of
a page are found by Viterbi. The labelled pages are written by a seeded generator in this module,
`max_pages` of them: articles in different frames with menus, site headers, footers, sidebars,
notices, adverts, forms and reader comments around and inside.

Defined cases: a null or empty page has empty text; a page without main blocks too; text outside
any tag is a block; unclosed, stray and nested tags are handled as browsers do in outline; very
long and deeply nested pages are read whole in linear time; formulas and noscript content count like any text, scripts, templates
and drawings don't; a null id or url is carried; repeated rows are extracted each; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, tidy

MAX_PAGES = 600

# HTML element classes.
BLOCK = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " iframe label legend li main menu nav object ol option p pre section select summary table tbody td tfoot th thead title tr ul video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content of these is no markup; without an end tag it goes on to the end of the page.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Content of these isn't text of the page; without an end tag they are like any other element.
HIDDEN = frozenset("template svg".split())
#: An opening tag ends the open elements named, up to the nearest of the barriers.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}), "thead": ({"tbody"}, {"table"}),
}
_SCOPE = frozenset("body html table td th button article section div li aside nav main footer header form caption object".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*>""", re.S)
_ATTR = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[a-z]+")


class Block:
    """path: the last three block-level ancestors. context: features of all ancestors, shared by blocks in the same place."""

    __slots__ = ("path", "context", "text", "linked")

    def __init__(self, path: tuple[str, ...], context: tuple[str, ...], text: str, linked: int):
        self.path, self.context, self.text, self.linked = path, context, text, linked


class Open:
    """The open elements. Each knows what all elements up to it say together; places by tag answer what is open in constant time."""

    def __init__(self, known: frozenset[str] | None):
        self.known = known
        self.stack: list[tuple[str, tuple[str, ...], tuple[str, ...], frozenset[str]]] = [("", (), (), frozenset())]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]
        self.scopes: list[int] = [0]

    def last(self, *tags: str) -> int:
        """Place of the last open element of these tags, 0 if none is open."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        _, path, context, held = self.stack[-1]
        new = {y for x in names if (y := "name:" + x) not in held and (self.known is None or y in self.known)} if names else set()
        if tag in BLOCK:
            path = (*path[-2:], tag)
            if (y := "in:" + tag) not in held and (self.known is None or y in self.known):
                new.add(y)
            self.blocks.append(len(self.stack))
        if tag in _SCOPE:
            self.scopes.append(len(self.stack))
        if new:
            held = held | new
            context = (*context, *sorted(new))
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, path, context, held))

    def cut(self, place: int) -> None:
        """Close the element at this place and all in it."""
        for tag, *_ in self.stack[place:]:
            self.at[tag].pop()
        del self.stack[place:]
        for places in (self.blocks, self.scopes):
            while places[-1] >= place:
                places.pop()


@lru_cache(4096)
def _short_attributes(raw: str) -> tuple[str, ...]:
    return attributes(raw)


def attributes(raw: str) -> tuple[str, ...]:
    """Lower-case words of an element's class, id and role, and hidden."""
    out: list[str] = []
    for key, *values in _ATTR.findall(raw):
        key = key.lower()
        if key in ("hidden", "aria-hidden"):
            if "false" not in values:
                out.append("hidden")
            continue
        out += _NAME.findall("".join(values).lower())
    return tuple(out)


def blocks(page: str | None, known: frozenset[str] | None = None) -> list[Block]:
    """Leaf blocks in page order. known: the ancestors' features of interest, all if null."""
    out: list[Block] = []
    tree = Open(known)
    text: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                _, path, context, _ = tree.stack[-1]
                out.append(Block(path, context, joined, min(len(joined), len(" ".join(html.unescape("".join(linked)).split())))))
            text.clear()
        linked.clear()

    def say(piece: str) -> None:
        if piece:
            text.append(piece)
            if tree.at.get("a"):
                linked.append(piece)

    page = page or ""
    at, end = 0, page.rfind(">") + 1  # behind it there is no tag
    endless: set[str] = set()  # tags without a further end tag
    while m := _TAG.search(page, at, end):
        say(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)  # an open comment
            continue  # a comment, a declaration or a broken tag
        tag = tag.lower()
        places = tree.at.get(tag)
        place = places[-1] if places else 0
        if m[1]:
            if tag in BLOCK:
                flush()
            if place and (tag in BLOCK or tag == "a" or tree.blocks[-1] < place):
                tree.cut(place)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            paragraph = tree.at.get("p")  # a block ends an open paragraph
            if paragraph and tag != "option" and paragraph[-1] > tree.scopes[-1]:
                tree.cut(paragraph[-1])
        if tag in ENDS:
            ended, barriers = ENDS[tag]
            while (inner := tree.last(*ended)) > tree.last(*barriers):
                tree.cut(inner)
                if tag != "tr":
                    break
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW or tag in HIDDEN:
            found = None if tag in endless else re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            stop = page.find(">", found.start()) if found else -1
            if stop >= 0:
                at = stop + 1
                continue
            endless.add(tag)
            if tag in RAW:
                at = len(page)
                continue
        if tag == "a" and place:
            tree.cut(place)
        raw = m[3]
        tree.push(tag, () if not raw else _short_attributes(raw) if len(raw) < 256 else attributes(raw))
    say(page[at:].partition("<!--")[0])
    flush()
    return out


def own_features(found: list[Block]) -> list[list[str]]:
    """Features of the blocks themselves, without those of their ancestors."""
    out = []
    n = len(found)
    for i, b in enumerate(found):
        t = b.text
        size = len(t)
        words = t.count(" ") + 1
        share = b.linked / size
        last = b.path[-1] if b.path else "none"
        f = ["bias", "leaf:" + last, "len:" + str(min(9, size.bit_length())), "words:" + str(min(7, words.bit_length())), "link:" + ("0" if share == 0 else "some" if share < 0.5 else "most")]
        f.append("up:" + "/".join(b.path[-3:]))
        if t[-1] in ".!?:;…»”\"'":
            f.append("ends")
        if "©" in t or "all rights" in t.lower():
            f.append("rights")
        if "." in t or "," in t:
            f.append("points")
        if i == 0:
            f.append("first")
        if i == n - 1:
            f.append("last")
        out.append(f)
    return out


def block_features(found: list[Block]) -> list[list[str]]:
    return [[*f, *b.context] for f, b in zip(own_features(found), found, strict=True)]


# Labelled pages.

_MAIN = ["article", "main", "div class=content", "div id=content", "div class=post-body", "div class=entry-content", "section class=article-body", "div class='story text'", "div role=main"]
_OTHER_NAMES = {
    "nav": ["nav", "div class=menu", "ul class=nav", "div id=navigation", "div class=navbar", "div class=breadcrumb", "div role=navigation"],
    "header": ["header", "div class=header", "div id=masthead", "div class=site-header", "div class=banner"],
    "footer": ["footer", "div class=footer", "div id=footer", "div class=site-footer", "div class=copyright"],
    "aside": ["aside", "div class=sidebar", "div id=sidebar", "div class=widget", "div class=related", "section class=recommended"],
    "ad": ["div class=ad", "div class=ads", "div class=advert", "div id=sponsor", "div class=promo", "aside class=advertisement", "div class=sponsored", "div class=banner-ad"],
    "notice": ["div class=notice", "div class=cookie-banner", "div id=consent", "div class=alert", "div class=newsletter", "div class=subscribe", "div role=alert", "dialog"],
    "form": ["form", "form class=search", "form id=login", "form class=signup"],
    "comments": ["div class=comments", "section id=comments", "div class=comment-list", "ol class=commentlist", "div id=disqus", "section class=responses"],
}
_LETTERS = "etaoinshrdlucmfwypvbgkjqxz"


class PageMaker:
    """Pages whose blocks' labels are known."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.words = ["".join(self.r.choice(_LETTERS[: self.r.choice((8, 14, 26))]) for _ in range(self.r.randint(1, 9))) for _ in range(3000)]

    def sentence(self, lo: int = 4, hi: int = 24) -> str:
        s = " ".join(self.r.choice(self.words) for _ in range(self.r.randint(lo, hi)))
        return s[:1].upper() + s[1:] + self.r.choice((".", ".", ".", "", "!", "?"))

    def prose(self) -> str:
        s = " ".join(self.sentence() for _ in range(self.r.choice((1, 1, 2, 3, 5, 8))))
        if self.r.random() < 0.2:
            s += f' <a href="/x">{self.sentence(1, 4)}</a> ' + self.sentence()
        return f"<b>{s}</b>" if self.r.random() < 0.1 else s

    def short(self) -> str:
        return " ".join(self.r.choice(self.words) for _ in range(self.r.randint(1, 4))).title()

    def wrap(self, opening: str, inner: str) -> str:
        return f"<{opening}>{inner}</{opening.split()[0]}>"

    def other(self, kind: str) -> str:
        r = self.r
        opening = r.choice(_OTHER_NAMES[kind])
        link = lambda: f'<a href="/{r.choice(self.words)}">{self.short()}</a>'
        if kind == "nav":
            inner = "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 9))) + "</ul>" if r.random() < 0.7 else " | ".join(link() for _ in range(r.randint(2, 6)))
        elif kind == "header":
            inner = r.choice(("", f"<h1>{self.short()}</h1>", f"<div>{self.short()}</div>")) + f"<p>{self.sentence(2, 6)}</p>" * r.randint(0, 1) + link()
        elif kind == "footer":
            inner = r.choice(("&copy; ", "© 2020 ", "Copyright ")) + self.short() + " &middot; " + self.sentence(2, 12) + (f"<p>{self.prose()}</p>" if r.random() < 0.3 else "")
        elif kind == "aside":
            inner = f"<h3>{self.short()}</h3>" + ("<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 6))) + "</ul>" if r.random() < 0.6 else f"<p>{self.prose()}</p>")
        elif kind in ("ad", "notice"):
            inner = r.choice((self.prose(), f"<p>{self.prose()}</p>", f"<span>{self.sentence()}</span>{link()}", f"<p>{self.sentence()}</p><button>{self.short()}</button>"))
        elif kind == "form":
            inner = f"<label>{self.short()}</label><input name=q><select><option>{self.short()}<option>{self.short()}</select><button>{self.short()}</button>"
        else:
            inner = f"<h3>{self.short()}</h3>" + "".join(r.choice((f"<div class=comment><p>{self.prose()}</p></div>", f"<li>{self.prose()}</li>", f"<div class=reply><b>{self.short()}</b><p>{self.prose()}</p></div>")) for _ in range(r.randint(1, 5)))
        return self.wrap(opening, inner)

    def part(self) -> str:
        r, x = self.r, self.r.random()
        if x < 0.7:
            return "<p>" + self.prose() + r.choice(("</p>", "</p>", "</p>", "<br>", ""))
        if x < 0.78:
            return self.wrap(r.choice(("h2", "h3", "h4")), self.short())
        if x < 0.84:
            return self.wrap(r.choice(("ul", "ol")), "".join(f"<li>{self.sentence()}</li>" for _ in range(r.randint(1, 5))))
        if x < 0.88:
            return f"<blockquote>{self.prose()}</blockquote>"
        if x < 0.91:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{self.short()}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 3))) + "</table>"
        if x < 0.94:
            return f"<figure><img src=a.png><figcaption>{self.sentence()}</figcaption></figure>"
        if x < 0.97:
            return f"<div>{self.prose()}</div>"
        return f"<pre>{self.sentence()}\n{self.sentence()}</pre>"

    def page(self) -> list[tuple[str, bool]]:
        """Pieces of HTML with their labels; tags that stand alone carry none that counts."""
        r = self.r
        out: list[tuple[str, bool]] = [(f"<!DOCTYPE html><html><head><title>{self.sentence()}</title><style>p{{}}</style></head><body>", False)]
        for kind in r.sample(["nav", "header", "notice", "ad", "form"], r.randint(0, 4)):
            out.append((self.other(kind), False))
        frames = [r.choice(_MAIN)]
        if r.random() < 0.3:
            frames.insert(0, r.choice(("div class=wrapper", "div id=page", "main", "div class=container")))
        if r.random() < 0.15:
            frames = []  # an article straight in the body
        if frames[:1] and r.random() < 0.2:
            out.append((f"<{frames[0]}>", False))
            out.append((self.other(r.choice(("aside", "nav"))), False))
        elif frames:
            out.append((f"<{frames[0]}>", False))
        out += [(f"<{f}>", False) for f in frames[1:]]
        if r.random() < 0.8:
            head = f"<h1>{self.sentence(2, 10)}</h1>"
            out.append((f"<header>{head}</header>" if frames and r.random() < 0.15 else head, True))
        for _ in range(r.choice((0, 1, 2, 3, 5, 8, 12))):
            out.append((self.part(), True))
            if r.random() < 0.06:
                out.append((self.other(r.choice(("ad", "aside", "notice", "form"))), False))
        if frames and r.random() < 0.15:
            out.append((self.other("comments"), False))
        out += [(f"</{f.split()[0]}>", False) for f in reversed(frames)]
        for kind in r.sample(["aside", "comments", "ad", "notice", "nav"], r.randint(0, 3)):
            out.append((self.other(kind), False))
        if r.random() < 0.85:
            out.append((self.other("footer"), False))
        if r.random() < 0.8:
            out.append(("</body></html>", False))
        return out


_MARK = re.compile("[\ue000\ue001]")


def labelled_pages(n: int, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """Blocks and their labels. Labels travel through the parser as private-use characters in the text."""
    maker, out = PageMaker(seed), []
    for _ in range(n):
        page = "".join(re.sub(r">([^<]*[^\s<][^<]*)(?=<)", lambda m, y=y: ">" + ("\ue001" if y else "\ue000") + m[1], ">" + piece + "<")[1:-1] for piece, y in maker.page())
        found, labels = [], []
        for b in blocks(page):
            marks = _MARK.findall(b.text)
            b.text = " ".join(_MARK.sub("", b.text).split())
            if b.text and marks:
                found.append(b)
                labels.append(int(marks[0] == "\ue001"))
                b.linked = min(b.linked, len(b.text))
        if found:
            out.append((found, labels))
    return out


class Field:
    """The trained field: weights of features for main against other, and of label pairs."""

    def __init__(self, weights: dict[str, float], pairs: list[list[float]], start: list[float]):
        self.weights, self.pairs, self.start = weights, pairs, start
        self.known = frozenset(x for x in weights if x.startswith(("in:", "name:")))

    def label(self, found: list[Block]) -> list[int]:
        """Viterbi."""
        if not found:
            return []
        get = self.weights.get
        (p00, p01), (p10, p11) = self.pairs
        back = []
        s0, s1 = self.start
        shared: dict[int, float] = {}  # blocks in the same place have one context
        for i, (b, f) in enumerate(zip(found, own_features(found), strict=True)):
            place = id(b.context)
            if place not in shared:
                shared[place] = sum([get(x, 0.0) for x in b.context])
            e = shared[place] + sum([get(x, 0.0) for x in f])
            if i == 0:
                s1 += e
                continue
            x, y, c, d = s0 + p00, s1 + p10, s0 + p01, s1 + p11
            back.append((int(y > x), int(d > c)))
            s0, s1 = max(x, y), max(c, d) + e
        y = [int(s1 > s0)]
        for b in reversed(back):
            y.append(b[y[-1]])
        return y[::-1]


def train_field(pages: list[tuple[list[Block], list[int]]], steps: int = 120, rate: float = 0.15, decay: float = 2e-4) -> Field:
    """Maximum conditional likelihood by forward-backward over all pages at once and Adam."""
    index: dict[str, int] = {}
    flat, cuts, labels, places = [], [0], [], []
    for k, (found, ys) in enumerate(pages):
        for i, f in enumerate(block_features(found)):
            flat += [index.setdefault(x, len(index)) for x in f]
            cuts.append(len(flat))
            places.append((k, i))
        labels += ys
    flat, starts, y = np.array(flat), np.array(cuts[:-1]), np.array(labels)
    owner = np.repeat(np.arange(len(y)), np.diff(cuts))
    k, i = np.array(places).T
    n, length = len(pages), i.max() + 1
    live = np.zeros((n, length), bool)
    live[k, i] = True
    target = np.zeros((n, length), int)
    target[k, i] = y
    w = np.zeros(len(index) + 6)
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    gold = np.zeros_like(w)
    np.add.at(gold, flat, y[owner])
    for s in range(1, length):
        both = live[:, s]
        np.add.at(gold, len(index) + 2 * target[both, s - 1] + target[both, s], 1)
    np.add.at(gold, len(index) + 4 + target[:, 0], 1)
    for step in range(1, steps + 1):
        e = np.zeros((n, length, 2))
        e[k, i, 1] = np.add.reduceat(w[flat], starts)
        pair, first = w[len(index) : len(index) + 4].reshape(2, 2), w[len(index) + 4 :]
        ahead = np.zeros((n, length, 2))
        behind = np.zeros((n, length, 2))
        ahead[:, 0] = first + e[:, 0]
        for s in range(1, length):
            new = np.logaddexp(ahead[:, s - 1, :1] + pair[0], ahead[:, s - 1, 1:] + pair[1]) + e[:, s]
            ahead[:, s] = np.where(live[:, s, None], new, ahead[:, s - 1])
        for s in range(length - 2, -1, -1):
            x = e[:, s + 1] + behind[:, s + 1]
            new = np.logaddexp(pair[:, 0] + x[:, :1], pair[:, 1] + x[:, 1:])
            behind[:, s] = np.where(live[:, s + 1, None], new, 0)
        z = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        p1 = np.exp(ahead[k, i, 1] + behind[k, i, 1] - z[k])
        mean = np.zeros_like(w)
        np.add.at(mean, flat, p1[owner])
        for s in range(1, length):
            q = np.exp(ahead[:, s - 1, :, None] + pair + (e[:, s] + behind[:, s])[:, None, :] - z[:, None, None])
            mean[len(index) : len(index) + 4] += q[live[:, s]].sum(axis=0).ravel()
        mean[len(index) + 4 :] += np.exp(ahead[:, 0] + behind[:, 0] - z[:, None]).sum(axis=0)
        grad = (mean - gold) / n + decay * w
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.99 * m2 + 0.01 * grad**2
        w -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return Field({x: float(w[j]) for x, j in index.items() if abs(w[j]) > 1e-4}, w[len(index) : len(index) + 4].reshape(2, 2).tolist(), w[len(index) + 4 :].tolist())


_trained: dict[tuple[int, int], Field] = {}


def trained_field(max_pages: int = MAX_PAGES, seed: int = 7) -> Field:
    if (max_pages, seed) not in _trained:
        _trained[max_pages, seed] = train_field(labelled_pages(max_pages, seed))
    return _trained[max_pages, seed]


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page, field.known)
    return "\n\n".join(b.text for b, y in zip(found, field.label(found), strict=True) if y)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", field: Field | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    bound_batches(pages.sparkSession)
    field = field or trained_field()
    types = dict(pages.dtypes)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                texts = [main_text(t, field) for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(tidy(run), f"page_id {types[id_col]}, url {types[url_col]}, text string, n_chars long")
