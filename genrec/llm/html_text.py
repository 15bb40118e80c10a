"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is parsed into leaf blocks (runs of text between block-level tags), each
with features of its ancestor tags, their class and id words, and its text.
The field labels blocks article or not; Viterbi decodes the best labelling and
the article blocks are the main text.

The field is trained on labelled pages.  The crawl has no labels, so
``labelled_pages`` makes them: sentences of a bounded sample of pages are set
into layouts whose parts are known (articles in many containers, menus,
sidebars, notices, adverts, forms, comments).

Defined cases: a null or empty page, or one without article blocks, has an
empty text; broken markup is parsed as far as it goes (a block ends a drawing
left open, an unknown marked section is passed over); repeated rows are parsed
alike; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 200             # pages whose sentences fill the labelled layouts
SAMPLE_CHARS = 1_000_000       # of one of them, at most
LAYOUTS = 500                  # labelled pages the field is trained on
EPOCHS = 80

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html input label legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td textarea tfoot th thead tr ul".split())
ENDS_PARAGRAPH = BLOCK - frozenset("br button input label option optgroup select textarea".split())
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("article aside body div dl footer form header main nav ol section table ul".split())


INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
                   "time tt u var wbr picture".split())
FOREIGN = frozenset(("svg", "math"))
LABEL = "data-article-label"   # the mark of labelled pages


@dataclass
class Block:
    text: str
    tags: frozenset[str]
    names: frozenset[str]
    linked: float
    label: int | None = None
    features: list[str] = field(default_factory=list)
    own: str = ""
    named: bool = False


@dataclass(slots=True)
class _Open:
    """An open element with what its descendants inherit: the sets are shared with the parent unless they grow."""
    tag: str
    tags: frozenset[str]
    names: frozenset[str]
    named: bool
    label: str | None
    hidden: int
    links: int
    scope: int                 # the place of the innermost element that ends a search for open elements
    foreign: int               # the place of the outermost open svg or math, or -1


_OUTSIDE = _Open("", frozenset(), frozenset(), False, None, 0, 0, -1, -1)


def _words(attrs: list[tuple[str, str | None]]) -> list[str]:
    got = dict(attrs)
    words = " ".join(v for k in ("class", "id", "role", "aria-label") if (v := got.get(k)))
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", words).lower()) if w]


class _Parser(HTMLParser):
    """Work and memory are linear in the page: an element inherits counts and sets, and open elements of a tag are found by
    their place.  ``marked`` pages are labelled by the attribute ``LABEL``, which other pages may hold as they like."""

    def __init__(self, marked: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.marked = marked
        self.stack: list[_Open] = []
        self.places: dict[str, list[int]] = {}
        self.parts: list[str] = []
        self.link_chars = 0
        self.blocks: list[Block] = []
        self.title: list[str] = []

    def _top(self) -> _Open:
        return self.stack[-1] if self.stack else _OUTSIDE

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self._top()
            self.blocks.append(Block(text, top.tags, top.names, min(1.0, self.link_chars / max(1, len(text))),
                                     None if top.label is None else int(top.label), own=top.tag, named=top.named))
        self.parts, self.link_chars = [], 0

    def _close_from(self, place: int) -> None:
        for x in self.stack[place:]:
            self.places[x.tag].pop()
        del self.stack[place:]

    def _pop_to(self, names: tuple[str, ...]) -> None:
        """Close the innermost open element of ``names`` that no scope separates from here."""
        place = max((at[-1] for t in names if (at := self.places.get(t))), default=-1)
        if place >= 0 and place >= self._top().scope:
            self._close_from(place)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._flush()
            if self._top().foreign >= 0 and tag != "title":
                self._close_from(self._top().foreign)      # a block ends a drawing that was left open
        if tag in VOID:
            return
        if tag == "body":
            kept = self.stack[:1] if self.stack and self.stack[0].tag == "html" else []
            self._close_from(len(kept))
        if tag in ENDS_PARAGRAPH:
            self._pop_to(("p",))
        if tag in SAME_ENDS:
            self._pop_to(SAME_ENDS[tag])
        top, place, own = self._top(), len(self.stack), _words(attrs)
        known = NAMES.intersection(own)
        label = dict(attrs).get(LABEL) if self.marked else None
        self.stack.append(_Open(
            tag, top.tags if tag in top.tags or tag not in ELEMENTS else top.tags | {tag},
            top.names if known <= top.names else top.names | known, top.named or bool(own), top.label if label is None else label,
            top.hidden + (tag in UNSEEN), top.links + (tag == "a"), place if tag in SCOPES or tag in UNSEEN else top.scope,
            place if tag in FOREIGN and top.foreign < 0 else top.foreign))
        self.places.setdefault(tag, []).append(place)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if self.places.get(tag):
            self._close_from(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        top = self._top()
        if top.hidden:
            if top.tag == "title":
                self.title.append(data)
            return
        self.parts.append(data)
        if top.links:
            self.link_chars += len(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section of whatever name is passed over up to its end."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1


def leaf_blocks(html: str | None, marked: bool = False) -> list[Block]:
    """The leaf blocks of a whole page, in page order, with their features."""
    p = _Parser(marked)
    p.feed(html or "")
    p.close()
    p._flush()
    title = " ".join("".join(p.title).split())
    for i, b in enumerate(p.blocks):
        b.features = _features(b, title, i, len(p.blocks))
    return p.blocks


def _features(b: Block, title: str, i: int, n: int) -> list[str]:
    words = b.text.split()
    out = ["bias", f"own={b.own}", f"words={min(6, len(words).bit_length())}",
           f"link={int(b.linked * 4)}", f"end={b.text[-1] in '.!?…:;'}", f"comma={min(3, b.text.count(','))}"]
    out += [f"in={t}" for t in sorted(b.tags)]
    out += [f"name={w}" for w in sorted(b.names)]
    out += [f"name+{t}={w}" for w in sorted(b.names) for t in sorted(b.tags & {"article", "main"})]
    if not b.named:
        out.append("unnamed")
    if any(c in b.text for c in "©®|»·"):
        out.append("sign")
    if title and (title.startswith(b.text) or b.text.startswith(title)):
        out.append("title")
    if i == 0:
        out.append("first")
    if i == n - 1:
        out.append("last")
    return out


# ---- labelled pages

CONTAINERS = ('<article>', '<article class="post">', '<main>', '<main><article>', '<div class="content">', '<div id="content">',
              '<div class="post-body">', '<div class="entry-content">', '<div class="article-body">', '<section class="story">',
              '<div class="main-text">', '<div id="main">', '<section>', '<div class="page"><div class="text">', '<td class="body">')
OTHERS = {
    "menu": ('<nav>', '<nav class="menu">', '<div class="menu">', '<ul class="nav">', '<div id="navigation">', '<div class="breadcrumb">',
             '<div class="navbar">', '<div class="topbar">'),
    "header": ('<header>', '<div class="header">', '<div id="masthead">', '<header class="site-header">', '<div class="banner">'),
    "sidebar": ('<aside>', '<aside class="sidebar">', '<div class="sidebar">', '<div id="side">', '<div class="widget">',
                '<div class="related">', '<section class="recommended">', '<div class="trending">', '<div class="tags">'),
    "notice": ('<div class="cookie-notice">', '<div class="notice">', '<div id="consent">', '<div role="alert">', '<div class="popup">',
               '<div class="newsletter">', '<div class="subscribe">', '<div class="paywall">', '<div class="disclaimer">'),
    "advert": ('<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement">', '<div class="sponsored">',
               '<aside class="promo">', '<ins class="adsbygoogle">', '<div class="share">', '<div class="social">'),
    "form": ('<form>', '<form class="search">', '<div class="login">', '<form id="signup">', '<fieldset>'),
    "comments": ('<div class="comments">', '<section id="comments">', '<ol class="commentlist">', '<div class="comment">',
                 '<div id="disqus_thread">', '<section class="replies">', '<div class="reviews">', '<div class="discussion">'),
    "footer": ('<footer>', '<div class="footer">', '<footer id="colophon">', '<div class="copyright">', '<div class="legal">'),
}


ELEMENTS = BLOCK | INLINE
# the words of the layouts' class names and ids; others are in no labelled page, so they would have no weight
NAMES = frozenset(w for opening in (*CONTAINERS, *(x for xs in OTHERS.values() for x in xs), '<div class="wrapper">', '<div id="page">')
                  for v in re.findall(r'"([^"]*)"', opening) for w in _words([("class", v)]))


def _closing(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<([a-z0-9]+)", opening)))


def _layout(rng: random.Random, sentences: list[str]) -> str:
    """One page with ``LABEL`` on its parts."""
    def text(low: int, high: int) -> str:
        words = " ".join(rng.choice(sentences) for _ in range(3)).split()
        n = rng.randint(low, high)
        while len(words) < n:
            words += rng.choice(sentences).split()
        return " ".join(words[:n]).replace("&", "&amp;").replace("<", "&lt;")

    def mark(opening: str, label: int) -> str:
        return re.sub(r">$", f' {LABEL}="{label}">', opening)

    def other(kind: str) -> str:
        opening = rng.choice(OTHERS[kind])
        items = []
        for _ in range(rng.randint(1, 5)):
            long = rng.random() < 0.5 and kind not in ("menu", "form")
            t = text(8, 60) if long else text(1, 5)
            if kind == "menu" or rng.random() < (0.5 if kind in ("sidebar", "footer", "advert") else 0.1):
                t = f'<a href="/x">{t}</a>'
            if kind == "form":
                t = rng.choice((f"<label>{t}</label><input>", f"<button>{t}</button>", f"<select><option>{t}<option>{t}</select>",
                                f"<p>{t}</p>", f"<textarea>{t}</textarea>", t))
            elif kind == "footer" and rng.random() < 0.5:
                t = f"&copy; {t}"
            wrap = rng.choice(("{}", "<p>{}</p>", "<p>{}</p>", "<li>{}</li>", "<div>{}</div>", "<h3>{}</h3><p>{}</p>", "{}<br>"))
            items.append(wrap.replace("{}", t))
        return mark(opening, 0) + "".join(items) + _closing(opening)

    def body() -> str:
        opening = rng.choice(CONTAINERS)
        out = [mark(opening, 1)]
        if rng.random() < 0.8:
            out.append(f"<h1>{text(2, 12)}</h1>")
        for _ in range(rng.randint(1, 8)):
            t = text(1, 5) if rng.random() < 0.15 else text(6, 90)
            if rng.random() < 0.1:
                t += f' <a href="/y">{text(1, 4)}</a>'
            out.append(rng.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}", "{}<br>", "<div>{}</div>", "<h2>{}</h2>",
                                   "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<pre>{}</pre>")).replace("{}", t))
            if rng.random() < 0.12:
                out.append(other(rng.choice(("advert", "sidebar", "notice", "form"))))
        if rng.random() < 0.15:
            out.append(other("comments"))
        return "".join(out) + _closing(opening)

    before = [other(k) for k in ("menu", "header", "notice", "advert", "form", "sidebar") if rng.random() < 0.45]
    after = [other(k) for k in ("sidebar", "comments", "advert", "form", "notice", "menu") if rng.random() < 0.4]
    rng.shuffle(before)
    rng.shuffle(after)
    if rng.random() < 0.7:
        after.append(other("footer"))
    shell = rng.choice(('<body data-article-label="0">', '<body data-article-label="0"><div class="wrapper">',
                        '<body data-article-label="0"><div id="page">'))
    return f"<html><head><title>{text(2, 10)}</title></head>{shell}{''.join(before)}{body()}{''.join(after)}</body></html>"


def labelled_pages(sample: list[str], n: int = LAYOUTS, seed: int = 11) -> list[list[Block]]:
    """``n`` labelled pages with sentences of the pages in ``sample``."""
    sentences = [b.text for html in sample for b in leaf_blocks(html) if len(b.text) > 2] or ["One two three."]
    rng = random.Random(seed)
    return [leaf_blocks(_layout(rng, sentences), marked=True) for _ in range(n)]


# ---- the field

@dataclass
class Field:
    """Weights of a two-label field: ``emit`` scores the label article."""

    emit: dict[str, float]
    move: list[list[float]]

    def decode(self, blocks: list[Block]) -> list[int]:
        """Viterbi: the labelling of highest score (ties: not article)."""
        if not blocks:
            return []
        score, back = [0.0, 0.0], []
        for k, b in enumerate(blocks):
            e = sum(self.emit.get(f, 0.0) for f in b.features)
            if k == 0:
                score = [0.0, e]
                continue
            step = [0 if score[0] + self.move[0][y] >= score[1] + self.move[1][y] else 1 for y in (0, 1)]
            score = [score[step[0]] + self.move[step[0]][0], score[step[1]] + self.move[step[1]][1] + e]
            back.append(step)
        y = 0 if score[0] >= score[1] else 1
        out = [y]
        for step in reversed(back):
            y = step[y]
            out.append(y)
        return out[::-1]


def train(pages: list[list[Block]], epochs: int = EPOCHS, rate: float = 0.15, decay: float = 1e-4, rare: int = 3) -> Field:
    """Maximum likelihood by gradient steps (Adam) over all pages at once, forward-backward in log space."""
    pages = [p for p in pages if p]
    counts: dict[str, int] = {}
    for p in pages:
        for b in p:
            for f in b.features:
                counts[f] = counts.get(f, 0) + 1
    known = {f: k for k, f in enumerate(sorted(f for f, c in counts.items() if c >= rare))}
    n, length = len(pages), max((len(p) for p in pages), default=0)
    if not known or not length:
        return Field({}, [[0.0, 0.0], [0.0, 0.0]])
    at = [(i, t, known[f]) for i, p in enumerate(pages) for t, b in enumerate(p) for f in b.features if f in known]
    page, place, feat = (np.array(x) for x in zip(*at, strict=True))
    there = np.zeros((n, length), bool)
    label = np.zeros((n, length), int)
    for i, p in enumerate(pages):
        there[i, :len(p)] = True
        label[i, :len(p)] = [b.label or 0 for b in p]
    w, move = np.zeros(len(known)), np.zeros((2, 2))
    m = [np.zeros_like(w), np.zeros_like(move)]
    v = [np.zeros_like(w), np.zeros_like(move)]
    seen = np.zeros((2, 2))
    both = there[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((label[:, :-1] == a) & (label[:, 1:] == b) & both).sum()
    cell = page * length + place
    for step in range(1, epochs + 1):
        e = np.zeros((n, length, 2))
        e[..., 1] = np.bincount(cell, w[feat], n * length).reshape(n, length)
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0]
        for t in range(1, length):
            nxt = np.logaddexp.reduce(fwd[:, t - 1, :, None] + move, axis=1) + e[:, t]
            fwd[:, t] = np.where(there[:, t, None], nxt, fwd[:, t - 1])
        for t in range(length - 2, -1, -1):
            nxt = np.logaddexp.reduce(move + (bwd[:, t + 1] + e[:, t + 1])[:, None, :], axis=2)
            bwd[:, t] = np.where(there[:, t + 1, None], nxt, 0.0)
        total = np.logaddexp.reduce(fwd[:, -1], axis=1)
        on = np.exp(fwd[..., 1] + bwd[..., 1] - total[:, None]) * there
        edge = fwd[:, :-1, :, None] + move + (bwd[:, 1:] + e[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(edge) * both[..., None, None]).sum(axis=(0, 1))
        grads = [np.bincount(feat, (label - on)[page, place], len(w)) / n - decay * w, (seen - expected) / n - decay * move]
        for k, (x, g) in enumerate(zip((w, move), grads, strict=True)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            x += rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return Field({f: float(w[k]) for f, k in known.items()}, move.tolist())


def main_text(html: str | None, model: Field) -> str:
    blocks = leaf_blocks(html)
    return " ".join(b.text for b, y in zip(blocks, model.decode(blocks), strict=True) if y)


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Field:
    """A field trained on layouts filled from at most ``sample`` pages of up to ``SAMPLE_CHARS`` characters, the first by
    a hash; collects those."""
    # the bound of the sample comes from a narrow scan; only sampled pages reach the driver
    key = F.xxhash64("page_id", "url").alias("k")
    short = pages.where(F.char_length("html") <= SAMPLE_CHARS)
    keys = [r[0] for r in short.select(key).orderBy("k").limit(sample).collect()]
    if not keys:
        return train(labelled_pages([]))
    got = short.select(key, "html").where(F.col("k") <= keys[-1]).orderBy("k", "html").limit(sample).collect()
    return train(labelled_pages([r["html"] for r in got]))


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; without ``model``, one is fitted first.  Ids pass through as they are."""
    used = model or fit(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py(), used).encode("utf-8", "replace").decode() for h in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string")
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
