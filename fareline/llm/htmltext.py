"""Main text of web pages: a recurrent network labels every block of a page in view of the whole page."""

from __future__ import annotations

import html as references
import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import pick, slices

# Bounds of the fit: pages that it may learn from, and the pages it lays out anew from their texts.
SAMPLE_PAGES = 300
LONGEST_SAMPLED = 1 << 20
LAID_OUT = 1500
PATH_BUCKETS, WORD_BUCKETS = 1024, 512
PATH_DIM, WORD_DIM, SHAPE_DIM, HIDDEN = 24, 8, 8, 24
EPOCHS, BATCH, RATE = 8, 32, 0.02
# Elements of a path that count, the innermost first.
DEPTH = 64
# Leaves of the pages that go through the network side by side.
_CELLS = 1 << 15
_REMEMBERED = 200_000
_GRAIN = 1 << 52

# --- fixed values: HTML elements ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript textarea title select option svg math iframe object audio video canvas "
                   "noembed noframes datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr img input".split())
CLOSED_BY_BLOCK = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                            "main menu nav ol p pre section table ul".split())
ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
HOLDS_SAME = frozenset("ul ol dl table body article section div".split())
IN_HEAD = frozenset("base link meta title script style noscript template".split())
# -----------------------------------

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?i)(?<![\w-])(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGIT = re.compile(r"\d")


@dataclass
class Leaf:
    """A block: its text, what share of it is link text, and the names of the elements it lies in, the outermost first."""

    path: tuple[str, ...]
    text: str
    linked: int = 0


@dataclass
class _Open:
    tag: str
    names: tuple[str, ...]


@dataclass
class _Page:
    """Elements that are open, and the block that is being read."""

    stack: list[_Open] = field(default_factory=list)
    hidden: int = 0
    links: int = 0
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    leaves: list[Leaf] = field(default_factory=list)

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                path = tuple(name for x in self.stack[-DEPTH:] for name in x.names[x.tag in INLINE:])
                self.leaves.append(Leaf(path, text, min(self.linked, len(text))))
            self.parts = []
        self.linked = 0

    def _cut(self, at: int) -> None:
        for x in self.stack[at:]:
            self.hidden -= x.tag in UNSEEN
            self.links -= x.tag == "a"
        del self.stack[at:]

    def read(self, raw: str) -> None:
        if self.stack and self.stack[-1].tag == "head" and not raw.isspace():
            self._cut(len(self.stack) - 1)
        if self.hidden:
            return
        text = references.unescape(raw)
        self.parts.append(text)
        if self.links:
            self.linked += len(text.strip())

    def opened(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self.end_block()
        if tag not in IN_HEAD and self.stack and self.stack[-1].tag == "head":
            self._cut(len(self.stack) - 1)
        if tag in CLOSED_BY_BLOCK:
            self._end(("p",), INLINE, False)
        if tag in ENDS_SAME:
            self._end(ENDS_SAME[tag], HOLDS_SAME, True)
        if tag == "br" or tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        names = [f"<{tag}>"]
        for kind, *values in _NAMED.findall(attributes):
            names += [f"{kind.lower()}:{piece.lower()}" for piece in _PIECES.findall(references.unescape("".join(values)))]
        self.stack.append(_Open(tag, tuple(names)))
        self.hidden += tag in UNSEEN
        self.links += tag == "a"

    def _end(self, tags: tuple[str, ...], edge: frozenset[str], stops: bool) -> None:
        """Ends the innermost element of ``tags``, searched through elements inside ``edge`` or (``stops``) outside of it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag in tags:
                self._cut(i)
                return
            if (self.stack[i].tag in edge) == stops:
                return

    def closed(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_block()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                self._cut(i)
                return
            if tag in INLINE and self.stack[i].tag not in INLINE:
                return


def leaves_of(page: str | None) -> list[Leaf]:
    """The blocks of a page in order; a block ends where any element but an inline one begins or ends.

    Scripts, styles, comments, the head and other elements that are not shown give none. Elements left open end as
    browsers end them, or with the page.
    """
    page = page or ""
    state, at, n = _Page(), 0, len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        if m is None:
            state.read(page[at:])
            break
        if m.start() > at:
            state.read(page[at:m.start()])
        at = max(m.end(), m.start() + 1)
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            state.closed(tag)
            continue
        state.opened(tag, m[3])
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = n if end is None else end.start()
    state.end_block()
    return state.leaves


class _Buckets(dict):
    """The bucket of each name seen so far."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, name: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        at = self[name] = zlib.crc32(name.encode("utf-8", "replace")) % self.buckets
        return at


class Features:
    """Numbers of a leaf."""

    def __init__(self) -> None:
        self.names, self.seen_words = _Buckets(PATH_BUCKETS), _Buckets(WORD_BUCKETS)

    def path(self, leaf: Leaf) -> list[int]:
        return list(map(self.names.__getitem__, leaf.path or ("",)))

    def words(self, leaf: Leaf) -> list[int]:
        return list(map(self.seen_words.__getitem__, leaf.text.lower().split()))

    @staticmethod
    def shape(leaf: Leaf, place: int, count: int) -> list[float]:
        n = len(leaf.text)
        words = leaf.text.count(" ") + 1
        return [min(1.0, n / 400), min(1.0, words / 60), leaf.linked / n, float(leaf.text[-1] in ".!?:;\"”»"),
                len(_DIGIT.findall(leaf.text)) / n, place / max(1, count - 1), min(1.0, count / 60),
                float(leaf.text[:1].isupper())]


@dataclass(frozen=True)
class PageModel:
    """Weights of the labeller by name."""

    weights: dict[str, np.ndarray]


def _initial_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    size = PATH_DIM + WORD_DIM + SHAPE_DIM
    made = {"path": rng.normal(0, 0.05, (PATH_BUCKETS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORD_BUCKETS, WORD_DIM)),
            "out": rng.normal(0, 0.2, (2 * HIDDEN + size, 1)), "bias": np.zeros(1)}
    for way in ("ahead", "back"):
        made[f"{way}_in"] = rng.normal(0, 1 / np.sqrt(size), (size, 4 * HIDDEN))
        made[f"{way}_state"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        made[f"{way}_bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
    return {k: v.astype(np.float32) for k, v in made.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Batch:
    """Pages side by side, padded to the longest: flat lists of path and word buckets with the cell each belongs to."""

    mask: np.ndarray
    shape: np.ndarray
    path: tuple[np.ndarray, np.ndarray, np.ndarray]
    word: tuple[np.ndarray, np.ndarray, np.ndarray]

    @classmethod
    def of(cls, pages: Sequence[Sequence[Leaf]], features: Features) -> Batch:
        long = max(map(len, pages))
        mask = np.zeros((len(pages), long), bool)
        shape = np.zeros((len(pages), long, SHAPE_DIM), np.float32)
        lists: dict[str, tuple[list, list, list]] = {"path": ([], [], []), "word": ([], [], [])}
        for i, leaves in enumerate(pages):
            mask[i, :len(leaves)] = True
            for j, leaf in enumerate(leaves):
                shape[i, j] = features.shape(leaf, j, len(leaves))
                for name, found in (("path", features.path(leaf)), ("word", features.words(leaf))):
                    rows, cells, weights = lists[name]
                    rows += found
                    cells += [i * long + j] * len(found)
                    weights += [1 / len(found) if name == "word" else 0.5] * len(found)
        flat = {name: (np.array(r, np.int32), np.array(c, np.int32), np.array(w, np.float32)) for name, (r, c, w) in lists.items()}
        return cls(mask, shape, flat["path"], flat["word"])


def _vectors(batch: Batch, weights: dict[str, np.ndarray]) -> np.ndarray:
    """Inputs ``(pages, leaves, size)``: summed path vectors, mean word vectors and the shape."""
    pages, long = batch.mask.shape
    made = []
    for name in ("path", "word"):
        rows, cells, share = getattr(batch, name)
        table = weights[name]
        out = np.empty((pages * long, table.shape[1]), np.float32)
        for d in range(table.shape[1]):  # a weighted count a column adds up the vectors of a cell
            out[:, d] = np.bincount(cells, weights=table[rows, d] * share, minlength=pages * long)
        made.append(out.reshape(pages, long, -1))
    return np.concatenate([*made, batch.shape], axis=2)


def _run(inputs: np.ndarray, mask: np.ndarray, weights: dict[str, np.ndarray], way: str, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states ``(pages, leaves, HIDDEN)`` of one direction, and with ``keep`` what the way back needs."""
    pages, long, _ = inputs.shape
    gates_in = inputs @ weights[f"{way}_in"] + weights[f"{way}_bias"]
    recur = weights[f"{way}_state"]
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    out = np.zeros((pages, long, HIDDEN), np.float32)
    steps = []
    for t in (range(long) if way == "ahead" else range(long - 1, -1, -1)):
        gates = gates_in[:, t] + h @ recur
        three = _sigmoid(gates[:, :3 * HIDDEN])
        i, f, o = three[:, :HIDDEN], three[:, HIDDEN:2 * HIDDEN], three[:, 2 * HIDDEN:]
        g = np.tanh(gates[:, 3 * HIDDEN:])
        alive = mask[:, t, None]
        new = f * c + i * g
        squashed = np.tanh(new)
        if keep:
            steps.append((t, h, c, i, f, o, g, squashed))
        c = np.where(alive, new, c)
        h = np.where(alive, o * squashed, h)
        out[:, t] = h
    return out, steps


def _scores(batch: Batch, weights: dict[str, np.ndarray]) -> np.ndarray:
    inputs = _vectors(batch, weights)
    states = [_run(inputs, batch.mask, weights, way, False)[0] for way in ("ahead", "back")]
    return _sigmoid((np.concatenate([*states, inputs], axis=2) @ weights["out"])[..., 0] + weights["bias"])


def _gradients(batch: Batch, labels: np.ndarray, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Of the mean cross entropy over the leaves, through time in both directions."""
    inputs = _vectors(batch, weights)
    runs = {way: _run(inputs, batch.mask, weights, way, True) for way in ("ahead", "back")}
    whole = np.concatenate([runs["ahead"][0], runs["back"][0], inputs], axis=2)
    p = _sigmoid((whole @ weights["out"])[..., 0] + weights["bias"])
    off = np.where(batch.mask, p - labels, 0).astype(np.float32) / batch.mask.sum()
    found = {"out": np.einsum("plh,pl->h", whole, off)[:, None], "bias": off.sum(keepdims=True).reshape(1)}
    down = off[..., None] * weights["out"][:, 0]
    into = down[..., 2 * HIDDEN:].copy()
    for k, way in enumerate(("ahead", "back")):
        recur = weights[f"{way}_state"]
        gates = np.zeros((*batch.mask.shape, 4 * HIDDEN), np.float32)
        d_recur = np.zeros_like(recur)
        dh = np.zeros((len(inputs), HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        for t, h, c, i, f, o, g, squashed in reversed(runs[way][1]):
            alive = batch.mask[:, t, None]
            dh = dh + down[:, t, k * HIDDEN:(k + 1) * HIDDEN]
            d_new = dc + dh * o * (1 - squashed * squashed)
            at = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f), dh * squashed * o * (1 - o),
                                 d_new * i * (1 - g * g)], axis=1) * alive
            gates[:, t] = at
            d_recur += h.T @ at
            dh = np.where(alive, at @ recur.T, dh)
            dc = np.where(alive, d_new * f, dc)
        found[f"{way}_state"] = d_recur
        found[f"{way}_bias"] = gates.sum((0, 1))
        found[f"{way}_in"] = np.einsum("plx,plg->xg", inputs, gates)
        into += gates @ weights[f"{way}_in"].T
    flat = into.reshape(-1, into.shape[2])
    for name, part in (("path", flat[:, :PATH_DIM]), ("word", flat[:, PATH_DIM:PATH_DIM + WORD_DIM])):
        rows, cells, share = getattr(batch, name)
        found[name] = np.stack([np.bincount(rows, weights=part[cells, d] * share, minlength=len(weights[name]))
                                for d in range(part.shape[1])], axis=1)
    return found


def train(pages: Sequence[tuple[Sequence[Leaf], Sequence[int]]], epochs: int = EPOCHS, seed: int = 1) -> PageModel:
    """A labeller from pages with a label (1: main text) for every leaf; Adam steps over batches of pages of like length."""
    rng = np.random.default_rng(seed)
    weights = _initial_weights(rng)
    features = Features()
    order = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
    batches = []
    for at in range(0, len(order), BATCH):
        part = order[at:at + BATCH]
        batch = Batch.of([leaves for leaves, _ in part], features)
        labels = np.zeros(batch.mask.shape, np.float32)
        for i, (_, told) in enumerate(part):
            labels[i, :len(told)] = told
        batches.append((batch, labels))
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for at in rng.permutation(len(batches)):
            step += 1
            batch, labels = batches[at]
            if rng.random() < 0.5:  # so that words sway no block whose path is clear
                batch = replace(batch, word=(*batch.word[:2], np.zeros_like(batch.word[2])))
            for name, slope in _gradients(batch, labels, weights).items():
                slope = np.clip(slope, -1, 1).astype(np.float32)
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.99 * second[name] + 0.01 * slope * slope
                weights[name] = weights[name] - rate * (first[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-7).astype(np.float32)
    return PageModel(weights)


def label(pages: Sequence[Sequence[Leaf]], model: PageModel, features: Features) -> list[np.ndarray]:
    """How likely each leaf of each page is main text; pages of like length go through the network together."""
    out: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
    order = sorted((i for i, leaves in enumerate(pages) if leaves), key=lambda i: -len(pages[i]))
    while order:
        many = max(1, _CELLS // len(pages[order[0]]))
        now, order = order[:many], order[many:]
        scores = _scores(Batch.of([pages[i] for i in now], features), model.weights)
        for i, row in zip(now, scores, strict=True):
            out[i] = row[:len(pages[i])]
    return out


# --- what training pages are laid out with: names of elements, classes and ids as the web uses them ---
MAIN_PLACES = ("article", "main", "div.content", "div#content", "div.article-body", "div.post-content", "div.entry-content",
               "section.story", "div.main-text", "div[role=main]", "div.post", "div.article", "section", "div", "div.text", "div#main",
               "article.post", "div[itemprop=articleBody]", "td.body", "div.blog-post", "div.page-body", "div.story-body")
NAVIGATION = ("nav", "ul.menu", "div.nav", "div#navigation", "div.navbar", "nav.breadcrumb", "div.breadcrumbs", "div.menu", "ul.nav-links",
              "div[role=navigation]", "ol.pagination", "div.pager", "div.tabs", "div.toolbar", "div.site-menu", "div.toc")
TOPS = ("header", "div.header", "div#header", "header.site-header", "div.masthead", "div.topbar", "div[role=banner]", "div.banner", "div.logo")
BOTTOMS = ("footer", "div.footer", "div#footer", "footer.site-footer", "div.copyright", "div[role=contentinfo]", "div.legal", "div.bottom",
           "section.footer-links", "div.imprint")
SIDES = ("aside", "div.sidebar", "div#sidebar", "div.widget", "div.related", "section.related-posts", "div[role=complementary]",
         "div.recommended", "div.tags", "div.popular", "ul.related-articles", "div.author-bio", "div.share", "div.social", "div.rail",
         "div.trending", "section.more-stories", "div.teaser")
NOTICES = ("div.cookie", "div.cookie-notice", "div.notice", "div.alert", "div.consent", "div.gdpr-banner", "div.popup", "div.modal",
           "div[role=alert]", "div.warning", "section.announcement", "p.disclaimer", "div.paywall", "div#cookie-banner", "dialog", "div.toast")
ADVERTS = ("div.ad", "div.ads", "div.advert", "div.advertisement", "aside.ad", "div.sponsored", "div.promo", "div.promotion", "section.sponsor",
           "div#ad", "div.banner-ad", "div.ad-slot", "p.ad", "div.commercial", "div.outbrain")
FORMS = ("form", "form.search", "div.newsletter", "div.subscribe", "form.login", "div.search-box", "form.comment-form", "div.signup",
         "fieldset", "form.contact", "div.poll")
REMARKS = ("div.comments", "section.comments", "div#comments", "ul.comment-list", "div.comment", "section.responses", "div.discussion",
           "div.reviews", "div.replies", "ol.commentlist", "div.disqus", "section.user-comments", "div.reader-comments", "div.comment-thread")
LIKELY_WORDS = {
    "nav": "Home About Contact News Products Services Blog Login Next Previous Menu Archive".split(),
    "notice": "We use cookies to improve your experience. Accept all By continuing you agree to our privacy policy.".split(),
    "ad": "Advertisement Sponsored Buy now Limited offer Shop the best deals today Save".split(),
    "form": "Subscribe Email Your name Search Submit Sign up Password Log in Message Send".split(),
    "side": "Related articles Read more Share this Popular Tags Follow us You may also like".split(),
    "bottom": "Copyright All rights reserved Terms Privacy Imprint Sitemap".split(),
    "remarks": "Reply says Comments Leave a reply Great post, thanks! I agree. likes Report".split(),
    "top": "Welcome Site The Daily Log in Register Search".split()}
# -------------------------------------------------------------------------------------------------------


def _placed(place: str, inner: str) -> str:
    m = re.match(r"([a-z]+)(?:\.([\w-]+)|#([\w-]+)|\[([\w-]+)=([\w-]+)\])?$", place)
    tag = m[1]
    attribute = f' class="{m[2]}"' if m[2] else f' id="{m[3]}"' if m[3] else f' {m[4]}="{m[5]}"' if m[4] else ""
    return f"<{tag}{attribute}>{inner}</{tag}>"


class _Layout:
    """Pages made of the texts of others, in which each block says by a mark whether it is main text."""

    MAIN, OTHER = "\ue000", "\ue001"

    def __init__(self, texts: Sequence[str], seed: int):
        self.rng = random.Random(seed)
        self.texts = [t for t in texts if t] or ["Some words of a text that stands for any other."]

    def _words(self, least: int, most: int) -> str:
        words = self.rng.choice(self.texts).split()
        n = self.rng.randint(least, most)
        at = self.rng.randrange(max(1, len(words) - n + 1))
        return references.escape(" ".join(words[at:at + n]), quote=False)

    def _likely(self, kind: str) -> str:
        words = LIKELY_WORDS[kind]
        at = self.rng.randrange(len(words))
        return " ".join(words[at:at + self.rng.randint(1, 6)])

    def _other(self, kind: str, most: int = 12) -> str:
        return self.OTHER + (self._words(1, most) if self.rng.random() < 0.6 else self._likely(kind))

    def _links(self, kind: str) -> str:
        items = [f'<a href="/{self.rng.randrange(99)}">{self._other(kind, 3)}</a>' for _ in range(self.rng.randint(1, 7))]
        style = self.rng.randrange(4)
        if style == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        if style == 1:
            return "".join(f"<div>{x}</div>" for x in items)
        if style == 2:
            return "<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>"
        return "<p>" + " | ".join(items) + "</p>"

    def _prose(self, kind: str) -> str:
        """Boilerplate that is written like main text."""
        tag = self.rng.choice(["p", "p", "div", "span", "h3", "h4", ""])
        parts = [self._other(kind, 40) for _ in range(self.rng.randint(1, 3))]
        return "".join(f"<{tag}>{x}</{tag}>" if tag else f"{x}<br>" for x in parts)

    def _boilerplate(self, kind: str) -> str:
        places = {"nav": NAVIGATION, "top": TOPS, "bottom": BOTTOMS, "side": SIDES, "notice": NOTICES, "ad": ADVERTS, "form": FORMS,
                  "remarks": REMARKS}[kind]
        place = self.rng.choice(places)
        inner = {"nav": self._links, "bottom": self.rng.choice([self._links, self._prose])}.get(
            kind, self.rng.choice([self._prose, self._prose, self._links]))(kind)
        if kind == "form":
            inner = f"<label>{self._other('form', 3)}</label><input name=x>{inner if self.rng.random() < 0.4 else ''}" \
                    f"<button>{self._other('form', 2)}</button>"
        if kind == "remarks":
            each = self.rng.choice(["div.comment", "li", "article.comment", "div.comment-body", "p", "div.reply"])
            inner = (f"<h3>{self._other('remarks', 3)}</h3>" if self.rng.random() < 0.6 else "") + "".join(
                _placed(each, (f"<b>{self._other('remarks', 2)}</b>" if self.rng.random() < 0.5 else "") + self._prose("remarks"))
                for _ in range(self.rng.randint(1, 4)))
        if kind == "top" and self.rng.random() < 0.5:
            inner = f"<h1>{self._other('top', 6)}</h1>" + (self._boilerplate("nav") if self.rng.random() < 0.5 else "")
        return _placed(place, inner)

    def _paragraph(self) -> str:
        text = self._words(1, 6) if self.rng.random() < 0.15 else self._words(8, 90)
        tag = self.rng.choice(["p", "p", "p", "p", "p", "li", "blockquote", "h2", "h3", "pre", "td", "div", "dd", "figcaption"])
        if self.rng.random() < 0.2:
            words = text.split(" ")
            at = self.rng.randrange(len(words))
            inline = self.rng.choice(["b", "em", "a href='/x'", "strong", "span", "code"])
            words[at] = f"<{inline}>{words[at]}</{inline.split()[0]}>"
            text = " ".join(words)
        if tag == "li":
            return f"<ul>{''.join(f'<li>{self.MAIN}{x}</li>' for x in (text, self._words(2, 15)))}</ul>"
        if tag == "td":
            return f"<table><tr><td>{self.MAIN}{text}</td><td>{self.MAIN}{self._words(1, 5)}</td></tr></table>"
        if tag == "p" and self.rng.random() < 0.2:
            return f"<p><b>{self.MAIN}{text}<br>{self.MAIN}{self._words(3, 30)}"
        return f"<{tag}>{self.MAIN}{text}" + ("" if tag == "p" and self.rng.random() < 0.15 else f"</{tag}>")

    def page(self) -> str:
        rng = self.rng
        title = f"<h1>{self.MAIN}{self._words(2, 12)}</h1>" if rng.random() < 0.8 else ""
        body = [self._paragraph() for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12]))]
        if rng.random() < 0.1:  # lines that repeat, as in verses, lists and junk
            body[rng.randrange(len(body)):0] = [f"<p>{self.MAIN}{self._words(1, 12)}</p>"] * rng.randint(3, 60)
        for kind, chance in (("ad", 0.25), ("side", 0.2), ("notice", 0.1), ("form", 0.1), ("remarks", 0.15), ("nav", 0.08)):
            if rng.random() < chance:
                at = len(body) if kind == "remarks" else rng.randint(0, len(body))
                body.insert(at, self._boilerplate(kind))
        place = rng.choice(MAIN_PLACES + ("article",) * 8)
        if rng.random() < 0.05:
            place = f"div.{''.join(rng.choice('abcdefghijklmnoprstuvw') for _ in range(rng.randint(2, 7)))}"
        main = _placed(place, title + "".join(body))
        if place.startswith("td"):
            main = f"<table><tr>{main}</tr></table>"
        for _ in range(rng.choice([0, 0, 1, 2])):
            main = _placed(rng.choice(["div", "div.wrapper", "div.container", "main", "section", "div.page", "div.row"]), main)
        before = [self._boilerplate(k) for k, c in (("top", 0.5), ("notice", 0.3), ("nav", 0.7), ("ad", 0.5), ("form", 0.2), (
            "side", 0.15)) if rng.random() < c]
        after = [self._boilerplate(k) for k, c in (("remarks", 0.35), ("side", 0.4), ("ad", 0.25), ("form", 0.2), ("notice", 0.15), (
            "nav", 0.15), ("bottom", 0.75)) if rng.random() < c]
        if rng.random() < 0.5:
            rng.shuffle(before)
        return f"<html><head><title>x</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"

    def labelled(self) -> tuple[list[Leaf], list[int]]:
        leaves, labels = [], []
        for leaf in leaves_of(self.page()):
            main = leaf.text.count(self.MAIN) >= leaf.text.count(self.OTHER)
            text = " ".join(leaf.text.replace(self.MAIN, "").replace(self.OTHER, "").split())
            if text:
                leaves.append(Leaf(leaf.path, text, min(leaf.linked, len(text))))
                labels.append(int(main))
        return leaves, labels


def told_by_elements(leaves: Sequence[Leaf]) -> list[int] | None:
    """Labels of a page that says where its only article is by an element, and has nothing in it that says it is no text."""
    inside = ["<article>" in leaf.path for leaf in leaves]
    unsure = {"<aside>", "<nav>", "<form>", "<footer>", "<header>"}
    if not any(inside) or any(i and (unsure & set(leaf.path) or any(":" in name for name in leaf.path))
                              for i, leaf in zip(inside, leaves, strict=True)):
        return None
    return [int(i) for i in inside]


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES, laid_out: int = LAID_OUT, html_col: str = "html") -> PageModel:
    """A model from about ``sample`` of the pages, and ``laid_out`` pages that are made of their texts.

    The sampled pages are drawn by a hash of their html among those of up to ``LONGEST_SAMPLED`` characters, equal ones once, which
    bounds what reaches the driver; equal tables give equal models. Those
    that mark their article by an element are learned from as they are; all give the texts of the pages laid out, where main text and
    boilerplate of every kind stand in many kinds of elements. An empty table gives a model of a fixed text.
    """
    rows = pick(pages, (html_col, "string", "html"))
    share = min(1.0, sample / max(1, rows.count()))
    hashed = rows.filter(F.length("html") <= LONGEST_SAMPLED).withColumn("h", F.xxhash64("html"))
    sampled = hashed.filter(F.pmod("h", F.lit(_GRAIN)) < F.lit(int(share * _GRAIN))).groupBy("h").agg(
        F.min("html").alias("html"))
    drawn = [r.html for r in sorted(sampled.collect(), key=lambda r: r.h)]
    told, texts = [], []
    for page in drawn:
        leaves = leaves_of(page)
        labels = told_by_elements(leaves)
        if labels is not None:
            told.append((leaves, labels))
        texts += [leaf.text[:4000] for leaf in leaves]
    layout = _Layout(texts, 7)
    return train(told + [layout.labelled() for _ in range(laid_out)])


def extract(pages: DataFrame, model: PageModel, with_blocks: bool = False, id_col: str = "page_id", html_col: str = "html",
            url_col: str = "url") -> DataFrame:
    """``(page_id, url, text)`` of every row; ``text`` joins the blocks the model takes for main text, in page order.

    ``with_blocks`` adds ``blocks``, the ``path, text, score`` of every block of the page. Character references are decoded, white
    space in a block is one space. Null html counts as empty; a page without main text has the empty text. Whole pages are
    read, the very long ones by themselves, and nothing is cut or capped. Repeated rows come out alike, null ids and urls stay null,
    an empty table gives an empty result. One pass, no shuffle.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    block = pa.struct([("path", pa.string()), ("text", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            leaves = [leaves_of(page) for page in batch.column(2).to_pylist()]
            scores = label(leaves, shared.value, features)
            pairs = [list(zip(of, by.tolist(), strict=True)) for of, by in zip(leaves, scores, strict=True)]
            columns = [*batch.columns[:2], pa.array([" ".join(x.text for x, s in page if s >= 0.5) for page in pairs], pa.string())]
            if with_blocks:
                columns.append(pa.array([[{"path": "".join(x.path), "text": x.text, "score": s} for x, s in page]
                                         for page in pairs], pa.list_(block)))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = pick(pages, (id_col, "long", "page_id"), (url_col, "string", "url"), (html_col, "string", "html"))
    kind = "page_id long, url string, text string" + (
        ", blocks array<struct<path:string,text:string,score:double>>" if with_blocks else "")
    names = ["page_id", "url", "text", "blocks"][:3 + with_blocks]
    return rows.mapInArrow(run, kind)
