"""Main text of web pages with a recurrent block labeller.

A page is a sequence of leaf blocks. Each block has a vector of its tag path
(hashed tags and words of class, id and role), of its hashed words and of a few
sizes. A bidirectional LSTM in numpy reads the whole sequence in both
directions, so each block is labelled in the context of all others, and the
blocks labelled as main text are joined.

The labeller is trained on a bounded sample of pages, ``TRAINING_PAGES``
(a parameter). Blocks below the elements with which authors mark the main text
are positive. So that it learns more than these elements, most of the pages are
dressed anew: the same blocks in other containers, between menus, sidebars,
notices, adverts, forms and comments of many forms.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekfold.llm.html_blocks import Block, Path, blocks
from weekfold.llm.linear import sigmoid
from weekfold.llm.pretokens import slices

TRAINING_PAGES = 400
TRAINING_CHARS = 500_000
SLICE_CHARS = 8_000_000  # characters of pages that are parsed and labelled together
DRESSINGS = 2
PATH_WIDTH = 192
WORD_WIDTH = 96
SIZES = 11
WIDTH = PATH_WIDTH + WORD_WIDTH + SIZES
INNER = 32
HIDDEN = 24
EPOCHS = 10
STRIP = 64  # blocks of a training sequence
GROUP_BLOCKS = 16_384  # blocks labelled together, padding included

# Names that mark the main text, and names that mark what is not part of it.
MAIN_TAGS = ("article", "main")
MAIN_NAMES = (
    "article", "articlebody", "body", "content", "entry", "main", "page", "post", "story", "text",
)
OTHER_TAGS = ("nav", "header", "footer", "aside", "form", "dialog", "menu")
OTHER_NAMES = {
    "menu": ("menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "tabs", "topbar", "toolbar", "pagination"),
    "header": ("header", "masthead", "banner", "branding", "logo", "top"),
    "footer": ("footer", "bottom", "copyright", "legal", "colophon", "imprint"),
    "sidebar": ("sidebar", "aside", "widget", "related", "recommended", "trending", "rail", "popular", "teaser", "tags"),
    "notice": ("cookie", "consent", "notice", "gdpr", "alert", "popup", "modal", "overlay", "privacy", "paywall"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "adbox", "banner", "affiliate"),
    "form": ("search", "login", "subscribe", "newsletter", "signup", "contact", "form"),
    "comments": ("comments", "comment", "replies", "disqus", "discussion", "respond", "responses", "thread", "feedback"),
}
OTHER_TEXTS = {
    "menu": ("Home", "About", "Contact", "News", "Sign in", "Archive", "Start", "Accueil", "Inicio", "Kontakt"),
    "header": ("Welcome", "Daily news", "The weekly", "Magazine"),
    "footer": ("All rights reserved", "Copyright 2024", "Privacy policy", "Terms of use", "Imprint", "© 2023"),
    "sidebar": ("Related articles", "Most read", "You may also like", "Tags", "Follow us", "Share this"),
    "notice": ("We use cookies to improve this site", "Accept all", "This site uses cookies", "Manage consent"),
    "advert": ("Advertisement", "Sponsored", "Buy now", "Limited offer", "Anzeige", "Publicité"),
    "form": ("Search", "Subscribe to our newsletter", "Your email", "Send", "Password", "Log in"),
    "comments": ("Comments", "Leave a reply", "3 comments", "Reply", "says:", "Post a comment"),
}


@lru_cache(maxsize=200_000)
def _slot(name: str, width: int) -> tuple[int, float]:
    h = xxhash.xxh64_intdigest(name)
    return h % width, 1.0 if h >> 63 else -1.0


class PathVectors:
    """Sums of the hashed tags and names of an element and all that it is in; those of recent elements are kept."""

    KEPT = 4_096

    def __init__(self):
        self.known: dict[Path, np.ndarray] = {}

    def of(self, path: Path | None) -> np.ndarray:
        missing = []
        while path is not None and path not in self.known:
            missing.append(path)
            path = path.parent
        row = np.zeros(PATH_WIDTH, dtype=np.float32) if path is None else self.known[path]
        if len(self.known) + len(missing) > self.KEPT:
            self.known.clear()
        for one in reversed(missing):
            row = row.copy()
            for name in ("t" + one.tag, *("n" + n for n in one.names)):
                at, sign = _slot(name, PATH_WIDTH)
                row[at] += sign
            self.known[one] = row
        return row


def vectors(page: list[Block], start: int = 0, stop: int | None = None, paths: PathVectors | None = None) -> np.ndarray:
    """One row per block (of a range): tag path, words, sizes."""
    stop = len(page) if stop is None else min(stop, len(page))
    paths = paths or PathVectors()
    out = np.zeros((stop - start, WIDTH), dtype=np.float32)
    for i in range(start, stop):
        b, row = page[i], out[i - start]
        if b.path is not None:
            row[:PATH_WIDTH] = paths.of(b.path)
            for name in ("l" + b.path.tag, *("m" + n for n in b.path.names)):
                at, sign = _slot(name, PATH_WIDTH)
                row[at] += sign
        words = b.text.split()
        hashed = row[PATH_WIDTH:PATH_WIDTH + WORD_WIDTH]
        for w in words:
            at, sign = _slot("w" + w.lower(), WORD_WIDTH)
            hashed[at] += sign
        hashed /= max(float(np.sqrt(hashed @ hashed)), 1.0)
        n = len(b.text)
        row[PATH_WIDTH + WORD_WIDTH:] = (
            np.log1p(n) / 4, np.log1p(len(words)) / 3, b.links / n, np.log1p(b.tags) / 2,
            sum(map(b.text.count, ".,;:!?")) / len(words), b.text[-1] in ".!?…:\"”»", b.text[:1].isupper(),
            i / len(page), (len(page) - 1 - i) / len(page), np.log1p(len(page)) / 4,
            (b.path.depth if b.path else 0) / 8,
        )
    return out


class Labeller:
    """A bidirectional LSTM over block vectors with one output per block."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def matrix(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.w = {"in": matrix(WIDTH, INNER), "in_b": np.zeros(INNER, np.float32)}
        for way in ("f", "b"):
            self.w[way + "x"] = matrix(INNER, 4 * HIDDEN)
            self.w[way + "h"] = matrix(HIDDEN, 4 * HIDDEN)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1.0  # forget little at first
            self.w[way + "b"] = bias
        self.w["out"] = matrix(2 * HIDDEN, 1)
        self.w["out_b"] = np.zeros(1, np.float32)

    def _lstm(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool = True):
        """Hidden states of (time, page, INNER) inputs; masked steps keep the state."""
        w_h, gates_x = self.w[way + "h"], x @ self.w[way + "x"] + self.w[way + "b"]
        steps, pages = x.shape[:2]
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros((pages, HIDDEN), np.float32)
        hs = np.zeros((steps, pages, HIDDEN), np.float32)
        kept = []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            g = gates_x[t] + h @ w_h
            s = sigmoid(g[:, :3 * HIDDEN])
            i, f, o, u = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(g[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = m * (f * c + i * u) + (1 - m) * c
            tanh_c = np.tanh(c_new)
            h_new = m * (o * tanh_c) + (1 - m) * h
            if keep:
                kept.append((t, h, c, i, f, o, u, tanh_c, m))
            h, c = h_new, c_new
            hs[t] = h
        return hs, kept

    def forward(self, x: np.ndarray, mask: np.ndarray):
        inner = np.tanh(x @ self.w["in"] + self.w["in_b"])
        forward, kept_f = self._lstm(inner, mask, "f")
        backward, kept_b = self._lstm(inner, mask, "b")
        both = np.concatenate([forward, backward], axis=2)
        return self._chances(both), (x, inner, both, kept_f, kept_b)

    def _chances(self, both: np.ndarray) -> np.ndarray:
        return sigmoid((both @ self.w["out"] + self.w["out_b"])[..., 0])

    def inner(self, page: list[Block]) -> np.ndarray:
        """What the layers in both directions read: a few numbers for each block, made strip by strip."""
        paths, out = PathVectors(), np.empty((len(page), INNER), np.float32)
        for at in range(0, len(page), GROUP_BLOCKS):
            x = vectors(page, at, at + GROUP_BLOCKS, paths)
            out[at:at + GROUP_BLOCKS] = np.tanh(x @ self.w["in"] + self.w["in_b"])
        return out

    def _back(self, kept, d_hs: np.ndarray, inner: np.ndarray, way: str, grad: dict) -> np.ndarray:
        w_h = self.w[way + "h"]
        d_gates = np.zeros((*d_hs.shape[:2], 4 * HIDDEN), np.float32)
        d_h = np.zeros(d_hs.shape[1:], np.float32)
        d_c = np.zeros_like(d_h)
        grad_h = np.zeros_like(w_h)
        for t, h, c, i, f, o, u, tanh_c, m in reversed(kept):
            d_h = d_h + d_hs[t]
            out = d_h * m
            cell = d_c * m + out * o * (1 - tanh_c**2)
            g = d_gates[t]
            g[:, :HIDDEN] = cell * u * i * (1 - i)
            g[:, HIDDEN:2 * HIDDEN] = cell * c * f * (1 - f)
            g[:, 2 * HIDDEN:3 * HIDDEN] = out * tanh_c * o * (1 - o)
            g[:, 3 * HIDDEN:] = cell * i * (1 - u**2)
            grad_h += h.T @ g
            d_h = g @ w_h.T + d_h * (1 - m)
            d_c = cell * f + d_c * (1 - m)
        flat = d_gates.reshape(-1, 4 * HIDDEN)
        grad[way + "h"] = grad_h
        grad[way + "x"] = inner.reshape(-1, INNER).T @ flat
        grad[way + "b"] = flat.sum(axis=0)
        return d_gates @ self.w[way + "x"].T

    def gradients(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        chance, (x, inner, both, kept_f, kept_b) = self.forward(x, mask)
        d_out = (((chance - labels) * mask) / max(mask.sum(), 1))[..., None].astype(np.float32)
        grad = {"out": both.reshape(-1, 2 * HIDDEN).T @ d_out.reshape(-1, 1), "out_b": d_out.sum(axis=(0, 1))}
        d_both = d_out @ self.w["out"].T
        d_inner = self._back(kept_f, d_both[..., :HIDDEN], inner, "f", grad)
        d_inner += self._back(kept_b, d_both[..., HIDDEN:], inner, "b", grad)
        d_inner *= 1 - inner**2
        grad["in"] = x.reshape(-1, WIDTH).T @ d_inner.reshape(-1, INNER)
        grad["in_b"] = d_inner.sum(axis=(0, 1))
        return grad

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Chances of all blocks of pages of ``inner`` rows; pages of similar length are read together."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        groups: list[list[int]] = []
        for i in order:  # the last page of a group is its longest
            if not groups or (len(groups[-1]) + 1) * len(pages[i]) > GROUP_BLOCKS:
                groups.append([])
            groups[-1].append(i)
        for own in groups:
            x, mask = _stacked([pages[i] for i in own])
            both = [self._lstm(x, mask, way, keep=False)[0] for way in ("f", "b")]
            chance = self._chances(np.concatenate(both, axis=2))
            for k, i in enumerate(own):
                out[i] = chance[:len(pages[i]), k]
        return out


def _stacked(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((longest, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k] = p
        mask[:len(p), k] = 1
    return x, mask


_OTHER = frozenset(n for names in OTHER_NAMES.values() for n in names)


def marked(block: Block) -> bool:
    """Whether an author's own mark-up says that the block is main text."""
    path = block.path
    while path is not None and path.tag not in MAIN_TAGS:
        if path.tag in OTHER_TAGS or any(n in _OTHER for n in path.names):
            return False
        path = path.parent
    return path is not None


def dressed(page: list[Block], others: list[str], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The page's main blocks in another layout, and which of its blocks are main text."""

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def container(kind: str) -> tuple:
        tag = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}.get(kind)
        name = (pick(OTHER_NAMES[kind]),)
        if tag and rng.random() < 0.5:
            return ((tag, () if rng.random() < 0.6 else name),)
        more = (pick(("box", "wrap", "inner", "block", "left", "right")),) if rng.random() < 0.4 else ()
        return ((pick(("div", "div", "section", "ul", "aside")), name + more),)

    def component(kind: str) -> list[tuple[Block, int]]:
        outer = ground + container(kind)
        made = []
        for _ in range(int(rng.integers(1, 7 if kind in ("menu", "comments", "sidebar") else 4))):
            prose = rng.random() < {"comments": 0.8, "sidebar": 0.4, "notice": 0.4, "advert": 0.6, "footer": 0.3}.get(kind, 0.15)
            words = (pick(others) if others else "More").split()
            if prose:
                text = " ".join(words[:int(rng.integers(4, 60))])
            elif rng.random() < 0.4:
                text = " ".join(words[:int(rng.integers(1, 4))])
            else:
                text = pick(OTHER_TEXTS[kind])
            inner = {"menu": "li", "comments": pick(("p", "li", "div")), "sidebar": pick(("li", "p", "h3"))}.get(
                kind, pick(("p", "div", "span", "li"))
            )
            path = outer if rng.random() < 0.3 else outer + ((inner, ()),)
            link = kind in ("menu", "sidebar", "footer") and not prose and rng.random() < 0.8
            made.append((Block(Path.of(path), text or "More", len(text) if link else 0, 2 * link), 0))
        return made

    ground: tuple = (("html", ()), ("body", ()))
    if rng.random() < 0.5:
        ground += (("div", (pick(("wrapper", "page", "container", "site", "layout")),)),)
    style = rng.random()
    if style < 0.35:
        main: tuple = ((pick(MAIN_TAGS), () if rng.random() < 0.5 else (pick(MAIN_NAMES),)),)
    elif style < 0.8:
        main = ((pick(("div", "section")), (pick(MAIN_NAMES),) + (("body",) if rng.random() < 0.3 else ())),)
    else:
        main = (pick((("td", ()), ("div", ()), ("div", (pick(("col", "grid", "inner", "left")),)))),)
    front = [k for k in ("notice", "header", "menu", "advert", "sidebar") if rng.random() < 0.5]
    back = [k for k in ("advert", "sidebar", "comments", "form", "footer", "notice") if rng.random() < 0.5]
    rng.shuffle(front)
    out = [x for k in front for x in component(k)]
    own = [b for b in page if marked(b)]
    cut = int(rng.integers(1, len(own) + 1)) if own else 0
    for i, b in enumerate(own):
        if i == cut and rng.random() < 0.3:
            whole = ground
            ground = ground + main  # something else in the middle of the text
            out += component(pick(("advert", "sidebar", "notice")))
            ground = whole
        own_path = Path.of((*ground, *main, (b.path.tag, b.path.names)))
        out.append((Block(own_path, b.text, b.links, b.tags), 1))
    out += [x for k in back for x in component(k)]
    return [b for b, _ in out], [y for _, y in out]


def train(pages: list[str], seed: int = 7, epochs: int = EPOCHS, dressings: int = DRESSINGS) -> Labeller | None:
    """A labeller from pages whose authors marked the main text; each also in other layouts. None without such pages."""
    rng = np.random.default_rng(seed)
    parsed = [p for p in map(blocks, pages) if p]
    texts = [b.text for p in parsed for b in p]
    examples: list[tuple[np.ndarray, np.ndarray]] = []

    def add(page: list[Block], labels: list[int]) -> None:
        x, y = vectors(page), np.array(labels, np.float32)
        for at in range(0, len(page), STRIP):
            examples.append((x[at:at + STRIP], y[at:at + STRIP]))

    for page in parsed:
        labels = [int(marked(b)) for b in page]
        if not any(labels):
            continue
        add(page, labels)
        for _ in range(dressings):
            add(*dressed(page, texts, rng))
    if not examples:
        return None
    model = Labeller(seed)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for epoch in range(epochs):
        # sequences of similar length together, batches in random order
        order = sorted(range(len(examples)), key=lambda i: (len(examples[i][0]), rng.random()))
        groups = [order[at:at + 32] for at in range(0, len(order), 32)]
        rng.shuffle(groups)
        rate = (0.01, 0.01, 0.01, 0.003, 0.001)[5 * epoch // epochs]
        for own in groups:
            x, mask = _stacked([examples[i][0] for i in own])
            y = _stacked([examples[i][1][:, None] for i in own])[0][..., 0]
            step += 1
            for k, g in model.gradients(x, mask, y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
    return model


def _extracted(weights: dict[str, np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Labeller()
        model.w = weights
        for batch in batches:
            texts, every = [], batch["html"].tolist()
            for part in slices(every, SLICE_CHARS):
                pages = [blocks(p) for p in every[part]]
                chances = model.label([model.inner(p) for p in pages])
                texts += [
                    " ".join(b.text for b, c in zip(p, chance.tolist()) if c >= 0.5)
                    for p, chance in zip(pages, chances)
                ]
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    return run


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", training_pages: int = TRAINING_PAGES,
) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, one row for each row of ``pages``.

    Blocks are joined by one space, white space inside them is one space. A
    null or empty page, and one without main text, has an empty text; ids and
    urls may be null or repeat; plain text without tags is one block. At most
    about ``training_pages`` pages, of at most ``TRAINING_CHARS`` characters each
    and the first ones in the order of a hash of their content, train the
    labeller; if none of them has main text that its author marked, nothing can
    be learned, and every text is empty. Other columns are ignored.
    """
    rows = pages.select(
        F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    )
    share = min(1.0, training_pages / max(rows.count(), 1))
    sample = (
        rows.where(F.length("html").between(1, TRAINING_CHARS))
        .where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < int(share * (1 << 20)))
        .select("html").orderBy(F.xxhash64("html"), "html").limit(training_pages).collect()
    )
    model = train(sorted(r["html"] for r in sample))
    if model is None:
        return rows.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars"))
    return rows.mapInPandas(_extracted(model.w), "page_id long, url string, text string, n_chars long")
