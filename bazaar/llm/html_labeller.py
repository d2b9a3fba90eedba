"""HTML extraction by a recurrent block labeller.

A page is a sequence of leaf blocks. Each block has a tag-path vector (hashed tags
and attribute words of its open elements), a hashed-word vector and a few rates of the
block, its container and its place. A bidirectional LSTM in numpy reads the whole sequence in
both directions and labels every block as article or not, so each decision sees the whole
page. No list of words is an input of the network. An element that holds the page's
heading and most of its text is its frame: the names it carries (``<body
class="has-sidebar">``) say nothing of its parts and are not read.

Training data, all from the table itself: at most ``TRAIN_PAGES`` pages, labelled by
what their markup declares, and as many pages made from the same blocks in other
layouts (containers, sidebars, comments, notices, forms; telling, opaque and misleading
names), whose labels are known by construction.

Defined cases: a null or empty page, or one without text, gives an empty text and
length 0; broken markup is read as far as it goes; pages with any number of blocks
are labelled whole; repeated rows are extracted each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.html_blocks import Block, blocks_of
from bazaar.llm.staging import smallest_hashes

TRAIN_PAGES = 300
#: Longest page, in characters of markup, that training takes. Extraction has no such bound.
TRAIN_CHARS = 40_000
PATH_DIM = 192
WORD_DIM = 48
HIDDEN = 24
EPOCHS = 14
BATCH = 48

# Words of class, id and role attributes, and elements, by what they usually hold. They label the
# table's own pages for training and are no input of the network.
BOILER_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie "
    "cookies disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notification "
    "alert pagination popup promo promotion related reply replies respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget complementary gdpr disclaimer recommended trending tags meta".split()
)
BOILER_TAGS = frozenset("nav footer header aside form menu button select label fieldset legend dialog".split())
CONTENT_TAGS = frozenset("article main".split())
#: Outer elements of a block among which frames are looked for.
FRAME_DEPTH = 40
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

DENSE = 16
DIM = PATH_DIM + WORD_DIM + DENSE


Path = tuple[tuple[str, tuple[str, ...]], ...]


@dataclass
class Page:
    """What the blocks of a page have in common: its frames, and rates of its containers."""

    blocks: int
    frames: frozenset[Path]
    #: path of a block -> share of the page's text, linked share, mean length, share of the part below the frames
    rates: dict[Path, tuple[float, float, float, float]]

    @classmethod
    def of(cls, blocks: list[Block]) -> Page:
        size: dict[Path, list[float]] = {}
        for b in blocks:
            held = size.setdefault(b.path, [0, 0.0, 0])
            held[0] += len(b.text)
            held[1] += b.linked * len(b.text)
            held[2] += 1
        inside: dict[Path, int] = {}
        for path, held in size.items():
            for k in range(1, min(len(path), FRAME_DEPTH) + 1):
                inside[path[:k]] = inside.get(path[:k], 0) + held[0]
        whole = max(1, sum(held[0] for held in size.values()))
        heading = next((b.path for h in ("h1", "h2", "h3") for b in blocks if any(t == h for t, _ in b.path)), ())
        frames = {
            heading[:k] for k in range(1, min(len(heading), FRAME_DEPTH) + 1)
            if 2 * inside[heading[:k]] >= whole and heading[k - 1][0] not in HEADINGS
        }
        frames |= {p for p in inside if p[-1][0] in ("html", "body")}
        rates = {}
        for path, (n, linked, count) in size.items():
            part = next((path[:k] for k in range(1, min(len(path), FRAME_DEPTH) + 1) if path[:k] not in frames), path)
            rates[path] = (n / whole, linked / n, min(n / count / 300, 2.0), inside.get(part, n) / whole)
        return cls(len(blocks), frozenset(frames), rates)

    def parts(self, path: Path) -> list[tuple[str, tuple[str, ...], bool]]:
        """Elements of a path with their names, and whether each is a frame, whose names are not read."""
        framed = [k < FRAME_DEPTH and path[: k + 1] in self.frames for k in range(len(path))]
        return [(t, () if f else w, f) for (t, w), f in zip(path, framed, strict=True)]


def declared(block: Block, page: Page) -> bool:
    """Whether the markup itself says that the block belongs to the article; frames say nothing."""
    return not any(
        not framed and (t in BOILER_TAGS or not BOILER_WORDS.isdisjoint(w)) for t, w, framed in page.parts(block.path)
    )


def has_article(blocks: list[Block]) -> bool:
    return any(t in CONTENT_TAGS or "main" in w for b in blocks for t, w in b.path)


def teacher_labels(blocks: list[Block]) -> list[bool]:
    """Labels of a page as its markup declares them: inside the article, outside of anything else."""
    inside, page = has_article(blocks), Page.of(blocks)
    return [
        declared(b, page)
        and (not inside or any(t in CONTENT_TAGS or "main" in w for t, w in b.path))
        and (inside or b.linked < 0.6)
        for b in blocks
    ]


def vectors(
    blocks: list[Block], slots: dict[str, int] | None = None, page: Page | None = None, start: int = 0
) -> np.ndarray:
    """One row per block: tag path, words, rates. ``blocks`` may be the part of ``page`` from ``start``."""
    slots = {} if slots is None else slots
    page = page or Page.of(blocks)
    n = page.blocks
    x = np.zeros((len(blocks), DIM), np.float32)

    def slot(token: str) -> int:
        if token not in slots:
            slots[token] = zlib.crc32(token.encode()) % PATH_DIM
        return slots[token]

    paths: dict[tuple, tuple[list[int], list[float]]] = {}
    for i, b in enumerate(blocks):
        if b.path not in paths:
            at, flags = [], [*page.rates[b.path], 0.0, 0.0, 0.0, 0.0]
            for tag, words, _ in page.parts(b.path):
                at.append(slot(f"t:{tag}"))
                at += [slot(f"c:{w}") for w in words]
            last = b.path[-1][0] if b.path else ""
            at.append(slot(f"l:{last}"))
            flags[4:8] = [last == "p", last in HEADINGS, last in ("li", "td", "dd", "dt"), last in ("div", "section", "body")]
            paths[b.path] = (at, flags)
        at, flags = paths[b.path]
        x[i, at] = 1
        data = b.text.encode()
        words = data.lower().split()
        hashed = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        x[i, PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount(hashed % WORD_DIM, minlength=WORD_DIM) / np.sqrt(len(words))
        size = len(b.text)
        x[i, PATH_DIM + WORD_DIM :] = [
            *flags, np.log1p(size) / 8, b.linked, (start + i + 1) / n, 1 / (start + i + 1), 1 / (n - start - i),
            b.text[-1] in ".!?…\"”»", ("©" in b.text) + ("|" in b.text), sum(map(b.text.count, ",.;")) / size,
        ]
    return x


# -- the network -----------------------------------------------------------------


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _turned(lengths: np.ndarray, steps: int) -> np.ndarray:
    """Index (steps, batch) that reverses each sequence and leaves its padding in place."""
    t = np.arange(steps)[:, None]
    return np.where(t < lengths, lengths - 1 - t, t)


def _forward(z: np.ndarray, u: np.ndarray, keep: bool = False):
    """Hidden states (steps, batch, H) for input sums z (steps, batch, 4H)."""
    steps, batch, _ = z.shape
    h, c = np.zeros((batch, HIDDEN), z.dtype), np.zeros((batch, HIDDEN), z.dtype)
    out = np.empty((steps, batch, HIDDEN), z.dtype)
    past = []
    for t in range(steps):
        a = z[t] + h @ u
        gates = _sigmoid(a[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(a[:, 3 * HIDDEN :])
        before = c
        c = f * c + i * g
        squashed = np.tanh(c)
        if keep:
            past.append((h, before, i, f, o, g, squashed))
        h = o * squashed
        out[t] = h
    return out, past


def _backward(dh: np.ndarray, u: np.ndarray, past: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input sums and of u."""
    steps, batch, _ = dh.shape
    dz = np.empty((steps, batch, 4 * HIDDEN), dh.dtype)
    du = np.zeros_like(u)
    later_h, later_c = np.zeros((batch, HIDDEN), dh.dtype), np.zeros((batch, HIDDEN), dh.dtype)
    for t in reversed(range(steps)):
        h, before, i, f, o, g, squashed = past[t]
        d = dh[t] + later_h
        dc = d * o * (1 - squashed**2) + later_c
        dz[t] = np.concatenate(
            [dc * g * i * (1 - i), dc * before * f * (1 - f), d * squashed * o * (1 - o), dc * i * (1 - g**2)], 1
        )
        du += h.T @ dz[t]
        later_h, later_c = dz[t] @ u.T, dc * f
    return dz, du


@dataclass
class Labeller:
    """Weights by direction: input (DIM, 4H), recurrent (H, 4H), bias; and the output layer."""

    weights: dict[str, np.ndarray]

    def logits(self, z: list[np.ndarray], lengths: np.ndarray, keep: bool = False):
        turn = _turned(lengths, len(z[0]))[..., None]
        ahead, past = _forward(z[0], self.weights["u0"], keep)
        back, past_back = _forward(np.take_along_axis(z[1], turn, 0), self.weights["u1"], keep)
        both = np.concatenate([ahead, np.take_along_axis(back, turn, 0)], 2)
        return both @ self.weights["v"] + self.weights["c"], (both, past, past_back, turn)

    def sums(self, x: np.ndarray) -> list[np.ndarray]:
        return [x @ self.weights[f"w{k}"] + self.weights[f"b{k}"] for k in (0, 1)]

    def label(self, pages: list[list[Block]], room: int = 16_384) -> list[np.ndarray]:
        """For each page, which blocks are article. Pages of like length are read together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        slots: dict[str, int] = {}
        while order:
            steps = len(pages[order[-1]])
            size = max(1, min(len(order), room // steps))
            group, order = order[-size:], order[:-size]
            z = [np.zeros((steps, size, 4 * HIDDEN), np.float32) for _ in range(2)]
            for b, i in enumerate(group):
                page = Page.of(pages[i])
                for s in range(0, len(pages[i]), room):
                    x = vectors(pages[i][s : s + room], slots, page, s)
                    for k, part in enumerate(self.sums(x)):
                        z[k][s : s + len(x), b] = part
            lengths = np.array([len(pages[i]) for i in group])
            scores, _ = self.logits(z, lengths)
            for b, i in enumerate(group):
                out[i] = scores[: lengths[b], b] > 0
            if len(slots) > 100_000:
                slots.clear()
        return out


def train(pages: list[list[Block]], labels: list[np.ndarray], seed: int = 0) -> Labeller:
    """Adam on the mean cross entropy of blocks, over batches of pages."""
    rng = np.random.default_rng(seed)
    w: dict[str, np.ndarray] = {}
    for k in (0, 1):
        w[f"w{k}"] = rng.normal(0, 0.08, (DIM, 4 * HIDDEN))
        w[f"u{k}"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
        w[f"b{k}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    w["v"], w["c"] = rng.normal(0, 0.15, 2 * HIDDEN), np.zeros(())
    w = {k: v.astype(np.float32) for k, v in w.items()}
    model = Labeller(w)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    xs = [vectors(p) for p in pages]
    step = 0
    for epoch in range(EPOCHS):
        order = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i]) // 8)
        batches = [order[s : s + BATCH] for s in range(0, len(order), BATCH)]
        for b in rng.permutation(len(batches)):
            group = batches[b]
            lengths = np.array([len(xs[i]) for i in group])
            x = np.zeros((lengths.max(), len(group), DIM), np.float32)
            y = np.zeros(x.shape[:2], np.float32)
            for j, i in enumerate(group):
                x[: lengths[j], j], y[: lengths[j], j] = xs[i], labels[i]
            real = np.arange(len(x))[:, None] < lengths
            scores, (both, past, past_back, turn) = model.logits(model.sums(x), lengths, keep=True)
            d = ((_sigmoid(scores) - y) * real / real.sum()).astype(np.float32)
            grad = {"v": np.tensordot(d, both, ([0, 1], [0, 1])), "c": d.sum()}
            dh = d[..., None] * w["v"]
            dz, grad["u0"] = _backward(dh[..., :HIDDEN], w["u0"], past)
            dback, grad["u1"] = _backward(np.take_along_axis(dh[..., HIDDEN:], turn, 0), w["u1"], past_back)
            for k, g in enumerate((dz, np.take_along_axis(dback, turn, 0))):
                g = g * real[..., None]
                grad[f"w{k}"], grad[f"b{k}"] = np.tensordot(x, g, ([0, 1], [0, 1])), g.sum((0, 1))
            step += 1
            rate = 0.012 * (1 - 0.9 * epoch / EPOCHS)
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                w[k] = (w[k] - rate * change).astype(np.float32)
    return model


# -- training pages ----------------------------------------------------------------

# Layouts for made pages. {} takes text; content is marked by data-y.
CONTAINERS = (
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<div id=content>{}</div>",
    '<div class="post-body">{}</div>', '<div class="entry-content">{}</div>', '<section class="story">{}</section>',
    "<div>{}</div>", '<div role="main">{}</div>', '<div class="wrapper"><article class="post">{}</article></div>',
)
FRAMES = (
    '<article class="NAME">{}</article>', '<main class="NAME">{}</main>', '<div class="NAME">{}</div>',
    '<section id="NAME">{}</section>', '<form id="NAME"><div>{}</div></form>',
)
CONTENT_ITEMS = (
    "<p data-y=1>{}</p>", "<p data-y=1>{}</p>", "<p data-y=1>{}</p>", "<h2 data-y=1>{}</h2>",
    "<ul><li data-y=1>{}</li></ul>", "<blockquote data-y=1>{}</blockquote>", "<div data-y=1>{}</div>",
    "<pre data-y=1>{}</pre>", "<section><p data-y=1>{}</p></section>", "<table><tr><td data-y=1>{}</td></tr></table>",
    "<p data-y=1>{} <a href=x>link</a> {}</p>", "<figure><figcaption data-y=1>{}</figcaption></figure>",
)
OUTSIDE_ITEMS = (
    "<nav><ul><li><a href=x>{}</a></li><li><a href=x>{}</a></li></ul></nav>", "<header><div>{}</div></header>",
    "<header><h1>{}</h1><p>{}</p></header>", '<div class="menu"><a href=x>{}</a></div>', "<footer><p>{}</p></footer>",
    '<div class="footer">{}</div>', "<aside><p>{}</p></aside>", '<div class="sidebar"><p>{}</p><p>{}</p></div>',
    '<div class="ad">{}</div>', '<div class="advert"><p>{}</p></div>', '<div id="cookie-notice"><p>{}</p></div>',
    '<div class="notice">{}</div>', '<div class="banner">{}</div>', "<form><label>{}</label><button>{}</button></form>",
    '<form><p>{}</p><input type=text></form>', '<div class="newsletter"><p>{}</p></div>',
    '<section class="comments"><h3>{}</h3><div class="comment"><p>{}</p></div><div class="comment"><p>{}</p></div></section>',
    '<div id="comments"><ul><li>{}</li><li>{}</li></ul></div>', '<div class="related"><h3>{}</h3><ul><li><a href=x>{}</a></li></ul></div>',
    '<div class="share">{}</div>', '<ul class="breadcrumb"><li><a href=x>{}</a></li></ul>', '<div class="promo">{}</div>',
    '<div role="navigation"><a href=x>{}</a></div>', '<section id="respond"><p>{}</p></section>',
    '<div class="sponsored"><p>{}</p></div>', '<div class="alert"><p>{}</p></div>', '<div role="alert">{}</div>',
    '<div class="popup"><p>{}</p></div>', "<menu><li>{}</li></menu>", '<dialog><p>{}</p></dialog>',
)
STOCK = (
    "We use cookies to improve this site.", "Subscribe to our newsletter", "All rights reserved.", "Home", "About us",
    "Read more", "Log in", "Leave a reply", "Share this", "Advertisement", "Related posts", "Search", "Comments",
    "3 comments", "Reply", "Copyright 2020", "Terms of use", "Privacy policy", "Contact", "Sign up", "Next", "Previous",
)
#: Names that mislead on a frame, and forms of names that say nothing.
MISLEADING = ("has-sidebar", "no-footer", "logged-in-search", "has-comments", "with-banner", "share-wrap", "nav-open", "ad-free")
#: Reader comments and a sidebar of an opaque page: long texts, told by their place, heads and links.
OPAQUE_ITEMS = (
    "<div class=a><h3>{0}</h3><div class=b><span>{1}</span><p>{}</p></div><div class=b><span>{1}</span><p>{}</p></div></div>",
    "<div class=a><h4>{0}</h4><ul class=b><li><a href=x>{}</a></li><li><a href=x>{}</a></li></ul></div>",
    "<div class=a><div><a href=x>{0}</a></div><div><a href=x>{0}</a></div></div>", "<div class=a>{0}</div>",
    "<div class=a><p>{0}</p></div>", "<div class=a><p>{0}</p><p>{0}</p></div>", "<ul class=a><li><a href=x>{0}</a></li></ul>",
)
FILLER = ("The river rose in the night, and by morning the road was gone.", "Nobody had expected it so soon.")


def made_page(texts: list[str], rng: np.random.Generator) -> str:
    """A page whose article blocks are marked, from given texts in a random layout."""

    def fill(form: str, stock: float = 0.0) -> str:
        while "{}" in form:
            text = STOCK[rng.integers(len(STOCK))] if rng.random() < stock else texts[rng.integers(len(texts))]
            if stock and rng.random() < 0.5:
                text = " ".join(text.split()[: 1 + rng.integers(8)])
            form = form.replace("{}", text.replace("<", "&lt;").replace("{}", ""), 1)
        return form

    def outside(most: int) -> str:
        return "".join(fill(OUTSIDE_ITEMS[rng.integers(len(OUTSIDE_ITEMS))], 0.25) for _ in range(rng.integers(most + 1)))

    def plain(most: int) -> str:
        out = ""
        for _ in range(rng.integers(most + 1)):
            form = OPAQUE_ITEMS[rng.integers(len(OPAQUE_ITEMS))]
            while "{0}" in form:
                form = form.replace("{0}", STOCK[rng.integers(len(STOCK))], 1)
            out += fill(form.replace("{1}", f"user{rng.integers(1000)}, {rng.integers(1, 28)} May"))
        return out

    def renamed(html: str) -> str:
        """Every class and id replaced by an opaque name, alike ones alike."""
        names: dict[str, str] = {}

        def new(found: re.Match) -> str:
            letters = "".join(chr(97 + int(k)) for k in rng.integers(0, 26, 6))
            return f' {found[1]}="{names.setdefault(found[2], f"x{letters}")}"'

        return re.sub(r""" (class|id)="?([\w -]+)"?(?=[ >])""", new, html)

    style = rng.random()  # telling names below 0.4, opaque to 0.7, misleading ones on the frames above
    if style >= 0.4:
        names = [MISLEADING[k] for k in rng.integers(0, len(MISLEADING), 3)] if style >= 0.7 else ["c1", "c2", "c3"]
    if 0.4 <= style < 0.7:
        outside = plain  # noqa: F811

    items = [fill(CONTENT_ITEMS[rng.integers(len(CONTENT_ITEMS))]) for _ in range(rng.integers(1, 14))]
    if rng.random() < 0.7:
        items.insert(0, fill("<h1 data-y=1>{}</h1>"))
    if rng.random() < 0.5:
        items.insert(rng.integers(len(items) + 1), outside(1))
    if rng.random() < 0.3:
        items.append(outside(2))
    container = CONTAINERS[rng.integers(len(CONTAINERS))]
    if style >= 0.7:
        container = f'<div class="{names[1]}">{FRAMES[rng.integers(len(FRAMES))].replace("NAME", names[2])}</div>'
    body = container.replace("{}", "".join(items))
    if style < 0.4:
        return f"<html><body>{outside(4)}{body}{outside(4)}</body></html>"
    if rng.random() < 0.5:
        body = f'<div class="{names[1]}">{outside(2)}{body}{outside(2)}</div>'
    page = f'<html><body class="{names[0]}">{outside(3)}{body}{outside(3)}</body></html>'
    return renamed(page) if style < 0.7 else page


def fit(pages: DataFrame, rows: int = TRAIN_PAGES) -> Labeller:
    """Train on at most ``rows`` pages, those with the smallest hashes, and as many made ones."""
    usable = pages.where(F.col("html").isNotNull() & (F.length("html") <= TRAIN_CHARS)).select(
        "html", F.xxhash64("html").alias("k")
    )
    keys = smallest_hashes(usable.select("k").distinct(), F.col("k"), rows)  # numbers only; the few pages come after
    sample = usable.join(F.broadcast(keys), "k").groupBy("k").agg(F.first("html").alias("html")).collect()
    sample.sort(key=lambda r: r["k"])
    read = [blocks_of(r["html"]) for r in sample]
    read = [p for p in read if p]
    texts = [b.text.replace("{}", "") for p in read for b in p] or list(FILLER)
    rng = np.random.default_rng(1)
    made = [blocks_of(made_page(texts, rng)) for _ in range(max(rows, 200))]
    data = [(p, np.array(teacher_labels(p))) for p in read] + [(p, np.array([b.mark for b in p])) for p in made if p]
    return train([p for p, _ in data], [y for _, y in data])


def main_text(blocks: list[Block], chosen: np.ndarray) -> str:
    return "\n".join(b.text for b, keep in zip(blocks, chosen, strict=True) if keep)


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    model = model or fit(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(s, 256) for s in range(0, whole.num_rows, 256)):
                read = [blocks_of(h.as_py()) for h in batch.column(2)]
                texts = [main_text(p, y) for p, y in zip(read, model.label(read), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
