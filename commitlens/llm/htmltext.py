"""Operator 3, main text of web pages: a recurrent labeller over the page's blocks.

A page is cut into blocks: runs of text under one chain of block elements. A bidirectional LSTM in numpy reads, for the
whole page in order, a vector of each block's tag path (hashed tag, class and id words), a hashed-word vector of its
text, and a few shapes (length, share of link text, punctuation, place), and says for every block whether it is article
text. Scripts, styles, comments and other markup never become blocks.

No page comes with labels. The model is trained on a bounded sample (``SAMPLE_PAGES`` pages, a run of at most
``TRAIN_BLOCKS`` blocks of each) of the pages at hand: blocks
under article or main elements are article text unless a boilerplate element holds them (a page without such elements is
labelled by its prose). Each training page is also
shown with other container names and with boilerplate blocks put in (also inside the article), so that the model learns
paths and neighbours that the sample itself lacks.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import arrow_map, byte_chunks, flat_words, word_hashes

SAMPLE_PAGES = 192
TRAIN_BLOCKS = 96
PATH_DIM, WORD_DIM, SHAPE_DIM, HIDDEN = 64, 24, 6, 20
VARIANTS, EPOCHS, RATE, SEED = 8, 12, 0.01, 7
#: Depth beyond which browsers too make nested elements siblings.
MAX_DEPTH = 512
#: Blocks (padding included) labelled at once, and steps whose inputs are held at once; a longer page is a batch alone.
BATCH_BLOCKS, SEGMENT = 1 << 14, 1 << 11

#: Element names of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea iframe noscript template svg math object noembed xmp".split())
CLOSES_P = BLOCK_TAGS - {"button", "option"}

#: Fixed word lists: names under which pages keep their article and everything else.
ARTICLE_NAMES = ("article", "main", "div.content", "div.post-content", "div.entry-content", "section.article-body",
                 "div#main-content", "div.story", "div.post-text", "main.page-content")
OTHER_NAMES = ("nav", "header", "footer", "aside", "form", "div.menu", "div.sidebar", "div.ad", "div.advert",
               "div.banner", "div.cookie-notice", "div.notice", "div.popup", "div.newsletter", "div.related",
               "div.share", "div.breadcrumbs", "ul.menu", "div.navbar", "div.site-header", "div.site-footer",
               "section.comments", "div.comment", "li.comment", "div#comments", "div.reply", "div.sponsored",
               "div.promo", "div.widget", "div.login", "form.search", "div.pagination", "div.copyright", "div.consent",
               "div.alert", "div.subscribe", "div.social", "div.toolbar", "div.user-comments", "ol.comment-list")
ARTICLE_WORDS = frozenset("article main content post entry story body text".split())
OTHER_WORDS = frozenset(
    "nav header footer aside form menu sidebar ad ads advert advertisement banner cookie cookies notice popup modal "
    "newsletter related share breadcrumb breadcrumbs navbar comment comments reply replies sponsored sponsor promo "
    "widget login search pagination pager copyright consent alert subscribe social toolbar button select option "
    "fieldset legend gdpr signup tags recommended disqus dialog".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([A-Za-z][^\s/>]*)", re.S)
TAG_STOP = re.compile(r">|=\s*([\"'])")
NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def tag_end(page: str, at: int) -> int:
    """Where the tag whose name ends at ``at`` ends, ``>`` included. Quoted values may hold ``>``; a quote that nothing
    closes ends at the next ``>``. Nothing scanned is scanned again, so a page takes linear time."""
    while stop := TAG_STOP.search(page, at):
        at = stop.end()
        if not stop[1]:
            return at
        close = page.find(stop[1], at)
        if close < 0:
            return page.find(">", at) + 1 or len(page)
        at = close + 1
    return len(page)


def page_blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """``(path, text, share of link text)`` of each block with text, in page order. Elements nested deeper than
    ``MAX_DEPTH`` become siblings at that depth, as in browsers; equal paths are one object."""
    blocks: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, str]] = []
    opened: Counter[str] = Counter()
    paths: dict[tuple[str, ...], tuple[str, ...]] = {}
    parts: list[str] = []
    links = [0, 0]

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                path = tuple(label for tag, label in stack if tag != "a")
                blocks.append((paths.setdefault(path, path), text, min(1.0, links[1] / max(1, links[0]))))
            parts.clear()
            links[:] = [0, 0]

    def say(text: str):
        if text:
            parts.append(text)
            n = len(text.strip())
            links[0] += n
            links[1] += n if any(tag == "a" for tag, _ in stack[-6:]) else 0

    def drop() -> str:
        tag = stack.pop()[0]
        opened[tag] -= 1
        return tag

    def push(tag: str, label: str):
        if len(stack) >= MAX_DEPTH:
            drop()
        stack.append((tag, label))
        opened[tag] += 1

    def close(tag: str):
        if opened[tag] > 0:
            if tag in BLOCK_TAGS:
                flush()
            while drop() != tag:
                pass

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m[1]:
            say(m[1])
        if not m[3]:
            continue
        tag = m[3].lower()
        at = tag_end(page, at)
        rest = page[m.end():at].removesuffix(">")
        if m[2]:
            close(tag)
        elif tag in RAW_TAGS:
            if not rest.rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
                at = stop.end() if stop else end
                if stop and page[at - 1] != ">":
                    at = page.find(">", at) + 1 or end
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK_TAGS or tag == "a":
            if tag in CLOSES_P:
                if stack and any(t == "p" for t, _ in stack[-3:]):
                    close("p")
            if tag in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                close(tag)
            if tag == "a":
                push(tag, tag)
                continue
            flush()
            if tag not in VOID_TAGS:
                names = ["." + w for k in NAMES.findall(rest) for w in (k[1] or k[2] or k[3]).split()]
                push(tag, tag + "".join(names))
    flush()
    return blocks


def path_words(path: tuple[str, ...]) -> list[list[str]]:
    """Lower-case words of every step of a path: the tag, then the parts of its class, id and role names."""
    return [[w for name in step.split(".") for w in [name.lower(), *re.split(r"[^a-z]+", re.sub(
        r"([a-z])([A-Z])", r"\1 \2", name).lower())] if w] for step in path]


def weak_labels(blocks: list[tuple[tuple[str, ...], str, float]]) -> list[bool]:
    """Training labels of a page's blocks: text under an article-like element and no boilerplate element. A page
    without any such element is labelled by its prose: ten words or more, few of them links."""
    words = [{w for step in path_words(path) for w in step} for path, _, _ in blocks]
    held = [bool(w & (ARTICLE_WORDS - {"body", "text"})) and not w & OTHER_WORDS for w in words]
    if any(held):
        return held
    return [not w & OTHER_WORDS and len(text.split()) >= 10 and link < 0.3 for w, (_, text, link) in zip(words, blocks)]


@lru_cache(maxsize=1 << 14)
def path_vector(path: tuple[str, ...]) -> bytes:
    """Hashed bag of a path's words; the innermost three steps are also told apart from the rest."""
    v = np.zeros(PATH_DIM, np.float32)
    for depth, step in enumerate(reversed(path_words(path))):
        for w in step:
            for key in (w, f"{w}@{min(depth, 3)}") if depth < 3 else (w,):
                x = zlib.crc32(key.encode())
                v[x % PATH_DIM] += 1.0 if x >> 16 & 1 else -1.0
    return v.tobytes()


def page_vectors(blocks: list[tuple[tuple[str, ...], str, float]], step: int = 1 << 13) -> np.ndarray:
    """One row per block: path, hashed words, shapes. Filled ``step`` blocks at a time."""
    out = np.zeros((len(blocks), PATH_DIM + WORD_DIM + SHAPE_DIM), np.float32)
    place = np.linspace(0, 1, len(blocks))
    for a in range(0, len(blocks), step):
        part = blocks[a:a + step]
        n = len(part)
        rows = out[a:a + n]
        rows[:, :PATH_DIM] = np.frombuffer(b"".join(path_vector(b[0]) for b in part), np.float32).reshape(n, PATH_DIM)
        texts = [b[1].encode() for b in part]
        words, bounds = flat_words(texts)
        sizes = np.diff(bounds)
        h = word_hashes(words)
        bags = np.bincount(np.repeat(np.arange(n), sizes) * WORD_DIM + (h % np.uint64(WORD_DIM)).astype(np.int64),
                           minlength=n * WORD_DIM).reshape(n, WORD_DIM)
        rows[:, PATH_DIM:PATH_DIM + WORD_DIM] = bags / np.sqrt(1.0 + sizes)[:, None]
        marks = np.array([t.count(b".") + t.count(b",") for t in texts])
        rows[:, -SHAPE_DIM:] = np.stack([
            np.log1p(sizes) / 3, [b[2] for b in part], marks / (1.0 + sizes), place[a:a + n],
            np.minimum(sizes, 8) / 8, [b[1][-1:] in ".!?" for b in part]], axis=1)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_model(seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d = PATH_DIM + WORD_DIM + SHAPE_DIM

    def draw(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    model = {f"{k}{way}": v for way in "fb" for k, v in
             {"W": draw(d, 4 * HIDDEN), "U": draw(HIDDEN, 4 * HIDDEN), "b": np.zeros(4 * HIDDEN, np.float32)}.items()}
    return model | {"out": draw(2 * HIDDEN, 1), "skip": draw(d, 1), "bias": np.zeros(1, np.float32)}


def _lstm(x, mask, w, u, b):
    """Forward pass over ``x[time, page, dim]``; padded steps keep the state. Returns states and what backward needs."""
    steps, pages = mask.shape
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    hs, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
    xw = x @ w + b
    for t in range(steps):
        z = xw[t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN] + (k == 1)) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        new = f * c + i * g
        tanh = np.tanh(new)
        kept.append((h, c, i, f, o, g, tanh, m))
        h, c = m * (o * tanh) + (1 - m) * h, m * new + (1 - m) * c
        hs[t] = h
    return hs, kept


def _lstm_back(x, dh_all, kept, w, u):
    dw, du, db = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * HIDDEN, np.float32)
    dh = dc = np.zeros_like(kept[0][0])
    for t in range(len(kept) - 1, -1, -1):
        h, c, i, f, o, g, tanh, m = kept[t]
        dh = dh + dh_all[t]
        dout, dnew = m * dh, m * dc
        dnew = dnew + dout * o * (1 - tanh * tanh)
        dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), dout * tanh * o * (1 - o),
                             dnew * i * (1 - g * g)], axis=1)
        dw += x[t].T @ dz
        du += h.T @ dz
        db += dz.sum(axis=0)
        dh, dc = (1 - m) * dh + dz @ u.T, (1 - m) * dc + dnew * f
    return dw, du, db


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for j, p in enumerate(pages):
        x[:len(p), j], mask[:len(p), j] = p, 1
    return x, mask


def _forward(model, x, mask):
    hf, kf = _lstm(x, mask, model["Wf"], model["Uf"], model["bf"])
    hb, kb = _lstm(x[::-1], mask[::-1], model["Wb"], model["Ub"], model["bb"])
    both = np.concatenate([hf, hb[::-1]], axis=2)
    return (both @ model["out"] + x @ model["skip"] + model["bias"])[..., 0], both, kf, kb


def _scores(model, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Scores of every block of every page. Both directions run in one loop, each page from its own start or end, so
    padding comes last and needs no mask. Nothing is kept but the two states and a score a block and direction; inputs
    are laid out ``SEGMENT`` steps at a time."""
    gate = np.where(np.arange(4 * HIDDEN) < 3 * HIDDEN, 0.5, 1).astype(np.float32)
    w, u, b = (np.stack([model[k + "f"], model[k + "b"]]) for k in "WUb")
    b[:, HIDDEN:2 * HIDDEN] += 1
    w, u, b = w * gate, u * gate, (b * gate)[:, None]
    out = model["out"].reshape(2, HIDDEN, 1)
    steps, dim, wide = max(len(p) for p in pages), pages[0].shape[1], (2, len(pages), HIDDEN)
    h, c, z = np.zeros(wide, np.float32), np.zeros(wide, np.float32), np.zeros((*wide[:2], 4 * HIDDEN), np.float32)
    gates, new = z[..., :3 * HIDDEN], z[..., 3 * HIDDEN:]
    put, forget, show = (gates[..., k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
    told = np.zeros((2, steps, len(pages)), np.float32)
    for a in range(0, steps, SEGMENT):
        n = min(SEGMENT, steps - a)
        x = np.zeros((2, n, len(pages), dim), np.float32)
        for j, p in enumerate(pages):
            for way, rows in enumerate((p[a:a + n], p[::-1][a:a + n])):
                x[way, :len(rows), j] = rows
        xw = x.reshape(2, -1, dim) @ w + b
        xw = np.ascontiguousarray(xw.reshape(2, n, len(pages), 4 * HIDDEN).swapaxes(0, 1))
        hs = np.zeros((n, *wide), np.float32)
        for t in range(n):
            # A logistic gate is (tanh(z / 2) + 1) / 2, so one tanh serves all four parts.
            np.matmul(h, u, out=z)
            z += xw[t]
            np.tanh(z, out=z)
            gates += 1
            gates *= 0.5
            c *= forget
            new *= put
            c += new
            h = hs[t]
            np.tanh(c, out=h)
            h *= show
        told[:, a:a + n] = (hs @ out)[..., 0].swapaxes(0, 1)
    return [told[0, :len(p), j] + told[1, :len(p), j][::-1] + (p @ model["skip"])[:, 0] + model["bias"]
            for j, p in enumerate(pages)]


def label_pages(model: dict[str, np.ndarray], pages: list[np.ndarray], batch: int = 64) -> list[np.ndarray]:
    """Whether each block of each page is article text; pages of like length share a batch of at most ``batch`` pages and
    ``BATCH_BLOCKS`` blocks, padding included."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    while order:
        n = 1
        while n < min(batch, len(order)) and (n + 1) * len(pages[order[n]]) <= BATCH_BLOCKS:
            n += 1
        part, order = order[:n], order[n:]
        for i, score in zip(part, _scores(model, [pages[i] for i in part])):
            out[i] = score > 0
    return out


def _varied(blocks, labels, rng, spare):
    """A training page under other container names, with boilerplate blocks put in."""
    main, rows = rng.choice(ARTICLE_NAMES).replace("#", "."), []
    outer = rng.random() < 0.3
    names: dict[tuple[str, ...], str] = {}
    for (path, text, link), good in zip(blocks, labels):
        if good:
            path = tuple(main if s.split(".")[0] == "article" else s for s in path)
            path = (*path[:2], "div.wrapper", *path[2:]) if outer else path
        elif len(path) > 2 and rng.random() < 0.6:
            name = names.setdefault(path[2:3], str(rng.choice(OTHER_NAMES)).replace("#", "."))
            path = (*path[:2], name, *path[3:])
        rows.append(((path, text, link), good))
    for _ in range(rng.integers(1, 6)):
        at = int(rng.integers(0, len(rows) + 1))
        inside = 0 < at < len(rows) and rows[at - 1][1] and rows[min(at, len(rows) - 1)][1]
        root = ("html", "body", main) if inside or rng.random() < 0.2 else ("html", "body")
        name = str(rng.choice(OTHER_NAMES)).replace("#", ".")
        for _ in range(rng.integers(1, 4)):
            text = str(spare[rng.integers(0, len(spare))])
            text = " ".join(text.split()[:int(rng.integers(2, 40))])
            tail = (("p",), (), ("ul", "li"), ("div",))[rng.integers(0, 4)]
            rows.insert(at, (((*root, name, *tail), text or "x", float(rng.random() < 0.4)), False))
    return [r for r, _ in rows], [g for _, g in rows]


def train(pages: list[str], epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Fit the labeller on weakly labelled pages (Adam on the mean cross-entropy of all blocks). A page of more than
    ``TRAIN_BLOCKS`` blocks is labelled whole and gives one run of so many blocks, at a seeded place."""
    rng = np.random.default_rng(seed)
    parsed = []
    for blocks in map(page_blocks, pages):
        labels = weak_labels(blocks)
        at = int(rng.integers(0, len(blocks) - TRAIN_BLOCKS + 1)) if len(blocks) > TRAIN_BLOCKS else 0
        if blocks:
            parsed.append((blocks[at:at + TRAIN_BLOCKS], labels[at:at + TRAIN_BLOCKS]))
    model = new_model(seed)
    if not parsed:
        return model
    spare = [b[1] for page, _ in parsed for b in page]
    data = []
    for blocks, labels in parsed:
        data.append((page_vectors(blocks), np.array(labels, np.float32)))
        for _ in range(VARIANTS):
            rows, good = _varied(blocks, labels, rng, spare)
            data.append((page_vectors(rows), np.array(good, np.float32)))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(order), 32):
            part = [data[i] for i in order[a:a + 32]]
            x, mask = _padded([p[0] for p in part])
            y = _padded([p[1][:, None] for p in part])[0][..., 0]
            score, both, kf, kb = _forward(model, x, mask)
            ds = ((_sigmoid(score) - y) * mask / mask.sum())[..., None].astype(np.float32)
            dh = ds @ model["out"].T
            grads = dict(zip(("Wf", "Uf", "bf"), _lstm_back(x, dh[..., :HIDDEN], kf, model["Wf"], model["Uf"])))
            grads |= dict(zip(("Wb", "Ub", "bb"), _lstm_back(
                x[::-1], dh[::-1, :, HIDDEN:], kb, model["Wb"], model["Ub"])))
            grads |= {"out": np.einsum("tph,tpk->hk", both, ds), "skip": np.einsum("tpd,tpk->dk", x, ds),
                      "bias": ds.sum(axis=(0, 1))}
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                model[k] -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit_labeller(pages: DataFrame, sample: int = SAMPLE_PAGES) -> dict[str, np.ndarray]:
    """Train on the ``sample`` pages with the smallest hashes of id and url: the same ones on any layout. The hashes are
    ranked first (8 bytes a page), so a task sends no pages but the chosen ones."""
    keyed = pages.where("html is not null and html <> ''").select(
        F.xxhash64(F.col("page_id").cast("long"), F.col("url").cast("string")).alias("key"), F.col("html").cast("string"))
    last = keyed.select("key").orderBy("key").limit(sample).agg(F.max("key")).first()[0]
    rows = keyed.where(F.col("key") <= F.lit(last)).limit(sample).collect() if last is not None else []
    return train(sorted(r["html"] for r in rows))


def main_text(pages: DataFrame, model: dict[str, np.ndarray] | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per input row: the article's blocks joined by line breaks.

    Null or empty html, or a page without article blocks: empty text. Repeated rows are labelled one by one; null ids
    and urls are kept; other columns are ignored. An empty table gives an empty result. Whole pages are read, whatever
    their length: reading is linear in it, labelling holds one vector a block of the pages of a chunk.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or fit_labeller(pages))

    def run(batches):
        for batch in batches:
            htmls = [h or "" for h in batch.column(2).to_pylist()]
            for a, b in byte_chunks(htmls):
                blocks = [page_blocks(h) for h in htmls[a:b]]
                good = label_pages(shared.value, [page_vectors(x) for x in blocks])
                texts = ["\n".join(t for (_, t, _), keep in zip(x, g) if keep) for x, g in zip(blocks, good)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return arrow_map(read, run, "page_id long, url string, text string, n_chars long")
