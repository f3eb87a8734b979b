"""Main text of web pages: a recurrent labeller over the page's blocks.

A page is cut into blocks in document order. Each block is a vector: the hashed
tags, classes and ids on its path, its hashed words, a few proportions. A
bidirectional LSTM in numpy reads the whole sequence, so each block is judged with all
others of the page in view; blocks labelled main text are joined in order.

It is trained here, on a bounded sample of those pages themselves that mark their
article (article or main), long ones in a bounded number of windows. These give the labels; copies of them with the marks taken
away, other names in their place, and further parts (comments, side columns, forms,
notices, made of texts from other pages) teach it not to lean on one layout.

Pages are independent: extraction is one pass without a shuffle, and the model (a few
hundred kilobytes, fixed by parameters) travels with the tasks.

Defined cases: null, empty and text-free pages give an empty text; a broken or
cut-off page is read as far as it goes; a page may have any number of blocks; repeated rows are extracted each; without a page to
learn from, blocks under article or main are taken; extra columns do not matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches, bounded_sample, table
from tidemark.llm.hashing import hash_words
from tidemark.llm.html_blocks import PATH_SLOTS, Block, blocks, slot

WORD_SLOTS = 256
NUMBERS = 5
WIDTH, HIDDEN = 24, 16
SPARSE = PATH_SLOTS + WORD_SLOTS
MAX_PAGES = 160
# Pages are learned from in windows of so many blocks, and a page in so many of them.
WINDOW, MAX_WINDOWS = 400, 4
# Steps whose gates are computed at a time.
STEPS = 1024
# Pages are labelled together in groups of about so many blocks.
GROUP_BLOCKS = 4096
BATCH_BYTES = 1 << 20


class Sheet:
    """A page's blocks as sparse vectors: for block i the entries starts[i] to starts[i + 1] of cols and values, and a row of numbers.

    Path slots count 1, word slots share a length of 1.
    """

    def __init__(self, page: list[Block]):
        n = len(page)
        words = [b.text.lower().encode().split() for b in page]
        counts = np.array([len(w) for w in words], np.int64)
        hashed = (hash_words([w for own in words for w in own]) % np.uint64(WORD_SLOTS)).astype(np.int64)
        path = np.array([s for b in page for s in b.slots], np.int64)
        rows = np.concatenate([np.repeat(np.arange(n), [len(b.slots) for b in page]), np.repeat(np.arange(n), counts)])
        entry = np.unique(rows * SPARSE + np.concatenate([path, PATH_SLOTS + hashed]))
        row, self.cols = entry // SPARSE, entry % SPARSE
        is_word = self.cols >= PATH_SLOTS
        distinct = np.bincount(row[is_word], minlength=n)  # every block has a word
        self.values = np.where(is_word, 1 / np.sqrt(distinct[row]), 1).astype(np.float32)
        self.starts = np.searchsorted(row, np.arange(n + 1))
        length = np.array([len(b.text) for b in page], float)
        self.numbers = np.stack(
            [
                np.log1p(length) / 8,
                np.array([b.linked for b in page]) / length,
                np.array([b.text[-1] in ".!?" for b in page], float),
                np.arange(n) / n,
                np.log1p(counts) / 6,
            ],
            1,
        ).astype(np.float32)

    def __len__(self) -> int:
        return len(self.numbers)

    def dense(self, begin: int, end: int) -> np.ndarray:
        """One row for each of these blocks: path slots, word slots, numbers."""
        out = np.zeros((end - begin, SPARSE + NUMBERS), np.float32)
        held = slice(self.starts[begin], self.starts[end])
        out[np.repeat(np.arange(end - begin), np.diff(self.starts[begin : end + 1])), self.cols[held]] = self.values[held]
        out[:, SPARSE:] = self.numbers[begin:end]
        return out

    def projected(self, e: np.ndarray) -> np.ndarray:
        """The dense rows times `e`, without making them."""
        out = self.numbers @ e[SPARSE:]
        for begin in range(0, len(self), GROUP_BLOCKS):
            end = min(begin + GROUP_BLOCKS, len(self))
            held = slice(self.starts[begin], self.starts[end])
            # Every block has an entry.
            out[begin:end] += np.add.reduceat(e[self.cols[held]] * self.values[held, None], self.starts[begin:end] - self.starts[begin])
        return out


@dataclass
class Model:
    """e: projection of the vectors; for each direction wx, wh, b (gates i, f, o, g); v, u, c: output."""

    p: dict[str, np.ndarray]

    def logits(self, pages: list[list[Block]]) -> list[np.ndarray]:
        if not pages:
            return []
        lengths = np.array([len(x) for x in pages])
        order = np.argsort(-lengths, kind="stable")
        y = np.zeros((len(pages), lengths.max(), WIDTH), np.float32)
        for row, i in enumerate(order):
            y[row, : lengths[i]] = np.tanh(Sheet(pages[i]).projected(self.p["e"]))
        g, _ = _read(self.p, y, lengths[order], keep=False)
        out: list = [None] * len(pages)
        for row, i in enumerate(order):
            out[i] = g[row, : lengths[i]]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _reverse(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each sequence backwards; its padding stays behind it."""
    at = lengths[:, None] - 1 - np.arange(x.shape[1])
    at = np.where(at >= 0, at, np.arange(x.shape[1]))
    return np.take_along_axis(x, at[:, :, None], 1)


def _lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray, keep: bool = True) -> tuple[np.ndarray, list]:
    """The states of every step, and what their gradients need if these are to be `kept`."""
    h = c = np.zeros((len(x), HIDDEN), x.dtype)
    hs, kept = np.empty((*x.shape[:2], HIDDEN), np.result_type(x, wx)), []
    for t in range(x.shape[1]):
        if t % STEPS == 0:
            gates = x[:, t : t + STEPS] @ wx + b
        z = gates[:, t % STEPS] + h @ wh
        ifo = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = np.split(ifo, 3, 1)
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        if keep:
            kept.append((h, before, i, f, o, g, tc))
        h = o * tc
        hs[:, t] = h
    return hs, kept


def forward(p: dict, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, tuple]:
    return _read(p, np.tanh(x @ p["e"]), lengths)


def _read(p: dict, y: np.ndarray, lengths: np.ndarray, keep: bool = True) -> tuple[np.ndarray, tuple]:
    ahead, kept_a = _lstm(y, p["wx0"], p["wh0"], p["b0"], keep)
    turned = _reverse(y, lengths)
    back, kept_b = _lstm(turned, p["wx1"], p["wh1"], p["b1"], keep)
    h = np.concatenate([ahead, _reverse(back, lengths)], 2)
    return h @ p["v"] + y @ p["u"] + p["c"], (y, turned, h, kept_a, kept_b)


def _lstm_gradients(d: np.ndarray, x: np.ndarray, kept: list, wx: np.ndarray, wh: np.ndarray):
    dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    dh = dc = np.zeros((len(x), HIDDEN), np.float32)
    dwh = np.zeros_like(wh)
    for t in range(x.shape[1] - 1, -1, -1):
        h, before, i, f, o, g, tc = kept[t]
        dh = dh + d[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        dz_all[:, t] = dz
        dwh += h.T @ dz
        dh, dc = dz @ wh.T, dc * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return dz_all @ wx.T, x.reshape(-1, WIDTH).T @ flat, dwh, flat.sum(0)


def gradients(p: dict, x: np.ndarray, lengths: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
    g, (y, turned, h, kept_a, kept_b) = forward(p, x, lengths)
    mask = np.arange(x.shape[1]) < lengths[:, None]
    d = ((_sigmoid(g) - truth) * mask / mask.sum()).astype(np.float32)
    dh = d[:, :, None] * p["v"]
    out = {"v": np.einsum("bt,bth->h", d, h), "u": np.einsum("bt,btx->x", d, y), "c": d.sum(keepdims=True)[0]}
    dy = d[:, :, None] * p["u"]
    da, out["wx0"], out["wh0"], out["b0"] = _lstm_gradients(dh[:, :, :HIDDEN], y, kept_a, p["wx0"], p["wh0"])
    db, out["wx1"], out["wh1"], out["b1"] = _lstm_gradients(_reverse(dh[:, :, HIDDEN:], lengths), turned, kept_b, p["wx1"], p["wh1"])
    dy = (dy + da + _reverse(db, lengths)) * (1 - y * y)
    out["e"] = x.reshape(-1, x.shape[2]).T @ dy.reshape(-1, WIDTH)
    return out


def fresh(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
    p = {"e": draw(SPARSE + NUMBERS, WIDTH), "v": draw(2 * HIDDEN), "u": draw(WIDTH), "c": np.zeros(1, np.float32)}
    for way in "01":
        p |= {f"wx{way}": draw(WIDTH, 4 * HIDDEN), f"wh{way}": draw(HIDDEN, 4 * HIDDEN), f"b{way}": np.zeros(4 * HIDDEN, np.float32)}
        p[f"b{way}"][HIDDEN : 2 * HIDDEN] = 1
    return p


def train(pages: list[tuple[Sheet, int, int, np.ndarray]], epochs: int = 20, seed: int = 3, rate: float = 0.01) -> Model:
    """Adam on the cross-entropy of the labels of blocks begin to end of each sheet; names on the path are dropped at random."""
    p, rng, step = fresh(seed), np.random.default_rng(seed), 0
    m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    steps = epochs * -(-len(pages) // 32)
    for _ in range(epochs):
        # Batches of pages of like length, in any order.
        by_length = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i][3]))
        for part in rng.permutation(range(0, len(pages), 32)):
            own = [pages[i] for i in by_length[part : part + 32]]
            lengths = np.array([len(labels) for *_, labels in own])
            x = np.zeros((len(own), lengths.max(), SPARSE + NUMBERS), np.float32)
            truth = np.zeros(x.shape[:2], np.float32)
            for i, (sheet, begin, end, labels) in enumerate(own):
                vector = sheet.dense(begin, end)
                gone = rng.random(vector.shape[1]) < 0.15
                gone[-NUMBERS:] = False
                x[i, : len(labels)] = np.where(gone, 0, vector)
                truth[i, : len(labels)] = labels
            step += 1
            for k, g in gradients(p, x, lengths, truth).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                p[k] = (p[k] - rate * (1 - (step - 1) / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(p)


_OPEN = re.compile(r"<(article|main)\b([^>]*)>", re.I)
_OPEN_SQL = r"(?i)<(article|main)\b[^>]*>"
_SHUT = re.compile(r"</(article|main)\s*>", re.I)
_TRUTH = re.compile("data-truth", re.I)
# Names that pages give their parts: main text, then other parts.
MAIN_NAMES = ["content", "post", "entry", "article-body", "story", "main-content", "post-content", "text", "page-content"]
SIDE_NAMES = {
    "nav": ["menu", "navbar", "breadcrumbs", "navigation", "toc"],
    "header": ["header", "masthead", "site-header", "topbar"],
    "footer": ["footer", "site-footer", "bottom", "copyright"],
    "aside": ["sidebar", "widget", "related", "side", "recommended", "promo", "newsletter", "share"],
    "section": ["comments", "comment-list", "discussion", "replies", "responses"],
    "form": ["search", "login", "subscribe", "signup", "contact-form"],
    "div": ["ad", "ads", "advert", "banner", "sponsored", "cookie-notice", "notice", "alert", "popup", "consent", "modal"],
}


def _side(rng: np.random.Generator, kind: str, texts: list[str]) -> str:
    """A part that is no main text, made of texts of other pages."""
    pick = lambda: texts[rng.integers(len(texts))]
    some = lambda: " ".join(pick().split()[: int(rng.integers(1, 40))])
    name = SIDE_NAMES[kind][rng.integers(len(SIDE_NAMES[kind]))]
    tag = kind if rng.random() < 0.5 else "div"
    count = int(rng.integers(1, 5))
    if kind in ("nav", "aside") and rng.random() < 0.6:
        inner = "<ul>" + "".join(f'<li><a href="/x">{" ".join(some().split()[:3])}</a></li>' for _ in range(count)) + "</ul>"
    elif kind == "section":
        inner = "<h2>" + " ".join(some().split()[:2]) + "</h2>" + "".join(f'<div class="comment"><b>{some().split()[0]}</b><p>{pick()}</p></div>' for _ in range(count))
    elif kind == "form":
        inner = f"<label>{some().split()[0]}</label><input><button>{some().split()[0]}</button>" + f"<p>{some()}</p>" * int(rng.integers(0, 2))
    else:
        inner = "".join(f"<p>{some()}</p>" if rng.random() < 0.5 else some() for _ in range(max(1, count // 2)))
    how = f' class="{name}"' if rng.random() < 0.7 else f' id="{name}"'
    return f'<{tag}{how if tag == "div" or rng.random() < 0.5 else ""} data-truth="0">{inner}</{tag}>'


def variants(html: str, texts: list[str], rng: np.random.Generator, count: int = 3) -> list[str]:
    """The page with its article marked as truth: as it is, and in other layouts. [] if it marks no article."""
    if not _OPEN.search(html):
        return []
    html = _TRUTH.sub("data-own", html)  # the mark is ours alone
    out = [_OPEN.sub(r'<\1\2 data-truth="1">', html)]
    for _ in range(count):
        name = MAIN_NAMES[rng.integers(len(MAIN_NAMES))]
        before, after, inside = ("".join(_side(rng, k, texts) for k in rng.permutation(list(SIDE_NAMES))[: rng.integers(0, n)]) for n in (4, 4, 2))
        form = rng.integers(3)
        opened = {0: f'<div class="{name}" data-truth="1">', 1: f'<div id="{name}" data-truth="1">'}.get(int(form))
        page = _SHUT.sub(lambda m: inside + ("</div>" if opened else m[0]) + after, html)
        page = _OPEN.sub(lambda m: before + (opened or f'<{m[1]}{m[2]} data-truth="1">'), page)
        for tag in ("nav", "footer", "header", "aside"):
            if rng.random() < 0.5:
                other = SIDE_NAMES[tag][rng.integers(len(SIDE_NAMES[tag]))]
                page = re.sub(rf"<{tag}\b[^>]*>", f'<div class="{other}" data-truth="0">', page).replace(f"</{tag}>", "</div>")
        out.append(page)
    return out


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html", most: int = MAX_PAGES, seed: int = 3) -> Model | None:
    """Learn from the pages that mark an article: all, or about `most` of them, however many pages there are besides."""
    rows = pages.select(F.col(page_id).alias("id"), F.col(html).alias("html")).where(F.col("html").rlike(_OPEN_SQL))
    sample = sorted(bounded_sample(rows, ["id", "html"], most).toArrow().to_pylist(), key=lambda r: (r["id"] is None, r["id"], r["html"]))
    rng = np.random.default_rng(seed)
    texts = [b.text for r in sample for b in blocks(r["html"]) if len(b.text) > 20] or ["text"]
    marked = [blocks(v) for r in sample for v in variants(r["html"], texts, rng)]
    learnt = [window for page in marked if page for window in windows(page, rng)]
    return train(learnt, seed=seed) if learnt else None


def windows(page: list[Block], rng: np.random.Generator) -> list[tuple[Sheet, int, int, np.ndarray]]:
    """The page to learn from; of one of more than `WINDOW` blocks as many windows of so many, at most `MAX_WINDOWS`, drawn by chance."""
    sheet, truth = Sheet(page), np.array([b.truth for b in page], np.float32)
    begins = np.arange(0, len(page), WINDOW)
    chosen = begins if len(begins) <= MAX_WINDOWS else np.sort(rng.choice(begins, MAX_WINDOWS, replace=False))
    return [(sheet, int(a), min(int(a) + WINDOW, len(page)), truth[a : a + WINDOW]) for a in chosen]


_MARKED = {slot("article"), slot("main")}


def extract(pages: DataFrame, model: Model | None, html: str = "html") -> DataFrame:
    """`pages` but for `html`, with `text` (main text) and `n_chars`; a column of these names is replaced."""
    own = pages.select(F.struct(*[pages[c] for c in pages.columns if c != html and c not in ("text", "n_chars")]).alias("row"), pages[html].alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def labelled(group: list[list[Block]]) -> list[str]:
        known = shared.value
        if known is None:
            return [" ".join(b.text for b in page if _MARKED & set(b.slots)) for page in group]
        filled = [page for page in group if page]
        marks = iter(known.logits(filled))
        return [" ".join(b.text for b, g in zip(page, next(marks), strict=True) if g > 0) if page else "" for page in group]

    def run(source):
        for batch in batches(BATCH_BYTES)(source):
            read = [blocks(h) if h else [] for h in batch.column(1).to_pylist()]
            texts: list = [""] * len(read)
            group: list[int] = []
            # Pages of like length share a group, so little of it is padding.
            for i in sorted(range(len(read)), key=lambda i: len(read[i])):
                if group and (len(group) + 1) * len(read[i]) > GROUP_BLOCKS:
                    for k, text in zip(group, labelled([read[k] for k in group]), strict=True):
                        texts[k] = text
                    group = []
                group.append(i)
            for k, text in zip(group, labelled([read[k] for k in group]), strict=True):
                texts[k] = text
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    schema = own.schema["row"].dataType.simpleString()
    return own.mapInArrow(run, f"row {schema}, text string").select("row.*", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages.select("page_id", "url", "html"), fit(pages))
