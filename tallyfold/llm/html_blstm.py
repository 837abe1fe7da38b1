"""HTML extraction: a recurrent block labeller.

A page is read into its leaf blocks: runs of text between block-level tags, each with the path of its
open elements (names, class, id and role words), its share of link text and its words, all of them.  Nothing is
thrown away before it is judged but what a page does not show: scripts, styles, templates, titles, comments,
annotations of formulas and the raw content of frames and text areas.  Formulas and drawings are part of the
text around them; buttons, choices and what stands in for media are insets, blocks of their own within a block.  A
head ends where HTML ends it, at the first thing that does not belong in one.  Paths and
words are hashed into fixed-size vectors; a bidirectional LSTM (numpy) reads the blocks of the whole page and
labels each of them, so a block is judged in the light of all others.  Blocks labelled as article
are joined in page order by an empty line.

The model is trained here: ``train`` generates ``TRAIN_PAGES`` labelled pages (a documented, fixed bound)
from page plans with articles, menus, headers, footers, sidebars, notices, adverts, forms and
comments in many markups, with a fixed seed, and fits the network by Adam in 10 to 20 seconds on the
driver.  The weights (about 0.2 MB whatever the data) go to the executors with the function.
Everything else is row-local: one pass over the pages, no shuffle.

Defined cases: null and empty html give an empty text; a page without tags is one block; broken
markup is read as far as it goes (unknown end tags are ignored, an open tag at the end is text);
null ids, repeated rows and other columns, whatever their names, are carried in ``row``; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import process_cache

#: A path size at which no element that tells much shares its hashed position with another one.
PATH_DIM, WORD_DIM, OTHER_DIM, HIDDEN = 250, 96, 8, 24
DIM = PATH_DIM + WORD_DIM + OTHER_DIM
TRAIN_PAGES, EPOCHS, SEED = 3200, 7, 20
#: Article blocks that are lost weigh more than strays: a block counts as article from here.
THRESHOLD = 0.4

# Elements of HTML by how they are read.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
HIDDEN_PARTS = frozenset("template annotation annotation-xml".split())
INSETS = frozenset("audio button canvas datalist object select video".split())
RAW = frozenset("script style textarea title noembed noframes iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
#: An element is not closed by a start tag across these.
FENCES = frozenset("table ul ol dl div section article aside main nav form blockquote body td th header footer".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile(r"\d")
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Element:
    """An open element: its own labels and, counted once, the labels of all elements around it too."""

    __slots__ = ("outer", "labels", "counts")

    def __init__(self, outer: Element | None, labels: list[str]):
        self.outer, self.labels, self.counts = outer, labels, None


@dataclass
class Block:
    element: Element | None
    text: str
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        own, at = [], self.element
        while at is not None:
            own.append(at.labels)
            at = at.outer
        return tuple(w for ws in reversed(own) for w in ws)


def _labels(name: str, attrs: str) -> list[str]:
    out = [f"<{name}>"]
    if attrs:
        for kind, a, b, c in _ATTR.findall(attrs):
            words = [w.lower() for w in _NAME_WORDS.findall(a or b or c)]
            out += words
            if kind.lower() == "itemprop":
                out += ["itemprop"]
    return out


class _Reader:
    """Open elements and the text since the last block ended."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, Element]] = []
        self.parts: list[str] = []
        self.inset: tuple[str, Element, list[str]] | None = None
        self.linked = self.hidden = self.in_link = 0

    def _emit(self, element: Element | None, parts: list[str], linked: int) -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            self.blocks.append(Block(element, text, min(linked, len(text))))

    def around(self) -> Element | None:
        return self.stack[-1][1] if self.stack else None

    def end_inset(self) -> None:
        if self.inset is not None:
            (_, element, parts), self.inset = self.inset, None
            self._emit(element, parts, 0)

    def end_block(self) -> None:
        self.end_inset()
        if self.parts:
            self._emit(self.around(), self.parts, self.linked)
        self.parts, self.linked = [], 0

    def pop_to(self, i: int) -> None:
        self.hidden -= sum(name in HIDDEN_PARTS for name, _ in self.stack[i:])
        del self.stack[i:]

    def add(self, text: str) -> None:
        if not text or self.hidden:
            return
        if self.inset is not None:
            self.inset[2].append(text)
            return
        self.parts.append(text)
        if self.in_link:
            self.linked += len(text.strip())

    def close(self, name: str) -> None:
        if name == "a":
            self.in_link = 0
        elif name in INSETS:
            if self.inset is not None and self.inset[0] == name:
                self.end_inset()
        elif name in BLOCKS or name in HIDDEN_PARTS:
            if name in BLOCKS and self.inset is not None and name in ("option", "optgroup"):
                self.add(" ")
                return
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == name:
                    if name in BLOCKS:
                        self.end_block()
                        self.in_link = 0
                    self.pop_to(k)
                    return
            if name in BLOCKS:
                self.end_block()

    def open(self, name: str, attrs: str) -> None:
        if name in ("br", "wbr"):
            self.add(" " if name == "br" else "")
        elif name == "a":
            self.in_link = 1
        elif name in ("html", "head"):  # they hold the page and split nothing
            pass
        elif self.inset is not None and name in ("option", "optgroup"):
            self.add(" ")
        elif name in INSETS:
            self.end_inset()
            if not self.hidden:
                self.inset = (name, Element(self.around(), _labels(name, attrs)), [])
        elif name in HIDDEN_PARTS:
            if not attrs.rstrip().endswith("/"):
                self.stack.append((name, Element(self.around(), _labels(name, attrs))))
                self.hidden += 1
        elif name in VOID:
            if name in BLOCKS:
                self.end_block()
        elif name in BLOCKS:
            self.end_block()
            self.in_link = 0
            if name == "body":
                self.pop_to(0)
            closes = CLOSED_BY.get(name, frozenset()) | {"p"}
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in closes:
                    self.pop_to(k)
                    break
                if self.stack[k][0] in FENCES:
                    break
            self.stack.append((name, Element(self.around(), _labels(name, attrs))))


def read_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; ones without text are left out."""
    r = _Reader()
    at, size = 0, len(page)
    while at < size:
        i = page.find("<", at)
        if i < 0:
            r.add(page[at:])
            break
        if i > at:
            r.add(page[at:i])
        m = _TOKEN.match(page, i)
        if not m:
            r.add("<")
            at = i + 1
            continue
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            r.close(name)
        elif name in RAW:  # everything up to its end tag
            close = re.compile(rf"</{name}[^>]*>", re.I).search(page, at)
            at = close.end() if close else size
        else:
            r.open(name, m[3] or m[6] or "")
    r.end_block()
    return r.blocks


# ---- vectors ---------------------------------------------------------------------------------------


class _Slots(dict):
    """word -> hashed position, kept for a bounded number of words."""

    def __init__(self, dim: int, strip: str):
        self.dim, self.strip = dim, strip

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        bare = word.strip(self.strip)
        got = self[word] = crc32(bare.encode("utf-8", "replace")) % self.dim if bare else self.dim  # the last is thrown away
        return got


def _path_counts(element: Element | None, slots: _Slots) -> np.ndarray:
    """Labels by slot over the whole path; each element adds its own to those of the one around it."""
    todo = []
    while element is not None and element.counts is None:
        todo.append(element)
        element = element.outer
    counts = np.zeros(PATH_DIM, np.float32) if element is None else element.counts
    for e in reversed(todo):
        e.counts = counts = counts + np.bincount([slots[w] for w in e.labels], minlength=PATH_DIM)[:PATH_DIM].astype(np.float32)
    return counts


def _path_vector(element: Element | None, slots: _Slots) -> np.ndarray:
    """Every label weighs 1 at any depth, the innermost three 0.5 more; more than two alike count as two."""
    out, last = np.minimum(_path_counts(element, slots), 2), 3
    while element is not None and last:
        for w in element.labels[::-1][:last]:
            last -= 1
            if (k := slots[w]) < PATH_DIM:
                out[k] += 0.5
        element = element.outer
    return out


def vectors(blocks: list[Block]) -> np.ndarray:
    cache = process_cache("html_slots")
    if not cache:
        cache["p"], cache["w"] = _Slots(PATH_DIM, ""), _Slots(WORD_DIM, "|.,;:!?()\"'")
    of_path, of_word = cache["p"], cache["w"].__getitem__
    n, o = len(blocks), PATH_DIM + WORD_DIM
    x = np.zeros((n, DIM), np.float32)
    for i, b in enumerate(blocks):
        row = x[i]
        row[:PATH_DIM] = _path_vector(b.element, of_path)
        text, size = b.text, len(b.text)
        words = text.lower().split()
        # all words; from 64 on in proportion, so that a long block keeps the scale
        row[PATH_DIM:o] = np.bincount(list(map(of_word, words)), minlength=WORD_DIM)[:WORD_DIM] / max(math.sqrt(len(words)), len(words) / 8)
        row[o:] = (math.log1p(len(words)) / 4, b.linked / size, text[-1] in ".!?:;\"'", "©" in text, len(_DIGITS.findall(text)) / size, i / n, (n - 1 - i) / n, 1.0)
    return np.minimum(x, 2.5)


# ---- network -----------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, keep: bool = False):
    """Hidden states of one direction. ``x``: (time, lanes, dim); padded steps leave the state alone."""
    steps, lanes, _ = x.shape
    h, c = np.zeros((lanes, HIDDEN), np.float32), np.zeros((lanes, HIDDEN), np.float32)
    out, saved = np.empty((steps, lanes, HIDDEN), np.float32), []
    pre = (x.reshape(steps * lanes, -1) @ w).reshape(steps, lanes, -1)
    for t in range(steps):
        z = pre[t] + h @ u
        s = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        c1 = f * c + i * g
        th = np.tanh(c1)
        if keep:
            saved.append((h, c, i, f, o, g, th, m))
        h, c = np.where(m, o * th, h), np.where(m, c1, c)
        out[t] = h
    return out, saved


def _lstm_back(dout: np.ndarray, x: np.ndarray, u: np.ndarray, saved: list) -> tuple[np.ndarray, np.ndarray]:
    steps, lanes, dim = x.shape
    dz = np.empty((steps, lanes, 4 * HIDDEN), np.float32)
    du = np.zeros_like(u)
    dh, dc = np.zeros((lanes, HIDDEN), np.float32), np.zeros((lanes, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, th, m = saved[t]
        dh = dh + dout[t]
        dho = np.where(m, dh, 0)
        d1 = np.where(m, dc, 0) + dho * o * (1 - th * th)
        dz[t] = np.concatenate((d1 * g * i * (1 - i), d1 * c * f * (1 - f), dho * th * o * (1 - o), d1 * i * (1 - g * g)), 1)
        du += h.T @ dz[t]
        dh = np.where(m, 0, dh) + dz[t] @ u.T
        dc = np.where(m, d1 * f, dc)
    return x.reshape(-1, dim).T @ dz.reshape(-1, 4 * HIDDEN), du


Weights = dict[str, np.ndarray]


def _pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), DIM), np.float32), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, True
    return x, mask


def predict(weights: Weights, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of being article text for every block of each page."""
    out: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):  # pages of about one length together, within a bounded number of cells
        steps = len(pages[order[at]])
        take = max(1, min(128, 20_000 // max(steps, 1)))
        group = order[at : at + take]
        at += take
        x, mask = _pad([pages[i] for i in group])
        forth, _ = _lstm(x, mask, weights["wf"], weights["uf"])
        back, _ = _lstm(x[::-1], mask[::-1], weights["wb"], weights["ub"])
        p = _sigmoid(np.concatenate((forth, back[::-1]), 2) @ weights["v"] + weights["b"])
        for k, i in enumerate(group):
            out[i] = p[: len(pages[i]), k]
    return out


def fit(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = SEED) -> Weights:
    rng = np.random.default_rng(seed)
    f32 = lambda *s: (rng.normal(0, 1, s) / np.sqrt(s[0])).astype(np.float32)
    w: Weights = {"wf": f32(DIM, 4 * HIDDEN), "uf": f32(HIDDEN, 4 * HIDDEN), "wb": f32(DIM, 4 * HIDDEN), "ub": f32(HIDDEN, 4 * HIDDEN), "v": f32(2 * HIDDEN), "b": np.zeros(1, np.float32)}
    m1 = {k: np.zeros_like(a) for k, a in w.items()}
    m2 = {k: np.zeros_like(a) for k, a in w.items()}
    step = 0
    order = sorted(range(len(pages)), key=lambda i: len(pages[i][0]))
    groups = [order[i : i + 32] for i in range(0, len(order), 32)]
    for epoch in range(epochs):
        for g in rng.permutation(len(groups)):
            own = [pages[i] for i in groups[g]]
            x, mask = _pad([p for p, _ in own])
            x[:, rng.random(len(own)) < 0.4, PATH_DIM : PATH_DIM + WORD_DIM] = 0  # words are a hint, not a must
            y = np.zeros(mask.shape, np.float32)
            for k, (_, labels) in enumerate(own):
                y[: len(labels), k] = labels
            forth, sf = _lstm(x, mask, w["wf"], w["uf"], True)
            back, sb = _lstm(x[::-1], mask[::-1], w["wb"], w["ub"], True)
            both = np.concatenate((forth, back[::-1]), 2)
            d = np.where(mask, _sigmoid(both @ w["v"] + w["b"]) - y, 0).astype(np.float32) / mask.sum()
            dboth = d[..., None] * w["v"]
            gf = _lstm_back(dboth[..., :HIDDEN], x, w["uf"], sf)
            gb = _lstm_back(dboth[::-1, :, HIDDEN:], np.ascontiguousarray(x[::-1]), w["ub"], sb)
            grads = {"wf": gf[0], "uf": gf[1], "wb": gb[0], "ub": gb[1], "v": np.einsum("tlh,tl->h", both, d), "b": d.sum(keepdims=False).reshape(1)}
            step += 1
            rate = 0.01 * (1 - step / (epochs * len(groups) + 1))
            for k, a in grads.items():
                m1[k] += 0.1 * (a - m1[k])
                m2[k] += 0.01 * (a * a - m2[k])
                w[k] -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w


@functools.lru_cache(maxsize=2)
def train(pages: int = TRAIN_PAGES, seed: int = SEED) -> Weights:
    """Weights fitted on ``pages`` generated pages: the same every time."""
    from .page_plans import labelled_pages

    data = []
    for blocks, labels in labelled_pages(pages, seed):
        if blocks:
            data.append((vectors(blocks), np.array(labels, np.float32)))
    return fit(data, seed=seed)


# ---- operator ----------------------------------------------------------------------------------------


def extract_texts(weights: Weights, pages: list[str], threshold: float = THRESHOLD) -> list[str]:
    blocks = [read_blocks(p) for p in pages]
    scores = predict(weights, [vectors(b) for b in blocks])
    return ["\n\n".join(x.text for x, s in zip(b, p.tolist(), strict=True) if s >= threshold) for b, p in zip(blocks, scores, strict=True)]


def _extract(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [x or "" for x in batch.column(1).to_pylist()]
            texts: list[str] = []
            for at in range(0, len(pages), 256):
                texts += extract_texts(weights, pages[at : at + 256])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    return run


def extract_main_text(pages: DataFrame, html_col: str = "html", carry: list[str] | None = None, weights: Weights | None = None) -> DataFrame:
    """``row text`` per input row."""
    carry = [c for c in pages.columns if c != html_col] if carry is None else carry
    base = pages.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{html_col}`").alias("html"))
    return base.mapInArrow(_extract(train() if weights is None else weights), f"row {base.schema['row'].dataType.simpleString()}, text string")
