"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks (runs of text between block-level tags).  Each
block is a vector of its tag path (the elements around it, with hashed words of their
class and id), hashed words of its text and a few densities.  A bidirectional
LSTM, written in numpy, reads a page's blocks in order and labels each
with the context of the whole page; blocks labelled main are joined.

The labeller is trained on the driver from a bounded sample of the given pages
(at most ``SAMPLE_PAGES`` of any size, fewer when they are long, parameters).  Their own semantic elements
give labels (inside article or main, outside navigation, asides, footers and forms), and
their blocks are also laid out anew in other page frames, whose regions are known, so
that the labeller learns class names and positions besides one site's tags.  Extraction reads
every page whole: pages of similar length are padded together in bounded groups.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.bytewords import Hasher
from vaultspark.llm.common import small_batches, texts

SAMPLE_PAGES = 200
#: Bytes of the sample, and those of a page from which its head and tail stand for it.
SAMPLE_BYTES = 12 << 20
PAGE_BYTES = 512 << 10
#: Blocks of a training sequence, and sequences taken from a page longer than that.
RUN, RUNS = 512, 4
HIDDEN = 16
#: Elements that do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
#: Elements whose content is not text of the page.
RAW = frozenset("script style title template iframe svg noembed noframes textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the key's kind ends when one of its values' kinds begins.
ENDS = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
        "option": {"option"}}
TAGS = ("article main section div p h1 h2 h3 h4 h5 h6 ul ol li table tr td th blockquote pre nav header footer aside form "
        "figure figcaption dl dd dt body button select option fieldset address details other").split()
TAG_AT = {t: k for k, t in enumerate(TAGS)}
N_CLASS, N_WORD, N_DENSE = 64, 24, 13
N_INPUT = 2 * len(TAGS) + N_CLASS + N_WORD + N_DENSE
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")


@dataclass
class Block:
    """Text of a leaf, the tags around it (outermost first), their class words, and how many of its characters are in links."""

    text: str
    path: tuple[str, ...]
    names: tuple[str, ...]
    linked: int = 0


def parse(page: str) -> list[Block]:
    """Leaf blocks in page order; white space is one space, character references are decoded.
    Unclosed and stray tags are tolerated; a tag cut off by the end of the page is not text."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    buffer: list[str] = []
    links, linked, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                blocks.append(Block(text, tuple(t for t, _ in stack), tuple(n for _, ns in stack for n in ns), min(linked, len(text))))
            buffer.clear()
        linked = 0

    n = len(page)
    while at < n:
        m = TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            buffer.append(page[at:stop])
            if links:
                linked += stop - at
        if not m:
            break
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        close = m.group(1) == "/"
        if tag in RAW:
            if not close and not m.group(3).endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if close else 1
            elif tag == "br":
                buffer.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        links = 0
        if close:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        while stack and stack[-1][0] in ENDS and (ENDS[stack[-1][0]] is None or tag in ENDS[stack[-1][0]]):
            stack.pop()
        names = tuple(w.lower() for x in NAMES.findall(m.group(3)) for w in SPLIT.split("".join(x)) if w) if m.group(3) else ()
        stack.append((tag, names[:12]))
    flush()
    return blocks


# -- vectors --------------------------------------------------------------

def _class_at(name: str) -> int:
    name = name.rstrip("0123456789")
    if len(name) > 4 and name.endswith("s"):
        name = name[:-1]
    return zlib.crc32(name.encode()) % N_CLASS


def vectors(hasher: Hasher, pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages, in order."""
    blocks = [b for p in pages for b in p]
    x = np.zeros((len(blocks), N_INPUT), dtype=np.float32)
    if not blocks:
        return x
    raw = [b.text.encode("utf-8", "replace") for b in blocks]
    w = hasher.words(raw)
    words = np.bincount(w.row, minlength=len(blocks)).astype(np.float32)
    base = 2 * len(TAGS) + N_CLASS
    bucket = (w.hash >> np.uint64(40)).astype(np.int64) % N_WORD
    hashed = np.bincount(w.row * N_WORD + bucket, minlength=len(blocks) * N_WORD).reshape(len(blocks), N_WORD)
    x[:, base: base + N_WORD] = hashed / np.sqrt(np.maximum(words, 1))[:, None]
    other = TAG_AT["other"]
    k, dense = 0, np.zeros((len(blocks), N_DENSE), dtype=np.float32)
    for p in pages:
        total = max(1, len(p))
        for i, b in enumerate(p):
            row = x[k]
            for t in b.path:
                row[TAG_AT.get(t, other)] = 1
            if b.path:
                row[len(TAGS) + TAG_AT.get(b.path[-1], other)] = 1
            for name in b.names:
                row[2 * len(TAGS) + _class_at(name)] = 1
            t, n = b.text, len(b.text)
            dense[k] = (np.log1p(n) / 5, b.linked / n, i / total, 1 / total, len(b.path) / 10, t[-1] in ".!?\"'»”:;…", t[0].isupper(),
                        (t.count(".") + t.count(",")) / n * 10, "©" in t, t.isupper(), "|" in t or "·" in t, n < 25, 0)
            k += 1
    dense[:, 12] = np.log1p(words) / 4
    x[:, base + N_WORD:] = dense
    return x


# -- the network ----------------------------------------------------------

def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a, -30, 30)))


@dataclass
class Labeller:
    """One LSTM each way (input weights, recurrent weights, bias; gates i, f, o, g) and a logistic layer over both."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, rng: np.random.Generator, hidden: int = HIDDEN) -> "Labeller":
        p = {}
        for way in "fb":
            p["W" + way] = rng.normal(0, 1 / np.sqrt(N_INPUT), (N_INPUT, 4 * hidden))
            p["R" + way] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            p["b" + way] = np.concatenate((np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)))
            p["v" + way] = rng.normal(0, 1 / np.sqrt(hidden), hidden)
        p["c"] = np.zeros(1)
        return cls(p)

    def run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """Hidden states [pages, blocks, hidden]; masked steps keep the state."""
        n, steps, _ = x.shape
        R = self.p["R" + way]
        size = len(R)
        z = x @ self.p["W" + way] + self.p["b" + way]
        h, c = np.zeros((n, size)), np.zeros((n, size))
        out = np.zeros((n, steps, size))
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            a = z[:, t] + h @ R
            i, f, o = (_sigmoid(a[:, k * size:(k + 1) * size]) for k in range(3))
            g = np.tanh(a[:, 3 * size:])
            m = mask[:, t, None]
            c2 = f * c + i * g
            th = np.tanh(c2)
            h2 = o * th
            if keep is not None:
                keep.append((t, i, f, o, g, c, th, h, m))
            c, h = c2 * m + c * (1 - m), h2 * m + h * (1 - m)
            out[:, t] = h
        return out

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return _sigmoid(self.run(x, mask, "f") @ self.p["vf"] + self.run(x, mask, "b") @ self.p["vb"] + self.p["c"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        keeps, outs = {"f": [], "b": []}, {}
        for way in "fb":
            outs[way] = self.run(x, mask, way, keeps[way])
        p = _sigmoid(outs["f"] @ self.p["vf"] + outs["b"] @ self.p["vb"] + self.p["c"])
        d = (p - y) * mask / mask.sum()
        grad = {"c": np.array([d.sum()])}
        for way in "fb":
            R, v = self.p["R" + way], self.p["v" + way]
            size = len(R)
            grad["v" + way] = outs[way].reshape(-1, size).T @ d.ravel()
            dz = np.zeros((*x.shape[:2], 4 * size))
            dR, dh, dc = np.zeros_like(R), np.zeros((len(x), size)), np.zeros((len(x), size))
            for t, i, f, o, g, c, th, h, m in reversed(keeps[way]):
                dh = dh + d[:, t, None] * v
                own = dh * m
                dct = dc * m + own * o * (1 - th * th)
                da = np.concatenate((dct * g * i * (1 - i), dct * c * f * (1 - f), own * th * o * (1 - o), dct * i * (1 - g * g)), axis=1)
                dz[:, t] = da
                dR += h.T @ da
                dh = dh * (1 - m) + da @ R.T
                dc = dc * (1 - m) + dct * f
            grad["R" + way], grad["b" + way] = dR, dz.sum(axis=(0, 1))
            grad["W" + way] = x.reshape(-1, x.shape[2]).T @ dz.reshape(-1, 4 * size)
        return grad


def groups(counts: list[int], rows: int = 1 << 14) -> Iterator[list[int]]:
    """Pages of similar length together, at most about ``rows`` padded blocks each."""
    held: list[int] = []
    for k in np.argsort(counts, kind="stable").tolist():
        if held and (len(held) + 1) * counts[k] > rows:
            yield held
            held = []
        held.append(k)
    if held:
        yield held


def padded(x: np.ndarray, first: np.ndarray, counts: list[int], pick: list[int]) -> tuple[np.ndarray, np.ndarray]:
    width = max(counts[k] for k in pick)
    out, mask = np.zeros((len(pick), width, x.shape[1]), dtype=np.float32), np.zeros((len(pick), width), dtype=np.float32)
    for i, k in enumerate(pick):
        out[i, : counts[k]], mask[i, : counts[k]] = x[first[k]: first[k] + counts[k]], 1
    return out, mask


# -- training pages -------------------------------------------------------

#: Usual class words of page regions (fixed values).
REGIONS = {
    "main": "content article post entry story main body text article-body post-content entry-content page-content",
    "nav": "nav menu navbar breadcrumb breadcrumbs pagination tabs toolbar links",
    "header": "header masthead top site-header logo branding tagline",
    "footer": "footer copyright legal site-footer colophon bottom",
    "side": "sidebar aside widget related rail teaser recommended popular trending",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner",
    "notice": "cookie notice consent alert gdpr newsletter subscribe popup modal warning",
    "form": "form search login signup contact survey",
    "comments": "comments comment comment-list discussion responses replies reader-comments thread",
}
#: Elements that hold a region besides div and section (fixed values).
HOLDERS = {"main": ("article", "main"), "nav": ("nav",), "header": ("header",), "footer": ("footer",), "side": ("aside",), "form": ("form",)}
NOISE = frozenset("nav header footer aside form".split())


def silver(b: Block) -> int | None:
    """Label that a page's own semantic elements give to a block; None if they give none."""
    if NOISE & set(b.path):
        return 0
    for region, words in REGIONS.items():
        if region != "main" and set(b.names) & set(words.split()):
            return 0
    return 1 if {"article", "main"} & set(b.path) else None


def layouts(rng: np.random.Generator, prose: list[str], short: list[str], count: int) -> Iterator[tuple[list[Block], np.ndarray]]:
    """Pages in other frames made of the given texts, with the region of every block known."""
    say = lambda pool: pool[int(rng.integers(len(pool)))]
    for _ in range(count):
        blocks, labels = [], []

        def add(region: str, texts_: list[str], tag: str, extra: tuple = (), link: float = 0.0) -> None:
            names = str(say(REGIONS[region].split()))
            kinds = (*HOLDERS.get(region, ()), "div", "div", "section")
            holder = str(say(kinds))
            named = holder in ("div", "section") or rng.random() < 0.5
            words = tuple(w for w in SPLIT.split(names)) if named else ()
            outer = ("html", "body") + (("div",) if rng.random() < 0.4 else ())
            path = tuple(t for t in outer) + (holder, *extra) + ((tag,) if tag else ())
            for t in texts_:
                blocks.append(Block(t, path, words, int(len(t) * link)))
                labels.append(region == "main")

        def lines(pool, lo, hi):
            return [say(pool) for _ in range(int(rng.integers(lo, hi)))]

        before = [lambda: add("header", lines(short, 1, 3), str(say(["h1", "p", "div", "h2"])), link=float(rng.random() < 0.5)),
                  lambda: add("nav", lines(short, 2, 9), "li", ("ul",), 1.0),
                  lambda: add("ad", lines(prose, 1, 3), str(say(["", "p"]))),
                  lambda: add("notice", lines(prose, 1, 2), str(say(["", "p"]))),
                  lambda: add("form", lines(short, 1, 5), str(say(["", "p", "fieldset", "button"])))]
        after = [lambda: add("comments", lines(prose, 1, 8), str(say(["p", "li", "div"])), tuple(say([(), ("div",), ("ol",), ("ul", "li")]))),
                 lambda: add("side", lines(prose, 1, 5), str(say(["p", "li", "h3"])), link=float(rng.random() < 0.5)),
                 lambda: add("side", lines(short, 2, 6), "li", ("ul",), 1.0),
                 lambda: add("ad", lines(prose, 1, 3), str(say(["", "p"]))),
                 lambda: add("form", lines(short, 1, 4), str(say(["", "p", "button"]))),
                 lambda: add("notice", lines(prose, 1, 2), ""),
                 lambda: add("footer", ["© " + say(short)] if rng.random() < 0.5 else lines(prose, 1, 2), str(say(["", "p"])))]
        for k in sorted(rng.permutation(len(before))[: int(rng.integers(0, 5))]):
            before[k]()
        if rng.random() < 0.95:
            where = len(blocks)
            add("main", lines(short, 1, 2), "h1")
            add("main", lines(prose, 1, 16), "p")
            same = blocks[where]  # title and paragraphs share one holder
            for b in blocks[where + 1:]:
                b.path, b.names = same.path[:-1] + (str(say(["p"] * 8 + ["h2", "li", "blockquote", "pre", "td"])),), same.names
            if rng.random() < 0.3:  # an advert inside the article
                cut = int(rng.integers(where + 1, len(blocks) + 1))
                blocks.insert(cut, Block(say(prose), same.path[:-1] + ("div",), same.names + (str(say(REGIONS["ad"].split())),), 0))
                labels.insert(cut, False)
        for k in rng.permutation(len(after))[: int(rng.integers(0, 5))]:
            after[k]()
        if blocks:
            yield blocks, np.array(labels, dtype=np.float32)


def runs(n: int) -> list[slice]:
    """All of a page of ``n`` blocks, or sequences spread evenly over a long one."""
    if n <= RUN:
        return [slice(0, n)]
    return [slice(a, a + RUN) for a in np.unique(np.linspace(0, n - RUN, min(RUNS, -(-n // RUN))).astype(np.int64)).tolist()]


def train(pages: list[str], epochs: int = 12, made: int = 600, rate: float = 0.01, seed: int = 11) -> Labeller | None:
    """A labeller from sample pages and from layouts made of their texts, from the layouts alone if the
    pages label no block; None without pages."""
    if not pages:
        return None
    rng = np.random.Generator(np.random.PCG64(seed))
    hasher, model = Hasher(), Labeller.new(rng)
    cases: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    prose, short = [], []
    for blocks in map(parse, pages):
        found = [silver(b) for b in blocks]
        known = np.array([f is not None for f in found], dtype=np.float32)
        if known.any():
            x, y = vectors(hasher, [blocks]), np.array([f or 0 for f in found], dtype=np.float32)
            cases += [(x[r].copy(), y[r], known[r]) for r in runs(len(blocks)) if known[r].any()]
        for b, f in zip(blocks, found):
            (prose if len(b.text) > 40 else short).append(b.text)
    words = [w for r in REGIONS.values() for w in r.split()]  # pages without any text
    prose, short = prose or short or words, short or prose or words
    cases += [(vectors(hasher, [b]), y, np.ones(len(y), dtype=np.float32)) for b, y in layouts(rng, prose, short, made)]
    xs = [x for x, _, _ in cases]
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    s = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    order = np.argsort([len(x) for x in xs], kind="stable")
    batches = np.array_split(order, max(1, len(order) // 32))
    for _ in range(epochs):
        for b in rng.permutation(len(batches)):
            pick = batches[b]
            width = max(len(xs[k]) for k in pick)
            x, y, mask = np.zeros((len(pick), width, N_INPUT)), np.zeros((len(pick), width)), np.zeros((len(pick), width))
            for i, k in enumerate(pick):
                n = len(xs[k])
                x[i, :n], y[i, :n], mask[i, :n] = xs[k], cases[k][1], cases[k][2]
            grad = model.gradients(x, mask, y)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            for k, g in grad.items():
                g = g / max(1.0, norm) + 1e-5 * model.p[k]
                m[k], s[k] = 0.9 * m[k] + 0.1 * g, 0.999 * s[k] + 0.001 * g * g
                model.p[k] = model.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    model.p = {k: v.astype(np.float32) for k, v in model.p.items()}
    return model


# -- the operator ---------------------------------------------------------

def label_pages(model: Labeller | None, hasher: Hasher, pages: list[list[Block]]) -> list[np.ndarray]:
    """Whether each block of each page is main text."""
    counts = [len(p) for p in pages]
    out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
    some = [k for k, n in enumerate(counts) if n]
    for group in groups([counts[k] for k in some]):
        pick = [some[g] for g in group]
        x = vectors(hasher, [pages[k] for k in pick])
        sizes = [counts[k] for k in pick]
        first = np.cumsum(sizes) - sizes
        if model is None:
            for i, k in enumerate(pick):
                out[k] = np.ones(sizes[i], dtype=bool)
            continue
        batch, mask = padded(x, first, sizes, list(range(len(pick))))
        p = model.probabilities(batch, mask)
        for i, k in enumerate(pick):
            out[k] = p[i, : sizes[i]] >= 0.5
    return out


def sample(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", html_col: str = "html", limit: int = SAMPLE_PAGES,
           most: int = SAMPLE_BYTES, longest: int = PAGE_BYTES) -> list[str]:
    """The bounded sample that the labeller learns from: rows of any size in order of a hash of id and
    text, until ``limit`` pages or ``most`` characters are reached.  A page beyond ``longest`` characters gives
    its head and its tail."""
    body = F.col(f"`{html_col}`").cast("string")
    src = pages.filter(F.octet_length(body) > 0).select(body.alias("html"), F.xxhash64(F.col(f"`{id_col}`"), body).alias("h"))
    first = src.select("h", F.least(F.length("html"), F.lit(longest)).alias("n")).distinct().orderBy("h", "n").limit(limit).collect()
    if not first:
        return []
    fit = max(1, int(np.searchsorted(np.cumsum([r["n"] for r in first]), most, side="right")))
    half = longest // 2
    cut = F.when(F.length("html") > longest, F.concat(F.substring("html", 1, half), F.substring("html", -half, half))).otherwise(F.col("html"))
    some = src.filter(F.col("h") <= first[fit - 1]["h"]).select("h", cut.alias("html")).distinct().collect()
    return [r["html"] for r in sorted(some, key=lambda r: (r["h"], r["html"]))]


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            model: Labeller | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every whole page, one row per input row.

    A null or empty page and a page without main blocks give an empty text.  Repeated rows and null ids are pages of their own; an empty
    table gives an empty result; other columns are not read."""
    model = model or train(sample(spark, pages, id_col, html_col))
    src = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                       F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in small_batches(it, "html", 2 << 20):
            found = [parse(t.decode("utf-8", "replace")) for t in texts(b.column("html"))]
            keep = label_pages(model, hasher, found)
            out = ["\n".join(x.text for x, k in zip(p, ks) if k) for p, ks in zip(found, keep)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()),
                                              pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(run, f"page_id {src.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint")
