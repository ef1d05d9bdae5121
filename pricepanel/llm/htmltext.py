"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks: text between block-level tags, with the path of open tags and
their class, id and role names.  Scripts, styles, comments and the head are markup and never blocks; math is text.  Each
block's input is the mean vector of its hashed path names, the mean vector of its hashed words, and a few
figures (length, share of link text, place); a bidirectional LSTM in numpy reads the whole page and labels
every block, so a block is judged by what stands around it.

The labels to learn from are taken from the pages themselves: text under an article or main element is
main text, unless an element or name between says otherwise (``NOISE``).  A training page is also varied:
the element around its main text is renamed (``CONTENT``), and blocks of other pages are put in under
elements of ``NOISE``, so that the network learns more layouts than the sample shows.  Training sees at
most ``max_pages`` pages, chosen by a hash of the id; every page is labelled where it lies.

Defined cases: NULL and empty pages, and pages without main text, give an empty text; pages are handled row
by row, repeated or not; other columns pass through (``text`` and ``n_chars`` are replaced); without any
labelled block to learn from all blocks are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .toxicity import Words, _sigmoid

#: Elements that end a block, that have no end tag, and whose content is no text.
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes ol optgroup
option p pre search section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|template|iframe|textarea|title"  # without an end tag, up to the end of the page
EMBEDDED = "svg|noscript|object|canvas"  # only with an end tag before the next of its kind, else a tag like any other
#: Elements and names that hold main text, and those that do not.
CONTENT = ("article main div.content div.post div.article section.story div.entry-content div.main-text div#content "
           "div#main section.body div.post-body div.article-body").split()
NOISE = ("nav header footer aside form menu div.ad div.ads div.advert div.sidebar div.comments div.comment section.comments "
         "div.cookie div.notice div.banner div.promo div.related div.share div.social div.newsletter div.menu "
         "div.breadcrumb div.subscribe ul.nav div.footer div.header div#comments div#sidebar div.sponsored div.popup "
         "div.navigation div.alert div.disclaimer div.widget div.copyright div.login div.search select button").split()
_NOISE_NAMES = {n.rpartition(".")[2].rpartition("#")[2] for n in NOISE}
_MAIN_NAMES = {"article", "main"}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<({RAW})(?=[\s/>])[^>]*+>.*?(?:</\1\s*>|\Z)"
    rf"|<(?!svg[^>]*/>)({EMBEDDED})(?=[\s/>])[^>]*+>(?:(?!<\2[\s/>]).)*?</\2\s*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+>|<[!?/][^>]*+>|[^<]++|<",
    re.S | re.I)
_NAME = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_P_ENDERS = BLOCK - {"body", "html", "td", "tr", "th", "tbody", "option", "legend", "caption"}

PATH_BITS, WORD_BITS, DIM, HIDDEN, FIGURES = 11, 12, 12, 16, 6


def leaf_blocks(html: str | None) -> list[tuple[str, tuple, float]]:
    """(text, path names, share of link text) of each block in page order."""
    stack: list[tuple[str, tuple]] = []
    out, text, linked, path = [], [], 0, ()

    def flush():
        nonlocal linked
        if text:
            joined = "".join(text)
            words = " ".join(joined.split())
            if words:
                out.append((words, path, min(1.0, linked / len(words))))
            text.clear()
        linked = 0

    for m in _TOKEN.finditer(html or ""):
        raw, embedded, close, name, rest = m.groups()
        if raw or embedded:
            if (raw or embedded).lower() not in ("script", "style", "template", "title", "svg"):
                flush()
            continue
        if not name:
            token = m.group()
            if token[0] != "<" or token == "<":
                if not text:
                    path = tuple(n for _, names in stack for n in names)
                piece = unescape(token) if "&" in token else token
                text.append(piece)
                if any(t == "a" for t, _ in stack):
                    linked += len(" ".join(piece.split()))
            continue
        name = name.lower()
        if name == "br":
            text.append(" ") if text else None
            continue
        if name in BLOCK:
            flush()
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name in VOID or rest.endswith("/"):
            continue
        if name in _P_ENDERS:  # a block start ends an open paragraph; an item ends its predecessor
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or (stack[i][0] == name and name in ("li", "dt", "dd", "option")):
                    del stack[i:]
                    break
                if stack[i][0] in BLOCK:
                    break
        names = [name]
        if "=" in rest:
            for a, b, c in _NAME.findall(rest):
                names += [x for x in re.split(r"[\s_-]+", (a or b or c).lower()) if x]
        stack.append((name, tuple(names)))
    flush()
    return out


def weak_label(path: tuple) -> float | None:
    """1 under an article or main element, 0 elsewhere or under a name of ``NOISE`` inside it."""
    at = max((i for i, n in enumerate(path) if n in _MAIN_NAMES), default=None)
    return 0.0 if at is None or any(n in _NOISE_NAMES for n in path[at:]) else 1.0


def _path_ids(path: tuple) -> list[int]:
    return [hash_name(n) for n in dict.fromkeys(path)] or [0]


_HASHES: dict = {}


def hash_name(name: str) -> int:
    got = _HASHES.get(name)
    if got is None:
        h = 14695981039346656037
        for b in name.encode("utf-8", "replace"):
            h = (h ^ b) * 1099511628211 % (1 << 64)
        if len(_HASHES) > 100_000:
            _HASHES.clear()
        got = _HASHES[name] = h >> (64 - PATH_BITS)
    return got


class Page:
    """Inputs of the blocks of some pages."""

    def __init__(self, pages: list[list]):
        self.sizes = np.array([len(p) for p in pages], np.int64)
        blocks = [b for p in pages for b in p]
        ids = [_path_ids(b[1]) for b in blocks]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        self.path = np.fromiter((i for x in ids for i in x), np.int64, int(lens.sum()))
        self.path_start = np.cumsum(lens) - lens
        self.path_len = np.maximum(lens, 1)[:, None].astype(np.float32)
        words = Words([b[0] for b in blocks])
        self.word = (words.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64)[words.ids]
        self.word_len = words.per_text
        place = np.concatenate([(np.arange(n) + 0.5) / n for n in self.sizes if n] or [np.empty(0)])
        chars = np.fromiter((len(b[0]) for b in blocks), np.float32, len(blocks))
        stops = np.fromiter((sum(map(b[0].count, ".,;!?")) for b in blocks), np.float32, len(blocks))
        self.figures = np.stack([np.log1p(chars) / 5, np.log1p(self.word_len) / 4,
                                 np.fromiter((b[2] for b in blocks), np.float32, len(blocks)), place,
                                 stops / (self.word_len + 1), np.ones(len(blocks))], axis=1).astype(np.float32)

    def inputs(self, w: dict) -> np.ndarray:
        n = len(self.figures)
        path = np.add.reduceat(w["path"][self.path], self.path_start, axis=0) / self.path_len if n else np.empty((0, DIM))
        words, some = np.zeros((n, DIM), np.float32), np.flatnonzero(self.word_len)
        if len(some):
            starts = (np.cumsum(self.word_len) - self.word_len)[some]
            words[some] = np.add.reduceat(w["word"][self.word], starts, axis=0) / self.word_len[some][:, None]
        return np.concatenate([path, words, self.figures], axis=1).astype(np.float32)


def new_weights(seed: int) -> dict:
    r = np.random.default_rng(seed)

    def m(*shape, s):
        return (r.standard_normal(shape) * s).astype(np.float32)

    w = {"path": m(1 << PATH_BITS, DIM, s=0.1), "word": m(1 << WORD_BITS, DIM, s=0.05),
         "out": m(2 * HIDDEN, s=0.3), "bias": np.zeros(1, np.float32)}
    for d in "fb":
        w |= {"x" + d: m(2 * DIM + FIGURES, 4 * HIDDEN, s=0.3), "h" + d: m(HIDDEN, 4 * HIDDEN, s=0.2),
              "b" + d: np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)}
    return w


def _lanes(sizes: np.ndarray, d: str):
    """Lockstep order: pages by falling length; per step the block number of each page still running."""
    order = np.argsort(-sizes, kind="stable")
    begin, n = (np.cumsum(sizes) - sizes)[order], sizes[order]
    for t in range(int(n[0]) if len(n) else 0):
        k = int(np.searchsorted(-n, -t, "left"))  # pages with more than t blocks
        yield (begin[:k] + t) if d == "f" else (begin[:k] + n[:k] - 1 - t)


def forward(w: dict, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """Logit of every block; each page is a sequence of its own."""
    H, out, saves = HIDDEN, np.empty((len(x), 2 * HIDDEN), np.float32), []
    for i, d in enumerate("fb"):
        proj = x @ w["x" + d] + w["b" + d]
        h, c, saved = np.zeros((len(sizes), H), np.float32), np.zeros((len(sizes), H), np.float32), []
        for at in _lanes(sizes, d):
            k = len(at)
            h, c = h[:k], c[:k]
            a = proj[at] + h @ w["h" + d]
            s, g = _sigmoid(a[:, :3 * H]), np.tanh(a[:, 3 * H:])
            new_c = s[:, H:2 * H] * c + s[:, :H] * g
            tc = np.tanh(new_c)
            if keep:
                saved.append((at, h, c, s, g, tc))
            h, c = s[:, 2 * H:] * tc, new_c
            out[at, i * H:(i + 1) * H] = h
        saves.append(saved)
    logit = out @ w["out"] + w["bias"]
    return (logit, (out, saves)) if keep else logit


def backward(w: dict, x: np.ndarray, sizes: np.ndarray, cache, d_logit: np.ndarray):
    out, saves = cache
    H = HIDDEN
    g = {"out": out.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
    d_out, d_x = d_logit[:, None] * w["out"], np.zeros_like(x)
    for i, d in enumerate("fb"):
        U, d_u, d_proj = w["h" + d], np.zeros_like(w["h" + d]), np.zeros((len(x), 4 * H), np.float32)
        d_h, d_c = np.zeros((0, H), np.float32), np.zeros((0, H), np.float32)
        for at, h, c, s, gg, tc in reversed(saves[i]):
            grow = ((0, len(at) - len(d_h)), (0, 0))  # pages that ended here
            d_h = np.pad(d_h, grow) + d_out[at, i * H:(i + 1) * H]
            d_c = np.pad(d_c, grow) + d_h * s[:, 2 * H:] * (1 - tc * tc)
            d_s = np.concatenate([d_c * gg, d_c * c, d_h * tc], axis=1) * s * (1 - s)
            d_a = np.concatenate([d_s, d_c * s[:, :H] * (1 - gg * gg)], axis=1)
            d_proj[at] = d_a
            d_u += h.T @ d_a
            d_h, d_c = d_a @ U.T, d_c * s[:, H:2 * H]
        g["h" + d], g["b" + d], g["x" + d] = d_u, d_proj.sum(axis=0), x.T @ d_proj
        d_x += d_proj @ w["x" + d].T
    return g, d_x


def _names(element: str) -> tuple:
    return tuple(x for x in re.split(r"[.#-]", element) if x)


def vary(page: list, others: list, r) -> tuple[list, list]:
    """A page's blocks with its main element renamed and blocks of other pages put in as noise; labels."""
    blocks, labels, new = [], [], _names(CONTENT[r.integers(len(CONTENT))])
    rename = r.random() < 0.7
    for text, path, links in page:
        y = weak_label(path)
        if rename:
            path = tuple(x for n in path for x in (new if n in _MAIN_NAMES else (n,)))
        blocks.append((text, path, links))
        labels.append(y)
    for _ in range(r.integers(0, 5)):
        at = int(r.integers(0, len(blocks) + 1))
        near = blocks[min(at, len(blocks) - 1)][1] if blocks and r.random() < 0.7 else ("html", "body")
        path = (*near, *_names(NOISE[r.integers(len(NOISE))]), *(("p",), ("div",), ("ul", "li"), ())[r.integers(4)])
        take = [others[r.integers(len(others))] for _ in range(r.integers(1, 4))]
        blocks[at:at] = [(t, path, 1.0 if r.random() < 0.2 else 0.0) for t in take]
        labels[at:at] = [0.0] * len(take)
    return blocks, labels


def train(pages: list, seed: int = 3, steps: int = 300, batch: int = 24, rate: float = 0.01) -> dict:
    """Weights fitted to weakly labelled, varied pages."""
    parsed = [b for b in map(leaf_blocks, pages) if b]
    if not any(weak_label(path) for p in parsed for _, path, _ in p):
        return {"keep_all": True}
    r, w = np.random.default_rng(seed), new_weights(seed)
    others = [t for p in parsed for t, _, _ in p]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    for step in range(1, steps + 1):
        made = [vary(parsed[i], others, r) for i in r.integers(0, len(parsed), batch)]
        page, y = Page([m[0] for m in made]), np.concatenate([np.float32(m[1]) for m in made])
        x = page.inputs(w)
        logit, cache = forward(w, x, page.sizes, keep=True)
        g, d_x = backward(w, x, page.sizes, cache, ((_sigmoid(logit) - y) / len(y) * 4).astype(np.float32))
        g["path"], g["word"] = np.zeros_like(w["path"]), np.zeros_like(w["word"])
        lens = np.diff(np.append(page.path_start, len(page.path)))
        np.add.at(g["path"], page.path, np.repeat(d_x[:, :DIM] / page.path_len, lens, axis=0))
        np.add.at(g["word"], page.word, np.repeat(d_x[:, DIM:2 * DIM] / np.maximum(page.word_len, 1)[:, None],
                                                  page.word_len, axis=0))
        pace = rate * (1 - 0.9 * step / steps)
        for k, v in g.items():  # Adam
            m, s = moments[k]
            m += 0.1 * (v - m)
            s += 0.01 * (v * v - s)
            w[k] -= (pace * m / (1 - 0.9 ** step) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return w


def main_texts(w: dict, pages: list) -> list[str]:
    """Main text of each page: its labelled blocks, joined by newlines."""
    parsed = [leaf_blocks(p) for p in pages]
    data = Page(parsed)
    if "keep_all" in w:
        keep = np.ones(len(data.figures), bool)
    elif len(data.figures):
        keep = forward(w, data.inputs(w), data.sizes) >= 0
    else:
        keep = np.empty(0, bool)
    out, at = [], 0
    for p in parsed:
        out.append("\n".join([b[0] for b, k in zip(p, keep[at:at + len(p)]) if k]))
        at += len(p)
    return out


def fit(pages: DataFrame, max_pages: int = 300, id_col: str = "page_id", html_col: str = "html") -> dict:
    """Weights learnt from at most ``max_pages`` pages of the table."""
    ids = pages.select(F.col(id_col).alias("_id")).filter("_id IS NOT NULL").orderBy(F.xxhash64("_id"), "_id").limit(max_pages)
    rows = (pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
            .join(F.broadcast(ids.distinct()), "_id").limit(2 * max_pages).collect())  # bounded by max_pages
    return train([html for _, html in sorted((r["_id"], r["_html"] or "") for r in rows)])


def _extract_rows(weights, batch_pages: int = 400, batch_chars: int = 4_000_000):
    def run(batches):
        w = weights.value
        for b in batches:
            texts, part, size = [], [], 0
            for h in b["_ht_html"]:
                h = h.as_py()
                part.append(h)
                size += len(h or "")
                if len(part) >= batch_pages or size >= batch_chars:
                    texts += main_texts(w, part)
                    part, size = [], 0
            if part:
                texts += main_texts(w, part)
            names = [n for n in b.schema.names if n != "_ht_html"]
            yield pa.record_batch([*[b[n] for n in names], pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])
    return run


def extract_text(pages: DataFrame, weights: dict, html_col: str = "html") -> DataFrame:
    """The input without ``html_col``, with ``text`` and ``n_chars`` (code points)."""
    sent = pages.sparkSession.sparkContext.broadcast(weights)  # a fixed size: about 0.3 MB
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    schema = StructType([*pages.select(*rest).schema.fields, StructField("text", StringType()),
                         StructField("n_chars", LongType())])
    return pages.select(*rest, F.col(html_col).alias("_ht_html")).mapInArrow(_extract_rows(sent), schema)
