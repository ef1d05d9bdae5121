"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are words: the word's vector (one common vector for words outside the training sample's
vocabulary) beside the mean of its hashed character-trigram vectors.
A window of ``WINDOW`` words runs through a GRU in either direction, attention pools the outputs, and a
linear layer gives the window's logit.  A document's windows overlap by a quarter and cover the whole text;
its score is the sigmoid of its largest logit.

Labels belong to documents, not windows, so training alternates: the windows that stand for a document
are chosen (first by how unevenly their words occur in the two classes, later by the network's own
scores: the largest of a toxic document, the largest few of a clean one), then the network is fitted to
them.  Training sees at most ``2 * per_class`` labelled documents, whole texts, chosen by a hash of the
id among those that are not held out; scoring runs over all documents where they lie.

A text over about 1.5 M characters is scored in parts that overlap by as many words as windows do.

Defined cases: NULL, empty and white-space texts have one window without words (its logit is the bias);
without labels of both classes every score is the share of toxic labels (0 if there are none); repeated
rows are scored alike; other columns pass through, those named like the output's are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import segments

WINDOW, STRIDE = 48, 36
CHAR_BITS, DIM, HIDDEN = 13, 8, 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORDS_AT_ONCE, _BLANK = 100_000, np.full(1, 32, np.uint8)
_POWERS = np.cumprod(np.full(64, 1099511628211, np.uint64))


class Words:
    """The words of some texts: hash and trigram buckets of each distinct word, words of each text."""

    def __init__(self, texts: list):
        raw = np.frombuffer("\n".join([*((t or "").lower() for t in texts), ""]).encode("utf-8", "replace"), np.uint8)
        sizes = np.fromiter((len((t or "").lower().encode("utf-8", "replace")) + 1 for t in texts), np.int64, len(texts))
        space = _SPACE[raw]
        inner = ~space
        starts = np.flatnonzero(inner & np.append(True, space[:-1]))
        ends = np.flatnonzero(inner & np.append(space[1:], True)) + 1
        self.per_text = np.bincount(np.searchsorted(np.cumsum(sizes), starts, "right"), minlength=len(texts))
        if not len(starts):
            self.ids, self.hash = np.empty(0, np.int64), np.empty(0, np.uint64)
            self.grams, self.gram_start = np.empty(0, np.int64), np.empty(0, np.int64)
            return
        lens = ends - starts
        h = np.empty(len(starts), np.uint64)
        for i in range(0, len(starts), _WORDS_AT_ONCE):  # eight-byte numbers for each byte: a part at a time
            n = lens[i:i + _WORDS_AT_ONCE]
            first = np.cumsum(n) - n
            off = np.arange(n.sum()) - np.repeat(first, n)
            byte = raw[np.repeat(starts[i:i + _WORDS_AT_ONCE], n) + off].astype(np.uint64)
            h[i:i + _WORDS_AT_ONCE] = np.add.reduceat((byte + np.uint64(1)) * _POWERS[off & 63], first) * _MIX
        self.hash, where, self.ids = np.unique(h, return_index=True, return_inverse=True)
        # trigrams of the distinct words, with a blank at either end
        starts, lens = starts[where], lens[where]
        self.gram_start = np.cumsum(lens) - lens
        at = np.repeat(starts, lens) + np.arange(lens.sum()) - np.repeat(self.gram_start, lens)
        b = np.concatenate([_BLANK, np.where(space, _BLANK, raw), _BLANK])
        code = b[at].astype(np.uint64) << np.uint64(16)
        code |= b[at + 1].astype(np.uint64) << np.uint64(8)
        code |= b[at + 2]
        code *= _MIX
        self.grams = (code >> np.uint64(64 - CHAR_BITS)).astype(np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers by window, -1 where there is none; the text of each window)."""
        n = np.maximum(1, -(-np.maximum(0, self.per_text - (WINDOW - STRIDE)) // STRIDE))
        text = np.repeat(np.arange(len(n)), n)
        no = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        begin = np.cumsum(self.per_text) - self.per_text
        at = no[:, None] * STRIDE + np.arange(WINDOW)
        ok = at < self.per_text[text][:, None]
        at = np.where(ok, at + begin[text][:, None], 0)
        return np.where(ok, self.ids[at] if len(self.ids) else 0, -1), text


def _sigmoid(x):
    y = np.multiply(x, 0.5)
    if not isinstance(y, np.ndarray):
        return 0.5 * (np.tanh(y) + 1)
    np.tanh(y, out=y)
    y += 1
    y *= 0.5
    return y


def new_weights(seed: int, vocabulary: np.ndarray) -> dict:
    """``vocabulary``: sorted word hashes; row 0 of the word vectors is for all others."""
    r = np.random.default_rng(seed)

    def m(*shape, s=0.1):
        return (r.standard_normal(shape) * s).astype(np.float32)

    w = {"word": m(len(vocabulary) + 1, DIM), "char": m(1 << CHAR_BITS, DIM), "att": m(2 * HIDDEN), "out": m(2 * HIDDEN, s=0.3),
         "bias": np.zeros(1, np.float32)}
    for d in "fb":
        w |= {"x" + d: m(2 * DIM, 3 * HIDDEN, s=0.3), "h" + d: m(HIDDEN, 3 * HIDDEN, s=0.3),
              "b" + d: np.zeros(3 * HIDDEN, np.float32)}
    return w


def vocabulary_rows(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + 1, 0)


def inputs(w: dict, words: Words, rows: np.ndarray) -> np.ndarray:
    """The network's input for each distinct word."""
    if not len(rows):
        return np.zeros((1, 2 * DIM), np.float32)
    lens = np.diff(np.append(words.gram_start, len(words.grams)))[:, None].astype(np.float32)
    return np.concatenate([w["word"][rows],
                           np.add.reduceat(w["char"][words.grams], words.gram_start, axis=0) / lens], axis=1)


def _gru(w, d, proj, at, mask, keep):
    """Outputs (T, windows, H) of one direction, and what the way back needs if ``keep``.

    ``at`` (word numbers) and ``mask`` come step by step: (T, windows) and (T, windows, 1).
    """
    steps, n, H = len(at), at.shape[1], HIDDEN
    h, U = np.zeros((n, H), np.float32), w["h" + d]
    out, saved = np.empty((steps, n, H), np.float32), {}
    x, hu = np.empty((n, 3 * H), np.float32), np.empty((n, 3 * H), np.float32)
    full = mask.all(axis=(1, 2))
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        np.take(proj, at[t], axis=0, out=x, mode="clip")
        np.matmul(h, U, out=hu)
        zr = _sigmoid(x[:, :2 * H] + hu[:, :2 * H])
        z, r = zr[:, :H], zr[:, H:]
        c = np.multiply(r, hu[:, 2 * H:])
        c += x[:, 2 * H:]
        np.tanh(c, out=c)
        new = np.subtract(h, c, out=out[t])
        new *= z
        new += c
        if keep:
            saved[t] = (h, z, r, c, hu[:, 2 * H:].copy())
        if not full[t]:
            new -= h
            new *= mask[t]
            new += h
        h = new
    return out, saved


def forward(w: dict, x: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Window logits; ``x`` holds the distinct words' inputs, ``ids`` the windows (-1: no word)."""
    mask = (ids >= 0).astype(np.float32)
    at, steps = np.maximum(ids, 0), np.ascontiguousarray(mask.T)[:, :, None]
    outs, saves = zip(*[_gru(w, d, x @ w["x" + d] + w["b" + d], np.ascontiguousarray(at.T), steps, keep)
                        for d in "fb"])
    o = np.concatenate(outs, axis=2)
    e = o @ w["att"] + (mask.T - 1) * 1e4
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    pooled = (a[:, :, None] * o).sum(axis=0) * mask.max(axis=1, initial=0)[:, None]
    logit = pooled @ w["out"] + w["bias"]
    return (logit, (mask, at, o, a, pooled, saves)) if keep else logit


def backward(w: dict, x: np.ndarray, cache, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the weights and of the inputs ``x``."""
    mask, at, o, a, pooled, saves = cache
    some = mask.max(axis=1, initial=0)[:, None]
    g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
    d_pool = d_logit[:, None] * w["out"] * some
    d_o = a[:, :, None] * d_pool
    d_a = (o * d_pool).sum(axis=2)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    g["att"] = np.einsum("tn,tnh->h", d_e, o)
    d_o = d_o + d_e[:, :, None] * w["att"]
    d_x, H = np.zeros_like(x), HIDDEN
    for i, d in enumerate("fb"):
        U, saved, steps = w["h" + d], saves[i], at.shape[1]
        d_u, d_h = np.zeros_like(U), np.zeros((at.shape[0], H), np.float32)
        d_proj = np.zeros((len(x), 3 * H), np.float32)
        for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
            h, z, r, c, hn = saved[t]
            m = mask[:, t:t + 1]
            d_h = d_h + d_o[t, :, i * H:(i + 1) * H]
            d_new = d_h * m
            d_c = d_new * (1 - z) * (1 - c * c)
            d_z = d_new * (h - c) * z * (1 - z)
            d_r = d_c * hn * r * (1 - r)
            gates = np.concatenate([d_z, d_r, d_c], axis=1)
            through = np.concatenate([d_z, d_r, d_c * r], axis=1)
            np.add.at(d_proj, at[:, t], gates * m)
            d_u += h.T @ through
            d_h = d_h * (1 - m) + d_new * z + through @ U.T
        g["h" + d], g["b" + d], g["x" + d] = d_u, d_proj.sum(axis=0), x.T @ d_proj
        d_x += d_proj @ w["x" + d].T
    return g, d_x


def document_logits(w: dict, texts: list, lanes: int = 8192) -> np.ndarray:
    """Largest window logit of each text."""
    words = Words(texts)
    ids, text = words.windows()
    x = inputs(w, words, vocabulary_rows(w["vocabulary"], words.hash))
    logits = np.concatenate([forward(w, x, ids[i:i + lanes]) for i in range(0, len(ids), lanes)])
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    return np.maximum.reduceat(logits, first)


def train(texts: list, labels: list, seed: int = 7, steps: int = 400, batch: int = 128,
          rate: float = 0.01) -> dict:
    """Weights fitted to documents and their 0/1 labels, in ``steps`` batches or a few more.

    The vocabulary is the words of at least one in a hundred of these documents.
    """
    y = np.asarray(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        return {"share": float(y.mean()) if len(y) else 0.0}
    r, words = np.random.default_rng(seed), Words(texts)
    ids, text = words.windows()
    # how unevenly each distinct word occurs in the documents of either class
    doc = np.repeat(np.arange(len(y)), words.per_text)
    seen = np.unique(words.ids * len(y) + doc)
    pos = np.bincount(seen // len(y), weights=y[seen % len(y)], minlength=len(words.hash)) / y.sum()
    neg = np.bincount(seen // len(y), weights=1 - y[seen % len(y)], minlength=len(words.hash)) / (1 - y).sum()
    lean = np.append((pos - neg) / np.sqrt((pos + neg) / 2 + 1 / len(y)), 0.0)
    value = lean[ids].max(axis=1) if len(lean) > 1 else np.zeros(len(ids))
    vocabulary = words.hash[np.bincount(seen // len(y), minlength=len(words.hash)) >= max(3, 0.01 * len(y))]
    rows = vocabulary_rows(vocabulary, words.hash)
    w = new_weights(seed, vocabulary)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step = 0
    while step < steps:
        part_done = step / steps
        if part_done >= 0.25:
            x = inputs(w, words, rows)
            value = np.concatenate([forward(w, x, ids[i:i + 8192]) for i in range(0, len(ids), 8192)])
        order = np.lexsort((-value, text))
        rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        chosen = order[rank < np.where(y[text[order]] > 0, 1, 3)]
        chosen = r.permutation(np.append(chosen, r.choice(np.flatnonzero(y[text] == 0), len(y))))
        weight = np.where(y[text[chosen]] > 0, (y[text[chosen]] == 0).sum() / max(1, (y[text[chosen]] > 0).sum()), 1.0)
        for i in range(0, len(chosen), batch):
            pick = chosen[i:i + batch]
            used, local = np.unique(ids[pick], return_inverse=True)
            shift = int(used[0] == -1)
            local, used = local.reshape(ids[pick].shape) - shift, used[shift:]
            if not len(used):
                continue
            part = Words.__new__(Words)
            lens = np.diff(np.append(words.gram_start, len(words.grams)))[used]
            part.gram_start = np.cumsum(lens) - lens
            part.grams = words.grams[np.repeat(words.gram_start[used], lens) + np.arange(lens.sum())
                                     - np.repeat(part.gram_start, lens)]
            x = inputs(w, part, rows[used])
            logit, cache = forward(w, x, local, keep=True)
            d = ((_sigmoid(logit) - y[text[pick]]) * weight[i:i + batch] / len(pick)).astype(np.float32)
            g, d_x = backward(w, x, cache, d)
            g["word"], g["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
            np.add.at(g["word"], rows[used], d_x[:, :DIM])
            np.add.at(g["char"], part.grams, np.repeat(d_x[:, DIM:] / lens[:, None], lens, axis=0))
            step += 1
            pace = rate * (1 - 0.9 * part_done)
            for k, v in g.items():  # Adam
                m, s = moments[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                w[k] -= (pace * m / (1 - 0.9 ** step) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return w | {"vocabulary": vocabulary}


def held_out(id_col) -> F.Column:
    """True for the fold that no label is learnt from: CRC-32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> dict:
    """Weights learnt from at most ``2 * per_class`` labelled documents that are not held out."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    order = [F.xxhash64("_id"), F.col("_id")]
    sample = known.filter("_y = 1").orderBy(*order).limit(per_class).unionAll(
        known.filter("_y = 0").orderBy(*order).limit(per_class))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(sample), "_id")  # bounded by per_class
            .select("_id", "_text", "_y").limit(4 * per_class).collect())
    rows = sorted(dict.fromkeys((r["_id"], r["_text"] or "", r["_y"]) for r in rows))
    return train([r[1] for r in rows], [r[2] for r in rows])


def _score_rows(weights, score_col: str, batch_chars: int = 1_500_000):
    def run(batches):
        w = weights.value
        for b in batches:
            logits, part, at, size = np.full(b.num_rows, -np.inf), [], [], 0
            for i, t in enumerate(b["_tox_text"]):
                if "share" in w:
                    break
                for s in segments(t.as_py() or "", batch_chars, WINDOW - STRIDE):
                    part.append(s)
                    at.append(i)
                    size += len(s)
                    if size >= batch_chars:
                        np.maximum.at(logits, at, document_logits(w, part))
                        part, at, size = [], [], 0
            if part:
                np.maximum.at(logits, at, document_logits(w, part))
            names = [n for n in b.schema.names if n != "_tox_text"]
            got = np.full(b.num_rows, w["share"]) if "share" in w else _sigmoid(logits)
            yield pa.record_batch([*[b[n] for n in names], pa.array(got, pa.float64())], names=[*names, score_col])
    return run


def score_toxicity(docs: DataFrame, weights: dict, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The input with ``score_col`` (0 to 1)."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # bounded by the training sample: a few MB
    rest = [c for c in docs.columns if c != score_col]
    ready = docs.select(*rest, F.col(text_col).alias("_tox_text"))
    schema = StructType([*docs.select(*rest).schema.fields, StructField(score_col, DoubleType())])
    return ready.mapInArrow(_score_rows(sent, score_col), schema)
