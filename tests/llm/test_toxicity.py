"""Gradients by difference quotients, learning on planted words, and the operator's odd rows."""

import random
import zlib

import numpy as np

from pricepanel.llm import toxicity as T


def corpus(n, seed, bad=("dolt", "oaf", "cretin")):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6))) for _ in range(400)]
    texts, labels = [], []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(5, 300))]
        y = int(rnd.random() < 0.3)
        if y:
            for _ in range(2):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        texts.append(" ".join(words))
        labels.append(y)
    return texts, labels


def test_gradients(monkeypatch):
    monkeypatch.setattr(T.np, "float32", np.float64)
    r = np.random.default_rng(0)
    words = T.Words(["a bb ccc dd " * 17, "x y", "", "the oaf is " * 9])
    ids, _ = words.windows()
    w = T.new_weights(1, np.empty(0, np.uint64))
    x = T.inputs(w, words, np.zeros(len(words.hash), np.int64))
    d = r.standard_normal(len(ids))
    _, cache = T.forward(w, x, ids, keep=True)
    g, d_x = T.backward(w, x, cache, d)
    for name in ("hf", "hb", "xf", "xb", "bf", "bb", "att", "out", "bias"):
        at = tuple(r.integers(0, n) for n in w[name].shape)
        old, values = w[name][at], []
        for e in (1e-5, -1e-5):
            w[name][at] = old + e
            values.append((T.forward(w, x, ids) * d).sum())
        w[name][at] = old
        assert abs((values[0] - values[1]) / 2e-5 - g[name][at]) < 1e-6, name


def test_windows_cover_every_word():
    words = T.Words(["w%d " % i * n for i, n in enumerate([0, 1, 47, 48, 49, 84, 85, 500])])
    ids, text = words.windows()
    for t, n in enumerate(words.per_text):
        own = ids[text == t]
        assert len(own) == max(1, -(-max(0, n - 12) // 36)) and (own >= 0).any(axis=1).sum() == (len(own) if n else 0)


def test_learns_planted_words():
    texts, labels = corpus(800, 1)
    w = T.train(texts[:500], labels[:500], steps=250)
    got = T.document_logits(w, texts[500:]) >= 0
    assert (got == np.array(labels[500:])).mean() > 0.95


def test_operator_edge_cases(spark, odd_docs):
    texts, labels = corpus(300, 2)
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    odd = [(1000, None, None), (1001, "", "a"), (1002, " \n\t ", "a"), (None, "oaf " * 3, "b"), (1003, "w " * 40_000, "c"),
           (1004, "same", "a"), (1004, "same", "a")]
    docs = odd_docs(rows + odd)
    known = spark.createDataFrame(list(enumerate(labels)) + [(None, 1), (5000, None), (5001, 1)], "doc_id long, toxic int")
    assert {r["doc_id"]: r["h"] for r in docs.filter("doc_id < 300").select("doc_id", T.held_out("doc_id").alias("h")).collect()} == {
        i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(300)}
    w = T.fit(docs, known, per_class=100)
    got = T.score_toxicity(docs, w, score_col="s").collect()
    assert len(got) == 307 and all(0 <= r["s"] <= 1 and r["score"] == 0.5 for r in got)
    assert len({r["s"] for r in got if r["doc_id"] == 1004}) == 1
    assert len({r["s"] for r in got if r["doc_id"] in (1000, 1001, 1002)}) == 1
    held = [(r["s"] >= 0.5) == bool(labels[r["doc_id"]]) for r in got
            if r["doc_id"] is not None and r["doc_id"] < 300 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean(held) > 0.8
    none = T.fit(docs, known.filter("false"))
    assert {r["score"] for r in T.score_toxicity(docs, none).collect()} == {0.0}
    assert T.score_toxicity(docs.filter("false"), w).count() == 0
