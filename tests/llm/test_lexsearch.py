import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pricepanel.llm import lexsearch as L
from pricepanel.llm.bytewords import byte_codes, span_hashes, text_buffer, word_spans
from pricepanel.llm.items import make_items

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 75 + 25 * sum(c.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text))
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        scored.sort()
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def result(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(2)
    vocab = ["The", "of", "ÉTÉ", "été", "x1", "zwölf", "語", "it's", "İ"] + [f"w{int(rnd.paretovariate(0.6)) % 400}" for _ in range(300)]
    docs = [(d, rnd.choice((" ", ", ", "\n")).join(rnd.choice(vocab) for _ in range(rnd.choice((0, 1, 4, 30, 200)))))
            for d in range(400)]
    docs += [(d, docs[5][1]) for d in (5, 900, 901)] + [(None, docs[6][1]), (902, None), (903, " ,. "), (904, "the " * 5000)]
    docs += [(d, "the same rare zebra") for d in range(1000, 1040)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i, n in enumerate((40, 10, 3, 1, 0, 80))]
    items += [(6, "zebra ZEBRA the"), (6, "zebra ZEBRA the"), (7, None), (None, "w1 w2 w3"), (8, "unheard")]
    return docs, items


@pytest.mark.parametrize("slots", [4096, 4])
def test_same_as_brute_force(spark, odd_docs, planted, slots):
    docs, items = planted
    df = odd_docs([(d, t, "s") for d, t in docs]).repartition(3)
    assert result(L.search(df, spark.createDataFrame(items, "item_id long, text string"), slots=slots)) == brute(docs, items)


def test_items_in_several_blocks_and_few_results(spark, planted, monkeypatch):
    docs, items = planted
    monkeypatch.setattr(L.item_blocks, "__defaults__", (200,))
    got = L.search(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, text string"), k=3)
    assert result(got) == brute(docs, items, 3)


def test_shared_hashes_decide_nothing(spark, planted, monkeypatch):
    docs, items = planted
    items = [x for x in items if x[1]]
    made = make_items([i for i, _ in items], [t for _, t in items])
    real = L.span_hashes
    monkeypatch.setattr(L, "span_hashes", lambda *a: np.where((h := real(*a)) % np.uint64(5) == 1, made.vocab[0], h))
    # a fifth of the words look like the first term: they must not be counted as that term
    batch = pa.record_batch([pa.array([t for _, t in docs], pa.string())], names=["text"])
    out = next(L._term_counts(made)(iter([batch])))
    got = dict(zip(out["term"].to_pylist(), out["docs"].to_pylist()))
    raw = bytes(made.buf)
    word = raw[made.start[0]:made.start[0] + made.length[0]].decode().translate(LOWER)
    assert got.get(0, 0) <= sum(word in terms(t) for _, t in docs)


def test_bounds_hold_and_prune(planted):
    docs, items = planted
    made = make_items([0], [items[0][1]])
    buf, off = text_buffer(pa.array([t for _, t in docs], pa.string()))
    s, e, c = word_spans(buf, off, L.ALNUM)
    block = L._Block(buf, s, e, c, span_hashes(buf, s, e, byte_codes(made.seed)), len(docs), len(s), 64)
    terms_, w = np.arange(len(made.vocab)), np.full(len(made.vocab), 7)
    bound = w @ block.sketch[L.slot_of(made.vocab >> np.uint64(16), 64)]
    exact = block.score(np.arange(len(docs)), made, terms_, w)
    assert (bound >= exact).all() and (exact > 0).any()


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert L.search(docs.limit(0), items).count() == 0
    assert L.search(docs, items.limit(0)).count() == 0
    assert result(L.search(docs, items)) == brute([(1, "a b c")], [(1, "a b c")])
