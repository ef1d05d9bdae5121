import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pricepanel.llm import decontaminate as D
from pricepanel.llm.items import make_items

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    """(id, n_words, n_hit, ids) of each document by comparing every window at every place."""
    out = []
    for doc, text in docs:
        w = words(text)
        hit, ids, any_ = set(), set(), False
        for item, item_text in items:
            q = words(item_text)
            if not q:
                continue
            n = min(window, len(q))
            grams = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    any_ = True
                    if item is not None:
                        ids.add(str(item))
        ids = sorted(ids)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), any_))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def test_suffix_array_and_search():
    rng = np.random.default_rng(0)
    for n, k, depth in ((1, 1, 4), (50, 2, 60), (3000, 3, 9), (3000, 500, 70)):
        letters = np.append(rng.integers(1, k + 1, n).astype(np.uint64), np.uint64(0))
        order = D.suffix_array(letters, depth)
        suffixes = [tuple(letters[i:i + depth]) for i in order]
        assert suffixes == sorted(suffixes) and sorted(order) == list(range(n + 1))
        offsets = np.array([0, 7, 7, 20])
        q = rng.integers(1, k + 1, 20).astype(np.uint64)
        block = D.Items(["a", "b", "c"], q, offsets, 0, None, None, None, None)
        longest, place, low, high = D.search_suffixes(letters, order, block, np.full(20, 2))
        text = list(letters)
        for i in range(20):
            end = 7 if i < 7 else 20
            best = max(next((d for d in range(end - i + 1) if d == end - i or j + d >= len(text) or text[j + d] != q[i + d]))
                       for j in range(len(text)))
            assert longest[i] == best
            if best:
                assert text[place[i]:place[i] + best] == list(q[i:i + best])
            twos = {j for j in range(len(text) - 1) if end - i >= 2 and text[j:j + 2] == list(q[i:i + 2])}
            assert set(order[low[i]:high[i]]) == twos


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(1)
    vocab = ["The", "of", "ÉTÉ", "été", "x1", "zwölf", "a", "B", "語", "it's"] + [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i, n in enumerate((40, 10, 9, 3, 1, 0, 11, 25, 200, 12))]
    items += [(3, "the cat sat on the mat and then it went to sleep again"), (None, "alone here " * 6), (77, None)]
    docs = []
    for d in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.choice((0, 1, 5, 60, 300)))]
        for _ in range(rnd.choice((0, 0, 1, 2))):
            src = words(rnd.choice(items)[1])
            if src:
                a = rnd.randrange(len(src))
                at = rnd.randrange(len(w) + 1)
                w[at:at] = src[a:a + rnd.choice((8, 10, 15, 50))]
        docs.append((d, rnd.choice((" ", ", ", "\n", "-")).join(w)))
    docs += [(7, docs[7][1]), (500, None), (501, ""), (502, "alone, HERE! " * 40), (None, docs[3][1]),
             (503, " ".join(rnd.choice(vocab) for _ in range(5000)) + " " + items[8][1])]
    return docs, items


@pytest.mark.parametrize("shard_words", [1_000_000, 500])
def test_same_as_brute_force(spark, odd_docs, planted, shard_words):
    docs, items = planted
    df = odd_docs([(d, t, "s") for d, t in docs]).withColumnRenamed("n_lines", "n_hit")
    it = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(df.repartition(3), it, shard_words=shard_words)
    assert set(df.columns) <= set(got.columns)
    assert result(got) == brute(docs, items)
    clean = D.decontaminate(df, it, shard_words=shard_words)
    assert clean.columns == df.columns and clean.schema == df.schema
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, *_, bad in brute(docs, items) if not bad)


def test_items_in_several_blocks(spark, planted, monkeypatch):
    docs, items = planted
    monkeypatch.setattr(D.item_blocks, "__defaults__", (300,))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    assert result(D.contamination(df, it, keep=["doc_id"])) == brute(docs, items)


def test_a_shared_hash_is_no_match(spark, planted, monkeypatch):
    docs, items = planted
    real = D.span_hashes

    block = make_items([str(i) if i is not None else None for i, _ in items], [t for _, t in items])
    fake = next(iter(block.vocab[block.vocab % np.uint64(4) == 0]))
    # an eighth of the documents' words get the hash of an item's word
    monkeypatch.setattr(D, "span_hashes", lambda *a: np.where((h := real(*a)) % np.uint64(8) == 1, fake, h))
    texts = pa.array([t for _, t in docs], pa.string())
    for row, counts, hits, found in D._row_hits(texts, block, 10, 1_000_000):
        at = np.concatenate([[0], np.cumsum(counts)])
        for k in range(len(counts)):
            w = words(docs[row + k][1])
            for p in np.flatnonzero(hits[at[k]:at[k + 1]]):  # every hit word stands in a real window of an item
                assert any(tuple(w[s:s + min(10, len(q))]) == tuple(q[i:i + min(10, len(q))])
                           for _, t in items for q in [words(t)] if q
                           for i in range(max(1, len(q) - 9)) for s in range(max(0, p - 9), p + 1))


def test_longest_matches(spark, planted):
    docs, items = planted
    docs = [(d, t) for d, t in docs if d is not None]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one = [x for x in items if x[0] in (0, 7)]
    got = {(r.item_id, r.suffix): (r.length, r.doc_id, r.word) for r in D.longest_matches(
        df, spark.createDataFrame(one, "item_id long, text string"), shard_words=400).collect()}
    texts = {}
    for d, t in docs:
        texts.setdefault(d, []).append(words(t))
    for i, t in one:
        q = words(t)
        for s in range(len(q)):
            best = 0
            for ws in texts.values():
                for w in ws:
                    for p in range(len(w)):
                        n = 0
                        while s + n < len(q) and p + n < len(w) and w[p + n] == q[s + n]:
                            n += 1
                        best = max(best, n)
            if not best:
                assert (str(i), s) not in got
                continue
            length, doc, word = got[str(i), s]
            assert length == best and any(w[word:word + best] == q[s:s + best] for w in texts[doc])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.contamination(docs.limit(0), items).count() == 0
    assert result(D.contamination(docs, items.limit(0))) == [(1, 3, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert D.longest_matches(docs, items.limit(0)).count() == 0
    assert result(D.contamination(docs, items))[0][2:4] == (3, 1)
