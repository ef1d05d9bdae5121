"""SimHash against a brute force over all pairs."""

import random

import numpy as np
import xxhash

from pricepanel.llm.components import connected_components
from pricepanel.llm.simhash import ball_variants, drop_near_duplicates, fingerprint_links, near_duplicates


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(values, near):
    comp = np.array(values)
    while True:
        new = np.array([comp[near[i]].min() for i in range(len(comp))])
        if (new == comp).all():
            return comp
        comp = new


def test_every_pair_within_three_bits_shares_a_variant():
    rnd, variants = random.Random(1), ball_variants(3)
    for _ in range(200):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, 3)):
            b ^= 1 << bit
        assert {(a & k) ^ x for k, x in variants} & {(b & k) ^ x for k, x in variants}
    assert len(variants) == 131


def test_dense_clusters_match_brute_force(spark):
    rnd, fps = random.Random(3), set()
    for c in range(6):
        base = rnd.getrandbits(64)
        for _ in range(120):
            x = base
            for b in rnd.sample(range(64 if c % 2 else 10), rnd.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    signed = np.array(sorted(fps), np.uint64).view(np.int64)
    near = np.bitwise_count(signed.view(np.uint64)[:, None] ^ signed.view(np.uint64)[None, :]) <= 3
    links = fingerprint_links(spark.createDataFrame([(int(x),) for x in signed], "fp long"), 3)
    got = {r["node"]: r["component"] for r in connected_components(links, "a", "b").collect()}
    want = closure(signed, near)
    assert [got.get(int(x), int(x)) for x in signed] == want.tolist()
    assert links.count() < near.sum() / 4  # spanning links, not all pairs


def test_even_radius_and_large_bucket(spark, monkeypatch):
    import pricepanel.llm.simhash as S
    rnd = random.Random(5)
    base = rnd.getrandbits(64)
    values = sorted({base ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)})
    fps = np.array(values, np.uint64)
    for radius in (2, 3):
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        edges = S._grow(fps, radius)
        assert len(edges) == len(values) - len(set(closure(np.arange(len(values)), near)))


def test_edge_cases(spark, odd_docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, "The cat sat on THE mat", "a"), (3, "the cat\tsat on the\nmat ", None), (None, "the cat sat on the mat", "b"),
            (7, None, "a"), (8, "", "a"), (9, " \n\t", "a"), (10, "one two", "c"), (10, "one two", "c"), (11, long, "c"),
            (12, long, None), (13, "ÄÖ ä", "a")]
    docs = odd_docs(rows)
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in near_duplicates(docs).collect()),
                 key=lambda r: (r[0] is None, r))
    assert {(i, f) for i, f, _ in got} == {(i, format(brute_fingerprint(t), "016x")) for i, t, _ in rows}
    comp = {i: c for i, _, c in got}
    assert (comp[5], comp[3], comp[None], comp[7], comp[8], comp[9], comp[10], comp[11], comp[12]) == (3, 3, 3, 7, 7, 7, 10, 11, 11)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.filter("row <> 1 OR key <> 'k'").count() == 0
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 10, 11, 13]
    empty = docs.filter("false")
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


def test_query_matches_brute_force(spark, sf_small):
    from pricepanel.llm.queries import op1_simhash
    rows = sorted(tuple(r) for r in op1_simhash(spark, sf_small).collect())
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    ids = np.array(sorted(docs))
    fps = np.array([brute_fingerprint(docs[i]) for i in ids], np.uint64)
    comp = closure(ids, np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    assert rows == [(int(i), format(int(f), "016x"), int(c)) for i, f, c in zip(ids, fps, comp)]
