"""Best-fit packing: constraints, and a naive best fit beside it."""

import random
import re
from collections import Counter, defaultdict

from pricepanel.llm.packing import best_fit, pack, pack_apart


def naive_bins(pieces, capacity, limit):
    bins = []
    for size, source, cluster in pieces:
        fits = [b for b in bins if size < capacity and b["left"] >= size and b["s"].count(source) < limit and cluster not in b["c"]]
        b = min(fits, key=lambda b: b["left"]) if fits else {"left": capacity, "s": [], "c": set()}
        if not fits:
            bins.append(b)
        b["left"] -= size
        b["s"].append(source)
        b["c"].add(cluster)
    return bins


def test_best_fit_holds_constraints_and_is_tight():
    for seed in range(60):
        rnd = random.Random(seed)
        capacity, limit = rnd.choice([10, 50, 200]), rnd.choice([1, 2, 4])
        pieces = sorted(((rnd.randint(0, capacity), rnd.choice("aaabcd"), rnd.choice([1, 1, 2, rnd.randint(3, 50)]))
                         for _ in range(rnd.randint(1, 120))), reverse=True)
        where = best_fit(*map(list, zip(*pieces)), capacity, limit)
        bins = defaultdict(list)
        for (b, slot, offset), p in zip(where, pieces):
            bins[b].append((slot, offset, *p))
        for b in bins.values():
            assert [x[0] for x in b] == list(range(len(b)))
            assert [x[1] for x in b] == [sum(y[2] for y in b[:i]) for i in range(len(b))]
            assert sum(x[2] for x in b) <= capacity and len({x[4] for x in b}) == len(b)
            assert max(sum(x[3] == s for x in b) for s in "abcd") <= limit
        assert abs(len(bins) - len(naive_bins(pieces, capacity, limit))) <= 1  # ties among equal residuals differ
        # best fit: a bin opened later never could have taken its first piece elsewhere
        tight = defaultdict(lambda: [capacity, [], set()])
        for (b, slot, _), (size, s, c) in zip(where, pieces):
            free = [x for x in tight.values() if size < capacity and x[0] >= size and x[1].count(s) < limit and c not in x[2]]
            best = min((x[0] for x in free), default=capacity)
            assert (tight[b][0] if slot else capacity) == best if free else slot == 0
            x = tight[b]
            x[0] -= size
            x[1].append(s)
            x[2].add(c)


def test_pack_keeps_every_word_once(spark, odd_docs):
    rows = [(i, "w " * (i % 40), "ab"[i % 2]) for i in range(300)]
    rows += [(500, "w " * 5_000, "a"), (501, None, None), (502, "", "b"), (None, "x y z", None)] + [(600, "copy me", "a")] * 30
    docs = odd_docs(rows)
    got = pack(docs, capacity=64, source_limit=2, group_size=3000).collect()
    words = defaultdict(int)
    for r in got:
        words[r["doc_id"]] += r["size"]
    assert words[500] == 5000 and words[600] == 60 and words[None] == 3 and words[501] == words[502] == 0
    assert sum(words.values()) == sum(len((t or "").split()) for _, t, _ in rows)
    bins = defaultdict(list)
    for r in got:
        bins[r["bin"]].append(r)
    assert all(sum(r["size"] for r in b) <= 64 for b in bins.values())
    assert all(sum(r["doc_id"] == 600 for r in b) <= 1 for b in bins.values())
    assert pack(docs.filter("false")).count() == 0


def test_query_against_brute_force(spark, sf_small):
    from pricepanel.llm.queries import op1_simhash, op3_packing
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    comp = {r["doc_id"]: r["component_id"] for r in op1_simhash(spark, sf_small).collect()}
    assert len(set(comp.values())) < len(comp)  # the table holds near copies
    bins, words, pieces = defaultdict(list), defaultdict(int), []
    for r in op3_packing(spark, sf_small).collect():
        bins[r["bin"]].append(r)
        words[r["doc_id"]] += r["size"]
        pieces.append((r["size"], docs[r["doc_id"]]["source"], comp[r["doc_id"]]))
    assert words == {d: len(re.findall(r"[^\x20\x09-\x0D]+", x["text"])) for d, x in docs.items()}
    for b in bins.values():
        b.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in b] == list(range(len(b))) and sum(r["size"] for r in b) <= 2048
        assert [r["offset"] for r in b] == [sum(x["size"] for x in b[:i]) for i in range(len(b))]
        assert max(Counter(docs[r["doc_id"]]["source"] for r in b).values()) <= 4
        assert len({comp[r["doc_id"]] for r in b}) == len(b)
    pieces.sort(key=lambda x: -x[0])
    assert abs(len(bins) - len(naive_bins(pieces, 2048, 4))) <= 1


def test_pack_apart_edge_cases(spark, odd_docs):
    rows = [(i, "a b c d e f g", "a") for i in range(3)] + [(5, None, None), (6, "", "b"), (None, "a b c d e f g", None), (8, "x y", "a")]
    got = pack_apart(odd_docs(rows), capacity=64).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    apart = [r["bin"] for r in got if r["doc_id"] in (0, 1, 2, None)]
    assert len(set(apart)) == 4
    assert pack_apart(odd_docs(rows).filter("false")).count() == 0
