"""Each stage of the pipeline against a brute force on its own input."""

import numpy as np

import corpus_pipeline as P
from pricepanel.session import cut_lineage
from test_linededup import brute
from test_simhash import brute_fingerprint, closure


def test_stages_on_their_own_inputs(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, at = docs.columns, [docs]
    for name, stage in P.STAGES:
        at.append(cut_lineage(stage(spark, at[-1], sf_small), f"test-{name}"))
    assert all(d.columns == columns for d in at[:-1])
    rows = [[r.asDict() for r in d.collect()] for d in at]
    ids = [[r["doc_id"] for r in x] for x in rows]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    clean = [i for i in ids[0] if labels.get(i) == 0]
    assert set(ids[1]) <= set(ids[0]) and len(set(clean) & set(ids[1])) >= 0.95 * len(clean)
    # line dedup
    want = {i: t for i, t, _, _ in brute([(r["doc_id"], r["text"]) for r in rows[1]], 10)}
    assert {r["doc_id"]: r["text"] for r in rows[2]} == want and all(r["n_chars"] == len(r["text"]) for r in rows[2])
    # near-dedup
    known = np.array(sorted(ids[2]))
    fps = np.array([brute_fingerprint(want[i]) for i in known], np.uint64)
    comp = closure(known, np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    assert sorted(ids[3]) == sorted(set(comp.tolist()))
    # mixing
    words = {r["doc_id"]: len(r["text"].split()) for r in rows[3]}
    total = sum(words.values())
    assert max(ids[4].count(i) for i in set(ids[4])) <= 2 and abs(sum(words[i] for i in ids[4]) - 1.5 * total) <= max(words.values())
    # packing
    assert sum(r["size"] for r in rows[5]) == sum(words[i] for i in ids[4])
    bins: dict = {}
    for r in rows[5]:
        bins.setdefault(r["bin"], []).append(r)
    assert all(sum(r["size"] for r in b) <= 2048 for b in bins.values())
    assert all(len({(r["doc_id"]) for r in b}) == len(b) for b in bins.values())


def test_stages_take_empty_tables_and_odd_rows(spark, odd_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, None, None), (2, "", "a"), (3, "x y z", "a"), (3, "x y z", "a"), (None, "q", None)]
    for docs in (odd_docs(rows), odd_docs(rows).filter("false")):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.filter("score <> 0.5 OR n_lines <> 'x' OR copies <> 3").count() == 0
            docs = cut_lineage(out, "odd")
        P.STAGES[-1][1](spark, docs, str(tmp_path)).count()
