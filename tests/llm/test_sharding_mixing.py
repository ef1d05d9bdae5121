import zlib

from pricepanel.llm.mixing import mix, mix_documents, source_targets
from pricepanel.llm.sharding import assign_shards, write_shards

ROWS = [(i, "word " * (i % 7), "ab"[i % 2] if i % 5 else None) for i in range(50)]
ROWS += [(None, None, None), (None, "", "a"), (3, "dup dup", "a"), (3, "dup dup", "a"), (99, "long " * 20_000, "b")]


def test_shards_are_contiguous_balanced_and_gapless(spark, odd_docs, tmp_path):
    docs = odd_docs(ROWS)
    got = [r.asDict() for r in assign_shards(docs, n_shards=4).collect()]
    assert len(got) == len(ROWS)
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _ in ROWS)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want
    got.sort(key=lambda r: (r["shard"], r["slot"]))
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    for s in {r["shard"] for r in got}:
        assert [r["slot"] for r in got if r["shard"] == s] == list(range(sum(r["shard"] == s for r in got)))
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    assert assign_shards(docs.filter("false")).count() == 0
    even = odd_docs([(i, "x" * 84, "a") for i in range(200)])
    shards = assign_shards(even, n_shards=8)
    sums = [r["n"] for r in shards.groupBy("shard").agg({"size": "sum"}).toDF("shard", "n").collect()]
    assert sums == [2500] * 8
    write_shards(even, shards, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 8


def test_targets_fill_like_water(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 300), (None, 90)], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    # 2100 to share by 5, 2, 1, 5: a and NULL stop at 20 and 180, c at 600; b takes the rest
    left, caps, w = 2100.0, {"a": 20, "b": 2000, "c": 600, None: 180}, {"a": 5, "b": 2, "c": 1, None: 5}
    want, free = {}, set(caps)
    while True:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > caps[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = caps[s]
            left -= caps[s]
        free -= over
    assert {s: round(t, 6) for s, t in got.items()} == {s: round(t, 6) for s, t in want.items()}


def test_mix_meets_targets_and_keeps_rows(spark, odd_docs):
    rows = [(i, "w " * (1 + i % 9), "s%d" % (0 if i % 3 else i % 7)) for i in range(600)]
    docs = odd_docs(rows + [(None, None, None), (1000, "", "s0"), (1001, " \n", None), rows[0], rows[0]])
    got = mix(docs).collect()
    assert len(got) == 605 and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    by: dict = {}
    for r in got:
        t = by.setdefault((r["source_size"], r["target"]), [0])
        t[0] += r["taken"]
    assert all(abs(t[0] - target) <= 20 for (_, target), t in by.items())
    assert sorted(map(tuple, mix(docs).drop("row_key").collect()), key=str) == sorted(
        map(tuple, mix(docs.repartition(3)).drop("row_key").collect()), key=str)
    out = mix_documents(docs)
    assert out.columns == docs.columns and out.filter("copies <> 3").count() == 0
    assert out.count() == sum(r["copies"] for r in got)
    assert mix(docs.filter("false")).count() == 0
    assert mix(docs.filter("text IS NULL")).collect()[0]["taken"] == 0
