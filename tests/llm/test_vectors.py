"""Nearest neighbours and vector dedup against brute force."""

import numpy as np

from pricepanel.llm.ann import nearest
from pricepanel.llm.vecdedup import near_vectors

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, 1, 2, 3) for i, v, l in rows],
                                 "vec_id long, embedding array<float>, label int, row int, block int, n_links int")


def cosines(x):
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return (u[:, None, :] * u[None, :, :]).sum(axis=2)


def odd(dim=16):
    return [(9000, None, 1), (9050, [], 1), (9100, [0.0] * dim, 1), (9150, [NAN] * dim, 1), (9200, [INF] + [1.0] * (dim - 1), 1),
            (9250, [None] + [1.0] * (dim - 1), 1), (None, [1.0] * dim, 1), (9300, [1.0, 2.0], 1)]


def test_nearest_recall_and_odd_rows(spark):
    r = np.random.default_rng(1)
    x = r.standard_normal((1500, 16)).astype(np.float32)
    x[200:240] = x[200]  # ties
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    vectors = frame(spark, rows + odd())
    got = nearest(vectors, vectors["vec_id"] % 50 == 0, k=5, block=400).collect()
    c, hit = cosines(x.astype(np.float64)), 0
    by = {}
    for row in got:
        by.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    assert set(by) == set(range(0, 1500, 50))
    for q, best in by.items():
        best.sort()
        s = c[q].copy()
        s[q] = -9
        want = np.lexsort((np.arange(len(s)), -np.round(s, 12)))[:5]
        hit += len(set(want.tolist()) & {b[1] for b in best})
        assert [b[0] for b in best] == [1, 2, 3, 4, 5] and all(abs(b[2] - s[b[1]]) < 1e-12 for b in best)
        assert [(-round(b[2], 12), b[1]) for b in best] == sorted((-round(b[2], 12), b[1]) for b in best)
    assert hit / 5 / len(by) >= 0.95
    assert [b[1] for b in by[200]] == [201, 202, 203, 204, 205]
    few = frame(spark, rows[:3] + odd())
    assert sorted((r["query_id"], r["vec_id"]) for r in nearest(few, few["vec_id"] == 0, k=5).collect()) == [(0, 1), (0, 2)]
    assert nearest(few.filter("false"), few["vec_id"] == 0).count() == 0


def test_near_vectors_equal_brute_force(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((60, 16))
    x = np.concatenate([base + 0.15 * r.standard_normal(base.shape) for _ in range(5)]
                       + [base[:1] + 0.05 * r.standard_normal((300, 16)), np.repeat(base[1:2], 40, axis=0)]).astype(np.float32)
    labels = [int(i) for i in r.integers(0, 3, 300)] + [1] * 340
    rows = [(i, v.tolist(), l) for i, (v, l) in enumerate(zip(x, labels))]
    rows += [(5000, x[0].tolist(), None), (3, x[3].tolist(), labels[3])] + odd()[:6]
    for block in (1024, 60):  # with and without large groups cut into blocks
        got = sorted(near_vectors(frame(spark, rows), block=block).collect(), key=lambda t: (t["vec_id"], t["n_links"]))
        ids = np.array([i for i in range(len(x))] + [3])
        both, lab = np.concatenate([x, x[3:4]]).astype(np.float64), np.array(labels + [labels[3]])
        near = (cosines(both) >= 0.93) & (lab[:, None] == lab[None, :])
        np.fill_diagonal(near, False)
        comp = ids.copy()
        while True:
            new = np.array([min(comp[i], comp[near[i]].min(initial=10**9)) for i in range(len(ids))])
            if (new == comp).all():
                break
            comp = new
        want = sorted(zip(ids.tolist(), near.sum(axis=1).tolist(), comp.tolist()))
        assert [(r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] < 5000] == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
        assert [(r["n_links"], r["component_id"] == r["vec_id"]) for r in got if r["vec_id"] >= 5000] == [(0, True)] * 7
    assert near_vectors(frame(spark, rows).filter("false")).count() == 0


def test_near_vectors_star_larger_than_all_windows(spark):
    r = np.random.default_rng(4)
    base = r.standard_normal(256)
    base /= np.linalg.norm(base)
    side = r.standard_normal((3000, 256))
    side -= (side @ base)[:, None] * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([0.94 * base + np.sqrt(1 - 0.94 ** 2) * side, base[None], r.standard_normal((200, 256))]).astype(np.float32)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    assert near[3000].sum() == 3000 and near.sum() == 6000  # linked to the base, not to each other
    got = {t["vec_id"]: (t["n_links"], t["component_id"]) for t in near_vectors(frame(spark, [(i, v, 0) for i, v in enumerate(x.tolist())])).collect()}
    assert got == {i: (3000 if i == 3000 else int(i < 3000), 0 if i <= 3000 else i) for i in range(len(x))}


def planted(n, pairs, dim=64):
    """Even vectors, the first ``pairs`` of them each with a partner (``pairs`` rows on) at cosine 0.932."""
    r = np.random.default_rng(6)
    x = r.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = r.standard_normal((pairs, dim))
    side -= (side * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    x[pairs:2 * pairs] = 0.932 * x[:pairs] + np.sqrt(1 - 0.932 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    return x.astype(np.float32)


def test_near_vectors_recall_follows_size_not_tasks(spark):
    pairs, parts, found = 600, spark.conf.get("spark.sql.shuffle.partitions"), []
    vectors = frame(spark, [(i, v, 0) for i, v in enumerate(planted(3000, pairs).tolist())])
    try:
        for n in (2, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append({t["vec_id"] for t in near_vectors(vectors, passes=2, window=4).collect() if t["component_id"] == t["vec_id"] - pairs})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert found[0] == found[1] and len(found[0]) >= 0.99 * pairs


def cone(n, pairs, cosine, dim=64):
    """``planted`` vectors moved towards one direction: their mean cosine becomes ``cosine``, the partners stay at 0.932."""
    r = np.random.default_rng(8)
    axis = np.eye(dim)[0]
    x = r.standard_normal((n, dim))
    x -= (x @ axis)[:, None] * axis
    x = np.sqrt(cosine) * axis + np.sqrt(1 - cosine) * x / np.linalg.norm(x, axis=1, keepdims=True)
    side = r.standard_normal((pairs, dim))
    side -= (side * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    x[pairs:2 * pairs] = 0.932 * x[:pairs] + np.sqrt(1 - 0.932 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    return x.astype(np.float32)


def test_near_vectors_in_a_cone(spark):
    n, pairs = 6000, 600
    x = cone(n, pairs, 0.6)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    got = {t["vec_id"]: t["n_links"] for t in near_vectors(frame(spark, [(i, v, 0) for i, v in enumerate(x.tolist())])).collect()}
    found, all_ = sum(got.values()), int(near.sum())
    assert all_ >= 2 * pairs and found >= 0.998 * all_
    assert all(got[i] <= c for i, c in enumerate(near.sum(axis=1).tolist()))


def test_a_label_that_needs_too_many_passes_is_met_whole(spark):
    x = cone(1500, 200, 0.6)
    got = near_vectors(frame(spark, [(i, v, 0) for i, v in enumerate(x.tolist())]), passes=1, most_passes=1, window=4).collect()
    assert sum(t["component_id"] == t["vec_id"] - 200 for t in got) == 200
