"""Embedding near-dedup by sorted projection passes.

Equal vectors of a label become one class first.  Each pass gives a class the sign bits of 64 random
projections as its key; the classes are ordered by (pass, label, key) over all tasks, and each is compared
with its next ``window`` neighbours, those in other tasks included.  The label's mean vector is taken off
before the projections, so that the bits split it evenly also where its vectors lie in a cone.  How many
passes a label gets (``passes`` at least) follows from its size and from a sample of its vectors: how often two of
them share a bit, and how often a pair at the threshold does, so that ``recall`` of such pairs meet.  Verified neighbours
are united (a task emits spanning stars, never all pairs), and the unions of all passes are connected.

A label that would need more than ``most_passes`` counts as crowded whole.  A window can be full before it reaches
all partners of a class.  A class is crowded if in some pass a
quarter of its window on one side lies within twice the threshold's angle.  Crowded classes are covered by
leaders, at most ``COVER`` such angles away; every class of the label is compared with every leader and
united with those that a partner of a covered class can lie by (one angle more), so a crowded class misses
no partner, however many it has.

Passes compare half-precision copies with a margin, so what they unite is a superset; a large group is cut
into ``spread`` blocks of 64 classes or more, or more blocks of at most ``block`` classes, every two of
which meet in a task.  There cosines of the original vectors in double precision decide: each class counts
its links, and only linked classes stay connected.  A class of copies is linked within
itself.  So large groups are never expanded: rows out are one per class and block.

Defined cases: a vector that is NULL, empty, zero or holds NULL or non-finite components, or has a NULL
label, links with nothing and keeps its own id; only vectors of one dimension are compared; repeated rows
(same id) are vectors of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage
from .common import join_small, shuffle_partitions
from .components import connected_components, spanning_stars
from .simhash import _spanning
from .vectors import groups, matrix, slices, unit, usable

SLACK = 0.005  # half-precision cosines may be off by less than this
SAMPLE = 500  # vectors of a label by which its passes are reckoned
COVER = 1.5  # a leader covers the crowded classes within so many times the threshold's angle


@lru_cache(8)
def _planes(dim: int, passes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((passes, dim, 64))


def _partial_means(batches):
    """(label, dim, sum of unit vectors, rows) of each label in a batch."""
    for b in batches:
        labels, dims = b["label"].to_numpy(), b["dim"].to_numpy()
        out = ([], [], [], [])
        for label, dim in sorted(set(zip(labels.tolist(), dims.tolist()))):
            at = np.flatnonzero((labels == label) & (dims == dim))
            total = unit(matrix(b["vector"].take(pa.array(at)))).sum(axis=0)
            for x, v in zip(out, (label, dim, total.tolist(), len(at))):
                x.append(v)
        yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                               pa.array(out[2], pa.list_(pa.float64())), pa.array(out[3], pa.int64())],
                              names=["label", "dim", "total", "n"])


def _needed(u: np.ndarray, mean: np.ndarray, size: int, threshold: float, window: int, recall: float, most: int) -> int:
    """Passes after which ``recall`` of the pairs at the threshold have met, by a sample ``u`` of the label; ``most`` + 1 if more.

    Two vectors share a bit with probability 1 - angle / pi, seen from the mean.  Keys that share L bits are neighbours
    where ``size`` times the mean of that probability to the power L comes down to the window; pairs that count as
    crowded anyway (twice the threshold's angle) are left out.
    """
    if size <= window or len(u) < 3:
        return 1
    cosine, res = u @ u.T, u - mean
    length = np.sqrt((res * res).sum(axis=1))
    length[length == 0] = 1.0
    share = 1 - np.arccos(np.clip(res @ res.T / (length[:, None] * length[None, :]), -1, 1)) / np.pi
    share = share[~np.eye(len(u), dtype=bool) & (cosine < _cosine_of(threshold, 2))]
    if not len(share):
        return 1
    low, high = 0.0, 64.0
    for _ in range(25):
        bits = (low + high) / 2
        low, high = (bits, high) if size * np.mean(share ** bits) > window else (low, bits)
    # a partner at the threshold: its own residual is longer or shorter by what it has of the mean
    on, m2 = u @ mean, mean @ mean
    partner = np.sqrt(np.maximum(1e-12, 1 - 2 * threshold * on + m2))
    bit = 1 - np.arccos(np.clip((threshold - on - threshold * on + m2) / (length * partner), -1, 1)) / np.pi
    miss, passes = 1 - bit ** high, 1
    while passes <= most and np.mean(miss ** passes) > 1 - recall:
        passes += 1
    return passes


def _shapes(classes: DataFrame, threshold: float, window: int, recall: float, least: int, most: int) -> DataFrame:
    """One row per (label, dim): size, mean, passes, and whether the whole label counts as crowded."""
    partial = classes.select("label", "dim", "vector").mapInArrow(_partial_means, "label long, dim long, total array<double>, n long")
    sums = partial.select("label", "dim", F.posexplode("total").alias("pos", "x"), "n").groupBy("label", "dim", "pos").agg(
        F.sum("x").alias("x"), F.sum("n").alias("n"))
    means = sums.groupBy("label", "dim").agg(F.max("n").alias("size"), F.transform(
        F.array_sort(F.collect_list(F.struct("pos", (F.col("x") / F.col("n")).alias("x")))), lambda p: p["x"]).alias("mean"))
    # a bounded sample of each label: planned as a WindowGroupLimit before the shuffle
    drawn = Window.partitionBy("label", "dim").orderBy(F.xxhash64("cid"), "cid")
    sample = classes.withColumn("rn", F.row_number().over(drawn)).filter(F.col("rn") <= SAMPLE).select("label", "dim", "vector")
    schema = pa.schema([("label", pa.int64()), ("dim", pa.int64()), ("size", pa.int64()), ("mean", pa.list_(pa.float64())),
                        ("passes", pa.int32()), ("whole", pa.bool_())])

    def shape(key, table):
        means, vectors = table["mean"].drop_null(), table["vector"].drop_null().combine_chunks()
        size = table["size"].drop_null()[0].as_py()
        mean = np.array(means[0].as_py())
        passes = _needed(unit(matrix(vectors)), mean, size, threshold, window, recall, most)
        return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(
            (key[0].as_py(), key[1].as_py(), size, mean.tolist(), min(most, max(least, passes)), passes > most), schema)], schema=schema)

    return (sample.unionByName(means, allowMissingColumns=True).groupBy("label", "dim")
            .applyInArrow(shape, "label long, dim long, size long, mean array<double>, passes int, whole boolean"))


def _keyed(most: int, seed: int):
    """Classes -> one row per pass of their label: (pass, label, dim, key, cid, half-precision unit vector)."""
    schema = pa.schema([("pass", pa.int32()), ("label", pa.int64()), ("dim", pa.int64()), ("key", pa.int64()),
                        ("cid", pa.int64()), ("v", pa.binary())])
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)

    def run(batches):
        for b in batches:
            dims, wanted = b["dim"].to_numpy(), b["passes"].to_numpy()
            for dim, passes in sorted(set(zip(dims.tolist(), wanted.tolist()))):
                part = b.take(pa.array(np.flatnonzero((dims == dim) & (wanted == passes))))
                u = unit(matrix(part["vector"]))
                raw = u.astype(np.float16)
                u -= matrix(part["mean"])
                cells = pa.array([r.tobytes() for r in raw], pa.binary())
                for p, planes in enumerate(_planes(dim, most, seed)[:passes]):
                    key = ((u @ planes > 0) @ weights).astype(np.uint64) ^ np.uint64(1 << 63)  # unsigned order
                    yield pa.record_batch([pa.array(np.full(len(u), p, np.int32)), part["label"], part["dim"],
                                           pa.array(key.view(np.int64)), part["cid"], cells], schema=schema)
    return run


def _cosine_of(threshold: float, times: float) -> float:
    """Cosine of ``times`` the angle of ``threshold``."""
    return float(np.cos(min(np.pi, times * np.arccos(np.clip(threshold, -1, 1)))))


_PASSED = "a long, b long, part int, pos long, pass int, label long, dim long, cid long, v binary"
_ORDER = ["pass", "label", "dim"]


def _compare(t: pa.Table, fresh: int, threshold: float, window: int, rows: int = 256):
    """Stars (n, r) of the neighbours from row ``fresh`` on that pass, and (n, None) of crowded classes."""
    wide, crowd = _cosine_of(threshold, 2) - SLACK, max(1, window // 4)
    cid, pairs = t["cid"].to_numpy(), []
    after, before = np.zeros(t.num_rows, np.int64), np.zeros(t.num_rows, np.int64)
    for s, e in slices([t[k].to_numpy() for k in _ORDER]):
        dim = int(t["dim"][s].as_py())
        v = np.frombuffer(b"".join(t["v"].slice(s, e - s).to_pylist()), np.float16).reshape(-1, dim).astype(np.float32)
        for i in range(0, e - s, rows):
            a, z = v[i:i + rows], v[i:i + rows + window]
            cosine = a @ z.T
            step = np.arange(len(z)) - np.arange(len(a))[:, None]
            inside = (step > 0) & (step <= window)
            x, y = np.nonzero(inside & (cosine >= threshold - SLACK))
            ok = s + i + y >= fresh
            pairs += zip(cid[s + i + x[ok]].tolist(), cid[s + i + y[ok]].tolist())
            close = inside & (cosine >= wide)  # those of the last batch's rows are counted anew, and whole
            after[s + i:s + i + len(a)] += close.sum(axis=1)
            before[s + i:s + i + len(z)] += close.sum(axis=0)
    stars = [(n, r) for n, r in spanning_stars(pairs).items() if n != r]
    return stars + [(n, None) for n in np.unique(cid[np.maximum(after, before) >= crowd]).tolist()]


def _neighbours(threshold: float, window: int):
    """Over rows sorted by (pass, label, dim, key): what ``_compare`` finds.

    Rows of ``_PASSED``: a star or crowded class in (a, b); the first and last ``window`` rows of the task
    with their position, for the borders between tasks; the task's row count as a ``pos`` without a class.
    """
    def made(part=None, pos=None, stars=None, rows=None):
        n = len(stars) if stars is not None else len(pos)
        none = {f.name: pa.nulls(n, f.type) for f in schema}
        if stars is not None:
            none |= {k: pa.array(x, pa.int64()) for k, x in zip("ab", zip(*stars))}
        else:
            none |= {"part": pa.array(np.full(n, part, np.int32)), "pos": pa.array(pos)}
        if rows is not None:
            none |= {k: rows[k].combine_chunks() for k in (*_ORDER, "cid", "v")}
        return pa.Table.from_pydict(none, schema=schema).combine_chunks().to_batches()

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()), ("pos", pa.int64()),
                        ("pass", pa.int32()), ("label", pa.int64()), ("dim", pa.int64()), ("cid", pa.int64()),
                        ("v", pa.binary())])

    def run(batches):
        part, tail, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            if seen < window:
                first = t.slice(0, window - seen)
                yield from made(part, np.arange(seen, seen + first.num_rows), rows=first)
            fresh = 0 if tail is None else tail.num_rows
            t = (t if tail is None else pa.concat_tables([tail, t])).combine_chunks()
            tail, seen = t.slice(max(0, t.num_rows - window)), seen + b.num_rows
            stars = _compare(t, fresh, threshold, window)
            if stars:
                yield from made(stars=stars)
        if seen:
            last = tail.slice(max(0, tail.num_rows - max(0, seen - window)))  # without those among the first
            if last.num_rows:
                yield from made(part, np.arange(seen - last.num_rows, seen), rows=last)
            yield from made(part, np.array([seen]))
    return run


def _borders(passed: DataFrame, threshold: float, window: int, parts: int) -> DataFrame:
    """(a, b) as of ``_compare`` for the ``window`` rows on either side of each border between tasks."""
    spark = passed.sparkSession
    at, starts = 0, []  # one row per task
    for part, n in sorted(passed.filter("pos IS NOT NULL AND cid IS NULL").select("part", "pos").collect()):
        starts.append((part, at))
        at += n
    starts = spark.createDataFrame(starts, "part int, start long")
    edge = passed.filter("pos IS NOT NULL AND cid IS NOT NULL").join(F.broadcast(starts), "part").withColumn("at", F.col("pos") + F.col("start"))
    near = F.broadcast(starts.filter("start > 0").select(F.col("start").alias("border"), F.expr(f"start div {window}").alias("cell")))
    dealt = (edge.withColumn("cell", F.explode(F.expr(f"sequence(at div {window} - 1, at div {window} + 1)")))
             .join(near, "cell").filter((F.col("at") >= F.col("border") - window) & (F.col("at") < F.col("border") + window)))

    def run(batches):
        for g in groups(batches, ["border"]):
            stars = _compare(g, 0, threshold, window)
            if stars:
                x, y = zip(*stars)
                yield pa.record_batch([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return (dealt.select("border", "at", *_ORDER, "cid", "v").repartition(parts, "border")
            .sortWithinPartitions("border", "at").mapInArrow(run, "a long, b long"))


def _leaders(threshold: float):
    """Groups (label, dim, slice) of crowded classes: those that cover the rest of their group."""
    reach = _cosine_of(threshold, COVER)

    def run(batches):
        for g in groups(batches, ["label", "dim", "slice"]):
            u = unit(matrix(g["vector"].combine_chunks()))
            left, picked = np.ones(len(u), bool), []
            while left.any():
                picked.append(int(left.argmax()))
                left &= u @ u[picked[-1]] < reach
                left[picked[-1]] = False
            yield from g.take(pa.array(picked)).select(["label", "dim", "cid", "vector"]).combine_chunks().to_batches()
    return run


def _by_leaders(threshold: float, rows: int = 1024):
    """Rows sorted by (label, dim, block, leads): a block's classes come first, its leaders stream after them.

    Stars over the block's classes and leaders: a class is united with each leader within one angle more
    than a leader covers.
    """
    reach = _cosine_of(threshold, COVER + 1) - 1e-9

    def run(batches):
        key, held, u, cid, comp = None, [], None, None, None
        ends: list = []

        def stars():
            if cid is None or not ends:
                return
            leader, at = (np.array(x, np.int64) for x in zip(*ends))
            near = np.isin(comp, comp[at])
            yield pa.record_batch([pa.array(np.append(leader, cid[near])), pa.array(np.append(cid[comp[at]], cid[comp[near]]))],
                                  names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            keys = [t[c].to_numpy() for c in ("label", "dim", "block", "leads")]
            for s, e in slices(keys):
                here = tuple(int(k[s]) for k in keys[:3])
                if here != key:
                    yield from stars()
                    key, held, u, cid, comp, ends = here, [], None, None, None, []
                part = t.slice(s, e - s).combine_chunks()
                ids, v = part["cid"].to_numpy(), unit(matrix(part["vector"].combine_chunks()))
                if not keys[3][s]:
                    held.append((ids, v))
                    continue
                if u is None and held:
                    cid, u = (np.concatenate(x) for x in zip(*held))
                    held, comp = [], np.arange(len(cid))
                if u is None:
                    continue
                for i in range(0, len(ids), rows):
                    near = v[i:i + rows] @ u.T >= reach
                    for j in np.flatnonzero(near.any(axis=1)).tolist():
                        met = np.unique(comp[near[j]])
                        if len(met) > 1:
                            comp[np.isin(comp, met)] = met[0]
                        ends.append((int(ids[i + j]), int(met[0])))
        yield from stars()
    return run


def _exact_links(threshold: float):
    """Groups (comp, one, two) of at most two blocks: link counts of classes, spanning edges of the links."""
    schema = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for g in groups(batches, ["comp", "one", "two"]):
            cid, n, block = (g[c].to_numpy() for c in ("cid", "n", "block"))
            one, two = g["one"][0].as_py(), g["two"][0].as_py()
            x = matrix(g["vector"].combine_chunks())
            norm = np.sqrt((x * x).sum(axis=1))
            i, j = np.flatnonzero(block == one), np.flatnonzero(block == two)
            near = (x[i] @ x[j].T) / (norm[i][:, None] * norm[j][None, :]) >= threshold
            if one == two:
                np.fill_diagonal(near, False)
                links, full = near @ n, near
            else:
                links, full = np.zeros(len(cid), np.int64), np.zeros((len(cid), len(cid)), bool)
                links[i], links[j] = near @ n[j], near.T @ n[i]
                full[np.ix_(i, j)] = near
                full |= full.T
            some = np.flatnonzero(links)
            edges = np.array(_spanning(full), np.int64).reshape(-1, 2)
            k, e = len(some), len(edges)
            yield pa.record_batch([
                pa.array(np.append(cid[some], np.zeros(e, np.int64)), mask=np.repeat([False, True], [k, e])),
                pa.array(np.append(links[some], np.zeros(e, np.int64))),
                pa.array(np.append(np.zeros(k, np.int64), cid[edges[:, 0]]), mask=np.repeat([True, False], [k, e])),
                pa.array(np.append(np.zeros(k, np.int64), cid[edges[:, 1]]), mask=np.repeat([True, False], [k, e]))],
                schema=schema)
    return run


def _crowded_links(classes: DataFrame, crowded: DataFrame, threshold: float, block: int, spread: int, parts: int) -> DataFrame:
    """Edges (a, b) by which the crowded classes meet all their partners in the label."""
    crowded = cut_lineage(classes.join(crowded, "cid").select("label", "dim", "cid", "vector"), "vec-crowded")
    members = F.count("*")
    one_slice = F.least(F.lit(4 * block), F.greatest(F.lit(64), F.ceil(members / spread)))
    sizes = crowded.groupBy("label", "dim").agg(F.ceil(members / one_slice).cast("long").alias("slices"))
    leaders = cut_lineage(
        join_small(crowded, sizes, ["label", "dim"])
        .select("label", "dim", F.pmod(F.xxhash64("cid"), "slices").alias("slice"), "cid", "vector")
        .repartition(parts, "label", "dim", "slice").sortWithinPartitions("label", "dim", "slice", "cid")
        .mapInArrow(_leaders(threshold), StructType([crowded.schema[c] for c in ("label", "dim", "cid", "vector")])),
        "vec-leaders")
    led = leaders.select("label", "dim").distinct()
    blocks = classes.join(led, ["label", "dim"], "left_semi").groupBy("label", "dim").agg(F.greatest(
        F.ceil(members / (4 * block)), F.least(F.lit(spread), F.ceil(members / 64))).cast("long").alias("blocks"))
    blocks = cut_lineage(blocks, "vec-blocks")
    dealt = join_small(classes, blocks, ["label", "dim"]).select(
        "label", "dim", F.pmod(F.xxhash64("cid"), "blocks").alias("block"), F.lit(0).alias("leads"), "cid", "vector")
    asked = join_small(leaders, blocks, ["label", "dim"]).select(
        "label", "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.lit(1).alias("leads"), "cid", "vector")
    return (dealt.unionAll(asked).repartition(parts, "label", "dim", "block")
            .sortWithinPartitions("label", "dim", "block", "leads", "cid")
            .mapInArrow(_by_leaders(threshold), "a long, b long"))


def near_vectors(vectors: DataFrame, threshold: float = 0.93, passes: int = 16, window: int = 64, block: int = 2048,
                 spread: int = 16, seed: int = 5, recall: float = 0.999, most_passes: int = 128, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` (smallest id reachable), ``kept``."""
    parts = shuffle_partitions(vectors.sparkSession)
    rows = cut_lineage(vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).alias("vector"), F.monotonically_increasing_id().alias("row"))
        .withColumn("ok", usable("vector") & F.col("label").isNotNull())
        .withColumns({"h1": F.when(F.col("ok"), F.xxhash64("vector")),
                      "h2": F.when(F.col("ok"), F.xxhash64(F.lit(17), "vector"))}), "vec-rows")
    classes = cut_lineage(rows.filter("ok").groupBy("label", "h1", "h2").agg(
        F.min("row").alias("cid"), F.count("*").alias("n"), F.min("id").alias("least"), F.first("vector").alias("vector"))
        .withColumn("dim", F.size("vector").cast("long")), "vec-classes")
    shapes = cut_lineage(_shapes(classes, threshold, window, recall, passes, most_passes), "vec-shapes")
    most = shapes.agg(F.max("passes")).first()[0] or passes
    keyed = (join_small(classes, shapes, ["label", "dim"], max_rows=2000)  # a mean vector each
             .select("label", "dim", "cid", "vector", "mean", "passes").repartition(parts)
             .mapInArrow(_keyed(most, seed), "pass int, label long, dim long, key long, cid long, v binary"))
    keyed = cut_lineage(keyed, "vec-keys")
    passed = cut_lineage(
        keyed.repartitionByRange(parts, "pass", "label", "dim", "key", "cid")
        .sortWithinPartitions("pass", "label", "dim", "key", "cid")
        .mapInArrow(_neighbours(threshold, window), _PASSED), "vec-passed")
    passed = cut_lineage(passed.filter("a IS NOT NULL").select("a", "b")
                         .unionAll(_borders(passed, threshold, window, parts)), "vec-met")
    whole = classes.join(shapes.filter("whole").select("label", "dim"), ["label", "dim"], "left_semi").select("cid")
    crowded = passed.filter("b IS NULL").select(F.col("a").alias("cid")).unionByName(whole).distinct()
    united = connected_components(passed.filter("b IS NOT NULL").unionAll(
        _crowded_links(classes, crowded, threshold, block, spread, parts)), "a", "b")
    united = cut_lineage(united.withColumnsRenamed({"node": "cid", "component": "comp"}), "vec-united")
    members = F.count("*")
    one_block = F.least(F.lit(block), F.greatest(F.lit(64), F.ceil(members / spread)))
    sizes = united.groupBy("comp").agg(F.ceil(members / one_block).cast("long").alias("blocks"))
    members = (united.join(sizes, "comp").join(classes, "cid")
               .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
               .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
               .select("comp", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
                       "block", "cid", "n", "vector"))
    exact = cut_lineage(members.repartition(parts, "comp", "one", "two").sortWithinPartitions("comp", "one", "two", "cid")
                        .mapInArrow(_exact_links(threshold), "cid long, links long, a long, b long"), "vec-links")
    linked = connected_components(exact.filter("a IS NOT NULL").select("a", "b"), "a", "b")
    counts = exact.filter("cid IS NOT NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    known = (classes.select("label", "h1", "h2", "cid", "n", "least").join(counts, "cid", "left")
             .join(linked.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("comp", F.coalesce("component", "cid")))
    known = cut_lineage(known.select("label", "h1", "h2", "comp", "least",
                                     (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vec-known")
    least = known.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = known.join(least, "comp").select("label", "h1", "h2", "n_links", "component_id")
    out = rows.select("id", "label", "h1", "h2").join(known, ["label", "h1", "h2"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
