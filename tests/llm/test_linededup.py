"""Line dedup against a plain dictionary."""

import random
from collections import defaultdict

import pyarrow as pa

from pricepanel.llm.linededup import COUNT, DROP, PENDING, _stream_runs, dedup_lines


def brute(rows, min_docs):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)
    docs = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            docs[key(line)].add((i, t))
    bad = {k for k, d in docs.items() if k and len(d) >= min_docs}
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if key(x) not in bad),
             len((t or "").split("\n")), sum(key(x) in bad for x in (t or "").split("\n"))) for i, t, *_ in rows]


def test_matches_brute_force_with_odd_rows(spark, odd_docs):
    rnd = random.Random(2)
    lines = ["Common line", " common LINE\t", "rare", "", "  ", "Ünï", "x" * 2000, "a", "é\xa0"] + [f"u{i}" for i in range(40)]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(1, 30))), "s") for i in range(60)]
    rows += [(100, None, None), (101, "", "s"), (None, "common line\nz", "s"), (None, "common line\ny", "s"), rows[0], rows[0]]
    rows.append((102, "\n".join(["common line", "only here"] * 3000), "s"))
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = dedup_lines(odd_docs(rows), min_docs=10)
        out = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2])
        assert sorted(out, key=key) == sorted(brute(rows, 10), key=key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert dedup_lines(odd_docs(rows).filter("false")).count() == 0


def test_stream_decides_alike_wherever_partitions_and_batches_are_cut():
    rnd = random.Random(4)
    rows = sorted((h, 0, d, 0, p) for h, n in ((1, 3), (2, 40), (3, 10), (4, 9), (5, 1), (6, 200))
                  for d in rnd.sample(range(300), n) for p in range(rnd.randint(1, 3)))
    want = {(h, d, p) for h, _, d, _, p in rows if len({r[2] for r in rows if r[0] == h}) >= 10}
    names = ["h1", "h2", "id", "th", "pos"]
    for cut in (5, 17, 60, len(rows)):
        # partitions are cut between documents, as the range partitioning does
        parts, part = [], []
        for i, r in enumerate(rows):
            if len(part) >= cut and r[:4] != rows[i - 1][:4]:
                parts.append(part)
                part = []
            part.append(r)
        parts.append(part)
        drop, pending, total = set(), [], defaultdict(int)
        for part in parts:
            batches = [pa.record_batch([pa.array(c) for c in zip(*part[i:i + 4])], names=names) for i in range(0, len(part), 4)]
            for b in _stream_runs(10)(batches):
                for r in b.to_pylist():
                    if r["kind"] == DROP:
                        drop.add((r["h1"], r["id"], r["pos"]))
                    elif r["kind"] == PENDING:
                        pending.append((r["h1"], r["id"], r["pos"]))
                    elif r["kind"] == COUNT:
                        total[r["h1"]] += r["n"]
        drop |= {p for p in pending if total[p[0]] >= 10}
        assert drop == want, cut
