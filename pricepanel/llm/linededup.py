"""Line dedup: lines found in many documents lose all their copies.

Lines become 128-bit hashes with their document and position.  The hashes are range-partitioned and
sorted by (hash, document, position), so even one line in a third of all documents is spread over many
tasks; a stream over each partition counts the first occurrence of a hash in each document.  Only a
partition's first and last hash can go on next door: for these the stream emits a partial count, and
holds back at most ``min_docs - 1`` documents' lines until the counts are added up.  What comes back per
document is a compressed keep bitmap, never text; the text is joined with it once.

A document is its (id, text): repeated rows count once and get the same result.

Defined cases: NULL or empty text is one empty line; a line whose key is empty is never dropped; NULL ids
are allowed; an empty table gives an empty result; all input columns are passed on.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import cut_lineage
from .common import WORD_SPACE, shuffle_partitions

ROWS = 200_000


def _line_rows(min_chars: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("th", pa.int64()),
                        ("pos", pa.int32())])

    def run(batches):
        hashes, ids, ths, pos = [], [], [], []

        def batch():
            h = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
            out = pa.record_batch([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64()),
                                   pa.array(ths, pa.int64()), pa.array(pos, pa.int32())], schema=schema)
            for x in (hashes, ids, ths, pos):
                x.clear()
            return out

        for b in batches:
            for doc, th, text in zip(b["id"].to_pylist(), b["th"].to_pylist(), b["text"]):
                for p, line in enumerate((text.as_py() or "").encode("utf-8", "surrogatepass").split(b"\n")):
                    key = line.strip(WORD_SPACE).lower()
                    if not key or (min_chars > 1 and len(key.decode("utf-8", "surrogatepass")) < min_chars):
                        continue
                    hashes.append(xxhash.xxh3_128_digest(key))
                    ids.append(doc)
                    ths.append(th)
                    pos.append(p)
                    if len(pos) >= ROWS:
                        yield batch()
        if pos:
            yield batch()

    return run


_MARKS = pa.schema([("kind", pa.int8()), ("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()),
                    ("th", pa.int64()), ("pos", pa.int32()), ("n", pa.int64())])
DROP, PENDING, COUNT = 0, 1, 2


def _stream_runs(min_docs: int):
    """Over rows sorted by (h1, h2, id, th, pos): dropped lines, held-back lines and partial counts."""
    cols = ("h1", "h2", "id", "th", "pos")

    def marks(kind, t, n=0):
        k = t.num_rows
        return pa.record_batch([pa.array(np.full(k, kind, np.int8)), *[t[c].combine_chunks() for c in cols],
                                pa.array(np.full(k, n, np.int64))], schema=_MARKS)

    def counted(h, n):
        return pa.record_batch([pa.array([COUNT], pa.int8()), pa.array([h[0]], pa.int64()),
                                pa.array([h[1]], pa.int64()), pa.array([None], pa.int64()),
                                pa.array([None], pa.int64()), pa.array([None], pa.int32()),
                                pa.array([n], pa.int64())], schema=_MARKS)

    def filled(t, name):
        c = t[name].combine_chunks()
        return c.fill_null(0).to_numpy(zero_copy_only=False), c.is_null().to_numpy(zero_copy_only=False)

    def run(batches):
        held = None       # rows of the open run that are not decided yet
        open_h, first_h = None, None
        base, last_doc = 0, None   # documents of the open run already flushed; the last of them
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]).select(cols)
            if held is not None and held.num_rows:
                t = pa.concat_tables([held, t]).combine_chunks()
            held = None
            h1, h2 = t["h1"].to_numpy(), t["h2"].to_numpy()
            (ids, no_id), ths = filled(t, "id"), t["th"].to_numpy()
            n = len(h1)
            if first_h is None:
                first_h = (int(h1[0]), int(h2[0]))
            new_run = np.ones(n, bool)
            new_run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new_doc = new_run.copy()
            new_doc[1:] |= (ids[1:] != ids[:-1]) | (no_id[1:] != no_id[:-1]) | (ths[1:] != ths[:-1])
            if open_h is not None and base:  # rows before these were flushed
                if open_h == (int(h1[0]), int(h2[0])):
                    if last_doc == (int(ids[0]), bool(no_id[0]), int(ths[0])):
                        new_doc[0] = False
                else:  # the flushed run ended with the last batch
                    if open_h == first_h:
                        yield counted(open_h, base)
                    base = 0
            starts = np.flatnonzero(new_run)
            docs = np.add.reduceat(new_doc.astype(np.int64), starts)
            docs[0] += base
            ends = np.append(starts[1:], n)
            # closed runs: all but the last; the partition's first run stays open to its left
            closed = np.arange(len(starts)) < len(starts) - 1
            hs0 = (int(h1[0]), int(h2[0]))
            verdict = np.where(docs >= min_docs, DROP, -1)
            if closed[0] and hs0 == first_h:
                yield counted(first_h, int(docs[0]))
                if docs[0] < min_docs:
                    verdict[0] = PENDING
            verdict[~closed & (verdict != DROP)] = -1
            per_row = np.repeat(verdict, ends - starts)
            for kind in (DROP, PENDING):
                sel = np.flatnonzero(per_row == kind)
                if len(sel):
                    yield marks(kind, t.take(pa.array(sel)))
            open_h = (int(h1[-1]), int(h2[-1]))
            if docs[-1] >= min_docs:
                base, last_doc = int(docs[-1]), (int(ids[-1]), bool(no_id[-1]), int(ths[-1]))
            else:
                base, held = 0, t.slice(int(starts[-1]))
        if open_h is not None:
            if base:
                yield counted(open_h, base)
            else:
                yield marks(PENDING, held)
                doc_rows = set(zip(held["id"].to_pylist(), held["th"].to_pylist()))
                yield counted(open_h, len(doc_rows))

    return run


def _bitmaps(batches):
    """Sorted (id, th, pos) rows -> one row per document: zlib of the packed keep bits up to the last drop."""
    schema = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("keep", pa.binary())])

    def bitmap(pos):
        keep = np.ones(int(pos[-1]) + 1, np.uint8)
        keep[pos] = 0
        return zlib.compress(np.packbits(keep).tobytes() + int(len(keep)).to_bytes(8, "little"), 1)

    doc, open_pos = None, []
    for b in batches:
        if not b.num_rows:
            continue
        ids, ths, pos = b["id"].to_pylist(), b["th"].to_pylist(), b["pos"].to_numpy()
        out = ([], [], [])
        keys = list(zip(ids, ths))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for s, e in zip(cuts, cuts[1:]):
            if doc is not None and keys[s] != doc:
                for c, v in zip(out, (*doc, bitmap(np.concatenate(open_pos)))):
                    c.append(v)
                open_pos = []
            doc = keys[s]
            open_pos.append(pos[s:e])
        yield pa.record_batch([pa.array(c, t.type) for c, t in zip(out, schema)], schema=schema)
    if doc is not None:
        yield pa.record_batch([pa.array([v], t.type) for v, t in
                               zip((*doc, bitmap(np.concatenate(open_pos))), schema)], schema=schema)


def read_bitmap(keep: bytes) -> np.ndarray:
    """The keep flags (1 = stays) of a document's lines up to its last dropped line."""
    raw = zlib.decompress(keep)
    return np.unpackbits(np.frombuffer(raw[:-8], np.uint8), count=int.from_bytes(raw[-8:], "little"))


def line_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row (id, th, keep) per document that loses lines; ``th`` is ``xxhash64(text)``."""
    parts = shuffle_partitions(docs.sparkSession)
    lines = cut_lineage(docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
        .mapInArrow(_line_rows(min_chars), "h1 long, h2 long, id long, th long, pos int"), "lines")
    marks = cut_lineage(
        lines.repartitionByRange(parts, "h1", "h2", "id", "th").sortWithinPartitions("h1", "h2", "id", "th", "pos")
        .mapInArrow(_stream_runs(min_docs), "kind byte, h1 long, h2 long, id long, th long, pos int, n long"), "line-marks")
    frequent = (marks.filter(F.col("kind") == COUNT).groupBy("h1", "h2").agg(F.sum("n").alias("n"))
                .filter(F.col("n") >= min_docs).select("h1", "h2"))  # two rows per partition at most
    dropped = marks.filter(F.col("kind") == DROP).select("id", "th", "pos").unionByName(
        marks.filter(F.col("kind") == PENDING).join(frequent, ["h1", "h2"]).select("id", "th", "pos"))
    return (dropped.distinct().repartition("id", "th").sortWithinPartitions("id", "th", "pos")
            .mapInArrow(_bitmaps, "id long, th long, keep binary"))


def _keep_lines(text_name: str):
    def run(batches):
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, keep in zip(b[text_name], b["_ld_keep"]):
                text, keep = text.as_py(), keep.as_py()
                if keep is None:
                    texts.append(text)
                    n_lines.append((text or "").count("\n") + 1)
                    n_dropped.append(0)
                    continue
                lines, flags = text.split("\n"), read_bitmap(keep)
                texts.append("\n".join([x for x, k in zip(lines, flags) if k] + lines[len(flags):]))
                n_lines.append(len(lines))
                n_dropped.append(int(len(flags) - flags.sum()))
            cols = {"_ld_lines": pa.array(n_lines, pa.int64()), "_ld_dropped": pa.array(n_dropped, pa.int64()),
                    text_name: pa.array(texts, b.schema.field(text_name).type)}
            names = [n for n in b.schema.names if n != "_ld_keep"] + ["_ld_lines", "_ld_dropped"]
            yield pa.record_batch([cols.get(n) if n in cols else b[n] for n in names], names=names)
    return run


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text",
                lines_col: str = "n_lines", dropped_col: str = "n_dropped") -> DataFrame:
    """The input with frequent lines gone from ``text_col``, and columns ``lines_col`` and ``dropped_col``.

    A line's key is the line without ASCII white space at both ends and with A-Z lower-cased; keys of
    ``min_chars`` code points or more in ``min_docs`` documents or more lose all their lines.  Input
    columns of these two names are replaced.
    """
    keep = line_bitmaps(docs, min_docs, min_chars, id_col, text_col).select(
        F.col("id").alias("_ld_id"), F.col("th").alias("_ld_th"), F.col("keep").alias("_ld_keep"))
    docs = docs.drop(*[c for c in (lines_col, dropped_col) if c in docs.columns])
    th = F.xxhash64(docs[text_col])
    joined = docs.join(keep, docs[id_col].cast("long").eqNullSafe(keep["_ld_id"]) & (th == keep["_ld_th"]), "left")
    joined = joined.select(*[docs[c] for c in docs.columns], "_ld_keep")
    out = StructType([*docs.schema.fields, StructField("_ld_lines", LongType()), StructField("_ld_dropped", LongType())])
    return (joined.mapInArrow(_keep_lines(text_col), out)
            .withColumnsRenamed({"_ld_lines": lines_col, "_ld_dropped": dropped_col}))
