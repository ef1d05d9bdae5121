"""SimHash near-dedup with meet-in-the-middle ball hashing.

A 64-bit fingerprint per document; two link when they differ in at most ``max_bits`` bits.  Every
distinct fingerprint emits all variants within half the radius; fingerprints that share a variant meet
in the shuffle and are verified there.  An odd radius leaves one bit over: the 64 positions are cut
into three blocks, and the variants are formed three times with one block blanked out.  Any pair within
``2 * half + 1`` bits has a block with at least one of its differing bits, so with that block blanked at
most ``2 * half`` are left and the two balls meet; no pair is lost.  For radius 3 that is 131 variants
instead of the 2,081 of a ball of radius 2.

A bucket never emits all its pairs: of each pair only the smallest shared variant counts, and a bucket
emits a spanning forest of those.  A bucket holds distinct fingerprints alone (equal texts were grouped
before), at most ``44 * 2**21`` by construction.

Defined cases: NULL and empty texts have fingerprint 0 and link like any other; repeated rows are kept;
NULL ids are allowed (a component of them alone has a NULL id); an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ROW, segments, shuffle_partitions, with_rows
from .components import connected_components

SEED = 42
_LANES = np.uint64(0x0101010101010101)
_DENSE = 512  # members up to which a bucket's distances are one matrix


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 of every k-word shingle (repeats included) of the text, ASCII-lower-cased."""
    return _word_hashes((text or "").encode("utf-8", "surrogatepass").lower().split(), k)


def hash_parts(text: str | None, k: int, most: int = 1_000_000):
    """The same hashes in parts, for texts of any length: each part carries the last k - 1 words on."""
    if text is None or len(text) <= most:
        yield shingle_hashes(text, k)
        return
    words: list = []
    some = False
    for part in segments(text, most):
        words = words[max(0, len(words) - k + 1):] + part.encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= k:
            some = True
            yield _word_hashes(words, k)
    if not some:  # the whole text has fewer words
        yield _word_hashes(words, k)


def _word_hashes(words: list, k: int) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    norm, n = b" ".join(words), max(1, len(words) - k + 1)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:n].tolist()
    last = ends[min(k, len(words)) - 1:].tolist()
    return np.fromiter(map(xxhash.xxh64_intdigest, (norm[s:e] for s, e in zip(starts, last)), repeat(SEED)),
                       np.uint64, n)


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(groups, 64) counts of set bits in consecutive non-empty groups of hashes.

    Eight byte lanes are summed at once, in blocks of at most 255 rows so that no lane overflows.
    """
    sizes = np.diff(np.append(starts, len(hashes)))
    blocks = (sizes + 254) // 255
    first = np.cumsum(blocks) - blocks
    at = np.repeat(starts, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    out = np.empty((len(starts), 64), np.int64)
    for s in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(s)) & _LANES, at).astype("<u8").view(np.uint8).reshape(-1, 8)
        out[:, s::8] = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
    return out


def _fingerprint_rows(k: int, chunk: int = 400_000):
    def run(batches):
        for b in batches:
            ones, total = np.zeros((b.num_rows, 64), np.int64), np.zeros(b.num_rows, np.int64)
            part, at, held = [], [], 0

            def flush():
                sizes = np.array([len(p) for p in part])
                np.add.at(ones, at, bit_counts(np.concatenate(part), np.cumsum(sizes) - sizes))
                np.add.at(total, at, sizes)
                part.clear()
                at.clear()

            for i, text in enumerate(b["_text"]):
                for h in hash_parts(text.as_py(), k):
                    if len(h):
                        part.append(h)
                        at.append(i)
                        held += len(h)
                        if held >= chunk:
                            flush()
                            held = 0
            if part:
                flush()
            fps = ((2 * ones > total[:, None]).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
            keep = [n for n in b.schema.names if n != "_text"]
            yield pa.record_batch([*[b[n] for n in keep], pa.array(fps.view(np.int64))], names=[*keep, "fp"])
    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ball_variants(max_bits: int) -> list[tuple[int, int]]:
    """(kept bits, flip) pairs: variant = (fingerprint & kept) ^ flip; blanked blocks carry their number."""
    half, every = max_bits // 2, (1 << 64) - 1
    blocks = [(0, 22), (22, 43), (43, 64)] if max_bits % 2 else [(0, 0)]
    out = []
    for no, (lo, hi) in enumerate(blocks, 1):
        kept = every & ~(((1 << hi) - 1) & ~((1 << lo) - 1))
        tag = no << lo if hi else 0
        bits = [1 << i for i in range(64) if kept >> i & 1]
        for d in range(half + 1):
            out += [(kept, tag | sum(c)) for c in combinations(bits, d)]
    return out


def _spanning(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a small boolean adjacency matrix."""
    left, edges = np.ones(len(adjacent), bool), []
    for seed in range(len(adjacent)):
        if not left[seed]:
            continue
        left[seed], stack = False, [seed]
        while stack:
            x = stack.pop()
            new = np.flatnonzero(adjacent[x] & left)
            left[new] = False
            edges += [(x, y) for y in new.tolist()]
            stack += new.tolist()
    return edges


def _grow(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of a large bucket: each reached member is compared with those not reached yet."""
    left, edges = np.arange(len(fps)), []
    while len(left):
        stack, left = [left[0]], left[1:]
        while stack and len(left):
            x = stack.pop()
            near = np.bitwise_count(fps[left] ^ fps[x]) <= max_bits
            new, left = left[near], left[~near]
            edges += [(x, y) for y in new.tolist()]
            stack += new.tolist()
    return edges


def _bucket_links(max_bits: int):
    """Over rows sorted by (variant, fingerprint): verified links, as spanning forests of the buckets."""
    masks = [np.uint64(k) for k in dict.fromkeys(k for k, _ in ball_variants(max_bits))]
    half = max_bits // 2

    def smallest_shared(a, b, v):
        """Is ``v`` the first shared variant of a and b (both within ``half`` of it, some block blanked)?"""
        ok = np.zeros(np.broadcast(a, b).shape, bool)
        done = ok.copy()
        for no, kept in enumerate(masks, 1):
            tag = np.uint64(0)
            if len(masks) > 1:
                tag = np.uint64(no << (0, 22, 43)[no - 1])
            d = np.bitwise_count((a ^ b) & kept)
            meets = (d <= 2 * half) & ~done
            done |= meets
            if half != 1:  # wider balls share many variants: any of them may report the pair
                ok |= meets
                continue
            x, low = a & kept, (a ^ b) & kept
            bit1 = low & (~low + np.uint64(1))
            first = np.where(d == 0, x, np.where(d == 1, np.minimum(x, b & kept),
                                                 np.minimum(x ^ bit1, x ^ (low ^ bit1))))
            ok |= meets & ((first | tag) == v)
        return ok

    def links(keys, fps):
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        two = starts[sizes == 2]
        a, b = fps[two], fps[two + 1]
        ok = (np.bitwise_count(a ^ b) <= max_bits) & smallest_shared(a, b, keys[two])
        out = [np.stack([a[ok], b[ok]], 1)]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            f = fps[s:s + n]
            if n <= _DENSE:
                x, y = f[:, None], f[None, :]
                edges = _spanning((np.bitwise_count(x ^ y) <= max_bits) & smallest_shared(x, y, keys[s]))
            else:
                edges = _grow(f, max_bits)
            if edges:
                out.append(f[np.array(edges)])
        return np.concatenate(out)

    def run(batches):
        held_k = held_f = np.empty(0, np.uint64)
        for b in batches:
            k = np.concatenate([held_k, b["key"].to_numpy().view(np.uint64)])
            f = np.concatenate([held_f, b["fp"].to_numpy().view(np.uint64)])
            if not len(k):
                continue
            cut = int(np.flatnonzero(np.append(True, k[1:] != k[:-1]))[-1])
            held_k, held_f = k[cut:], f[cut:]
            if cut:
                e = links(k[:cut], f[:cut]).view(np.int64)
                if len(e):
                    yield pa.record_batch([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])
        if len(held_k):
            e = links(held_k, held_f).view(np.int64)
            if len(e):
                yield pa.record_batch([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])
    return run


def fingerprint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) among distinct LONG fingerprints ``fp``, enough to connect all within ``max_bits`` bits."""
    variants = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(k))).bitwiseXOR(F.lit(_signed(x)))
                         for k, x in ball_variants(max_bits)])
    # a row becomes 131: spread the few bytes of fingerprints over all tasks first
    spread = fps.select("fp").repartition(shuffle_partitions(fps.sparkSession), "fp")
    return (spread.select("fp", F.explode(variants).alias("key")).repartition("key").sortWithinPartitions("key", "fp")
            .mapInArrow(_bucket_links(max_bits), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``fingerprint`` (16 hex digits), ``component_id``, ``root``, ``row_key``.

    ``component_id`` is the smallest id reachable over links, ``root`` the smallest fingerprint (signed).
    ``row_key`` is the input's ``ROW`` column if there is one, else NULL.
    """
    key = F.col(ROW) if ROW in docs.columns else F.lit(None).cast("long")
    rows = cut_lineage(docs.select(F.col(id_col).cast("long").alias("id"), key.alias("row_key"),
                                   F.col(text_col).alias("_text"))
                       .mapInArrow(_fingerprint_rows(shingle), "id long, row_key long, fp long"), "fingerprints")
    fps = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct-fingerprints")
    linked = connected_components(fingerprint_links(fps, max_bits), "a", "b")
    grouped = (fps.join(linked, fps["fp"] == linked["node"], "left")
               .select("fp", "first_id", F.coalesce("component", "fp").alias("root")))
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = cut_lineage(grouped.select("fp", "root").join(least, "root"), "fingerprint-groups")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        "root", "row_key")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The input without all but one document of each group (the smallest id, NULL last, then row)."""
    keyed = with_rows(docs, "simhash-docs")
    found = near_duplicates(keyed, shingle, max_bits, id_col, text_col)
    stay = found.groupBy("root").agg(F.min(F.struct(
        F.col(id_col).isNull(), F.col(id_col).alias("id"), F.col("row_key").alias("row_key"))).alias("m"))
    return keyed.join(stay.select(F.col("m.row_key").alias(ROW)), ROW, "left_semi").select(*docs.columns)
