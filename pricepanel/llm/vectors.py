"""Helpers for embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for vectors that are not NULL, not empty, not zero and hold finite numbers only."""
    inf = float("inf")
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists(vector, lambda x: x != 0),
        F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of one dimension as a float64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (first by their largest entry, against overflow)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def slices(keys: list[np.ndarray]):
    """(start, end) of the runs of equal keys."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    return list(zip(starts.tolist(), np.append(starts[1:], n).tolist()))


def groups(batches, keys: list[str]):
    """Tables of whole key groups from batches sorted by ``keys`` (LONG, not NULL); a group is held at a time."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        cuts = slices([t[k].to_numpy() for k in keys])
        for i, (s, e) in enumerate(cuts):
            part = t.slice(s, e - s)
            if held is not None:
                if i == 0 and all(held[k][0].as_py() == part[k][0].as_py() for k in keys):
                    part = pa.concat_tables([held, part])
                else:
                    yield held.combine_chunks()
            held = part
    if held is not None:
        yield held.combine_chunks()
