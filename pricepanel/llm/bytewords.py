"""Words of many texts at once: numpy over the bytes of an Arrow column, no Python step per word.

Words and their hashes come from the UTF-8 bytes; A-Z count as a-z.  Hashes are Rabin-Karp polynomials over
2^64 from one prefix array, so every span of a buffer has its hash in constant time.  Equal spans have equal
hashes; callers that need the reverse compare the bytes (``same_spans``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_PRIME, -1, 2**64)
#: Bytes hashed in one go; longer spans make it grow.
HASH_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words of letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def byte_codes(seed: int = 0) -> np.ndarray:
    """A random 64-bit code for each byte, the same for upper and lower case."""
    return np.random.default_rng([7, seed]).integers(1, 2**64, 256, dtype=U64)[_LOWER]


def _powers(n: int, most: int = 0) -> tuple[np.ndarray, np.ndarray]:
    size = max(most or HASH_BYTES, n)
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = tuple(np.cumprod(np.concatenate([np.ones(1, U64), np.full(size, U64(p))]))
                              for p in (_PRIME, _INVERSE))
    return _POWERS[size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a hash over all its bits (one to one, so equality is kept)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 offsets into them; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, (_, offsets, data) = len(column), column.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def blocks(offsets: np.ndarray, most_bytes: int, most_rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most_bytes`` bytes; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most_bytes, side="right")) - 1
        j = min(max(j, i + 1), i + most_rows, n)
        yield i, j
        i = j


def word_spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words of each row; no word spans two rows."""
    rows = len(offsets) - 1
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    w = is_word[buf]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()
    last[:-1] &= ~w[1:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(buf))]  # rows may touch word to word
    first[inner] = w[inner]
    last[inner - 1] = w[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray, most: int = 0) -> np.ndarray:
    """The mixed polynomial hash of every span; starts and ends ascend.  Memory follows ``most`` (``HASH_BYTES``)."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(int(np.searchsorted(ends, base + (most or HASH_BYTES), side="right")), i + 1)
        stop = int(ends[j - 1])
        power, inverse = _powers(stop - base, most)
        prefix = np.zeros(stop - base + 1, U64)
        np.cumsum(codes[buf[base:stop]] * power[:stop - base], out=prefix[1:])
        out[i:j] = (prefix[ends[i:j] - base] - prefix[starts[i:j] - base]) * inverse[starts[i:j] - base]
        i = j
    return mixed(out)


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, A-Z as a-z, packed into one number (zero beyond the end)."""
    lower = np.concatenate([_LOWER[buf], np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", lower, strides=(1,))


def same_spans(a: np.ndarray, a_start: np.ndarray, a_len: np.ndarray,
               b: np.ndarray, b_start: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """Whether span i of ``a`` has the bytes of span i of ``b``; both as ``eights``."""
    same = a_len == b_len
    live, done = np.flatnonzero(same & (a_len > 0)), 0
    while len(live):
        mask = _MASKS[np.minimum(a_len[live] - done, 8)]
        equal = ((a[a_start[live] + done] ^ b[b_start[live] + done]) & mask) == 0
        same[live[~equal]] = False
        done += 8
        live = live[equal]
        live = live[a_len[live] > done]
    return same


def gathered(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string column."""
    lens = (ends - starts).astype(np.int64)
    offsets = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    index = np.repeat(starts - offsets[:-1], lens) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.string(), len(lens), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                                          pa.py_buffer(buf[index].tobytes())])
