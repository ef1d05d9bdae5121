"""Texts worked on in parts give what they give as a whole."""

import random

import numpy as np

from pricepanel.llm.common import segments
from pricepanel.llm.simhash import bit_counts, hash_parts, shingle_hashes


def texts():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 5, 400):
        yield "".join(rnd.choice(["ab", "c", "é", "longerword"]) + rnd.choice([" ", "\n", "  \t"]) for _ in range(n))
    yield "x" * 300
    yield "a b " + "x" * 300 + " c d"
    yield " " * 200 + "end"


def test_segments_cover_the_text_and_cut_at_white_space():
    for text in texts():
        for most in (7, 50, 10_000):
            assert "".join(segments(text, most)) == text
            assert [w for s in segments(text, most) for w in s.split()] == text.split()
    words = [f"w{i}" for i in range(500)]
    for most in (7, 50, 300):
        for back in (1, 3):
            parts = [s.split() for s in segments(" \n".join(words), most, back)]
            assert list(dict.fromkeys(w for p in parts for w in p)) == words
            assert all(a[-back:] == b[:back] for a, b in zip(parts, parts[1:]) if len(a) > back)


def test_shingles_in_parts():
    for text in texts():
        for k in (1, 3):
            for most in (7, 50, 10_000):
                parts = list(hash_parts(text, k, most))
                whole = shingle_hashes(text, k)
                assert np.array_equal(np.concatenate(parts) if parts else whole[:0], whole)


def test_bit_counts_over_several_lane_blocks():
    r = np.random.default_rng(1)
    h = r.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, 3000, dtype=np.uint64)
    starts = np.array([0, 1, 256, 1000])
    want = [[int((g >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)] for g in np.split(h, starts[1:])]
    assert bit_counts(h, starts).tolist() == want
