import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricepanel.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, max_words=3, min_count=10, top=2000):
    langs = {}
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            f = langs.setdefault(lang or "und", Counter())
            for n in range(1, max_words + 1):
                f.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in langs.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        rows = []
        for p, a in cand.items():
            if any(100 * b >= 50 * a for q, b in cand.items() if len(q) > len(p) and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), " ".join(p), a, f[p[:k]], f[p[k:]]))
        rows.sort()
        out += [(lang, i, r[3], r[4], r[5], r[6], n, -r[0]) for i, r in enumerate(rows[:top], 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(3)
    vocab = ["The", "of", "ÉTÉ", "été", "x1", "語", "it's", "New", "York", "a\x00b", "\x1f"] + [f"w{i}" for i in range(15)]
    out = []
    for _ in range(500):
        w = [rnd.choice(vocab) for _ in range(rnd.choice((0, 1, 2, 30, 100)))]
        for _ in range(rnd.choice((0, 1, 3))):
            at = rnd.randrange(len(w) + 1)
            w[at:at] = rnd.choice(("New York", "new york city", "the quick fox", "over AND over and over")).split()
        text = "".join(x + rnd.choice((*" " * 20, "  ", "\t", ". ", ",", "\n", " ; ", "\r\n")) for x in w)
        out.append((rnd.choice(("en", "de", "en", None)), text))
    return out + [("en", None), ("en", ""), ("fr", "ha " * 5000), ("fr", "a b" * 3000), ("xx", "solo"), ("en", " .,; ")]


@pytest.mark.parametrize("chunk", [4 << 20, 600])
@pytest.mark.parametrize("words", [3, 4])
def test_same_as_brute_force(spark, docs, chunk, words):
    df = spark.createDataFrame([(i, t, lang, 1, 2, "x") for i, (lang, t) in enumerate(docs)],
                               "doc_id long, text string, lang string, n long, chunk long, phrase string")
    want = brute(docs, words)
    assert len(want) > 50
    assert result(C.collocations(df.repartition(3), words, chunk_bytes=chunk)) == want


def test_top_and_other_limits(spark, docs):
    df = spark.createDataFrame(docs, "lang string, text string")
    assert result(C.collocations(df, min_count=3, top=7)) == brute(docs, min_count=3, top=7)
    big = [("en", "one two")] * 300
    assert result(C.collocations(spark.createDataFrame(big, "lang string, text string"), min_count=300)) == brute(big, min_count=300)


def test_shared_fingerprints_change_no_count(docs, monkeypatch):
    text = " ".join(t or "" for lang, t in docs if lang == "en")
    norm = C.normalised(np.frombuffer((text + "\n").encode(), np.uint8)).tobytes()
    real = C.span_hashes
    monkeypatch.setattr(C, "span_hashes", lambda *a: real(*a) % C.U64(50) << C.U64(20))  # fifty fingerprints in all
    made = next(C._fingerprints(3, 10, 4, np.uint8)(iter([pa.record_batch(
        [pa.array([1]), pa.array(["en"]), pa.array([0], pa.int32()), pa.array([norm])], names=["chunk", "lang", "carry", "text"])])))
    bits = {}
    for r, blob in zip(made["range"].to_pylist(), made["blob"].to_pylist()):
        t = C._frequent(10, np.uint8)([pa.scalar(r)], pa.table({"range": [r], "chunk": [1], "blob": [blob]}))
        bits.update(zip(t["range"].to_pylist(), t["bits"].to_pylist()))
    table = pa.table({"lang": ["en"] + [None] * len(bits), "carry": [0] + [None] * len(bits), "text": [norm] + [None] * len(bits),
                      "range": [None, *bits], "bits": [None, *bits.values()]})
    got = Counter()
    for row in C._phrases(3, 4)(None, table).to_pylist():
        got[row["phrase"]] += row["count"]
    want = Counter()
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
        w = re.findall(r"[^\x20\x09]+", piece)
        for n in (1, 2, 3):
            want.update(" ".join(w[i:i + n]) for i in range(len(w) - n + 1))
    assert {p: c for p, c in got.items() if c >= 10} == {p: c for p, c in want.items() if c >= 10}


def test_score_is_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_019, 3_000_000_037, 3_000_000_077
    got = spark.range(1).select(C.cut_score(F.lit(a), F.lit(l), F.lit(r))).first()[0]
    assert got == 10**6 * a * a // (l * r)


def test_packing_round_trip():
    rng = np.random.default_rng(0)
    for n, top in ((1, 48), (1000, 48), (5000, 20)):
        v = np.unique(rng.integers(0, 2**top, n, dtype=np.uint64))
        c = rng.integers(1, 10, len(v)).astype(np.uint8)
        a, b = C._unpack(C._pack(v, c), np.uint8)
        assert (a == v).all() and (b == c).all()


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_memory_of_a_full_chunk():
    """What a task holds for one chunk of the default size: two of them fit an executor beside its JVM."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from pricepanel.llm import collocations as col
    text = b" ".join(b"%x" % (i * 2654435761 % 4294967291) for i in range(col.CHUNK_BYTES // 9)) + b"\n"
    batch = pa.record_batch([pa.array([1]), pa.array(["en"]), pa.array([0], pa.int32()), pa.array([1]), pa.array([text], pa.binary())],
                            names=["chunk", "lang", "carry", "words", "text"])
    tracemalloc.start()
    try:
        list(col._fingerprints(3, 10, 16, np.uint8)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 48 << 20, peak >> 20


def chunks_of(batches, most, monkeypatch):
    class Task:
        def partitionId(self):
            return 0

    monkeypatch.setattr(C.TaskContext, "get", staticmethod(Task))
    return list(C._chunk_rows(most, 2)(iter(batches)))


def test_chunks_hold_no_more_than_they_may(monkeypatch):
    rnd = random.Random(5)
    rows = [(rnd.choice(("en", "de")), " ".join(rnd.choice("ab") * rnd.randrange(1, 9) for _ in range(rnd.randrange(150)))) for _ in range(900)]
    batches = [pa.record_batch([pa.array(x) for x in zip(*rows[i:i + 300])], names=["lang", "text"]) for i in (0, 300, 600)]
    texts = {"en": [], "de": []}
    for b in chunks_of(batches, 2000, monkeypatch):
        texts[b["lang"][0].as_py()].append(C._opened(b["text"][0].as_py()))
    for lang, found in texts.items():
        want = "".join(t + "\n" for x, t in rows if x == lang and t)
        assert b"".join(found).decode() == want
        assert max(map(len, found)) <= 2000 < len(want) // 50
        assert len(found) < 2 * len(want) // 2000


def test_memory_from_documents_to_phrases(monkeypatch):
    """Chunks of the default size, made from documents: what a task holds to ship their fingerprints and to show their phrases."""
    import tracemalloc

    words = [b"%x" % (i * 2654435761 % 60000) for i in range(C.CHUNK_BYTES // 2)]
    docs = [b" ".join(words[i:i + 200]).decode() for i in range(0, len(words), 200)]
    made = chunks_of([pa.record_batch([pa.array(["en"] * len(docs)), pa.array(docs)], names=["lang", "text"])], C.CHUNK_BYTES, monkeypatch)
    table = made[0].select(["lang", "carry", "text"])
    next(C._fingerprints(3, 10, 2, np.uint8, C._opened)(iter(made)))  # what is kept from chunk to chunk
    tracemalloc.start()
    try:
        shipped = next(C._fingerprints(3, 10, 2, np.uint8, C._opened)(iter(made)))
        first = tracemalloc.get_traced_memory()[1]
        bits = [C._frequent(1, np.uint8)([pa.scalar(r)], pa.table({"range": [r], "chunk": [1], "blob": [blob]}))["bits"][0].as_py()
                for r, blob in zip(shipped["range"].to_pylist(), shipped["blob"].to_pylist())]
        rows = {c: table[c].to_pylist() + [None, None] for c in ("lang", "carry", "text")}
        group = pa.table(rows | {"range": [None, 0, 1], "bits": [None, *bits]})
        tracemalloc.reset_peak()
        assert C._phrases(3, 2, C._opened)(None, group).num_rows > 150_000
        second = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert max(first, second) < 48 << 20, (first >> 20, second >> 20)
