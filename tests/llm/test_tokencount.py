"""The compiled transducer against the tokenizer library."""

import random
import unicodedata

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
BITS = ["'s", "'", "don't", "I'LL", "''ve", "é", "é", "Σ", "ΑΣ", "12", "½", " ", "​", "\x1c", "\x85", "İ", "ß",
        "<|endoftext|>", "<|startoftext|>x", "<|x|>", "--'s", "中文", "😀", "\n", "  ", "hello", "THE", "aaaaaaa", "ing", "ͅ",
        "ǆ", "١", "²", "　", "'re", "'Re", "ll'll", "_", "@@", "!!!", "."]


def library_counts(texts):
    from tokenizers import Tokenizer
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_fuzz_equals_library():
    from pricepanel.llm.tokencount import Transducer
    rnd, machine = random.Random(1), Transducer(PATH)
    texts = ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(chr(rnd.choice([rnd.randint(32, 126), rnd.randint(0xA0, 0x17F), rnd.randint(0x370, 0x5FF),
                                      rnd.randint(0x4E00, 0x4EFF)])) for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    texts += ["x" * 3000, "ab" * 2000 + " c", ""]  # words longer than several chunks
    assert machine.count(texts).tolist() == library_counts(texts)
    assert machine.count(texts[::-1]).tolist() == library_counts(texts[::-1])


def test_every_code_point_equals_library():
    from pricepanel.llm.tokencount import Transducer
    texts = [f"a{chr(c)}b {chr(c)}1" for c in [*range(0x3000), *range(0xA000, 0xD000, 7), *range(0xF900, 0x11000), *range(0x1F600, 0x1F650)]
             if unicodedata.category(chr(c)) not in ("Cs", "Cn")]  # the library's Unicode may be newer
    got, want = Transducer(PATH).count(texts).tolist(), library_counts(texts)
    assert sum(a != b for a, b in zip(got, want)) == 0, [hex(ord(t[1])) for t, a, b in zip(texts, got, want) if a != b][:20]


def test_table_starts_anew_when_full(monkeypatch):
    import pricepanel.llm.tokencount as T
    monkeypatch.setattr(T, "MAX_STATES", 200)
    machine = T.Transducer(PATH)
    texts = [f"word{i} another{i * 7} thing{i}" for i in range(200)]
    for i in range(0, 200, 20):
        assert machine.count(texts[i:i + 20]).tolist() == library_counts(texts[i:i + 20])


def test_operator_edge_cases(spark, odd_docs):
    from pricepanel.llm.tokencount import count_tokens
    rows = [(1, None, None), (2, "", "a"), (3, "Hello, World!", "a"), (3, "Hello, World!", "a"), (None, "né", "b"), (5, "w " * 50_000, "c")]
    docs = odd_docs(rows).withColumnRenamed("copies", "n_tokens")
    got = count_tokens(docs, PATH)
    want = sorted(zip([str(r[0]) for r in rows], [len((r[1] or "").encode()) for r in rows], library_counts([r[1] or "" for r in rows])))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want
    assert {"score", "key", "row"} <= set(got.columns) and count_tokens(docs.filter("false"), PATH).count() == 0


def test_query_equals_library(spark, sf_small):
    from pricepanel.llm.queries import op6_token_counts
    got = {r["doc_id"]: (r["n_tokens"], r["over_limit"]) for r in op6_token_counts(spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    want = library_counts([d["text"] for d in docs])
    assert got == {d["doc_id"]: (n, n > 2048) for d, n in zip(docs, want)}


def test_junk_and_unbroken_runs_stay_within_the_table(monkeypatch):
    import pricepanel.llm.tokencount as T
    monkeypatch.setattr(T, "MAX_STATES", 3000)
    rnd, machine, most = random.Random(2), T.Transducer(PATH), [0]
    real = T.Transducer.add

    def add(self, starts, tail):
        got = real(self, starts, tail)
        most[0] = max(most[0], len(self.states))
        return got
    monkeypatch.setattr(T.Transducer, "add", add)
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    texts = [" ".join(letters(60) for _ in range(300)), letters(20_000), "x" * 5000, "ab" * 3000 + " c", "é" * 2000 + letters(3000),
             "".join(rnd.choice("中文字語言大小") for _ in range(3000))]
    assert machine.count(texts).tolist() == library_counts(texts)
    assert 2900 < most[0] <= 3000
