import random

import pytest
import tiktoken

from plover.llm import byte_bpe as B
from plover.llm import queries
from tests.llm import brute

PATH, PATTERN = queries.tokenizer_files()


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(B.read_ranks(PATH)) if t}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def samples():
    rnd = random.Random(4)
    pool = "aaab  \n\t.é\xa0\x85\x1c²½Ā日🙂́'sre019AB\x00_<|>"
    out = ["", " ", "a" * 3000, " " * 500, "é" * 999, "<|endoftext|>", "it's I'LL we've", "日本語 テキスト 🙂🙂", "x́y"]
    out += ["".join(rnd.choices(pool, k=rnd.randrange(30))) for _ in range(3000)]
    out += ["".join(chr(rnd.choice((rnd.randrange(0x250), rnd.randrange(0x3000), rnd.randrange(0x1F300, 0x1F700))))
                    for _ in range(rnd.randrange(20))) for _ in range(1500)]
    return out


def test_ids_offsets_and_round_trip(spark, reference):
    texts = [None, *samples()]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(3)
    encoded = B.encode(docs, PATH, PATTERN)
    table = B.read_ranks(PATH)
    rows = {r["doc_id"]: r for r in B.decode(encoded, PATH).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        t, r = t or "", rows[i]
        assert r["ids"] == reference.encode_ordinary(t)
        assert bytes(r["decoded"]) == t.encode()
        at, where = 0, [k for k, c in enumerate(t) for _ in c.encode()]
        for token, s, e in zip(r["ids"], r["starts"], r["ends"]):
            size = len(table[token])
            assert (s, e) == (where[at], where[at + size - 1] + 1)
            at += size


def test_a_full_memory_starts_anew(monkeypatch, reference):
    monkeypatch.setattr(B, "SEEN_PIECES", 50)
    key, latin = (PATH, PATTERN), B.latin_pattern(PATTERN)
    texts = samples()[:400]
    for i in range(0, 400, 40):
        got = B._ids(key, texts[i:i + 40], latin)
        assert [x.tolist() for x in got] == [reference.encode_ordinary(t) for t in texts[i:i + 40]]


def test_other_patterns_have_no_fast_form():
    assert B.latin_pattern(r"\p{Lu}+|.") is None


def test_query_matches_the_library(spark, reference):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op6_byte_bpe(spark, sf).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    for r in docs:
        ids = reference.encode_ordinary(r["text"])
        assert got[r["doc_id"]] == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(r["text"]))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert B.decode(B.encode(docs, PATH, PATTERN), PATH).count() == 0


def test_long_foreign_texts_in_parts(monkeypatch, reference):
    monkeypatch.setattr(B, "FOREIGN_CHUNK", 7)
    key, latin = (PATH, PATTERN), B.latin_pattern(PATTERN)
    texts = [t + "\u65e5" for t in samples()] + ["\u65e5\u672c\u8a9e\u3002 it's\u3001we've  \xa0b. 12,3 a_b" * 20, "\u65e5" * 5000]
    assert any(len(B._parts(t)) > 3 for t in texts) and all("".join(B._parts(t)) == t for t in texts)
    for i in range(0, len(texts), 100):
        got = B._ids(key, texts[i:i + 100], latin)
        assert [x.tolist() for x in got] == [reference.encode_ordinary(t) for t in texts[i:i + 100]]
