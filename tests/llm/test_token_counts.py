import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plover.llm import queries
from plover.llm import token_counts as T

PATH = queries.tokenizer_files(queries.WORD_FILE)[0]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def samples():
    rnd = random.Random(5)
    parts = ["a", "the", "é", "é", " ", "\n\t", "\xa0", "\x85", "\x1c", "²", "日本", "🙂", "'s", "'ll", "'ve", "'", "re", "0",
             "İ", "Σ", "<|endoftext|>", "<|startoftext|>", "<|", "!", "!!", "ing", "THE", "_"]
    syllables = ["th", "e", "in", "g", "er", "an", "ou", "ti", "on", "s", "z", "xq", "st"]
    out = ["", " ", "<|endoftext|>", "a<|endoftext|>b!!<|startoftext|≯", "it's we're I'LL 'rest", "a" * 700, "é" * 600, "日本" * 400]
    out += ["".join(rnd.choice(parts) for _ in range(rnd.randrange(16))) for _ in range(400)]
    return out + ["".join(rnd.choice(syllables) for _ in range(rnd.randrange(14))) for _ in range(400)]


def test_every_prefix_has_the_librarys_count(library):
    c = T.counter(PATH)
    texts = [c.normal(t) for t in samples()]
    rnd = random.Random(1)
    for t, steps in zip(texts, c.steps(texts)):
        assert len(steps) == len(t)
        got = [0, *np.cumsum(steps, dtype=np.int64).tolist()]
        cuts = range(len(t) + 1) if len(t) < 100 else [len(t), *rnd.sample(range(len(t)), 30)]
        assert [got[k] for k in cuts] == library([t[:k] for k in cuts])


def test_long_pieces_in_small_blocks_and_a_full_memory(monkeypatch, library):
    monkeypatch.setattr(T, "BLOCK", 70)
    monkeypatch.setattr(T, "LONG_PIECE", 20)
    monkeypatch.setattr(T, "SEEN_PIECES", 30)
    monkeypatch.setattr(T, "SEEN_PAIRS", 50)
    c = T.PrefixCounter(PATH)
    texts = [c.normal(t) for t in samples()]
    for k in range(0, len(texts), 40):
        part = texts[k:k + 40]
        assert [int(s.sum(dtype=np.int64)) for s in c.steps(part)] == library(part)


def test_questions_are_answered_from_the_table(spark, library):
    c = T.counter(PATH)
    texts = [None, *samples(), "the long story " * 900]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, steps string").repartition(3)
    table = T.prefix_counts(docs, PATH, limits={"fit 4": 4}).withColumn("k", F.col("doc_id") * 37 % 3000).withColumn("limit", F.col("doc_id") % 9)
    rows = {r["doc_id"]: r for r in T.with_budget(T.with_truncation(T.with_count_at(table, "k"), "limit"), 7).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r, t = rows[i], c.normal(t or "")
        counts = [0, *np.cumsum(c.steps([t])[0], dtype=np.int64).tolist()]
        assert r["n_bytes"] == len((texts[i] or "").encode()) and r["n_chars"] == len(t)
        assert r["n_tokens"] == counts[-1] and r["over_limit"] == (counts[-1] > 7)
        assert r["tokens_at"] == counts[min(i * 37 % 3000, len(t))]
        assert r["fit 4"] == max(k for k, n in enumerate(counts) if n <= 4)
        assert r["fit_chars"] == max(k for k, n in enumerate(counts) if n <= i % 9)


def test_query_matches_the_library(spark, library):
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {(i, len(t.encode()), n, n > 2048) for (i, t), n in zip(docs, library([t for _, t in docs]))}
    out = queries.op13_token_counts(spark, SF)
    assert {tuple(r) for r in out.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()} == want


def test_one_very_long_piece(library):
    t = "".join(random.Random(3).choice("aeinrst") for _ in range(200_000))
    assert int(T.counter(PATH).steps([t])[0].sum(dtype=np.int64)) == library([t])[0]


def test_repeated_rows_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, "the the"), (1, "the the")], "doc_id long, text string")
    out = T.prefix_counts(docs, PATH)
    got = [tuple(r) for r in out.select("doc_id", "n_tokens").collect()]
    assert sorted(got, key=repr) == [(1, 2), (1, 2), (None, 0)]
    assert T.with_truncation(T.prefix_counts(docs.limit(0), PATH).withColumn("q", F.lit(3)), "q").count() == 0
    with pytest.raises(ValueError):
        T.with_count_at(out, "n_chars", "steps")


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        T.PrefixCounter(queries.tokenizer_files("byte_bpe_50k.json")[0])
