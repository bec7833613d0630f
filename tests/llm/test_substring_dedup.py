import random

import pytest

from plover.llm import queries
from plover.llm.substring_dedup import duplicate_spans, remove_duplicate_spans
from pyspark.sql import functions as F
from tests.llm import brute


def check(spark, texts, window, gram):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, spans string, t string")
    spans = {r["id"]: r["spans"] for r in duplicate_spans(docs, window, gram=gram).collect()}
    got = {r["doc_id"]: r for r in remove_duplicate_spans(docs, window).collect()} if gram == 6 else None
    want = brute.substring_dedup(texts, window)
    for i, (n, gone, digest) in enumerate(want):
        assert sum(s["e"] - s["s"] for s in spans.get(i, ())) == gone, (i, texts[i])
        if got:
            assert (got[i]["n_words"], got[i]["n_removed"], brute.sha(got[i]["kept_text"])) == (n, gone, digest)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "the", "of", "é", "日本"] + [f"w{k}" for k in range(40)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.choice((0, 3, 12, 60, 200)))) for _ in range(25)]
    for _ in range(25):  # cut, join and edit passages of others
        w = " ".join(rnd.choice(texts) for _ in range(2)).split(" ")
        k = rnd.randrange(len(w))
        w[k] = rnd.choice(vocabulary)
        texts.append("\n\t".join(w[rnd.randrange(len(w)):][:rnd.randrange(1, 150)]))
    check(spark, texts, window=10, gram=3)


def test_edges(spark):
    line = " ".join(f"p{k}" for k in range(50))
    check(spark, [None, "", "  \t\n", "one", line, line, " ".join(["same"] * 200), line + " end", "start " + line,
                  "x " * 34 + "x", "x\x0bx\x0cx " * 14], window=35, gram=6)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert remove_duplicate_spans(docs).count() == 0


def test_null_and_repeated_ids(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    docs = spark.createDataFrame([(None, a), (1, a), (2, b), (2, b), (3, "z " + b[:-4]), (3, "short")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in remove_duplicate_spans(docs).collect())
    assert got == [(0, 40, 40), (1, 40, 40), (2, 40, 40), (2, 40, 40), (3, 1, 0), (3, 40, 39)]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute.substring_dedup([r["text"] for r in docs], 35)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op3_substring_dedup(spark, sf).select(
        "doc_id", "n_words", "n_removed", "kept_sha256").collect()}
    assert got == {r["doc_id"]: w for r, w in zip(docs, want)}


def test_factors_spell_the_text(spark):
    rnd = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)]
    passages = [rnd.choices(vocabulary, k=rnd.randrange(30, 200)) for _ in range(6)]
    texts = []
    for _ in range(40):
        w = []
        for _ in range(rnd.randrange(1, 4)):
            p = rnd.choice(passages)
            w += rnd.choices(vocabulary, k=rnd.randrange(60)) + p[rnd.randrange(10):len(p) - rnd.randrange(10)]
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = duplicate_spans(docs, 12, gram=4).collect()
    words = {r["k"]: brute.WORD.findall(texts[r["id"]]) for r in rows}
    copied = longest = 0
    for r in rows:
        own = words[r["k"]]
        covered = set()
        for f in r["factors"]:
            assert f["e"] - f["s"] >= 12
            covered |= set(range(f["s"], f["e"]))
            if f["ref"] is not None:
                assert (f["ref"], f["ref_s"]) != (r["k"], f["s"])  # copied from another place
                assert words[f["ref"]][f["ref_s"]:f["ref_s"] + f["e"] - f["s"]] == own[f["s"]:f["e"]]
                copied += f["e"] - f["s"]
                longest = max(longest, f["e"] - f["s"])
        assert covered == {i for x in r["spans"] for i in range(x["s"], x["e"])}
    assert longest > 100 and copied > sum(map(len, words.values())) / 2
