"""Every registered query on tables of odd rows: nulls in every column, empty and
very long texts, ties and repeated rows, further columns with the operators' own
names, and no rows at all."""

import random

import pytest

from plover.llm import queries

OWN = ("row t s a w x id size item at range pos fp component marks steps ids starts ends pii cards matches label score before "
       "after path value n key slot pattern category head depth turn_id c seg cls v g blk tile").split()


def long_texts():
    rnd = random.Random(0)
    words = [f"w{rnd.randrange(3000)}" for _ in range(120_000)]
    return [" ".join(words), "x" * 400_000, "a1" * 200_000, "日本語のテキスト。" * 30_000, "é́" * 60_000, "!?" * 150_000,
            "token = \"" + "ab12" * 10 + "\"\n" * 5_000, "a@" + "b." * 20_000 + "c", "12 " * 100_000, "\x00\x1c\x85\xa0 " * 20_000,
            "<|endoftext|>" * 20_000, "The End. " * 40_000, "\\### Assistant: </turn> ok" * 5_000]


def write(spark, path, rows):
    more = ", ".join(f"`{c}` string" for c in OWN)
    fill = list(OWN)
    texts = [None, "", " ", "same words here", "same words here", *long_texts()] if rows else []
    n = len(texts)
    docs = [(i if i != 1 else None, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}", None if i == 2 else i, *fill)
            for i, t in enumerate(texts)] + ([(4, "same words here", "en", "s0", 4, *fill)] if rows else [])
    spark.createDataFrame(docs, f"doc_id long, text string, lang string, source string, n_chars long, {more}").write.parquet(f"{path}/documents.parquet")
    labels = [(i, i % 2, None, *fill) for i in range(n)] + [(None, 1, 0, *fill), (3, None, 1, *fill)] if rows else []
    other = ", ".join(f"`{c}_` string" for c in OWN)
    spark.createDataFrame(labels, f"doc_id long, quality int, toxic int, {other}").write.parquet(f"{path}/labels.parquet")
    bench = [(1, "a short benchmark question of some nine words here", *fill), (None, "x", *fill), (2, None, *fill), (3, "y " * 50_000, *fill)] if rows else []
    spark.createDataFrame(bench, f"item_id long, text string, {other}").write.parquet(f"{path}/benchmark.parquet")
    pages = [(1, "http://a-b.com/x", "h", *fill), (1, "http://a-b.com/x", "h", *fill), (None, None, None, *fill), (2, "http://" + "d." * 5_000 + "com/" + "p/" * 5_000, "", *fill),
             (3, "", "", *fill)] if rows else []
    spark.createDataFrame(pages, f"page_id long, url string, html string, {more}").write.parquet(f"{path}/pages.parquet")
    talk = [(c, t, r, x, *fill) for c, t, r, x in [(0, 0, "user", "q"), (0, 0, "user", "q"), (0, None, None, None), (1, 1, "a:b", "x" * 300_000),
            (None, 1, "user", "q"), (200, 0, "user", "日本" * 100_000)]] if rows else []
    spark.createDataFrame(talk, f"conv_id long, turn long, role string, text string, {more}").write.parquet(f"{path}/conversations.parquet")
    vec = [(i, [float(i), 1.0, None if i == 4 else 2.0], None if i == 3 else i % 2, *fill) for i in range(120)] + [
        (0, [0.0, 1.0, 2.0], 0, *fill), (None, [1.0], 1, *fill), (500, None, 1, *fill), (600, [], 1, *fill), (700, [float("nan")] * 3, 0, *fill)] if rows else []
    drop = [c for c in OWN if c not in ("label",)]
    spark.createDataFrame([r[:3] + tuple(drop) for r in vec], "vec_id long, embedding array<float>, label int, " + ", ".join(
        f"`{c}` string" for c in drop)).write.parquet(f"{path}/embeddings.parquet")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = {}
    for name, rows in (("odd", True), ("none", False)):
        out[name] = str(tmp_path_factory.mktemp(name))
        write(spark, out[name], rows)
    return out


#: Rows of each result on the odd tables, where they follow from the tables.
N_DOCS = 5 + len(long_texts()) + 1
ROWS = {"op1_url_filter": 4, "op2_chat_format": 5, "op3_substring_dedup": N_DOCS, "op4_simhash_dedup": N_DOCS, "op5_sketch": N_DOCS,
        "op6_byte_bpe": N_DOCS, "op7_pii": N_DOCS, "op10_quality": N_DOCS, "op13_token_counts": N_DOCS}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_odd_rows(spark, tables, name):
    got = queries.QUERIES[name](spark, tables["odd"])
    n = len(got.collect())
    assert n == ROWS.get(name, n)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_rows(spark, tables, name):
    n = queries.QUERIES[name](spark, tables["none"]).count()
    assert n == (1 if name == "op2_chat_format" else 0)  # the probe conversation
