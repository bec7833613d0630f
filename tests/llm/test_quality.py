from plover.llm import quality, queries
from pyspark.sql import functions as F


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score_documents(docs, labels).filter("part = 'test'").select("label", "accepted").collect()
    good = [r["accepted"] for r in rows if r["label"] == 1]
    bad = [r["accepted"] for r in rows if r["label"] == 0]
    assert len(bad) > 80 and sum(bad) / len(bad) < 0.03
    assert sum(good) / len(good) > 0.995


def test_metadata_teaches_the_text_view(spark):
    """Sources tell good from bad; texts do too, but the labelled ones show only one kind of junk."""
    rows, labels = [], []
    for i in range(1200):
        bad = i % 3 == 0
        text = ("| " * 20 if i % 2 else "SHOUT!! " * 20) if bad else f"some plain text number of words here {i % 7} and more"
        if i % 6 != 3 or not bad:
            if i % 2 == 0 and bad or not bad and i % 4:
                labels.append((i, 0 if bad else 1))
        rows.append((i, text, "en", "junk" if bad else "fine", len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score_documents(docs, lab).collect()}
    assert all(got[i]["accepted"] == (i % 3 != 0) for i in range(1200))
    pipes = [got[i]["p_text"] for i in range(1200) if i % 6 == 3]  # junk that no label shows
    assert max(pipes) < 0.5


def test_many_sources_keep_apart(spark):
    """Nothing but the source tells junk; 200 sources would share 64 bins."""
    n = 200 * 24
    docs = spark.createDataFrame([(i, "some plain words", "en", f"s{i % 200}", 16) for i in range(n)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(n) if i // 200 < 20], "doc_id long, quality int")
    got = quality.score_documents(docs, labels).select("doc_id", "accepted").collect()
    assert len(got) == n and all(r["accepted"] == (r["doc_id"] % 5 > 0) for r in got)
    kept = quality.accepted_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == n * 4 // 5


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, None), (1, None, None), (None, "", "s"), (2, "x" * 100_000, "s"), (3, "| " * 50, "t")],
                                 "doc_id long, text string, source string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score_documents(docs, none).collect()
    assert len(got) == 5 and all(r["accepted"] and abs(r["score"] - 0.5) < 1e-9 for r in got)
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 0)], "doc_id long, quality int")
    assert quality.score_documents(docs, odd).count() == 5
    assert quality.score_documents(docs.limit(0), odd).count() == 0
    assert quality.accepted_documents(docs.withColumn("score", F.lit(1)), none).columns == ["doc_id", "text", "source", "score"]
    assert quality.accepted_documents(docs, none).count() == 5


def test_query(spark):
    got = queries.op10_quality(spark, "/root/testdata/sf0.001")
    assert got.count() == 200 and got.filter("score is null").count() == 0
