"""Profile models on the shipped fixtures (goldens from FIXTURES.md §2)."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from plover.operators import models as M

SIMPLE = [(0, 10, 20, 30, 40, 30), (0, 12, 22, 29, 42, 35), (0, 11, 21, 31, 40, 34), (0, 13, 22, 30, 42, 32),
          (0, 12, 22, 32, 41, 33), (0, 10, 21, 33, 45, 35), (1, 30, 11, 21, 40, 34), (1, 33, 10, 20, 43, 30),
          (1, 30, 12, 23, 40, 33), (1, 32, 10, 20, 42, 33), (1, 30, 13, 20, 42, 30), (1, 30, 9, 22, 41, 32)]
TEST = [(1, 11, 21, 31, 44, 32), (2, 14, 26, 32, 39, 30), (3, 32, 14, 21, 42, 32), (4, 34, 12, 22, 42, 34),
        (5, 34, 12, 22, 42, 34)]


def _vec(spark, data, key):
    df = spark.createDataFrame([tuple(float(x) for x in r) for r in data],
                               f"{key} double, f1 double, f2 double, f3 double, f4 double, f5 double")
    return df.select(F.col(key).cast("long").alias("id") if key == "id" else F.col(key),
                     F.array("f1", "f2", "f3", "f4", "f5").alias("features"))


@pytest.mark.parametrize("block_bytes", [1 << 24, 200, 80])
def test_knn_golden(spark, block_bytes):
    lab = _vec(spark, SIMPLE, "label").withColumn("id", F.monotonically_increasing_id())
    q = _vec(spark, TEST, "id")
    out = rows(M.knn_classify(q, lab, k=1, block_bytes=block_bytes), "id", "label", "score")
    assert [(i, lbl) for i, lbl, _ in out] == [(1, 0.0), (2, 0.0), (3, 1.0), (4, 1.0), (5, 1.0)]
    assert [s for _, _, s in out] == [10.0, 33.0, 10.0, 13.0, 13.0]
    sim = rows(M.knn_classify(q, lab, k=1, metric="similarity", block_bytes=block_bytes), "id", "score")
    assert [round(s, 6) for _, s in sim] == [0.240253, 0.148268, 0.240253, 0.217129, 0.217129]
    vote = rows(M.knn_classify(q, lab, k=3, block_bytes=block_bytes), "id", "label")
    assert vote == [(1, 0.0), (2, 0.0), (3, 1.0), (4, 1.0), (5, 1.0)]


def test_min_max_scale_constant_and_range(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 5.0, 5.0), (3, 10.0, 5.0)], "k int, a double, b double")
    got = rows(M.min_max_scale(df, ["a", "b"]), "k", "a", "b")
    assert got == [(1, 0.0, 0.5), (2, 0.5, 0.5), (3, 1.0, 0.5)]


TEXTS = [("好评", 0.0), ("不错 很好", 0.0), ("红包", 0.0), ("还行", 1.0), ("好评", 1.0)]


def test_term_stats_idf(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "doc_id long, text string")
    st = {(d, t): (tf, df, idf) for d, t, tf, df, idf in rows(M.term_stats(docs), "doc_id", "term", "tf", "df", "idf")}
    m = len(TEXTS)
    assert st[(0, "好评")][1] == 2 and math.isclose(st[(0, "好评")][2], math.log((m + 1) / 3))
    assert math.isclose(st[(2, "红包")][2], math.log((m + 1) / 2))
    # same formula as MLlib's IDF on the hashed vectors
    vec, _ = M.tfidf(docs.withColumn("label", F.lit(0.0)))
    v = vec.filter("doc_id = 2").first()["tf_idf_vec"]
    assert list(v.values) == pytest.approx([math.log((m + 1) / 2)])


def test_tokenize_whole_text(spark):
    long_text = " ".join(["alpha"] * 30000 + ["omega"])
    df = spark.createDataFrame([(long_text,)], "text string")
    toks = df.select(M.tokenize("text", stop_words=["alpha"]).alias("t")).first()["t"]
    assert toks == ["omega"]


SAMPLE = [("张飞", "老师", 20002, "青年", "男", "出轨"), ("赵云", "老师", 20000, "中年", "女", "出轨"),
          ("花满楼", "老师", 40000, "老年", "女", "出轨"), ("刘亦菲", "程序员", 42000, "青年", "女", "出轨"),
          ("任我行", "程序员", 21000, "老年", "男", "出轨"), ("段正淳", "公务员", 50000, "中年", "男", "出轨"),
          ("虚竹", "公务员", 5000, "青年", "男", "出轨"), ("陆小凤", "老师", 5000, "青年", "男", "没出"),
          ("田汉", "老师", 5002, "青年", "女", "没出"), ("唐嫣", "程序员", 40070, "青年", "男", "没出"),
          ("汪小敏", "程序员", 22000, "中年", "男", "没出"), ("刘晓庆", "程序员", 20200, "中年", "男", "没出"),
          ("郭靖", "公务员", 20010, "老年", "女", "没出"), ("黄蓉", "公务员", 4800, "老年", "女", "没出"),
          ("段誉", "公务员", 4801, "中年", "女", "没出")]
# The profile encodings (one shared job coding, SURVEY Q41).
JOB = {"程序员": 0, "老师": 1, "公务员": 2}
AGE = {"青年": 0, "中年": 1, "老年": 2}


def _encode(df):
    cols = [F.col("name"), M.code("job", JOB).alias("job"), M.bucket("income", 10000.0, 5).alias("income"),
            M.code("age", AGE).alias("age"), F.when(F.col("sex") == "男", 1.0).otherwise(0.0).alias("sex")]
    if "label" in df.columns:
        cols.append(F.when(F.col("label") == "出轨", 0.0).otherwise(1.0).alias("label"))
    return df.select(*cols)


def test_profile_nb_save_load(spark, tmp_path):
    train = _encode(spark.createDataFrame(SAMPLE, "name string, job string, income long, age string, sex string, label string"))
    assert rows(train.filter("name = '张飞'"), "job", "income", "age", "sex", "label") == [(1.0, 2.0, 0.0, 1.0, 0.0)]
    test = _encode(spark.createDataFrame([("小明", "老师", 20002.0, "青年", "男"), ("小红", "程序员", 48000.0, "中年", "男"),
                                          ("小华", "公务员", 8000.0, "青年", "女")],
                                         "name string, job string, income double, age string, sex string"))
    feats = ["job", "income", "age", "sex"]
    model = M.fit_profile_nb(train, feats, path=str(tmp_path / "nb"))
    a = rows(M.predict_profile(model, test, feats, keep=["name"]))
    b = rows(M.predict_profile(M.load_profile_nb(str(tmp_path / "nb")), test, feats, keep=["name"]))
    assert a == b and len(a) == 3 and all(c in (0.0, 1.0) for _, c in a)


def test_naive_bayes_terms_matches_mllib(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer

    texts = [(0, "good great fine", 0.0), (1, "great value good", 0.0), (2, "bad poor awful", 1.0),
             (3, "poor fine bad", 1.0), (4, "good bad", 0.0), (5, "awful value", 1.0), (6, "fine fine good", 0.0),
             (7, "great poor", 1.0)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, label double")
    words = docs.withColumn("words", F.split("text", " "))
    vec = CountVectorizer(inputCol="words", outputCol="tf_vec").fit(words).transform(words)
    train = vec.filter("doc_id < 6")
    model = NaiveBayes(featuresCol="tf_vec", labelCol="label", smoothing=1.0, modelType="multinomial").fit(train)
    want = dict(rows(model.transform(vec), "doc_id", "prediction"))
    weights = (words.select("doc_id", F.explode("words").alias("term"))
               .groupBy("doc_id", "term").agg(F.count(F.lit(1)).cast("double").alias("w")))
    got = dict(rows(M.naive_bayes_terms(weights, train.select("doc_id", "label"), smoothing=1.0)))
    assert got == want


def test_knn_keeps_every_query_and_any_type(spark):
    nan = float("nan")
    q = spark.createDataFrame([("q1", [0.0, 0.0]), ("q2", [nan, 1.0]), ("q3", None), ("q4", [5.0, 5.0])],
                              "id string, features array<double>")
    lab = spark.createDataFrame([("n1", "red", [0.0, 1.0]), ("n2", "blue", [1.0, 0.0]), ("n3", "blue", [9.0, 9.0]),
                                 ("n4", "red", [nan, 0.0])], "id string, label string, features array<double>")
    one = {r["id"]: (r["label"], r["neighbour"]) for r in M.knn_classify(q, lab).collect()}
    assert one == {"q1": ("red", "n1"), "q2": (None, None), "q3": (None, None), "q4": ("blue", "n3")}
    vote = {r["id"]: r["label"] for r in M.knn_classify(q, lab, k=3).collect()}
    assert vote == {"q1": "blue", "q2": None, "q3": None, "q4": "blue"}
    alone = M.knn_classify(lab.limit(1), lab.limit(1), exclude_self=True).collect()
    assert len(alone) == 1 and alone[0]["label"] is None


def test_unknown_category_has_a_code(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string").select(M.code("c", {"a": 0, "b": 1}).alias("n"))
    assert [r["n"] for r in df.collect()] == [0.0, 2.0, 2.0]


def test_text_model_learns_saves_and_takes_any_text(spark, tmp_path):
    good, poor = "good great fine nice", "bad poor awful cheap"
    docs = spark.createDataFrame([(i, " ".join((good if i % 2 else poor).split()[i % 3:] + ["common", f"w{i}"])) for i in range(20)]
                                 + [(20, None), (21, ""), (22, "great great"), (23, "awful " * 50_000)], "doc_id long, text string")
    train = spark.createDataFrame([(i, float(i % 2)) for i in range(20)] + [(99, 1.0)], "doc_id long, label double")
    model = M.fit_text_model(docs, train, str(tmp_path / "m"), num_features=1000)
    again = type(model).load(str(tmp_path / "m"))
    got = dict(rows(M.classify_texts(again, docs)))
    assert got == dict(rows(M.classify_texts(model, docs))) and len(got) == 24
    assert all(got[i] == i % 2 for i in range(20)) and got[22] == 1 and got[23] == 0
    # one IDF number per bucket: ln((documents + 1) / (documents with it + 1))
    index = M.hashed_tf(docs.filter("doc_id = 22"), num_features=1000).first()["tf_vec"].indices[0]
    n = sum(index in r["tf_vec"].indices for r in M.hashed_tf(docs, num_features=1000).collect())
    assert abs(model.stages[1].idf[int(index)] - math.log(25 / (n + 1))) < 1e-12


# The churn fixture, label, gid and 12 features; the last four rows have no label.
CHURN = """0 1 6 30 3 10 0 1 10 15 1 2 1 1
0 2 7 31 4 10 1 2 11 16 2 3 1 1
0 3 8 29 6 11 2 2 12 17 1 1 1 2
0 4 7 27 6 13 1 2 13 18 2 3 2 3
0 5 8 26 7 10 2 3 14 19 3 4 3 4
0 6 6 30 3 9 0 1 10 15 1 2 1 1
0 7 7 32 2 10 1 2 11 16 2 3 1 1
0 8 7 26 1 8 2 2 12 17 1 1 1 2
0 9 9 24 8 12 1 2 13 18 2 3 2 3
0 10 9 25 9 10 2 3 14 19 3 4 3 4
1 11 0 1 0 1 0 1 0 0 0 1 14 14
1 12 0 2 0 2 0 2 0 0 0 2 13 14
1 13 0 1 0 0 0 0 0 0 0 0 14 14
1 14 0 3 0 2 0 0 0 0 0 2 14 14
1 15 0 1 0 2 0 0 0 0 0 0 14 14
1 16 0 1 0 1 0 1 0 0 0 1 14 14
1 17 0 2 0 2 0 2 0 0 0 2 13 14
1 18 0 1 0 1 0 0 0 0 0 0 13 14
1 19 0 3 0 2 0 0 0 0 0 2 12 13
1 20 0 1 0 0 0 0 0 0 0 0 10 11
- 21 0 1 0 0 0 0 0 0 0 0 14 14
- 22 8 29 3 10 2 2 12 17 1 1 1 2
- 23 0 2 0 1 1 2 3 1 2 0 8 6
- 24 4 10 15 2 2 2 1 2 1 1 1 2"""
CHURN_COLUMNS = [f"f{i}" for i in range(12)]


def test_churn_golden(spark):
    data = [[None if x == "-" else float(x) for x in line.split()] for line in CHURN.split("\n")]
    df = spark.createDataFrame(data, "label double, gid double, " + ", ".join(f"{c} double" for c in CHURN_COLUMNS))
    train = df.filter("label is not null")
    scaled = M.min_max_scale(train, CHURN_COLUMNS).orderBy("gid").first()
    assert [round(scaled[c], 4) for c in CHURN_COLUMNS[:4]] == [0.6667, 0.9355, 0.3333, 0.7692]
    model = M.fit_churn(train, CHURN_COLUMNS)
    got = dict(rows(M.predict(model, df, keep=["gid"])))
    assert [got[float(i)] for i in range(1, 21)] == [0.0] * 10 + [1.0] * 10
    assert got[21.0] == 1.0 and got[22.0] == 0.0
    vector = model.transform(train).orderBy("gid").first()["features"]
    assert [round(x, 4) for x in vector[:4]] == [0.6667, 0.9355, 0.3333, 0.7692]


@pytest.mark.parametrize("tile_rows, n_pivots", [(4096, 64), (20, 9)])
def test_pruned_neighbours_equal_brute_force(spark, tile_rows, n_pivots):
    import random
    rnd = random.Random(tile_rows)
    centres = [[rnd.uniform(-100, 100) for _ in range(6)] for _ in range(8)]
    data = [(i, "ab"[i % 2], [float(round(x + rnd.gauss(0, 2))) for x in rnd.choice(centres)]) for i in range(160)]
    data += [(400 + i, "t", data[i][2]) for i in range(20)]  # ties
    odd = [(900, "n", None), (901, "n", []), (902, "n", [float("nan")] * 6), (903, "n", [1.0] * 5), (904, "n", [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    lab = spark.createDataFrame(data + odd, "id long, label string, features array<double>").repartition(3)
    for self_out in (False, True):
        counted = {}
        out = M.knn_pruned(lab, lab, k=3, tile_rows=tile_rows, block_rows=50, n_pivots=n_pivots, exclude_self=self_out, counted=counted)
        got = {}
        for r in out.collect():
            got.setdefault(r["id"], []).append((r["rank"], r["neighbour"], r["label"], r["score"]))
        assert set(got) == {i for i, _, _ in data}
        for i, _, f in data:
            want = sorted((sum((a - b) ** 2 for a, b in zip(f, g)), j, y) for j, y, g in data if not (self_out and i == j))[:3]
            assert sorted(got[i]) == [(n, j, y, d) for n, (d, j, y) in enumerate(want, 1)]
        assert counted["pairs"] <= counted["possible"]
        if n_pivots == 64:  # clusters apart from each other: most cells are never paired
            assert counted["pairs"] < counted["possible"] / 4
    assert M.knn_pruned(lab.limit(0), lab).count() == 0 and M.knn_pruned(lab, lab.limit(0)).count() == 0


def _brute(a, b, k, same):
    import numpy as np
    out = []
    for i, x in enumerate(a):
        d = [(float(((x.astype(float) - y) ** 2).sum()), j) for j, y in enumerate(b.astype(float)) if (i, j) not in same]
        out += [(i, j, v) for v, j in sorted(p for p in d if np.isfinite(p[0]))[:k]]
    return out


@pytest.mark.parametrize("far", [0, 1e4, 1e17])
@pytest.mark.parametrize("kind", ["float32", "float64"])
@pytest.mark.parametrize("n, k", [(2, 3), (700, 3), (700, 1), (3000, 5)])
def test_nearest_equals_brute_force(far, kind, n, k):
    """Also far from the origin, with copies, with odd rows and over several steps."""
    import numpy as np
    rng = np.random.default_rng(n + k)
    b = (rng.integers(-9, 9, (n, 7)) + far).astype(kind)
    a = np.concatenate([b[:40], (rng.integers(-9, 9, (10, 7)) + far).astype(kind)])
    a[3], b[1, 2] = np.nan, np.inf
    same = (np.arange(min(n, 40)), np.arange(min(n, 40)))
    with np.errstate(invalid="ignore"):
        want = _brute(a, b, k, set(zip(*map(list, same))))
    got = M._nearest(a, b, k, np.arange(n), same, step_cells=20_000)
    assert [tuple(x) for x in zip(*(c.tolist() for c in got))] == want


def test_nearest_does_not_sort_whole_rows():
    """Ranking every distance of 3,000 queries and 30,000 rows took 20 s and more; the bound leaves a few to rank."""
    import time

    import numpy as np
    rng = np.random.default_rng(0)
    b = rng.normal(size=(30_000, 32)).astype("float32")
    began = time.process_time()
    r, _, _ = M._nearest(b[:3000], b, 3, np.arange(len(b)), (np.arange(3000), np.arange(3000)))
    assert len(r) == 9000 and time.process_time() - began < 15


def _wordy(spark):
    words = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(["the", "of"] + [words[(i * j) % 40] for j in range(1, 9)] + [f"only{i}"])) for i in range(60)]
    texts += [(7, "the again w3 w3"), (None, "the lost w3"), (99, None), (100, "x" * 400 + " the " + "x" * 400)]
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(3)


def _counts(docs):
    import re
    from collections import Counter
    tf = Counter((r["doc_id"], t) for r in docs.collect() for t in re.split(r"[^a-z0-9]+", r["text"] or "") if len(t) > 1)
    return tf, Counter(t for _, t in tf)


@pytest.mark.parametrize("most", [0, 2, 30, 200_000])
def test_term_stats_by_broadcast_and_by_shuffle(spark, monkeypatch, most):
    """Frequent and rare terms come by different ways, each row once."""
    monkeypatch.setattr(M, "MOST_FREQUENT", most)
    docs = _wordy(spark)
    tf, df = _counts(docs)
    want = sorted((str(d), t, n, df[t]) for (d, t), n in tf.items())
    out = M.term_stats(docs)
    assert sorted((str(r["doc_id"]), r["term"], r["tf"], r["df"]) for r in out.collect()) == want
    if most == 200_000:  # nearly all rows are neither shuffled nor sorted
        from plover.session import scratch_path, stored
        assert stored(out, scratch_path(spark, "t")).count() == len(want)
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_term_counts_of_a_task_are_bounded(spark, monkeypatch):
    """More text means more tasks, not larger ones: one file of counts each."""
    monkeypatch.setattr(M, "TASK_TEXT_BYTES", 50)
    written = []
    monkeypatch.setattr(M, "stored", lambda df, path, f=M.stored: (written.append(df), f(df, path))[1])
    docs = _wordy(spark)
    n_bytes = sum(len(r["text"] or "") for r in docs.collect())
    M.term_stats(docs)
    assert "hashpartitioning(doc_id#" in (plan := written[0]._jdf.queryExecution().executedPlan().toString())
    assert f", {math.ceil(n_bytes / 50)})" in plan


@pytest.mark.parametrize("most", [0, 10, 200_000])
def test_naive_bayes_by_broadcast_and_by_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(M, "MOST_FREQUENT", most)
    docs = _wordy(spark).filter("doc_id is not null")
    weights = M.term_stats(docs).select("doc_id", "term", F.col("tf_idf").alias("w"))
    train = [(i, float(i % 3)) for i in range(0, 60, 2)] + [(4, 1.0), (4, 2.0), (500, 0.0)]
    got = dict(rows(M.naive_bayes_terms(weights, spark.createDataFrame(train, "doc_id long, label double"))))
    ws = {}
    for r in weights.collect():
        ws.setdefault(r["doc_id"], {})[r["term"]] = r["w"]
    vocab = {t for x in ws.values() for t in x}
    score = {}
    for c in (0.0, 1.0, 2.0):
        mine = [d for d, y in train if y == c]
        s = {t: sum(ws.get(d, {}).get(t, 0.0) for d in mine) for t in vocab}
        den = math.log(sum(s.values()) + len(vocab))
        pi = math.log(len(mine) + 1) - math.log(len(train) + 3)
        for d, x in ws.items():
            score[d, c] = pi + sum(w * (math.log(s[t] + 1) - den) for t, w in x.items())
    assert set(got) == set(ws)
    for d, c in got.items():
        assert score[d, c] >= max(score[d, y] for y in (0.0, 1.0, 2.0)) - 1e-9


def test_naive_bayes_sorts_no_weights(spark):
    """The weights meet labels and frequent terms by hashes: sorting them took the task memory."""
    weights = spark.range(4000).select((F.col("id") % 400).alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 37).alias("term"), F.lit(1.0).alias("w"))
    out = M.naive_bayes_terms(weights, spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("double").alias("label")))
    assert out.count() == 400
    assert "SortMergeJoin [_d" not in out._jdf.queryExecution().executedPlan().toString()


def test_text_nb_does_not_shuffle_weights_to_labels(spark, monkeypatch, tmp_path):
    """A task held its whole share of the weights while it dealt them out by document; now the labels come to the counts."""
    from plover.plans import queries as Q
    docs = _wordy(spark)
    lab = [(i, i % 2) for i in range(0, 60, 2)] + [(4, 1), (4, 1), (None, 0), (500, 0)]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(lab, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    written = {}
    monkeypatch.setattr(M, "stored", lambda df, path, f=M.stored: (written.update({path.rsplit("plover-", 1)[1][:-13]: df}), f(df, path))[1])
    Q.q_text_nb(spark, str(tmp_path))
    plan = written["nb-weights"]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_d#" not in plan and "hashpartitioning(doc_id#" not in plan
    plan = written["term-counts"]._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [doc_id" in plan and "SortMergeJoin" not in plan


def test_classes_come_with_the_weights(spark):
    """The same predictions, whether labels come along with the counts or are joined to the weights."""
    docs = _wordy(spark)
    train = spark.createDataFrame([(i, float(i % 3)) for i in range(0, 60, 2)] + [(4, 1.0), (4, 1.0), (4, 2.0), (None, 1.0), (500, 0.0)], "doc_id long, label double")
    weights = M.term_stats(docs, more=M.classes_by_id(train)).withColumn("w", F.col("tf_idf"))
    plain = M.term_stats(docs)
    assert sorted(map(str, weights.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    got = {r["doc_id"]: sorted((x["c"], x["n"]) for x in r["classes"] or []) for r in weights.collect()}
    assert got[4] == [(1.0, 3), (2.0, 1)]
    assert got[7] == [] and got[None] == [] and 500 not in got
    some = weights.filter("doc_id is not null")
    assert rows(M.naive_bayes_terms(some, train)) == rows(M.naive_bayes_terms(some.drop("classes"), train))
