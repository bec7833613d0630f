import random

from pyspark.sql import functions as F

from plover.llm import queries, sketch
from tests.llm import brute


def shingles(text):
    w = brute.WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def estimates(spark, pairs, size=sketch.SIZE):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    df = sketch.with_sketches(df, {"a": "x", "b": "y"}, size)
    return df.select("i", sketch.resemblance("x", "y", size).alias("j"), sketch.containment("x", "y", size).alias("c"),
                     sketch.distinct_shingles("x", size).alias("n"), "x", "y",
                     sketch.merged("x", "y", size).alias("u")).orderBy("i").collect()


def test_estimates_are_close_to_the_exact_values(spark):
    rnd = random.Random(1)
    pairs = []
    for _ in range(40):
        a = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice((300, 3000)))]
        cut = rnd.randrange(len(a))
        pairs.append((" ".join(a), " ".join(a[:cut] + [f"v{rnd.randrange(5000)}" for _ in range(rnd.randrange(500))])))
    worst = {"j": [], "c": [], "n": []}
    for (a, b), r in zip(pairs, estimates(spark, pairs)):
        x, y = shingles(a), shingles(b)
        worst["j"].append(abs(r["j"] - len(x & y) / len(x | y)))
        worst["c"].append(abs(r["c"] - len(x & y) / len(x)))
        worst["n"].append(abs(r["n"] / len(x) - 1))
    assert sum(worst["j"]) / 40 < 0.04 and max(worst["j"]) < 0.16
    assert sum(worst["c"]) / 40 < 0.06 and sum(worst["n"]) / 40 < 0.12


def test_small_sets_are_exact_and_merge(spark):
    texts = ["a b c d e f", "c d e f g h", "", None, "one", "one", "x y", "a b c d e f"]
    pairs = [(a, b) for a in texts for b in texts]
    for (a, b), r in zip(pairs, estimates(spark, pairs)):
        x, y = shingles(a), shingles(b)
        assert r["n"] == len(x) and len(r["u"]) == len(x | y)
        assert r["j"] == (len(x & y) / len(x | y) if x | y else 1)
        assert abs(r["c"] - (len(x & y) / len(x) if x else 1)) < 1e-9
        assert r["x"] == sorted(r["x"])


def test_merge_of_parts_is_the_sketch_of_the_whole(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(2000)) for c in "ab")
    ab, a_only, b_only = f"{a} {b}", f"{a} b0 b1 b2 b3", b
    r = estimates(spark, [(a_only, b_only), (ab, ab)])
    assert r[0]["u"] == r[1]["x"]


def test_next_text_and_query(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i * 3 - 50, "".join(rnd.choices("ab é日", k=rnd.choice((0, 1, 3, 40))))) for i in range(900)]
    rows[7] = (rows[7][0], None)
    rnd.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op5_sketch(spark, str(tmp_path)).collect()}
    order = sorted(rows)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        k = len(t) // 4
        edited = t[:len(t) - k] + n[:k]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == brute.sha(edited)
        assert got[i]["near_next"] == (len(shingles(t) & shingles(n)) / len(shingles(t) | shingles(n)) if shingles(t) | shingles(n) else 1)
        assert (got[i]["fingerprint"] == got[i]["edited_fingerprint"]) == (shingles(t) == shingles(edited))


def test_one_row_and_none(spark, tmp_path):
    for name, rows in (("one", [(5, "a b c d")]), ("none", []), ("ties", [(1, "a"), (1, "b"), (None, "c"), (1, "b")])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / name / "documents.parquet"))
        assert queries.op5_sketch(spark, str(tmp_path / name)).count() == len(rows)


def test_next_texts_over_many_ranges_ties_and_large_ids(spark, monkeypatch):
    monkeypatch.setattr(queries, "RANGE_ROWS", 3)
    rnd = random.Random(5)
    rows = [(rnd.choice((None, 7, 7, 7, (1 << 53) + rnd.randrange(40), rnd.randrange(-50, 50))), rnd.choice("abcdefgh") * rnd.randrange(1, 4))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = queries.with_next_text(df).select("doc_id", "text", "next_text", F.xxhash64("text").alias("t"),
                                            F.xxhash64("next_text").alias("n")).collect()

    def key(i, t):
        return (i is not None, i or 0, t)
    assert sorted(key(r["doc_id"], r["text"]) for r in got) == sorted(key(*r) for r in rows)
    order = sorted(got, key=lambda r: key(r["doc_id"], r["t"]))
    texts = [r["text"] for r in order]
    for part in {key(r["doc_id"], r["t"]) for r in order}:
        at = [k for k, r in enumerate(order) if key(r["doc_id"], r["t"]) == part]
        want = sorted(texts[(k + 1) % len(texts)] for k in at)  # equal rows: in any order
        assert sorted(order[k]["next_text"] for k in at) == want
    monkeypatch.setattr(queries, "MOST_RANGES", 4)  # longer ranges, the same texts
    again = queries.with_next_text(df).select("doc_id", "text", "next_text").collect()
    assert sorted(map(repr, again)) == sorted(repr(r) for r in queries.with_next_text(df).collect())
