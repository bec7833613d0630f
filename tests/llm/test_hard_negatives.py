import random

import pytest
from pyspark.sql import functions as F

from plover.llm import hard_negatives as H

NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, is_anchor, k_pos=5, k_neg=5, low=80, high=100, whole=100):
    rows = sorted({(i, y, tuple(v)) for i, y, v in rows})
    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))  # a shorter vector's missing components are zero
    out = []
    for a in rows:
        if not is_anchor(a[0]):
            continue
        scored = sorted(((-dot(a[2], b[2]), b[0], b) for b in rows if b != a))
        pos = [(-s, b) for s, _, b in scored if b[1] == a[1]][:k_pos]
        for ps, p in pos:
            neg = [(-s, b) for s, _, b in scored if b[1] != a[1] and low * ps <= whole * -s <= high * ps][:k_neg]
            out += [(a[0], p[0], r, b[0], ps, s) for r, (s, b) in enumerate(neg, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, label long, v array<long>").repartition(3)


def got(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


def clustered(seed, n=400, dim=8):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 100) for _ in range(dim)] for _ in range(6)]
    out = []
    for i in range(n):
        size = rnd.choice((0.2, 1, 1, 1.5, 6))
        c = rnd.choice(centres)
        out.append((i, rnd.choice((0, 1, 1, 2)), [int(size * (x + rnd.gauss(0, 25))) for x in c]))
    return out


@pytest.mark.parametrize("tile, block", [(4096, 4096), (40, 7)])
def test_rows_equal_brute_force(spark, tile, block):
    rows = clustered(tile)
    rows += [(1000, 1, [0] * 8), (1001, 0, []), (1002, 1, [5] * 3), (1003, 1, [-7] * 8), (1004, 0, [0] * 8)]  # zero, empty, short
    rows += rows[:20]  # repeated rows
    rows += [(i, y, [x + 1 for x in v]) for i, y, v in rows[40:50]]  # other rows of the same id
    want = brute(rows, lambda i: i % 10 == 0)
    assert got(H.mine(frame(spark, rows), F.col("id") % 10 == 0, tile=tile, block=block)) == want
    assert len(want) > 100


@pytest.mark.parametrize("bucket", [256, 50, 1])
def test_buckets_prune_and_lose_nothing(monkeypatch, bucket):
    import numpy as np
    monkeypatch.setattr(H, "BUCKET", bucket)
    rnd = np.random.default_rng(3)
    vectors = np.concatenate([rnd.normal(c, 20, (600, 16)) for c in rnd.normal(0, 100, (8, 16))]).astype(np.int64)
    tile = H._Tile(list(vectors), 16)
    n = 0
    for a in vectors[::400]:
        exact = vectors @ a
        least = np.sort(exact)[-20]
        seen = []
        tile.search(a, lambda: float(least), lambda at, s: seen.append((at, s)))
        at = np.concatenate([x for x, _ in seen])
        assert {*np.flatnonzero(exact >= least)} <= {*at.tolist()}
        n += len(at)
        assert (np.concatenate([s for _, s in seen]) == exact[at]).all()
    assert n < len(vectors) * len(vectors[::400]) / 2  # the ranges leave out most rows


def test_equal_vectors_and_one_hot_label(spark):
    rows = [(i, 0, [3, 4]) for i in range(150)] + [(200 + i, 1, [3, 4]) for i in range(150)] + [(500, 2, [3, 3])]
    assert got(H.mine(frame(spark, rows), F.col("id") % 100 == 0, tile=16, block=2)) == brute(rows, lambda i: i % 100 == 0)


def test_very_large_components(spark):
    big = (1 << 62) + 12345
    rows = [(0, 0, [big, 1]), (1, 0, [1, 1]), (2, 1, [1, 0]), (3, 1, [1, -5]), (4, 0, [1 << 30, 7]), (5, 1, [(1 << 30) - 1, 3])]
    assert got(H.mine(frame(spark, rows), F.col("id") == 4)) == brute(rows, lambda i: i == 4)
    top = (1 << 63) - 1
    assert {r[4] for r in got(H.mine(frame(spark, rows + [(6, 0, [big, 0]), (7, 1, [big, 0])]), F.col("id") == 0))} <= {top, big + 1}


def test_rows_that_take_no_part_and_no_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, 0, [0.5, 0.5], 1), (1, 0, [0.5, 0.4999], 1), (2, 1, [0.25, 0.5], 1), (3, 1, [nan, 1.0], 1), (4, 1, [inf, 1.0], 1),
            (5, None, [1.0, 1.0], 1), (6, 1, None, 1), (7, 1, [None, 1.0], 1), (None, 1, [0.5, 0.45], 1), (8, 1, [-0.1, 0.9], 1)]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>, row int")
    rows = H.integer_vectors(df, "vec_id", F.col("label"), "embedding")
    kept = sorted((r["id"], r["label"], tuple(r["v"])) for r in rows.collect())
    assert kept == [(0, 0, (128, 128)), (1, 0, (128, 127)), (2, 1, (64, 128)), (8, 1, (-26, 230))]
    assert got(H.mine(rows, F.col("id") % 100 == 0)) == brute(kept, lambda i: i % 100 == 0)
    assert H.mine(rows.limit(0), F.col("id") % 100 == 0).count() == 0
    assert H.mine(rows, F.lit(False)).count() == 0
