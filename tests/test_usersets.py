"""User sets as bitmaps against plain Python sets."""

import datetime as dt
import random

from conftest import rows
from plover.operators import activity as A
from plover.operators import usersets as U

D = dt.date


def test_the_dictionary_grows_and_keeps_its_numbers(spark):
    def frame(names):
        return spark.createDataFrame([(n,) for n in names], "guid string")
    first = U.extend_dictionary(frame([f"g{i}" for i in range(500)] * 2 + [None]), parts=3)
    kept = dict(rows(first))
    first = spark.createDataFrame(list(kept.items()), "guid string, num long")
    both = dict(rows(U.extend_dictionary(frame([f"g{i}" for i in range(400, 1500)]), first, parts=3)))
    assert len(kept) == 500 and len(both) == 1500 and kept.items() <= both.items()
    assert len(set(both.values())) == 1500 and min(both.values()) >= 1
    assert max(both.values()) <= 3 * U.BUCKET  # dense: one bucket for each part


def test_sets_of_days_unite_and_list_their_members(spark, monkeypatch):
    rnd = random.Random(3)
    data = [(f"g{rnd.randrange(300)}", D(2024, 1, rnd.randrange(1, 6)), rnd.choice("ab")) for _ in range(900)] + [(None, D(2024, 1, 1), "a")]
    df = spark.createDataFrame(data, "guid string, dy date, k string")
    words = U.extend_dictionary(df, parts=2)
    days = U.user_sets(U.with_numbers(df, words), ["dy", "k"])
    want = {}
    for g, d, k in data:
        want.setdefault((d, k), set()).add(g)
    assert dict((tuple(r[:2]), r[2]) for r in rows(U.set_sizes(days, ["dy", "k"]))) == {k: len(v - {None}) for k, v in want.items()}
    span = U.united(days, ["k"])
    whole = {k: {g for g, _, x in data if x == k and g} for k in "ab"}
    assert dict(rows(U.set_sizes(span, ["k"]))) == {k: len(v) for k, v in whole.items()}
    got = {}
    for k, g in rows(U.members(span, words, ["k"]), "k", "guid"):
        got.setdefault(k, set()).add(g)
    assert got == whole


def test_sets_over_several_buckets(spark):
    n = 70_000
    df = spark.range(n).selectExpr("concat('g', id) as guid", "id % 7 as k")
    words = U.extend_dictionary(df, parts=2)
    assert words.agg({"num": "max"}).first()[0] <= 4 * U.BUCKET
    sets = U.user_sets(U.with_numbers(df, words), ["k"])
    assert dict(rows(U.set_sizes(sets, ["k"]))) == {k: n // 7 for k in range(7)}
    assert U.members(U.united(sets, []), words, []).distinct().count() == n


def test_active_days_sets_hold_the_members(spark):
    r = spark.createDataFrame([("a", D(2024, 1, 1), A.OPEN_END), ("b", D(2024, 1, 4), A.OPEN_END), ("c", D(2024, 1, 6), A.OPEN_END),
                               ("d", D(2024, 1, 4), A.OPEN_END), ("x", D(2024, 1, 1), D(2024, 1, 3))],
                              "guid string, range_start date, range_end date")
    words = U.extend_dictionary(r)
    sets = A.active_days_sets(r, words, "2024-01-06")
    assert rows(U.members(sets, words, ["days"]), "days", "guid") == rows(A.active_days_members(r, "2024-01-06"), "days", "guid")
    assert rows(U.set_sizes(sets, ["days"], "n")) == [(1, 4), (2, 3), (3, 3), (4, 1), (5, 1), (6, 1)]
