"""Attribution on the shipped attribution fixture (goldens from FIXTURES.md §2)."""

import pytest

from conftest import rows
from plover.operators import attribution as AT

FACTOR = [
    ("g01", "e1", 1), ("g01", "e3", 2), ("g01", "e6", 3), ("g01", "e4", 4), ("g01", "e3", 5), ("g01", "e6", 6),
    ("g01", "e2", 7), ("g01", "e6", 8), ("g01", "e5", 9), ("g02", "e3", 1), ("g02", "e1", 2), ("g02", "e1", 3),
    ("g02", "e1", 4), ("g02", "e6", 5), ("g02", "e6", 6), ("g02", "e6", 7), ("g02", "e1", 8), ("g02", "e6", 9),
    ("g03", "e7", 1), ("g03", "e8", 2), ("g03", "e3", 3), ("g03", "e1", 4), ("g03", "e1", 5), ("g03", "e5", 6),
    ("g03", "e6", 7), ("g03", "e8", 8),
]
TOUCH, TARGET = ("e1", "e3", "e5"), "e6"
KW = dict(bucket_size=4)  # small buckets so the fixture crosses bucket borders


@pytest.fixture(scope="module")
def factor(spark):
    return spark.createDataFrame(FACTOR, "guid string, event string, timestamp long")


def test_paths(factor):
    got = rows(AT.event_paths(factor, TOUCH, TARGET, **KW), "guid", "step", "event")
    g01 = [e for g, _, e in got if g == "g01"]
    assert g01 == ["e1", "e3", "e6", "e3", "e6", "e6", "e5"]
    assert {g for g, _, _ in got} == {"g01", "g02", "g03"}


def test_first_touch_overall(factor):
    assert rows(AT.first_touch_overall(factor, TOUCH, TARGET)) == [("g01", "e1"), ("g02", "e3"), ("g03", "e3")]


def test_first_and_last_touch(factor):
    assert rows(AT.first_touch(factor, TOUCH, TARGET, **KW)) == [
        ("g01", 0, "e1"), ("g01", 1, "e3"), ("g02", 0, "e3"), ("g02", 3, "e1"), ("g03", 0, "e3")]
    assert rows(AT.last_touch(factor, TOUCH, TARGET, **KW)) == [
        ("g01", 0, "e3"), ("g01", 1, "e3"), ("g02", 0, "e1"), ("g02", 3, "e1"), ("g03", 0, "e5")]


def test_linear(factor):
    got = rows(AT.linear_attribution(factor, TOUCH, TARGET, **KW), "guid", "conversion", "event", "weight")
    assert got == [("g01", 0, "e1", 50), ("g01", 0, "e3", 50), ("g01", 1, "e3", 100),
                   ("g02", 0, "e1", 50), ("g02", 0, "e3", 50), ("g02", 3, "e1", 100),
                   ("g03", 0, "e1", 33), ("g03", 0, "e3", 33), ("g03", 0, "e5", 33)]


def test_decay(factor):
    got = {(g, c, e): round(w, 6) for g, c, e, w in
           rows(AT.decay_attribution(factor, TOUCH, TARGET, **KW), "guid", "conversion", "event", "weight")}
    assert got == {("g01", 0, "e1"): 0.526316, ("g01", 0, "e3"): 0.473684, ("g01", 1, "e3"): 1.0,
                   ("g02", 0, "e3"): 0.526316, ("g02", 0, "e1"): 0.473684, ("g02", 3, "e1"): 1.0,
                   ("g03", 0, "e3"): 0.369004, ("g03", 0, "e1"): 0.332103, ("g03", 0, "e5"): 0.298893}


def test_attribution_matches_brute_force(spark):
    import random
    rnd = random.Random(21)
    events = ["e1", "e3", "e5", "e6", "e9"]
    data, eid = [], 0
    for g in range(60):
        t = 0
        for _ in range(rnd.randint(1, 25)):
            t += rnd.choice([0, 1, 2])          # equal timestamps happen
            eid += 1
            data.append((f"g{g:02d}", rnd.choice(events), t, eid))
    df = spark.createDataFrame(data, "guid string, event string, timestamp long, eid long")
    kw = dict(tiebreak="eid", bucket_size=3)

    first, last, linear, decay = {}, {}, {}, {}
    for g in sorted({d[0] for d in data}):
        path = sorted((t, e, i) for gg, e, t, i in data if gg == g and e in TOUCH + (TARGET,))
        targets_before, seg = 0, []
        for t, e, i in path:
            if e == TARGET:
                if seg:
                    first[(g, targets_before)] = seg[0]
                    last[(g, targets_before)] = seg[-1]
                    distinct = list(dict.fromkeys(seg))
                    tot = sum(0.9 ** k for k in range(len(distinct)))
                    for k, ev in enumerate(distinct):
                        linear[(g, targets_before, ev)] = 100 // len(distinct)
                        decay[(g, targets_before, ev)] = round(0.9 ** k / tot, 9)
                targets_before += 1
                seg = []
            else:
                seg.append(e)
    assert {(g, c): e for g, c, e in rows(AT.first_touch(df, TOUCH, TARGET, **kw))} == first
    assert {(g, c): e for g, c, e in rows(AT.last_touch(df, TOUCH, TARGET, **kw))} == last
    assert {(g, c, e): w for g, c, e, w in rows(AT.linear_attribution(df, TOUCH, TARGET, **kw))} == linear
    assert {(g, c, e): round(w, 9) for g, c, e, w in rows(AT.decay_attribution(df, TOUCH, TARGET, **kw))} == decay
