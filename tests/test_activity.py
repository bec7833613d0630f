"""Activity state on the shipped fixtures (goldens from FIXTURES.md §2)."""

import datetime as dt

from conftest import rows
from plover.operators import activity as A

D = dt.date
OPEN = D(9999, 12, 31)

INTERVAL_CSV = [
    (1, "2020-05-20", "2020-01-01", "2020-01-12"), (1, "2020-05-20", "2020-02-09", "2020-03-11"),
    (1, "2020-05-20", "2020-03-13", "9999-12-31"), (2, "2020-05-22", "2020-03-02", "2020-03-02"),
    (2, "2020-05-22", "2020-03-04", "2020-03-05"), (3, "2020-05-22", "2020-03-02", "2020-03-09"),
    (3, "2020-05-22", "2020-03-12", "9999-12-31"), (4, "2020-06-03", "2020-03-04", "9999-12-31"),
    (5, "2020-06-04", "2020-03-12", "2020-03-13"),
]
ACTIVITY_CSV = [
    (1, "2020-05-20", "2020-05-20", "2020-05-26"), (1, "2020-05-20", "2020-05-29", "2020-06-01"),
    (1, "2020-05-20", "2020-06-03", "9999-12-31"), (2, "2020-05-22", "2020-05-22", "2020-05-30"),
    (2, "2020-05-22", "2020-06-03", "2020-06-05"), (3, "2020-05-22", "2020-05-22", "2020-05-30"),
    (3, "2020-05-22", "2020-06-07", "9999-12-31"), (4, "2020-06-03", "2020-06-03", "9999-12-31"),
    (5, "2020-06-04", "2020-06-04", "2020-06-05"),
]


def _ranges(spark, data):
    df = spark.createDataFrame(data, "guid long, first_dt string, range_start string, range_end string")
    return df.selectExpr("guid", "cast(first_dt as date) first_dt", "cast(range_start as date) range_start",
                         "cast(range_end as date) range_end")


def test_visit_intervals_golden(spark):
    got = rows(A.visit_intervals(_ranges(spark, INTERVAL_CSV), "2020-03-14"), "guid", "interval", "times")
    assert got == [(1, 0, 28), (1, 2, 1), (2, 0, 1), (2, 2, 1), (3, 0, 9), (3, 3, 1), (4, 0, 10), (5, 0, 1)]


def test_visit_interval_detail_golden(spark):
    got = rows(A.visit_interval_detail(_ranges(spark, INTERVAL_CSV), "2020-03-14"), "guid", "interval", "times")
    assert got == sorted([(1, 0, 27), (1, 0, 1), (1, 2, 1), (2, 0, 0), (2, 0, 1), (2, 2, 1), (3, 0, 7),
                          (3, 0, 2), (3, 3, 1), (4, 0, 10), (5, 0, 1)])


def test_active_days_golden(spark):
    r = _ranges(spark, ACTIVITY_CSV)
    cnt = rows(A.active_days(r, "2020-06-08"), "days", "user_cnt")
    assert cnt == [(1, 3), (2, 3), (3, 2), (4, 2), (5, 2), (6, 2)]
    mem = rows(A.active_days_members(r, "2020-06-08"), "days", "guid")
    by_n = {}
    for n, g in mem:
        by_n.setdefault(n, set()).add(g)
    assert by_n == {1: {1, 3, 4}, 2: {1, 3, 4}, 3: {1, 4}, 4: {1, 4}, 5: {1, 4}, 6: {1, 4}}


def test_rollover_ranges_cases(spark):
    prev = spark.createDataFrame([
        (D(2020, 1, 1), "open_present", D(2020, 12, 1), OPEN),
        (D(2020, 1, 1), "open_absent", D(2020, 12, 1), OPEN),
        (D(2020, 1, 1), "closed_absent", D(2020, 11, 1), D(2020, 11, 5)),
        (D(2020, 1, 1), "closed_present", D(2020, 11, 1), D(2020, 11, 5)),
    ], "first_dt date, guid string, range_start date, range_end date")
    today = spark.createDataFrame([("open_present",), ("closed_present",), ("new",)], "guid string")
    got = rows(A.rollover_ranges(prev, today, cur_dy="2020-12-11"), "guid", "range_start", "range_end")
    assert got == sorted([
        ("open_present", D(2020, 12, 1), OPEN),
        ("open_absent", D(2020, 12, 1), D(2020, 12, 10)),
        ("closed_absent", D(2020, 11, 1), D(2020, 11, 5)),
        ("closed_present", D(2020, 11, 1), D(2020, 11, 5)),
        ("closed_present", D(2020, 12, 11), OPEN),
        ("new", D(2020, 12, 11), OPEN),
    ])
    literal = A.rollover_ranges(prev, today, cur_dy="2020-12-11", new_user_open=False)
    assert rows(literal.filter("guid = 'new'"), "range_start", "range_end") == [(D(2020, 12, 11), D(2020, 12, 11))]


def test_update_bitmap_golden(spark):
    prev = spark.createDataFrame([("u1", 0b101), ("u2", 0b101), ("u3", 1 << 30 | 1)], "guid string, bitmap long")
    today = spark.createDataFrame([("u1",), ("new",), ("u3",)], "guid string")
    got = dict(rows(A.update_bitmap(prev, today), "guid", "bitmap"))
    assert got == {"u1": 11, "u2": 10, "new": 1, "u3": 3}


def test_bitmap_snapshots_from_scratch(spark):
    act = spark.createDataFrame([("u", D(2024, 1, 1)), ("u", D(2024, 1, 3)), ("late", D(2024, 1, 9))],
                                "guid string, dy date")
    got = rows(A.bitmap_snapshots(act, last_day=D(2024, 1, 4)), "guid", "dy", "bitmap")
    assert got == [("u", D(2024, 1, 1), 1), ("u", D(2024, 1, 2), 2), ("u", D(2024, 1, 3), 5),
                   ("u", D(2024, 1, 4), 10)]


def test_ranges_rolled_day_by_day_match_the_islands(spark):
    import random
    rnd = random.Random(4)
    first, last = D(2024, 1, 1), D(2024, 1, 12)
    span = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    act = {(f"u{k}", d) for k in range(12) for d in span if rnd.random() < rnd.choice((0.1, 0.5, 0.9))}
    state = spark.createDataFrame([], "first_dt date, guid string, range_start date, range_end date")
    for d in span[:6]:
        today = spark.createDataFrame([(g,) for g, x in act if x == d] * 2, "guid string")
        state = spark.createDataFrame(A.rollover_ranges(state, today, cur_dy=str(d)).collect(), state.schema)
    want = set()
    for g in {g for g, x in act if x <= span[5]}:
        days = sorted(x for u, x in act if u == g and x <= span[5])
        run = [days[0], days[0]]
        for x in [*days[1:], None]:
            if x is not None and (x - run[1]).days == 1:
                run[1] = x
                continue
            want.add((days[0], g, run[0], OPEN if run[1] == span[5] else run[1]))
            run = [x, x]
    assert set(rows(state)) == want


def test_interval_detail_on_single_days_and_clipped_ranges(spark):
    r = spark.createDataFrame([(D(2019, 1, 1), "g", D(2019, 1, 1), D(2020, 3, 1)), (D(2019, 1, 1), "g", D(2020, 3, 3), D(2020, 3, 3)),
                               (D(2019, 1, 1), "g", D(2019, 1, 1), D(2019, 2, 1)), (D(2019, 1, 1), "h", D(2020, 3, 14), OPEN)], A_SCHEMA)
    got = rows(A.visit_interval_detail(r, "2020-03-14"), "guid", "interval", "times")
    assert got == [("g", 0, 0), ("g", 0, 17), ("g", 2, 1), ("h", 0, 0)]


A_SCHEMA = "first_dt date, guid string, range_start date, range_end date"
