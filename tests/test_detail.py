"""Detail layer on the shipped fixtures (goldens from FIXTURES.md §2)."""


from conftest import rows
from plover.operators import detail as D

IDBIND = [  # deviceid, account ('' = missing), timestamp, sessionid
    ("d01", "a01", 12235.0, "s01"), ("d01", "a01", 12266.0, "s01"), ("d01", "a01", 12345.0, "s02"),
    ("d01", "a01", 12368.0, "s02"), ("d01", None, 12345.0, "s03"), ("d01", None, 12376.0, "s03"),
    ("d02", "a02", 12445.0, "s04"), ("d02", "a02", 12576.0, "s04"), ("d03", "a03", 13345.0, "s05"),
    ("d03", "a03", 13376.0, "s05"), ("d04", None, 14786.0, "s06"), ("d04", None, 14788.0, "s06"),
]
IDSCORE = [("d00", "a00", 11000.0, 600.0), ("d01", "a01", 12235.0, 400.0),
           ("d02", "a02", 12445.0, 300.0), ("d02", "a12", 12576.0, 100.0)]


def _today(spark):
    return spark.createDataFrame(IDBIND, "deviceid string, account string, timestamp double, sessionid string")


def _prev(spark):
    return spark.createDataFrame(IDSCORE, "deviceid string, account string, timestamp double, score double")


def test_rollover_scores_golden(spark):
    out = D.rollover_scores(_prev(spark), _today(spark))
    got = rows(out, "deviceid", "account", "timestamp", "score")
    assert got == sorted([
        ("d00", "a00", 11000.0, 300.0), ("d01", "a01", 12368.0, 600.0), ("d02", "a02", 12576.0, 400.0),
        ("d02", "a12", 12576.0, 50.0), ("d03", "a03", 13376.0, 100.0), ("d04", None, 14788.0, 100.0),
    ], key=lambda r: (r[0], r[1] or ""))


def test_best_account_golden(spark):
    got = rows(D.best_account(_prev(spark)), "deviceid", "account")
    assert got == [("d00", "a00"), ("d01", "a01"), ("d02", "a02")]


def test_assign_guid_rules(spark):
    log = spark.createDataFrame([("d01", "x1"), ("d01", None), ("d01", " "), ("d09", None)],
                                "deviceid string, account string")
    best = spark.createDataFrame([("d01", "a01")], "deviceid string, account string")
    got = rows(D.assign_guid(log, best), "deviceid", "guid")
    assert got == sorted([("d01", "x1"), ("d01", "a01"), ("d01", "a01"), ("d09", "d09")])


def test_flag_new_users(spark):
    log = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "")], "id int, account string")
    hist = spark.createDataFrame([("a",), ("c",)], "account string")
    got = rows(D.flag_new_users(log, hist), "id", "newuser")
    assert got == [(1, 0), (2, 1), (3, 1), (4, 1)]


def test_clean_events(spark):
    schema = ("account string, deviceid string, eventid string, sessionid string, properties map<string,string>,"
              " latitude double, longitude double")
    p = {"pageId": "1"}
    data = [("a", "d", "e", "s", p, 10.0, 10.0),      # kept
            (None, None, "e", "s", p, 10.0, 10.0),    # no identity
            ("a", "d", " ", "s", p, 10.0, 10.0),      # blank event
            ("a", "d", "e", None, p, 10.0, 10.0),     # no session
            ("a", "d", "e", "s", None, 10.0, 10.0),   # no properties
            ("a", "d", "e", "s", p, 90.0, 10.0),      # lat on the bound
            ("a", "d", "e", "s", p, 10.0, None)]      # null lon
    assert D.clean_events(spark.createDataFrame(data, schema)).count() == 1


def test_sessionize_gap_and_buckets(spark):
    m = 60 * 1000
    # one incoming session; gaps of 10, 40 (split), 29, 30 (split) minutes, crossing hour buckets
    ts = [0, 10 * m, 50 * m, 79 * m, 109 * m]
    df = spark.createDataFrame([(i, "s", t) for i, t in enumerate(ts)], "id int, sessionid string, timestamp long")
    out = D.sessionize(df, tiebreak="id", bucket_ms=20 * m)
    assert rows(out, "id", "newsession") == [(0, "s-1"), (1, "s-1"), (2, "s-2"), (3, "s-2"), (4, "s-3")]


def test_sessionize_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    m = 60 * 1000
    data = []
    for key, n in (("hot", 400), ("a", 30), ("b", 5)):
        t = 0
        for i in range(n):
            t += rnd.choice([0, 1, 5, 29, 30, 31, 45, 120]) * m + rnd.randint(0, 999)
            data.append((f"{key}{i}", key, t))
    expect = {}
    by_key = {}
    for eid, k, t in data:
        by_key.setdefault(k, []).append((t, eid))
    for k, evs in by_key.items():
        seq, prev = 0, None
        for t, eid in sorted(evs):
            if prev is None or t - prev >= 30 * m:
                seq += 1
            expect[eid] = f"{k}-{seq}"
            prev = t
    df = spark.createDataFrame(data, "id string, sessionid string, timestamp long")
    got = dict(rows(D.sessionize(df), "id", "newsession"))
    assert got == expect


def test_sessionize_null_key(spark):
    df = spark.createDataFrame([(1, None, 10), (2, "s", 10)], "id int, sessionid string, timestamp long")
    assert rows(D.sessionize(df), "id", "newsession") == [(1, None), (2, "s-1")]


def _roll(days, last, decay):
    """Plain day-by-day roll of one pair: {day: (score, timestamp)}."""
    import datetime as dt
    out, score, ts, d = {}, 0.0, None, min(days)
    while d <= last:
        if d in days:
            score, ts = score + days[d][0], days[d][1] if days[d][1] is not None else ts
        else:
            score *= decay
        out[d] = (score, ts)
        d += dt.timedelta(days=1)
    return out


def test_rolled_scores_match_a_plain_roll(spark):
    import datetime as dt
    import random
    rnd = random.Random(11)
    start, last = dt.date(2019, 12, 1), dt.date(2024, 3, 9)
    span = (last - start).days
    for decay in (0.5, 0.9, 1.0, 0.001):
        want, data = {}, []
        for k in range(12):
            share = rnd.choice((0.001, 0.01, 0.3, 0.9, 1))
            days = {start + dt.timedelta(days=i): (100.0 * rnd.randint(1, 4), rnd.choice((None, float(i))))
                    for i in range(rnd.randrange(span), span + 40) if rnd.random() < share}
            data += [(f"d{k}", "a", d, s, t) for d, (s, t) in days.items()]
            seen = {d: x for d, x in days.items() if d <= last}
            if seen:
                want.update({(f"d{k}", d): x for d, x in _roll(seen, last, decay).items()})
        data.append(("d0", " ", start, 100.0, 1.0))
        daily = spark.createDataFrame(data, "deviceid string, account string, dy date, score double, timestamp double")
        got = {(r["deviceid"], r["dy"]): (r["score"], r["timestamp"]) for r in
               D.rolled_scores(daily, last, decay=decay, first_day=start if decay < 1 else None).collect()}
        assert got.keys() == want.keys()
        for key, (score, ts) in want.items():
            assert abs(got[key][0] - score) <= 1e-9 * max(1.0, score) and got[key][1] == ts


def test_rolled_scores_do_not_depend_on_the_number_of_days_per_pair(spark):
    import datetime as dt
    last = dt.date(2024, 1, 31)
    daily = spark.range(3).selectExpr("'d' as deviceid", "'a' as account", "date'2024-01-01' as dy", "1.0D as score", "1.0D as timestamp")
    plan = D.rolled_scores(daily, last)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "lambda" not in plan
