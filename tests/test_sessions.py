"""Session aggregate, cube and funnel on small literal logs."""

import itertools

from pyspark.sql import functions as F

from conftest import rows
from plover.operators import sessions as S

COLS = ("event_id long, guid string, sessionId string, timestamp long, eventid string, page string, "
        "province string, city string, district string, devicetype string, releasechannel string, "
        "appversion string, osname string, newuser int, dy string")


def _detail(spark, data):
    df = spark.createDataFrame(data, COLS)
    return df.withColumn("properties", F.create_map(F.lit("pageId"), F.col("page"))) \
             .withColumn("dy", F.col("dy").cast("date")).drop("page")


LOG = [
    (1, "g1", "s1", 3_600_000, "pageView", "p1", "P1", "C1", "D1", "t1", "c1", "v1", "ios", 1, "2024-01-01"),
    (2, "g1", "s1", 3_600_500, "pageView", "p2", "P2", "C2", "D2", "t0", "c1", "v2", "ios", 0, "2024-01-01"),
    (3, "g1", "s1", 3_600_500, "pageView", "p3", "P3", "C3", "D3", "t1", "c1", "v1", "ios", 1, "2024-01-01"),
    (4, "g1", "s1", 3_500_000, "click", "p0", "P0", "C0", "D0", "t1", "c1", "v1", "ios", 1, "2024-01-01"),
    (5, "g2", "s2", 7_200_000, "pageView", "p9", "P9", "C9", "D9", "t2", "c2", "v2", "android", 0, "2024-01-01"),
]


def test_session_aggregate(spark):
    out = S.session_aggregate(_detail(spark, LOG))
    got = rows(out, "guid", "start_time", "end_time", "in_page", "out_page", "pv_cnt", "isnew", "hour_segment",
               "province", "device_type")
    assert got == [("g1", 3_600_000, 3_600_500, "p1", "p3", 3, 0, 1, "P1", "t0"),
                   ("g2", 7_200_000, 7_200_000, "p9", "p9", 1, 0, 2, "P9", "t2")]
    # merged from time buckets, the rows are the same
    for size in (500, 3_600_000):
        assert rows(out) == rows(S.session_aggregate_bucketed(_detail(spark, LOG), bucket_ms=size).select(*out.columns))


def test_traffic_cube_totals(spark):
    sess = S.session_aggregate(_detail(spark, LOG))
    cube = S.traffic_cube(sess)
    total = cube.filter(F.col("grouping_id") == 255).select("session_cnt", "pv_cnt", "uv_cnt").first()
    assert tuple(total) == (2, 4, 2)
    prov = cube.filter(F.col("grouping_id") == 127).agg(F.sum("session_cnt"), F.sum("pv_cnt")).first()
    assert tuple(prov) == (2, 4)
    assert cube.select("grouping_id").distinct().count() == 9


def _brute_depth(seq, steps):
    depth = 0
    for ev in seq:
        if depth < len(steps) and ev == steps[depth]:
            depth += 1
    return depth


def test_funnel_matches_brute_force(spark):
    steps = ["pageView", "share", "addCart"]
    events = ["pageView", "share", "addCart", "other"]
    data, expect = [], {}
    eid = 0
    for g, combo in enumerate(itertools.product(events, repeat=4)):
        seq = []
        for t, ev in enumerate(combo):
            eid += 1
            data.append((eid, f"g{g}", "s", 1000 + (t // 2), ev, "1", "P", "C", "D", "t", "c", "v", "o", 0,
                         "2024-01-01"))
            seq.append((1000 + t // 2, ev, eid))
        ordered = [e for _, e, _ in sorted(seq)]
        if any(e in steps for e in ordered):
            expect[f"g{g}"] = _brute_depth([e for e in ordered if e in steps], steps)
    det = _detail(spark, data)
    preds = [F.col("eventid") == s for s in steps]
    got = dict(rows(S.funnel_depth(det, preds, "f"), "guid", "comp_step"))
    assert got == expect


def test_funnel_of_pages_in_small_parts(spark):
    import random
    rnd = random.Random(2)
    steps = [("pageView", "1"), ("share", "2"), ("pageView", "1"), ("addCart", "3")]
    day = 24 * 3_600_000
    data, seqs = [], {}
    for i in range(1500):
        g = "hot" if rnd.random() < 0.4 else f"g{rnd.randrange(60)}"
        at = rnd.choice((None, 5, 5, rnd.randrange(3 * day), rnd.randrange(3 * day), -rnd.randrange(day)))
        ev, page = rnd.choice((("pageView", "1"), ("share", "2"), ("addCart", "3"), ("pageView", "9"), ("other", "1")))
        data.append((i, g, "s", at, ev, page, "P", "C", "D", "t", "c", "v", "o", 0, "2024-01-01"))
        seqs.setdefault(g, []).append((at is not None, at or 0, ev, i, page))
    expect = {}
    for g, seq in seqs.items():
        seq = [(ev, page) for _, _, ev, _, page in sorted(seq) if (ev, page) in steps]
        if seq:
            expect[g] = _brute_depth(seq, steps)
    det = _detail(spark, data)
    for bucket, chunk in ((3_600_000, 256), (60_000, 3), (5 * day, 2)):
        out = S.funnel_depth(det, S.page_steps(steps), "f", bucket_ms=bucket, chunk=chunk)
        assert dict(rows(out, "guid", "comp_step")) == expect
    assert set(expect.values()) == {0, 1, 2, 3, 4} or len(set(expect.values())) >= 4
