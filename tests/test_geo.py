"""IP range fallback and the geo dictionary on small literal inputs."""

from pyspark.sql import functions as F

from conftest import rows
from plover.functions.columns import long_to_ip
from plover.operators import geo as GEO


def test_ip_ranges_boundaries(spark):
    lines = spark.createDataFrame([("0 65535 CN|0|P1|C1|isp",), ("65536 200000 CN|0|P2|C2|isp",),
                                   ("200001 4294967295 0|0|P3|C3|isp",), ("bad line",)], "value string")
    ranges = GEO.parse_ip_regions(lines)
    assert ranges.count() == 3
    ips = [(1, 0, None), (2, 65535, None), (3, 65536, None), (4, 131072, None), (5, 200000, None),
           (6, 200001, None), (7, 70000, "GEO")]
    log = (spark.createDataFrame(ips, "id int, v long, province string")
           .withColumn("ip", long_to_ip("v")).withColumn("city", F.lit(None).cast("string")))
    got = {i: (p, c) for i, p, c in rows(GEO.ip_region_enrich(log, ranges), "id", "province", "city")}
    assert got == {1: ("P1", "C1"), 2: ("P1", "C1"), 3: ("P2", "C2"), 4: ("P2", "C2"), 5: ("P2", "C2"),
                   6: (None, None), 7: ("GEO", None)}


def test_geo_dictionary_unique_cells(spark):
    lines = spark.createDataFrame([("a b 116.4074 39.9042 P:C:D2",), ("a b 116.40741 39.90421 P:C:D1",),
                                   ("a b 500 10 X:Y:Z",), ("a b -5.603 42.605 Q:R:S T",)], "value string")
    d = rows(GEO.build_geo_dictionary(lines), "geo", "province", "city", "district")
    assert d == [("ezs42s", "Q", "R", "S T"), ("wx4g0b", "P", "C", "D1")]


def test_overlapping_ranges_keep_one_row_per_event(spark):
    from plover.operators import geo as GEO
    log = spark.createDataFrame([(1, "0.0.0.5", None, None), (2, "0.0.0.50", None, None), (3, "0.0.0.5", "P", "C"),
                                 (4, "bad", None, None), (5, "0.1.0.3", None, None)],
                                "id int, ip string, province string, city string")
    ranges = spark.createDataFrame([(0, 99, "CN", "wide", "w"), (3, 9, "CN", "narrow", "n"), (50, 70000, "CN", "long", "l"),
                                    (0, 9, "0", "no", "no")],
                                   "ip_start long, ip_end long, country string, province string, city string")
    got = {r["id"]: (r["province"], r["city"]) for r in GEO.ip_region_enrich(log, ranges).collect()}
    assert got == {1: ("narrow", "n"), 2: ("wide", "w"), 3: ("P", "C"), 4: (None, None), 5: ("long", "l")}


def test_swept_pieces_match_brute_force(spark):
    import random
    rnd = random.Random(9)
    for bits, top in ((16, 1 << 18), (4, 200), (6, 1000)):
        data = []
        for i in range(150):
            a = rnd.randrange(top)
            z = a + int(rnd.choice((0, 3, 20, top / 3)) * rnd.random())
            data.append((a, z, rnd.choice(("CN", "CN", "0")), "x", rnd.choice(("p", "q", None)), rnd.choice(("c", "d", None)), "i"))
        data += data[:20] + [(5, 4, "CN", "x", "p", "c", "i")]
        df = spark.createDataFrame(data, "ip_start long, ip_end long, country string, area string, province string, city string, isp string")
        pieces = GEO.disjoint_ranges(df, bits).collect()
        taken = sorted((r["_s"], r["_e"]) for r in pieces)
        assert all(a[1] < b[0] for a, b in zip(taken, taken[1:]))
        assert all(r["_s"] >> bits == r["_e"] >> bits == r["_blk"] for r in pieces)

        def answer(ip):
            hits = [(z - a, -a, (p is not None, p or ""), (c is not None, c or ""), p, c) for a, z, k, _, p, c, _ in data
                    if k != "0" and a <= ip <= z]
            return min(hits)[4:] if hits else None
        for ip in {rnd.randrange(top) for _ in range(300)} | {e for a, z, *_ in data for e in (a - 1, a, z, z + 1) if e >= 0}:
            got = [(r["_ip_p"], r["_ip_c"]) for r in pieces if r["_s"] <= ip <= r["_e"]]
            assert got == ([] if answer(ip) is None else [answer(ip)]), ip


def test_a_block_of_nested_ranges_costs_its_ranges(spark):
    import time
    n = 30_000
    df = spark.range(n).selectExpr("id as ip_start", f"{2 * n} - id as ip_end", "'CN' as country", "'a' as area",
                                   "concat('p', id) as province", "'c' as city", "'i' as isp")
    t0 = time.time()
    pieces = GEO.disjoint_ranges(df)
    assert pieces.count() >= 2 * n - 1 and time.time() - t0 < 30
