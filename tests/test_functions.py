"""Column expressions against independent plain-Python versions."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from plover.functions import columns as C

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def bisect_geohash(lat, lon, precision=6):
    """The textbook interval-halving geohash (longitude first)."""
    lat_rng, lon_rng = [-90.0, 90.0], [-180.0, 180.0]
    bits, even, out, ch, n = 0, True, [], 0, 0
    while len(out) < precision:
        rng, v = (lon_rng, lon) if even else (lat_rng, lat)
        mid = (rng[0] + rng[1]) / 2
        if v >= mid:
            ch = (ch << 1) | 1
            rng[0] = mid
        else:
            ch <<= 1
            rng[1] = mid
        even = not even
        n += 1
        if n == 5:
            out.append(ALPHABET[ch])
            ch, n = 0, 0
    return "".join(out)


def test_geohash_known_values_and_random_points(spark):
    rnd = random.Random(5)
    pts = [(42.605, -5.603), (57.64911, 10.40744), (39.9042, 116.4074), (0.0, 0.0), (-89.9, -179.9), (89.9, 179.9)]
    pts += [(round(rnd.uniform(-89.99, 89.99), 5), round(rnd.uniform(-179.99, 179.99), 5)) for _ in range(400)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pts)], "i int, lat double, lon double")
    got = dict(rows(df.select("i", C.geohash("lat", "lon", 6).alias("g")), "i", "g"))
    assert got[0] == "ezs42s" and got[1] == "u4pruy" and got[2] == "wx4g0b"
    for i, (a, b) in enumerate(pts):
        assert got[i] == bisect_geohash(a, b), (a, b)
    g9 = df.select(C.geohash("lat", "lon", 9).alias("g")).first()["g"]
    assert g9 == bisect_geohash(42.605, -5.603, 9)


def test_ip_round_trip_and_malformed(spark):
    rnd = random.Random(9)
    vals = [0, 1, 255, 65536, 4294967295] + [rnd.randrange(0, 2 ** 32) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    back = df.select("v", C.ip_to_long(C.long_to_ip("v")).alias("w"))
    assert back.filter(F.col("v") != F.col("w")).count() == 0
    bad = spark.createDataFrame([(0, "1.2.3"), (1, "1.2.3.256"), (2, "a.b.c.d"), (3, None), (4, "10.0.0.1")],
                                "i int, ip string")
    got = {r["i"]: r["x"] for r in bad.select("i", C.ip_to_long("ip").alias("x")).collect()}
    assert got == {0: None, 1: None, 2: None, 3: None, 4: 10 * 2 ** 24 + 1}


def test_epoch_ms_floor_and_zones(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.999999",)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("ntz"), F.col("s").cast("timestamp").alias("ts"))
    ntz = df.select(C.epoch_ms("ntz").alias("x")).first()["x"]
    assert ntz == int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000) + 999
    zoned = df.select(C.epoch_ms("ts", zoned=True).alias("x")).first()["x"]
    assert zoned == ntz  # the session zone of the tests is UTC
