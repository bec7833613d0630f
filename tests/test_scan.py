"""The bucketed running count against a plain Python scan, with one key
holding most rows and spanning many buckets."""

import random

from pyspark.sql import functions as F

from conftest import rows
from plover.operators.scan import running_count, time_bucket


def test_running_count_hot_key(spark):
    rnd = random.Random(11)
    data = []
    for key, n in (("hot", 600), ("k1", 20), ("k2", 3)):
        t = 0
        for i in range(n):
            t += rnd.choice([0, 1, 3, 10])
            data.append((key, t, i, int(rnd.random() < 0.3)))
    df = spark.createDataFrame(data, "k string, t long, i int, f int")
    out = running_count(df, ["k"], [F.col("t"), F.col("i")], F.col("f") == 1, time_bucket("t", 25), "n",
                        inclusive=False, total="tot")
    got = {(k, i): (n, tot) for k, i, n, tot in rows(out, "k", "i", "n", "tot")}
    expect = {}
    for key in ("hot", "k1", "k2"):
        evs = sorted((t, i, f) for k, t, i, f in data if k == key)
        total = sum(f for _, _, f in evs)
        acc = 0
        for t, i, f in evs:
            expect[(key, i)] = (acc, total)
            acc += f
    assert got == expect
