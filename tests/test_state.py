"""Bucketed state tables: a day's roll leaves the state where it is."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from plover.operators import activity as A
from plover.operators import detail as D
from plover.sources import state

CONF = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "4"}


@pytest.fixture
def plain(spark):
    was = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for name in ("test_state_a", "test_state_b"):
        state.drop_state(spark, name)


def moved(df):
    """For each bucketed scan of the plan, whether a shuffle stands between it and the join above."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")

    def depth(x):
        return len(x) - len(x.lstrip(" +-:*()0123456789"))
    out = []
    for i, line in enumerate(lines):
        if "Bucketed: true" in line:
            d, shuffled = depth(line), False
            for x in reversed(lines[:i]):
                if depth(x) < d:
                    d = depth(x)
                    if "Join" in x:
                        break
                    shuffled |= "Exchange" in x
            out.append(shuffled)
    return out


def test_bitmaps_roll_on_their_buckets(plain):
    prev = plain.range(1000).select(F.concat(F.lit("g"), "id").alias("guid"), F.lit(5).cast("long").alias("bitmap"))
    today = plain.range(500, 1500).select(F.concat(F.lit("g"), "id").alias("guid"))
    table = state.save_state(prev, "test_state_a", ["guid"], 8)
    out = A.update_bitmap(table, today)
    assert moved(out) == [False]
    again = state.save_state(out, "test_state_b", ["guid"], 8, rolled=True)
    assert rows(again) == rows(A.update_bitmap(prev, today))
    nxt = A.update_bitmap(again, today)
    assert moved(nxt) == [False] and nxt.count() == 1500
    files = [f for f in again.inputFiles()]
    assert len(files) <= 8  # a bucket is one file


def test_ranges_roll_on_their_buckets(plain):
    day = dt.date(2024, 1, 5)
    prev = plain.range(600).select(F.lit(dt.date(2024, 1, 1)).alias("first_dt"), F.concat(F.lit("g"), F.col("id") % 300).alias("guid"),
                                   F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 300).cast("int") * 2).alias("range_start"),
                                   F.when(F.col("id") < 300, F.lit(dt.date(2024, 1, 2))).otherwise(F.lit(A.OPEN_END)).alias("range_end"))
    today = plain.range(200, 400).select(F.concat(F.lit("g"), "id").alias("guid"))
    out = A.rollover_ranges(state.save_state(prev, "test_state_a", ["guid"], 8), today, cur_dy=day)
    assert not any(moved(out)) and moved(out)
    assert rows(out) == rows(A.rollover_ranges(prev, today, cur_dy=day))


def test_scores_roll_on_their_buckets(plain):
    prev = plain.range(400).select(F.concat(F.lit("d"), F.col("id") % 100).alias("deviceid"), F.concat(F.lit("a"), "id").alias("account"),
                                   F.lit(1.0).alias("timestamp"), F.lit(100.0).alias("score"))
    log = plain.range(300).select(F.concat(F.lit("d"), F.col("id") % 150).alias("deviceid"),
                                  F.when(F.col("id") % 3 > 0, F.concat(F.lit("a"), "id")).alias("account"),
                                  F.concat(F.lit("s"), "id").alias("sessionid"), F.lit(9.0).alias("timestamp"))
    out = D.rollover_scores(state.save_state(prev, "test_state_a", ["deviceid", "account"], 8), log)
    assert moved(out)[0] is False  # the table itself; its devices are matched with today's blank ones apart
    def of(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    assert of(out) == of(D.rollover_scores(prev, log))
