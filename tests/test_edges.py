"""Edge cases: empty inputs and degenerate parameters."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from plover.operators import activity as A
from plover.operators import detail as D
from plover.operators import graph as G
from plover.operators import sessions as S


def test_components_without_edges(spark):
    v = spark.createDataFrame([("b",), ("a",)], "id string")
    e = spark.createDataFrame([], "src string, dst string")
    assert rows(G.connected_components(v, e)) == [("a", "a"), ("b", "b")]


def test_single_step_funnel(spark):
    df = spark.createDataFrame([("g1", 1, "x", 1), ("g1", 2, "y", 2), ("g2", 3, "y", 3)],
                               "guid string, timestamp long, eventid string, event_id long")
    got = rows(S.funnel_depth(df, [F.col("eventid") == "x", F.col("eventid") == "z"], "f"), "guid", "comp_step")
    assert got == [("g1", 1)]
    one = rows(S.funnel_depth(df, [F.col("eventid") == "y"], "f"), "guid", "comp_step")
    assert one == [("g1", 1), ("g2", 1)]


def test_rollovers_from_empty_state(spark):
    today = spark.createDataFrame([("u",)], "guid string")
    no_ranges = spark.createDataFrame([], "first_dt date, guid string, range_start date, range_end date")
    got = rows(A.rollover_ranges(no_ranges, today, cur_dy="2024-01-05"), "guid", "range_start", "range_end")
    assert got == [("u", dt.date(2024, 1, 5), A.OPEN_END)]
    no_bits = spark.createDataFrame([], "guid string, bitmap long")
    assert rows(A.update_bitmap(no_bits, today), "guid", "bitmap") == [("u", 1)]
    no_scores = spark.createDataFrame([], "deviceid string, account string, timestamp double, score double")
    log = spark.createDataFrame([("d1", "a1", 5.0, "s1")], "deviceid string, account string, timestamp double, sessionid string")
    assert rows(D.rollover_scores(no_scores, log), "deviceid", "account", "score") == [("d1", "a1", 100.0)]
