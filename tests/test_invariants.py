"""Invariants of SURVEY §5 on the smallest driver tables."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
Q = E.queries()


def test_one_guid_per_event(spark):
    for name in ("w10_assign_guid", "w16_detail_etl", "w15_label_rows"):
        df = Q[name](spark, SF)
        assert df.count() == df.select("event_id").distinct().count()
        assert df.filter(F.col("guid").isNull()).count() == 0


def test_ranges_of_a_guid_are_disjoint(spark):
    r = Q["w26_rollover_ranges"](spark, SF)
    w = Window.partitionBy("dy", "guid").orderBy("range_start")
    nxt = r.withColumn("_next", F.lead("range_start").over(w))
    assert nxt.filter(F.col("_next").isNotNull() & (F.col("_next") <= F.col("range_end"))).count() == 0
    assert r.filter(F.col("range_start") > F.col("range_end")).count() == 0


def test_decay_weights_sum_to_one(spark):
    d = Q["w25_decay_attribution"](spark, SF)
    sums = d.groupBy("guid", "conversion").agg(F.sum("weight").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1.0) > 1e-5).count() == 0


def test_component_label_not_above_id(spark):
    c = Q["w12_connected_components"](spark, SF)
    assert c.filter(F.col("component") > F.col("id")).count() == 0


def test_cube_total_equals_province_sum(spark):
    cube = Q["w18_traffic_cube"](spark, SF)
    measures = ("session_cnt", "pv_cnt", "time_long")
    total = cube.filter(F.col("grouping_id") == 255).groupBy("dy").agg(*[F.sum(m).alias(m) for m in measures])
    prov = cube.filter(F.col("grouping_id") == 127).groupBy("dy").agg(*[F.sum(m).alias(m) for m in measures])
    a = sorted(tuple(r) for r in total.collect())
    b = sorted(tuple(r) for r in prov.select("dy", *measures).collect())
    assert a == b and len(a) > 0
