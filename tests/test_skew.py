"""Joins with a hot key: with broadcasts off and low thresholds the final plan
must show that AQE split the hot partition."""

import pytest
from pyspark.sql import functions as F

from plover.operators import detail as D
from plover.operators import geo as GEO
from plover.operators import graph as G
from plover.operators import models as M
from plover.operators.joins import rekeyed

CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}


@pytest.fixture
def skewed(spark):
    was = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def log(spark):
    """40,000 events in 8 parts; one account has half of them, a quarter has none."""
    i = F.col("id")
    return spark.range(0, 40_000, 1, 8).select(
        i.alias("event_id"), F.when(i % 4 == 0, None).when(i % 2 == 0, F.concat(F.lit("a"), (i % 900).cast("string")))
        .otherwise("hot").alias("account"), F.concat(F.lit("d"), F.when(i % 2 == 0, 7).otherwise(i % 500).cast("string"))
        .alias("deviceid"), F.date_add(F.lit("2024-01-01").cast("date"), (i % 5).cast("int")).alias("dy"),
        F.repeat(F.md5(i.cast("string")), 4).alias("fill"),
        F.when(i % 2 == 0, 10.0).otherwise((i % 90).cast("double")).alias("latitude"), F.lit(20.0).alias("longitude"))


def star(spark):
    """A hub with half of the edges."""
    i = F.col("id")
    e = spark.range(0, 40_000, 1, 8).select(F.when(i % 2 == 0, 0).otherwise(i % 997 + 1).alias("u"), (i + 1000).alias("v"))
    return e, e.select(F.col("v").alias("u"), (F.col("u") + 100_000).alias("v")).select(F.col("u"), F.col("v"))


def test_account_joins_split(skewed):
    x = log(skewed)
    assert split(D.flag_new_users_by_day(x))
    assert split(D.flag_new_users(x, x.select("account")))
    best = x.groupBy("deviceid").agg(F.max("account").alias("account"))
    assert split(D.assign_guid(x, best))


def test_geo_join_splits(skewed):
    x = log(skewed)
    lines = x.select(F.concat_ws(" ", F.lit("_"), F.lit("_"), "longitude", "latitude", F.lit("p:c:d")).alias("value"))
    assert split(GEO.geo_enrich(x, GEO.build_geo_dictionary(lines)))


def test_star_joins_split(skewed):
    e, _ = star(skewed)
    assert split(G._large_star(e))
    # many small neighbours of one vertex
    down = e.select(F.col("v").alias("u"), (F.col("u") + 1_000_000).alias("v"))
    assert split(G._small_star(down))


def test_label_joins_split(skewed):
    x = log(skewed)
    comp = x.filter("account is not null").groupBy(F.col("account").alias("id")).agg(F.min("deviceid").alias("component"))
    assert split(G.label_rows(x, comp, ("account",)))


def test_term_join_splits(skewed):
    docs = skewed.range(0, 6_000, 1, 8).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.lit("the of and"), F.md5(F.col("id").cast("string")), F.lit("the")).alias("text"))
    assert split(M.term_stats(docs))


def test_rekeyed_keeps_rows(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (2, "y")], "a int, b string")
    assert sorted(map(str, rekeyed(df, "a", "b").collect())) == sorted(map(str, df.collect()))


def test_blank_accounts_are_new_and_match_nothing(spark):
    x = spark.createDataFrame([(None,), ("",), (" ",), ("\u00000",), ("a",)], "account string")
    got = {r["account"]: r["newuser"] for r in D.flag_new_users(x, x.filter("account = 'a'")).collect()}
    assert got == {None: 1, "": 1, " ": 1, "\u00000": 1, "a": 0}


def test_incremental_join_splits(skewed):
    # yesterday one guid held half of the identifiers; a new edge merges it
    i = F.col("id")
    prev = skewed.range(0, 40_000, 1, 8).select(F.format_string("i%06d", i).alias("id"), F.when(i % 2 == 0, "g1").otherwise(
        F.format_string("i%06d", i)).alias("guid"))
    v = skewed.createDataFrame([("a",)], "id string")
    e = skewed.createDataFrame([("a", "i000002")], "src string, dst string")
    out = G.incremental_components(v, e, prev)
    assert split(out)
    assert out.filter("component = 'a'").count() == 20_001


def test_carry_over_join_splits(skewed):
    i = F.col("id")
    today = skewed.range(0, 40_000, 1, 8).select(F.format_string("i%06d", i).alias("id"), F.when(i % 2 == 0, "g1").otherwise(
        F.format_string("i%06d", i)).alias("guid"))
    assert split(G.carry_over_guid(today, today.filter("id < 'i000900'")))


def test_a_hot_guids_funnel_is_spread(skewed):
    """No task gets all events of the guid that has most of them."""
    from plover.operators import sessions as S
    n = 60_000
    i = F.col("id")
    detail = skewed.range(0, n, 1, 8).select(
        F.when(i % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (i % 500).cast("string"))).alias("guid"),
        (i * 60_000).alias("timestamp"), i.alias("event_id"), F.when(i % 2 == 0, "pageView").otherwise("share").alias("eventid"),
        F.current_date().alias("dy"))
    steps = [F.col("eventid") == "pageView", F.col("eventid") == "share"]
    out = S.funnel_depth(detail, steps, "f")
    assert {r["comp_step"] for r in out.filter("guid = 'hot'").collect()} == {2}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(guid" in plan and "_b#" in plan  # events are dealt by guid and bucket
    events = detail.withColumn("_b", F.floor(F.col("timestamp") / 3_600_000))
    most = max(r["n"] for r in events.repartition(8, "guid", "_b").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    assert most < n / 4
