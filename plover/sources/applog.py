"""Adapter: derive an app log from the driver's ``events`` table.

``/root/testdata`` has no app log, so one is derived by integer arithmetic
that Spark and DuckDB evaluate identically (the SQL twin lives in
``plover.plans.oracle``). The rules:

* ``k`` = JSON ``$.k`` of ``props``; ``timestamp`` = epoch ms; ``dy`` = date.
* ``eventid``: view→pageView, click→share, purchase→addCart, else unchanged;
  ``properties`` = {'pageId': k}.
* ``deviceid`` = 'd'‖user_id; ``account`` = null when event_id % 4 = 0,
  '' when event_id % 4 = 1 and k < 10, else 'a'‖((user_id + [k % 33 = 0]) % 60).
* ``sessionid`` = user_id‖'_'‖dy, null when event_id % 97 = 0.
* lat = ((user_id·37 + k) % 200) − 100, lon = ((user_id·53 + k) % 380) − 190.
* ip = ((user_id·7919 + k)·65536) mod 2^32, dotted.
* dimension columns are small modulo buckets of user_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.functions.columns import epoch_ms, long_to_ip


def app_log(events: DataFrame) -> DataFrame:
    """Raw app log (the 18 log columns) plus ``event_id``, ``user_id`` and ``dy``."""
    k = F.get_json_object("props", "$.k").cast("int")
    base = events.select(
        "event_id", "user_id", "event_type",
        k.alias("k"),
        epoch_ms("ts").alias("timestamp"),
        F.to_date("ts").alias("dy"),
    )
    uid = F.col("user_id")
    eventid = (F.when(F.col("event_type") == "view", "pageView")
               .when(F.col("event_type") == "click", "share")
               .when(F.col("event_type") == "purchase", "addCart")
               .otherwise(F.col("event_type")))
    account = (F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("string"))
               .when((F.col("event_id") % 4 == 1) & (F.col("k") < 10), F.lit(""))
               .otherwise(F.concat(F.lit("a"), ((uid + F.when(F.col("k") % 33 == 0, 1).otherwise(0)) % 60)
                                   .cast("string"))))
    sessionid = F.when(F.col("event_id") % 97 != 0,
                       F.concat(uid.cast("string"), F.lit("_"), F.col("dy").cast("string")))
    ip_long = ((uid * 7919 + F.col("k")) * 65536) % 4294967296
    return base.select(
        "event_id", "user_id",
        account.alias("account"),
        F.lit("app1").alias("appid"),
        F.concat(F.lit("v"), (uid % 3).cast("string")).alias("appversion"),
        F.concat(F.lit("carrier"), (uid % 3).cast("string")).alias("carrier"),
        F.concat(F.lit("d"), uid.cast("string")).alias("deviceid"),
        F.concat(F.lit("type"), (uid % 3).cast("string")).alias("devicetype"),
        eventid.alias("eventid"),
        long_to_ip(ip_long).alias("ip"),
        (((uid * 37 + F.col("k")) % 200) - 100).cast("double").alias("latitude"),
        (((uid * 53 + F.col("k")) % 380) - 190).cast("double").alias("longitude"),
        F.lit("wifi").alias("nettype"),
        F.when(uid % 2 == 0, "android").otherwise("ios").alias("osname"),
        F.concat(F.lit("os"), (uid % 4).cast("string")).alias("osversion"),
        F.create_map(F.lit("pageId"), F.col("k").cast("string")).alias("properties"),
        F.concat(F.lit("ch"), (uid % 4).cast("string")).alias("releasechannel"),
        F.lit("1080x1920").alias("resolution"),
        sessionid.alias("sessionid"),
        "timestamp",
        "dy",
    )


def detail_log(events: DataFrame) -> DataFrame:
    """Service-layer input: cleaned adapter log with the enrichment columns.

    Stands in for the detail ETL's output so that each service job can be
    checked on its own: rows without a session are dropped, ``guid`` is the
    account when present else the device, geography and the new-user flag
    are buckets of user_id and the day.
    """
    log = app_log(events).filter(F.col("sessionid").isNotNull())
    uid = F.col("user_id")
    province = F.concat(F.lit("P"), (uid % 5).cast("string"))
    city = F.concat(province, F.lit("-C"), (uid % 3).cast("string"))
    district = F.concat(city, F.lit("-D"), (uid % 2).cast("string"))
    return log.select(
        "event_id", "user_id",
        F.coalesce(F.when(F.trim("account") != "", F.col("account")), F.col("deviceid")).alias("guid"),
        F.col("sessionid").alias("sessionId"),
        "timestamp", "eventid", "properties",
        province.alias("province"), city.alias("city"), district.alias("district"),
        "devicetype", "releasechannel", "appversion", "osname",
        F.when((uid + F.dayofmonth("dy")) % 7 == 0, 1).otherwise(0).alias("newuser"),
        "dy",
    )
