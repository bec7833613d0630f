"""Exact user sets as bitmaps that merge: distinct users of any span of days
from stored days (W18), and the member sets of W29, without the guids.

A dictionary gives every guid a number for good. A set is a row per bucket
of 32,768 numbers with a 4 KB bitmap, so a set of any size is spread over
its buckets, sets are united bucket by bucket with map-side combination,
and a hot set is no hot row. Numbers are dense within ``parts`` hash parts of
the guids, each filled bucket after bucket, so that a day's new guids extend
the dictionary without touching what is there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plover.operators.joins import rekeyed

BUCKET = 32_768  # fixed: the users of one bitmap of Spark's bitmap functions
PARTS = 64


def extend_dictionary(guids: DataFrame, prev: DataFrame | None = None, parts: int = PARTS) -> DataFrame:
    """guid, num (from 1): ``prev`` (guid, num) and a number for each guid that it
    lacks. ``parts`` must stay the same for a dictionary. Null guids have none."""
    new = guids.filter("guid IS NOT NULL").select("guid").distinct()
    part = F.pmod(F.xxhash64("guid"), F.lit(parts))
    new = new.withColumn("_p", part)
    if prev is not None:
        new = new.join(prev.select("guid"), "guid", "left_anti")
        # users of a part so far: the place of its largest number
        bucket = F.floor((F.col("num") - 1) / BUCKET)
        place = F.floor(bucket / parts) * BUCKET + (F.col("num") - 1) % BUCKET + 1
        used = prev.groupBy((bucket % parts).alias("_q")).agg(F.max(place).alias("_used"))
        new = new.join(rekeyed(used, "_q"), F.col("_p") == F.col("_q"), "left")
    else:
        new = new.withColumn("_used", F.lit(0))
    at = F.row_number().over(Window.partitionBy("_p").orderBy("guid")) + F.coalesce("_used", F.lit(0)) - 1
    num = (F.floor(at / BUCKET) * parts + F.col("_p")) * BUCKET + at % BUCKET + 1
    new = new.select("guid", num.cast("long").alias("num"))
    return new if prev is None else prev.select("guid", "num").unionByName(new)


def with_numbers(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``rows`` with num for guid (null for a guid without one)."""
    d = rekeyed(dictionary.select(F.col("guid").alias("_g"), "num"), "_g")
    return rows.join(d, F.col("guid") == F.col("_g"), "left").drop("_g")


def user_sets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, bucket, users: the set of ``num`` per key."""
    return rows.filter("num IS NOT NULL").groupBy(*keys, F.bitmap_bucket_number("num").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("num")).alias("users"))


def united(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sets of several rows per key as one, e.g. of the days of a span."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def set_sizes(sets: DataFrame, keys: Sequence[str], out: str = "uv_cnt") -> DataFrame:
    """Users per key; a key has one row per bucket here."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).cast("long").alias(out))


def members(sets: DataFrame, dictionary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, guid of every user of the sets."""
    d = dictionary.select("guid", F.bitmap_bucket_number("num").alias("_b"), F.bitmap_bit_position("num").alias("_bit"))
    byte = F.conv(F.hex(F.substring("users", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1 = 1")
    return (d.join(sets, F.col("_b") == F.col("bucket")).withColumn("_byte", byte).filter(there).select(*keys, "guid"))
