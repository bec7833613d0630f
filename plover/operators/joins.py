"""Join help for hot keys.

AQE splits a hot partition of a join only if both sides come straight from
a shuffle of their own and nothing above the join relies on its
partitioning. A side that is an aggregate on the join key is partitioned
already and gets no such shuffle; an aggregate on the same key above the
join relies on it. ``rekeyed`` hides the partitioning in both cases.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rekeyed(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with the same rows and columns, but key columns that Spark does not
    know to be partitioned: a join or aggregate on them shuffles again. For
    the side with one row per key, this is the cheap side to shuffle."""
    return df.withColumns({k: F.element_at(F.array(F.col(k)), 1) for k in keys})


def join_by_frequency(df: DataFrame, keyed: DataFrame, key: str, n: str, most: int,
                      how: str = "inner", key_bytes: int = 256, task_rows: int = 2_000_000) -> DataFrame:
    """``df`` joined with ``keyed``, a stored table with one row per key, whose
    column ``n`` tells about how many rows of ``df`` have the key.

    The most frequent keys, at most ``most``, are broadcast: words are so
    distributed that these have nearly all rows, which then are neither shuffled
    nor sorted. The rows of all other keys (and keys longer than ``key_bytes``)
    are shuffled, about ``task_rows`` to a task. With broadcasts off all rows are.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return df.join(keyed, key, how)
    # a row per power of two
    levels = keyed.groupBy(F.floor(F.log2(n)).alias("l")).agg(F.count(F.lit(1)).alias("k"), F.sum(n).alias("n")).collect()
    cut, room, rest = None, most, 0
    for x in sorted(levels, key=lambda x: -x["l"]):
        room -= x["k"]
        if room >= 0:
            cut = 2 ** x["l"]
        else:
            rest += x["n"]
    short = F.octet_length(F.col(key).cast("string")) <= key_bytes
    hot = (F.col(n) >= cut) & short if cut else F.lit(False)
    head = F.broadcast(keyed.filter(hot))
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(rest / task_rows))
    tail = df.join(F.broadcast(keyed.filter(hot).select(key)), key, "left_anti").repartition(parts, key)
    return df.join(head, key).unionByName(tail.join(keyed.filter(~hot).repartition(parts, key), key, how))


def spread_key(key: Column, usable: Column) -> Column:
    """``key`` (text) where it can match; elsewhere a text that no key equals,
    one per input partition, so rows without a key don't meet in one task."""
    nowhere = F.concat(F.lit("\u0000"), F.spark_partition_id().cast("string"))
    return F.when(usable, key).otherwise(nowhere)
