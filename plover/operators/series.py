"""Gap-filled series: last observation carried forward (W30) and the
range-join form (W31).

A series is one row per (by…, date) with a nullable value. Both forms are
skew-safe: the scan and the join run per (key, date bucket), never over one
key's whole history in one task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_EPOCH = _dt.date(1970, 1, 1)


def _bucket(date: str, days: int):
    return F.floor(F.datediff(F.col(date), F.lit(_EPOCH)) / F.lit(days)).cast("long")


def forward_fill(series: DataFrame, date: str, value: str, by: Sequence[str] = (),
                 bucket_days: int = 31, out: str | None = None) -> DataFrame:
    """Each row's value, or the latest non-null value before it (W30).

    Within a (key, bucket) window ``last(ignorenulls)`` fills locally; the
    latest known value of the earlier buckets comes from a summary with
    one row per (key, bucket) and is joined back.
    """
    by = list(by)
    out = out or value
    d = series.withColumn("_bk", _bucket(date, bucket_days))
    w = Window.partitionBy(*by, "_bk").orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_loc", F.last(value, ignorenulls=True).over(w))
    summ = (d.filter(F.col(value).isNotNull()).groupBy(*by, "_bk")
            .agg(F.max_by(value, F.col(date)).alias("_lastv")))
    wk = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    spine = d.select(*by, "_bk").distinct().join(summ, [*by, "_bk"], "left")
    carry = spine.select(*by, "_bk", F.last("_lastv", ignorenulls=True).over(wk).alias("_carry"))
    d = d.join(carry, [*by, "_bk"], "left")
    return d.withColumn(out, F.coalesce(F.col("_loc"), F.col("_carry"))).drop("_bk", "_loc", "_carry")


def fill_by_range_join(series: DataFrame, date: str, value: str, by: Sequence[str] = (),
                       bucket_days: int = 31, ordered: bool = False) -> DataFrame:
    """Unknown dates take the value of the known interval [date, next known
    date] that contains them; known rows are kept (W31). As in the
    reference, dates after the last known value stay unfilled and are not
    returned (SURVEY Q35).

    The non-equi join is made an equi-join on (key, bucket): each interval
    is listed once per date bucket it touches, so each unknown row meets
    only the intervals of its own bucket, never all intervals of its key.
    ``ordered`` sorts the result by (by…, date) as the reference prints it.
    """
    by = list(by)
    known = series.filter(F.col(value).isNotNull())
    # next known date: inside the (key, bucket), else the first of the key's next bucket,
    # which comes from a summary with one row per (key, bucket)
    k = known.withColumn("_kb", _bucket(date, bucket_days))
    firsts = k.groupBy(*by, "_kb").agg(F.min(date).alias("_d"))
    after = firsts.select(*by, "_kb", F.lead("_d").over(Window.partitionBy(*by).orderBy("_kb")).alias("_n"))
    inside = F.lead(date).over(Window.partitionBy(*by, "_kb").orderBy(date))
    iv = (k.withColumn("_in", inside).join(after, [*by, "_kb"])
          .select(*by, F.col(date).alias("_s"), F.col(value).alias("_v"), F.coalesce("_in", "_n", date).alias("_e")))
    iv = iv.withColumn("_bk", F.explode(F.sequence(_bucket("_s", bucket_days), _bucket("_e", bucket_days))))
    unknown = series.filter(F.col(value).isNull()).withColumn("_bk", _bucket(date, bucket_days))
    filled = (unknown.join(iv, [*by, "_bk"])
              .filter(F.col(date).between(F.col("_s"), F.col("_e")))
              .select(*by, date, F.col("_v").alias(value)))
    out = filled.unionByName(known.select(*by, date, value))
    # the reference orders by date; a global (range-partitioned) sort only on request
    return out.orderBy(*by, date) if ordered else out
