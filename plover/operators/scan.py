"""Skew-safe ordered scans.

A window partitioned only by a user key sorts all of that key's rows in
one task; if one key holds a third of the data, that task holds a third of
the data. These helpers window by (key, bucket) instead, where ``bucket``
is a coarse, order-preserving slice of the ordering column (e.g. the hour),
and carry what crosses a bucket border through a summary with one row per
(key, bucket). The big side is shuffled once on (key, bucket); the carry is
computed on the summary, whose size is keys × buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_bucket(ts, size: int) -> Column:
    """Order-preserving bucket of a numeric ordering column."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(c / F.lit(size)).cast("long")


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], flag: Column,
                  bucket: Column, out: str, inclusive: bool = True, total: str | None = None,
                  total_of: Column | None = None) -> DataFrame:
    """Add ``out`` = Σ ``flag`` over the rows of the same ``keys`` that come
    before each row in ``order`` (and the row itself when ``inclusive``).
    ``bucket`` must be non-decreasing in ``order``. With ``total`` set, the
    key's grand total of ``flag`` (or of ``total_of``) is added as that column."""
    keys = list(keys)
    d = df.withColumn("_f", flag.cast("long")).withColumn("_bk", bucket)
    d = d.withColumn("_t", (flag if total_of is None else total_of).cast("long"))
    w = Window.partitionBy(*keys, "_bk").orderBy(*order)
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    d = d.withColumn("_loc", F.coalesce(F.sum("_f").over(frame), F.lit(0).cast("long")))
    wk = Window.partitionBy(*keys).orderBy("_bk")
    summ = d.groupBy(*keys, "_bk").agg(F.sum("_f").alias("_n"), F.sum("_t").alias("_nt"))
    cols = [*keys, "_bk",
            F.coalesce(F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")]
    if total:
        cols.append(F.sum("_nt").over(Window.partitionBy(*keys)).cast("long").alias(total))
    d = d.join(summ.select(*cols), [*keys, "_bk"], "left")
    return d.withColumn(out, (F.col("_loc") + F.col("_off")).cast("long")).drop("_f", "_t", "_bk", "_loc", "_off")


def affine_scan(df: DataFrame, keys: Sequence[str], order: str, factor: Column, offset: Column, rows: int, out: str) -> DataFrame:
    """Adds ``out`` = the value that enters each row when every earlier row of
    the same ``keys`` turned x into factor * x + offset, starting from 0.

    Affine maps compose to affine maps, so the composition of all earlier rows
    is a prefix scan by doubling: after k steps a row holds the composition of
    its last 2^k maps. ``rows`` bounds the rows of a key; ceil(log2(rows))
    windows of one partitioning and order follow, so it is for summaries (a
    row per key and bucket), not for events."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = df.withColumn("_a", factor.cast("double")).withColumn("_c", offset.cast("double"))
    step = 1
    while step < rows:
        a, c = F.lag("_a", step).over(w), F.lag("_c", step).over(w)
        d = d.select("*", a.alias("_pa"), c.alias("_pc"))
        # no map that far back: what is there already is the whole composition
        d = (d.withColumn("_c", F.col("_a") * F.coalesce("_pc", F.lit(0.0)) + F.col("_c"))
             .withColumn("_a", F.col("_a") * F.coalesce("_pa", F.lit(1.0))).drop("_pa", "_pc"))
        step *= 2
    return d.withColumn(out, F.coalesce(F.lag("_c").over(w), F.lit(0.0))).drop("_a", "_c")
