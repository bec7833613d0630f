"""State tables that a day's roll need not shuffle: catalog tables bucketed by
their key.

A table of scores, ranges or bitmaps (W08, W26, W32) has a row or a few per
key and is joined with the day's keys every day. Stored in buckets of the
key, it is read as if it had been shuffled already, so only the day's rows move.
The join's tasks hold one bucket each, and the new state is written from
them without a shuffle either. Each day has a table of its own; the one
before is dropped when it is no longer needed.

``buckets`` should be at least ``spark.sql.shuffle.partitions`` (Spark shuffles
the side with fewer partitions) and give files of a few hundred MB.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def save_state(df: DataFrame, name: str, keys: Sequence[str], buckets: int, rolled: bool = False) -> DataFrame:
    """Writes ``df`` as the bucketed table ``name`` and reads it back. ``rolled``:
    ``df`` comes from a join with a state of the same keys and buckets, so its
    tasks hold whole buckets; otherwise it is shuffled by the keys once."""
    out = df if rolled else df.repartition(buckets, *keys)
    out.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def drop_state(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
