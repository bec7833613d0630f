"""Catalog tables partitioned by day.

The warehouse tables of the reference are day-partitioned tables in a
catalog. These helpers issue the equivalent Spark SQL; data goes in with
dynamic partition overwrite so a re-run of a day replaces that day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _ddl_cols(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_partitioned_table(spark: SparkSession, name: str, schema: T.StructType,
                             partition_cols: Sequence[str] = ("dy",), location: str | None = None,
                             fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS … USING parquet PARTITIONED BY (…)``;
    the partition columns must be part of ``schema``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl_cols(schema)}) USING {fmt} "
              f"PARTITIONED BY ({', '.join(partition_cols)}){loc}")


def insert_partitions(df: DataFrame, name: str, overwrite: bool = True) -> None:
    """``INSERT [OVERWRITE] TABLE name PARTITION (dy)`` by position of the
    table's columns: only the partitions present in ``df`` are replaced."""
    spark = df.sparkSession
    cols = spark.table(name).columns
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.select(*cols).write.insertInto(name, overwrite=overwrite)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def create_table_as(df: DataFrame, name: str, if_not_exists: bool = True) -> None:
    """CTAS; with ``if_not_exists`` an existing table is left untouched."""
    df.write.mode("ignore" if if_not_exists else "errorifexists").saveAsTable(name)


def databases(spark: SparkSession) -> list[str]:
    """``SHOW DATABASES``."""
    return [d.name for d in spark.catalog.listDatabases()]
