"""Readers and writers, all built-in Spark sources/sinks.

Every reader takes an explicit schema; nothing is inferred in library code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False,
             null_value: str | None = None) -> DataFrame:
    """CSV with an explicit schema; ``header`` skips the first line."""
    r = spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def read_csv_quarantine(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False,
                        null_value: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, broken): the lines that fit the schema, and file, line of those that
    don't – too few or too many fields, or a value of another type. Nothing is
    lost or guessed: every line but a header or a blank one is in one of the two."""
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    line = "_broken_line"
    full = T.StructType([*schema.fields, T.StructField(line, T.StringType())])
    # without pruning a line is judged by all its fields, whatever a query selects
    r = (spark.read.schema(full).option("header", str(header).lower()).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", line).option("columnPruning", "false").option("enforceSchema", "true"))
    if null_value is not None:
        r = r.option("nullValue", null_value)
    df = r.csv(path).select("*", F.col("_metadata.file_path").alias("file"))
    # Spark refuses a plan that reads the broken lines alone, so a test that always holds names the fields
    fields = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.names])) >= 0
    rows = df.filter(F.col(line).isNull() & fields).select(*schema.names)
    return rows, df.filter(F.col(line).isNotNull() & fields).select("file", F.col(line).alias("line"))


def line_counts(rows_by_file: DataFrame, broken: DataFrame) -> DataFrame:
    """file, n_lines, n_broken of a load: ``rows_by_file`` has a row (file) per good line."""
    both = rows_by_file.select("file", F.lit(0).alias("b")).unionByName(broken.select("file", F.lit(1).alias("b")))
    return both.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("b").cast("long").alias("n_broken"))


def read_csv_named(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Headerless CSV, all strings, columns renamed by position (``toDF``)."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One ``value`` string column per line."""
    return spark.read.text(path)


def read_table(spark: SparkSession, name_or_path: str, day: str | None = None, day_col: str = "dy") -> DataFrame:
    """A catalog table or a parquet folder, optionally one day partition
    (the filter prunes partitions at planning time)."""
    df = spark.read.parquet(name_or_path) if "/" in name_or_path else spark.read.table(name_or_path)
    if day is not None:
        df = df.filter(F.col(day_col) == F.lit(day).cast("date"))
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A database table; with a numeric ``partition_column`` the read is split
    into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str] = ("dy",),
                     fmt: str = "parquet") -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition
    overwrite), so re-running one day replaces that day instead of
    appending a second copy (SURVEY Q44).

    The rebalance hint lets AQE shape the write: rows of a day are grouped
    into few tasks sized to the advisory partition size, and a day too big
    for one task is split, so neither tiny files nor one giant task."""
    (df.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))


def write_day(df: DataFrame, path: str, day: str, day_col: str = "dy") -> None:
    """Replace one day's partition of a day-partitioned folder, also by nothing:
    the folder of that day is overwritten as a whole, so an empty result
    leaves no rows of an earlier run."""
    df.drop(day_col).hint("rebalance").write.mode("overwrite").parquet(f"{path.rstrip('/')}/{day_col}={day}")


def save_table(df: DataFrame, name: str, partition_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Catalog table (CTAS / INSERT)."""
    w = df.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "append") -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
