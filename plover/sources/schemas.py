"""Explicit schemas of the warehouse tables (no inference in library code)."""

from pyspark.sql import types as T

ACTIVITY_RANGES = T.StructType([
    T.StructField("first_dt", T.DateType()),
    T.StructField("guid", T.StringType()),
    T.StructField("range_start", T.DateType()),
    T.StructField("range_end", T.DateType()),
])

SCORES = T.StructType([
    T.StructField("deviceid", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
])
