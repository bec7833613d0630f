"""Readers and the idempotent day-partition writer."""

from pyspark.sql import functions as F

from conftest import rows
from plover.session import scratch_path
from plover.sources import io


def test_csv_schema_and_header(spark, tmp_path):
    p = tmp_path / "ui.csv"
    p.write_text("guid,first_dt\n1,2020-05-20\n2,2020-05-22\n")
    df = io.read_csv(spark, str(p), "guid long, first_dt date", header=True)
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "date"]
    assert df.count() == 2
    named = io.read_csv_named(spark, str(p), ["a", "b"])
    assert named.columns == ["a", "b"] and named.count() == 3


def test_partition_overwrite_is_idempotent(spark):
    path = scratch_path(spark, "test-parts")
    day1 = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "x int, dy string") \
        .withColumn("dy", F.col("dy").cast("date"))
    io.write_partitions(day1, path)
    io.write_partitions(day1.filter("x = 2"), path)   # re-run of one day
    io.write_partitions(day1.filter("x = 2"), path)
    assert rows(spark.read.parquet(path), "x") == [(1,), (2,)]
    one = io.read_table(spark, path, day="2024-01-02")
    assert rows(one, "x") == [(2,)]


def test_catalog_partitioned_table(spark):
    from pyspark.sql import types as T

    from plover.sources import catalog

    loc = scratch_path(spark, "catalog-table")
    schema = T.StructType([T.StructField("guid", T.StringType()), T.StructField("bitmap", T.LongType()),
                           T.StructField("dy", T.DateType())])
    catalog.create_partitioned_table(spark, "plover_test_bitmap", schema, ["dy"], location=loc)
    try:
        df = spark.createDataFrame([("a", 1, "2024-01-01"), ("b", 3, "2024-01-02")], "guid string, bitmap long, dy string") \
            .withColumn("dy", F.col("dy").cast("date"))
        catalog.insert_partitions(df, "plover_test_bitmap")
        catalog.insert_partitions(df.filter("guid = 'b'").withColumn("bitmap", F.lit(7).cast("long")),
                                  "plover_test_bitmap")
        assert rows(spark.table("plover_test_bitmap"), "guid", "bitmap") == [("a", 1), ("b", 7)]
        catalog.create_table_as(df, "plover_test_bitmap")  # exists: left as is
        assert spark.table("plover_test_bitmap").count() == 2
        assert "default" in catalog.databases(spark)
    finally:
        spark.sql("DROP TABLE IF EXISTS plover_test_bitmap")


def test_broken_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,x,s\n1,1.5,a\n2,oops,b\n3,2.5\n4,3.5,d,e\n,,\n5,,\"q,r\"\n")
    (tmp_path / "b.csv").write_text("k,x,s\nnine,1,a\n")
    good, bad = io.read_csv_quarantine(spark, str(tmp_path), "k long, x double, s string", header=True)
    assert {tuple(r) for r in good.collect()} == {(1, 1.5, "a"), (None, None, None), (5, None, "q,r")}
    assert sorted(r["line"] for r in bad.collect()) == ["2,oops,b", "3,2.5", "4,3.5,d,e", "nine,1,a"]
    assert good.select("k").count() == 3 and good.filter("k > 1").count() == 1  # judged by all fields
    by_file = spark.createDataFrame([("x",), ("x",), ("y",)], "file string")
    broken = spark.createDataFrame([("y", "l"), ("z", "l")], "file string, line string")
    assert rows(io.line_counts(by_file, broken)) == [("x", 2, 0), ("y", 2, 1), ("z", 1, 1)]


def test_text_scan_and_catalog_table(spark, tmp_path):
    (tmp_path / "t.txt").write_text("one\n\ntwo words\n")
    assert rows(io.read_text(spark, str(tmp_path / "t.txt"))) == [("",), ("one",), ("two words",)]
    name = "plover_test_saved"
    try:
        df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
        io.save_table(df, name, ["p"])
        io.save_table(df.filter("x = 2"), name, ["p"], mode="append")
        assert rows(io.read_table(spark, name), "x", "p") == [(1, "a"), (2, "b"), (2, "b")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
