"""Day-by-day service runs on partitioned tables: rolled state equals the
state rebuilt from scratch, and re-running a day changes nothing."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from plover.operators import activity as A
from plover.operators import geo as GEO
from plover.plans import daily, etl
from plover.plans import queries as Q
from plover.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_service_days_roll_and_rerun(spark):
    log = Q._log(spark, SF).filter(F.col("dy") <= F.lit("2024-01-04").cast("date"))
    detail_path = scratch_path(spark, "daily-detail")
    etl.run_detail_etl(log, GEO.build_geo_dictionary(Q.geo_lines(spark, SF)),
                       GEO.parse_ip_regions(Q.ip_lines(spark, SF)), detail_path, tiebreak="event_id")
    root = scratch_path(spark, "daily-state")
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    for i, d in enumerate(days):
        daily.run_service_day(spark, detail_path, root, d, first_day=(i == 0))
    daily.run_service_day(spark, detail_path, root, days[2])  # re-run one day
    daily.run_service_day(spark, detail_path, root, days[3])

    sessions = spark.read.parquet(f"{root}/{daily.SESSIONS}")
    act = sessions.select("guid", F.col("dy").cast("date").alias("dy")).distinct()
    last = dt.date(2024, 1, 4)
    want_ranges = A.range_snapshots(act, last_day=last).filter(F.col("dy") == F.lit(last))
    got_ranges = spark.read.parquet(f"{root}/{daily.RANGES}").filter(F.col("dy") == F.lit(last))
    cols = ("guid", "first_dt", "range_start", "range_end")
    assert rows(got_ranges, *cols) == rows(want_ranges, *cols)
    want_bits = A.bitmap_snapshots(act, last_day=last).filter(F.col("dy") == F.lit(last))
    got_bits = spark.read.parquet(f"{root}/{daily.BITMAP}").filter(F.col("dy") == F.lit(last))
    assert rows(got_bits, "guid", "bitmap") == rows(want_bits, "guid", "bitmap")
    # one copy of each day's sessions despite the re-runs
    per_day = rows(sessions.groupBy("dy").count(), "dy", "count")
    assert len(per_day) == 4
    assert sessions.count() == sessions.select("guid", "sessionId", "dy").distinct().count()


def test_identity_and_score_days(spark):
    from plover.operators import detail as D

    log = Q._log(spark, SF).filter(F.col("dy") <= F.lit("2024-01-03").cast("date"))
    log_path = scratch_path(spark, "daily-log")
    from plover.sources.io import write_partitions
    write_partitions(D.clean_events(log), log_path)
    root = scratch_path(spark, "daily-id")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for i, d in enumerate(days):
        daily.run_identity_day(spark, log_path, root, d, first_day=(i == 0), min_support=0)
        daily.run_scores_day(spark, log_path, root, d, first_day=(i == 0))
    daily.run_scores_day(spark, log_path, root, days[2])  # re-run
    labels = spark.read.parquet(f"{root}/{daily.LABELS}")
    # one guid per identifier and day
    assert labels.count() == labels.select("id", "dy").distinct().count()
    # guids only merge downwards: an identifier's guid never grows from one day to the next
    a, b = labels.alias("a"), labels.alias("b")
    j = a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("b.dy") == F.date_add(F.col("a.dy"), 1)))
    assert j.count() > 0
    assert j.filter(F.col("b.guid") > F.col("a.guid")).count() == 0
    scores = spark.read.parquet(f"{root}/{daily.SCORES}")
    assert scores.count() == scores.select("deviceid", "account", "dy").distinct().count()
    day3 = scores.filter(F.col("dy") == F.lit("2024-01-03").cast("date")).drop("dy")
    prev = scores.filter(F.col("dy") == F.lit("2024-01-02").cast("date")).drop("dy")
    today = spark.read.parquet(log_path).filter(F.col("dy") == F.lit("2024-01-03").cast("date"))
    want = D.rollover_scores(prev, today)
    cols = ("deviceid", "account", "timestamp", "score")
    def collect(df):
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

    assert collect(day3) == collect(want)


def test_empty_day_replaces_the_day(spark, tmp_path):
    from plover.sources.io import read_table, write_day
    df = spark.createDataFrame([(1,), (2,)], "a int")
    for day in ("2024-01-01", "2024-01-02"):
        write_day(df, str(tmp_path / "t"), day)
    write_day(df.limit(0), str(tmp_path / "t"), "2024-01-02")
    assert read_table(spark, str(tmp_path / "t"), day="2024-01-02").count() == 0
    assert read_table(spark, str(tmp_path / "t"), day="2024-01-01").count() == 2


def test_idle_device_keeps_its_account(spark):
    import datetime as dt
    from plover.operators import detail as D
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    daily = spark.createDataFrame([("d", "a", 100.0, 1.0, days[0]), ("d", "b", 100.0, 9.0, days[3]), ("d", None, 900.0, 9.0, days[1])],
                                  "deviceid string, account string, score double, timestamp double, dy date")
    state = {(r["account"], r["dy"]): r["score"] for r in D.rolled_scores(daily, days[4]).collect()}
    assert state == {("a", days[0]): 100.0, ("a", days[1]): 50.0, ("a", days[2]): 25.0, ("a", days[3]): 12.5,
                     ("a", days[4]): 6.25, ("b", days[3]): 100.0, ("b", days[4]): 50.0}
    best = {r["dy"]: r["account"] for r in D.best_account(D.rolled_scores(daily, days[4]), by=["dy"]).collect()}
    assert best == {days[0]: "a", days[1]: "a", days[2]: "a", days[3]: "b", days[4]: "b"}
