"""One day of the service layer on day-partitioned tables.

Reads only today's partition of the detail table and yesterday's partition
of each state table (partition pruning on ``dy``), computes today's session
aggregate, traffic cube, activity ranges and activity bitmap, and
overwrites today's partitions. Running a day again replaces that day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plover.operators import activity as A
from plover.operators import sessions as S
from plover.sources import schemas
from plover.sources.io import read_table, write_day

SESSIONS, CUBE, RANGES, BITMAP = "sessions", "traffic_cube", "activity_ranges", "activity_bitmap"
INTERVALS, ACTIVE_DAYS, DETAIL = "visit_intervals", "active_days", "detail"


def _state(spark: SparkSession, root: str, name: str, day, schema) -> DataFrame:
    """Yesterday's partition of a state table, or an empty table on the first day."""
    if day is None:
        return spark.createDataFrame([], schema)
    return read_table(spark, f"{root}/{name}", day=str(day)).drop("dy")


def run_service_day(spark: SparkSession, detail_path: str, out_root: str, dy: str,
                    first_day: bool = False, session_col: str = "newsession", tiebreak: str = "timestamp") -> None:
    """W17 → W18 for ``dy``, then roll W26 ranges and W32 bitmaps from the
    previous day's partitions (absent when ``first_day``), and W28 visit
    intervals and W29 active days from the day's ranges."""
    day = _dt.date.fromisoformat(dy)
    prev_day = None if first_day else day - _dt.timedelta(days=1)
    detail = read_table(spark, detail_path, day=dy)
    sessions = S.session_aggregate(detail, session_col=session_col, tiebreak=tiebreak)
    write_day(sessions, f"{out_root}/{SESSIONS}", dy)
    sessions = read_table(spark, f"{out_root}/{SESSIONS}", day=dy)
    write_day(S.traffic_cube(sessions), f"{out_root}/{CUBE}", dy)

    today = sessions.select("guid").distinct()
    prev_ranges = _state(spark, out_root, RANGES, prev_day, schemas.ACTIVITY_RANGES)
    ranges = A.rollover_ranges(prev_ranges, today, cur_dy=dy)
    write_day(ranges, f"{out_root}/{RANGES}", dy)
    ranges = read_table(spark, f"{out_root}/{RANGES}", day=dy)
    write_day(A.visit_intervals(ranges, as_of=dy), f"{out_root}/{INTERVALS}", dy)
    write_day(A.active_days(ranges, as_of=dy), f"{out_root}/{ACTIVE_DAYS}", dy)

    prev_bits = _state(spark, out_root, BITMAP, prev_day, "guid string, bitmap long")
    bits = A.update_bitmap(prev_bits, today)
    write_day(bits, f"{out_root}/{BITMAP}", dy)


SCORES, LABELS = "score", "graph_labels"


def run_scores_day(spark: SparkSession, log_path: str, out_root: str, dy: str, first_day: bool = False) -> None:
    """Device–account score table of ``dy`` (W07 on the first day, else
    W08 from yesterday's partition); W09's best account of a day is
    ``best_account`` over that partition."""
    from plover.operators import detail as D

    day = _dt.date.fromisoformat(dy)
    log = read_table(spark, log_path, day=dy)
    if first_day:
        scores = D.device_account_scores(log)
    else:
        prev = _state(spark, out_root, SCORES, day - _dt.timedelta(days=1), schemas.SCORES)
        scores = D.rollover_scores(prev, log)
    write_day(scores.select("deviceid", "account", "timestamp", "score"), f"{out_root}/{SCORES}", dy)


def run_detail_day(spark: SparkSession, log_path: str, geo_dict: DataFrame, ip_ranges: DataFrame, out_root: str, dy: str,
                   first_day: bool = False, tiebreak: str | None = None) -> None:
    """Detail table of ``dy`` (W16): devices are bound by the score table that
    :func:`run_scores_day` left for the day before, and accounts of earlier
    detail days are known."""
    from plover.operators import detail as D
    from plover.plans.etl import detail_etl

    day = _dt.date.fromisoformat(dy)
    log = read_table(spark, log_path, day=dy)
    scores = _state(spark, out_root, SCORES, None if first_day else day - _dt.timedelta(days=1), schemas.SCORES)
    known = (spark.createDataFrame([], "account string") if first_day else
             read_table(spark, f"{out_root}/{DETAIL}").filter(F.col("dy") < F.lit(dy).cast("date")).select("account"))
    out = detail_etl(log, geo_dict, ip_ranges, tiebreak=tiebreak, history=known, prev_best=D.best_account(scores))
    write_day(out, f"{out_root}/{DETAIL}", dy)


def run_identity_day(spark: SparkSession, log_path: str, out_root: str, dy: str, first_day: bool = False,
                     id_cols=("account", "deviceid"), min_support: int = 2) -> None:
    """Identifier → guid labels of ``dy``: components of today's identity
    graph (W11, W12); from the second day on, yesterday's labels join the
    graph as edges (W13) and each component keeps the smallest of
    yesterday's guids found among its members (W14)."""
    from plover.operators import graph as G

    day = _dt.date.fromisoformat(dy)
    log = read_table(spark, log_path, day=dy)
    v, e = G.identity_vertices(log, id_cols), G.identity_edges(log, id_cols, "pairs", min_support)
    if first_day:
        labels = G.connected_components(v, e).select("id", F.col("component").alias("guid"))
    else:
        prev = _state(spark, out_root, LABELS, day - _dt.timedelta(days=1), "id string, guid string")
        comp = G.incremental_components(v, e, prev).select("id", F.col("component").alias("guid"))
        labels = G.carry_over_guid(comp, prev)
    write_day(labels, f"{out_root}/{LABELS}", dy)
