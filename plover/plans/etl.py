"""Detail ETL (W16): clean → sessionize → geo → IP fallback → new-user flag
→ guid, written as day partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.operators import detail as D
from plover.operators import geo as GEO
from plover.session import remove_path, scratch_path, stored
from plover.sources.io import write_partitions


def detail_etl(log: DataFrame, geo_dict: DataFrame, ip_ranges: DataFrame, gap_ms: int = 30 * 60 * 1000,
               tiebreak: str | None = None, day: str = "dy", history: DataFrame | None = None,
               prev_best: DataFrame | None = None) -> DataFrame:
    """The whole detail chain as one lazy plan; nothing runs until the write.

    ``log`` may hold many days. The new-user flag uses ``history`` when
    given (accounts known before the log), else each account's first day in
    the log. Guids use ``prev_best`` (device → account of the previous day)
    when given, else the best accounts of the log's own previous day, by
    scores rolled from day to day (W08), so that a device without events
    on one day keeps its account.
    """
    return _enrich(D.clean_events(log), geo_dict, ip_ranges, gap_ms, tiebreak, day, history, prev_best)


def _enrich(clean, geo_dict, ip_ranges, gap_ms=30 * 60 * 1000, tiebreak=None, day="dy", history=None, prev_best=None):
    s = D.sessionize(clean, tiebreak=tiebreak, gap_ms=gap_ms)
    g = GEO.ip_region_enrich(GEO.geo_enrich(s, geo_dict), ip_ranges)
    flagged = (D.flag_new_users(g, history) if history is not None
               else D.flag_new_users_by_day(g, day=day, seen=clean))
    if prev_best is None:
        first, last = clean.agg(F.min(day), F.max(day)).first()  # two dates
        if last is None:
            return D.assign_guid(flagged, clean.select("deviceid", "account", day).limit(0), day=day)
        rolled = D.rolled_scores(D.device_account_scores(clean, by=[day]), last, day, first_day=first)
        prev_best = D.best_account(rolled, by=[day])
        return D.assign_guid(flagged, prev_best, day=day)
    return D.assign_guid(flagged, prev_best)


def run_detail_etl(log: DataFrame, geo_dict: DataFrame, ip_ranges: DataFrame, out_path: str, **kw) -> None:
    """Run :func:`detail_etl` and overwrite the day partitions it produced. The
    log is scanned once: the cleaned rows are stored, and the summaries
    (sessions, first days, scores) are read from them."""
    spark = log.sparkSession
    path = scratch_path(spark, "clean")
    clean = stored(D.clean_events(log), path)
    write_partitions(_enrich(clean, geo_dict, ip_ranges, **kw), out_path, ["dy"])
    remove_path(spark, path)
