"""Event paths and touch attribution (W20–W25).

A conversion path of a guid is its time-ordered touch and target events;
it is cut at every target. A segment is the run of touches that ends in a
target (a trailing run without a target is not a conversion). Segment ids
come from a running count of earlier targets computed by the skew-safe
bucketed scan, so no guid's events are ever gathered into one list; every
per-segment result is a plain aggregate. Order is (timestamp, event name,
tie-break), so equal timestamps are resolved deterministically (SURVEY Q21).
Results are rows (guid, conversion, …) rather than arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plover.operators.scan import running_count, time_bucket


def _order(ts: str, event: str, tiebreak: str | None):
    return [F.col(ts), F.col(event)] + ([F.col(tiebreak)] if tiebreak else [])


def _key(ts, event, tiebreak):
    return F.struct(*_order(ts, event, tiebreak))


def event_paths(events: DataFrame, touches: Sequence[str], target: str, guid: str = "guid",
                event: str = "event", ts: str = "timestamp", tiebreak: str | None = None,
                bucket_size: int = 3600 * 1000) -> DataFrame:
    """Paths of guids that reached ``target`` (W20), one row per step:
    guid, step (1-based position), event, timestamp."""
    ev = events.filter(F.col(event).isin(list(touches) + [target]))
    steps = running_count(ev, [guid], _order(ts, event, tiebreak), F.lit(1), time_bucket(ts, bucket_size), "step",
                          total="_targets", total_of=F.col(event) == target)
    return steps.filter(F.col("_targets") > 0).select(guid, "step", event, ts)


def segments(events: DataFrame, touches: Sequence[str], target: str, guid: str = "guid",
             event: str = "event", ts: str = "timestamp", tiebreak: str | None = None,
             bucket_size: int = 3600 * 1000) -> DataFrame:
    """Touch rows that belong to a conversion, with ``conversion`` = number
    of targets before the row (0-based segment id)."""
    ev = events.filter(F.col(event).isin(list(touches) + [target]))
    is_t = (F.col(event) == target)
    seg = running_count(ev, [guid], _order(ts, event, tiebreak), is_t, time_bucket(ts, bucket_size),
                        "conversion", inclusive=False, total="_targets")
    return seg.filter((F.col(event) != target) & (F.col("conversion") < F.col("_targets"))).drop("_targets")


def first_touch_overall(events: DataFrame, touches: Sequence[str], target: str, guid: str = "guid",
                        event: str = "event", ts: str = "timestamp", tiebreak: str | None = None) -> DataFrame:
    """Earliest touch of each guid that reached the target; targets are not
    cut (W21). Guids with a target but no touch get null (SURVEY Q22)."""
    ev = events.filter(F.col(event).isin(list(touches) + [target]))
    agg = ev.groupBy(guid).agg(
        F.max((F.col(event) == target).cast("int")).alias("_hit"),
        F.min_by(F.when(F.col(event) != target, F.col(event)),
                 F.when(F.col(event) != target, _key(ts, event, tiebreak))).alias("event"))
    return agg.filter(F.col("_hit") == 1).select(guid, "event")


def first_touch(events: DataFrame, touches: Sequence[str], target: str, **kw) -> DataFrame:
    """First touch of every conversion (W22): guid, conversion, event."""
    ts, event, tb = kw.get("ts", "timestamp"), kw.get("event", "event"), kw.get("tiebreak")
    guid = kw.get("guid", "guid")
    s = segments(events, touches, target, **kw)
    return s.groupBy(guid, "conversion").agg(F.min_by(event, _key(ts, event, tb)).alias("event"))


def last_touch(events: DataFrame, touches: Sequence[str], target: str, **kw) -> DataFrame:
    """Last touch of every conversion (W23): guid, conversion, event."""
    ts, event, tb = kw.get("ts", "timestamp"), kw.get("event", "event"), kw.get("tiebreak")
    guid = kw.get("guid", "guid")
    s = segments(events, touches, target, **kw)
    return s.groupBy(guid, "conversion").agg(F.max_by(event, _key(ts, event, tb)).alias("event"))


def _distinct_touches(events, touches, target, **kw):
    ts, event, tb = kw.get("ts", "timestamp"), kw.get("event", "event"), kw.get("tiebreak")
    guid = kw.get("guid", "guid")
    s = segments(events, touches, target, **kw)
    d = s.groupBy(guid, "conversion", event).agg(F.min(_key(ts, event, tb)).alias("_first"))
    return d, guid, event


def linear_attribution(events: DataFrame, touches: Sequence[str], target: str, **kw) -> DataFrame:
    """Each distinct touch of a conversion gets 100 div n (W24, integer as
    in the reference: three touches get 33 each, SURVEY Q24)."""
    d, guid, event = _distinct_touches(events, touches, target, **kw)
    n = F.count(F.lit(1)).over(Window.partitionBy(guid, "conversion"))
    return d.select(guid, "conversion", event, (F.lit(100) / n).cast("int").alias("weight"))


def decay_attribution(events: DataFrame, touches: Sequence[str], target: str, base: float = 0.9,
                      newest_first: bool = False, **kw) -> DataFrame:
    """Distinct touches of a conversion in first-occurrence order get
    base^i / Σ base^k (W25). The earliest gets the largest weight as in the
    reference (SURVEY Q25); ``newest_first`` reverses it. The windows run
    over one conversion's distinct touches only."""
    d, guid, event = _distinct_touches(events, touches, target, **kw)
    order = F.col("_first").desc() if newest_first else F.col("_first").asc()
    i = F.row_number().over(Window.partitionBy(guid, "conversion").orderBy(order)) - 1
    d = d.withColumn("_p", F.pow(F.lit(base), i))
    tot = F.sum("_p").over(Window.partitionBy(guid, "conversion"))
    return d.select(guid, "conversion", event, (F.col("_p") / tot).alias("weight"))
