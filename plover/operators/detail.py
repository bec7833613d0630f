"""Detail layer: clean (W01), sessionize (W02), new-user flag (W06) and the
device–account identity binding (W07–W10)."""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plover.functions.columns import is_blank, not_blank
from plover.operators.joins import rekeyed, spread_key
from plover.operators.scan import affine_scan


def clean_events(log: DataFrame) -> DataFrame:
    """Keep rows with an identity, properties, non-blank event and session
    ids and coordinates strictly inside the valid range (W01). One filter,
    pushed to the scan where the source allows it."""
    return log.filter(
        F.coalesce(F.col("account"), F.col("deviceid")).isNotNull()
        & F.col("properties").isNotNull()
        & not_blank("eventid") & not_blank("sessionid")
        & (F.col("latitude") > -90) & (F.col("latitude") < 90)
        & (F.col("longitude") > -180) & (F.col("longitude") < 180)
    )


def sessionize(log: DataFrame, key: str = "sessionid", ts: str = "timestamp",
               gap_ms: int = 30 * 60 * 1000, tiebreak: str | None = None,
               bucket_ms: int | None = None, out: str = "newsession") -> DataFrame:
    """Split each incoming session at inactivity gaps of at least ``gap_ms``
    (W02); every event gets ``out`` = key‖'-'‖n, n counting sessions from 1.

    Time is cut into buckets no wider than the gap. Two events of one
    bucket are less than a gap apart, so a session can only start at the
    first event of a bucket, and it does when the previous non-empty bucket
    of the key ended at least a gap earlier. The session number is
    therefore a property of the (key, bucket): one partial aggregate
    (first and last timestamp per bucket), a window per key over its
    buckets – one row per bucket, not per event – and a join back on
    (key, bucket). No event-level sort is needed and a key holding a large
    share of the rows is spread over its buckets. ``tiebreak`` is accepted
    for symmetry with the other scans; equal timestamps always share a
    session.
    """
    b_ms = bucket_ms or gap_ms
    if b_ms > gap_ms:
        raise ValueError("bucket_ms must not exceed gap_ms")
    df = log.withColumn("_b", F.floor(F.col(ts) / F.lit(b_ms)).cast("long"))
    wk = Window.partitionBy(key).orderBy("_b")
    summ = df.groupBy(key, "_b").agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    prev_last = F.lag("_last").over(wk)
    summ = summ.withColumn("_start", F.when(prev_last.isNull() | (F.col("_first") - prev_last >= gap_ms), 1)
                           .otherwise(0))
    summ = summ.select(key, "_b", F.sum("_start").over(wk.rowsBetween(Window.unboundedPreceding, 0))
                       .cast("long").alias("_seq"))
    j = df.join(summ, [key, "_b"], "left")
    # a null incoming key gives a null session id (it matches no summary row)
    return j.withColumn(out, F.concat(F.col(key), F.lit("-"), F.col("_seq").cast("string"))).drop("_b", "_seq")


def flag_new_users(log: DataFrame, history: DataFrame, account: str = "account",
                   out: str = "newuser") -> DataFrame:
    """newuser = 1 when the account is missing/blank or absent from
    ``history`` (any DataFrame with the account column), else 0 (W06).

    Exact membership by a left join to the distinct historical accounts
    (partial-aggregated distinct, shuffled anew so that AQE can split a hot
    account; blank accounts are spread, since they match nothing) – in place
    of an undersized bloom filter (SURVEY Q07).
    """
    known = rekeyed(history.select(F.col(account).alias("_acc")).filter(not_blank("_acc")).distinct(), "_acc")
    known = known.withColumn("_known", F.lit(1))
    j = log.withColumn("_key", spread_key(F.col(account), not_blank(account)))
    j = j.join(known, j["_key"] == known["_acc"], "left")
    return j.withColumn(out, F.when(F.col("_known").isNull(), 1).otherwise(0)).drop("_key", "_acc", "_known")


def flag_new_users_by_day(log: DataFrame, account: str = "account", day: str = "dy",
                          out: str = "newuser", seen: DataFrame | None = None) -> DataFrame:
    """W06 for every day of ``log`` at once: history of day d = the accounts
    seen before d, i.e. newuser = 1 unless the account was first seen on an
    earlier day. One aggregate (first day per account) and one join.
    ``seen`` (default ``log``) is where first days are taken from – pass the
    cheapest frame with the same (account, day) rows, so that a long
    upstream chain is not recomputed for the aggregate."""
    src = log if seen is None else seen
    first = rekeyed(src.filter(not_blank(account)).groupBy(F.col(account).alias("_acc"))
                    .agg(F.min(day).alias("_first")), "_acc")
    j = log.withColumn("_key", spread_key(F.col(account), not_blank(account)))
    j = j.join(first, j["_key"] == first["_acc"], "left")
    newuser = F.when(is_blank(account) | (F.col("_first") >= F.col(day)), 1).otherwise(0)
    return j.withColumn(out, newuser).drop("_key", "_acc", "_first")


def device_account_scores(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Binding score per (deviceid, account): 100 × distinct sessions, and
    the latest timestamp (W07). ``by`` adds grouping keys such as the day."""
    return log.groupBy(*by, "deviceid", "account").agg(
        (F.count_distinct("sessionid") * 100).cast("double").alias("score"),
        F.max("timestamp").cast("double").alias("timestamp"),
    )


def _advance(df: DataFrame, day: str | None) -> DataFrame:
    return df if day is None else df.withColumn(day, F.date_add(F.col(day), 1))


def rollover_scores(prev: DataFrame, today_log: DataFrame, day: str | None = None,
                    decay: float = 0.5) -> DataFrame:
    """Today's score table from yesterday's and today's log (W08).

    Non-blank pairs of today are full-joined to yesterday on (deviceid,
    account): both → sum, only yesterday → × ``decay``, only today → today's;
    timestamp is today's else yesterday's. Devices seen today only with a
    blank account and unknown to yesterday's table are added as they are.
    With ``day`` set, ``prev`` may hold many days: day d's rows roll into
    day d+1 of ``today_log`` in the same job.
    """
    keys = ([day] if day else [])
    cur = device_account_scores(today_log, by=keys)
    cur_named = cur.filter(not_blank("account"))
    cur_blank = cur.filter(is_blank("account"))
    p = _advance(prev.select(*keys, "deviceid", "account", "timestamp", "score"), day)
    pn = p.select(*keys, "deviceid", "account", F.col("timestamp").alias("p_ts"), F.col("score").alias("p_score"),
                  F.lit(1).alias("p_hit"))
    cn = cur_named.select(*keys, "deviceid", "account", F.col("timestamp").alias("c_ts"),
                          F.col("score").alias("c_score"), F.lit(1).alias("c_hit"))
    both = pn.join(cn, keys + ["deviceid", "account"], "full")
    score = (F.when(F.col("p_hit").isNotNull() & F.col("c_hit").isNotNull(), F.col("p_score") + F.col("c_score"))
             .when(F.col("p_hit").isNotNull(), F.col("p_score") * F.lit(decay))
             .otherwise(F.col("c_score")))
    rolled = both.select(*keys, "deviceid", "account", F.coalesce("c_ts", "p_ts").alias("timestamp"),
                         score.alias("score"))
    # the table is matched with today's blank devices, which are few, and not the other way round
    known = p.select(*keys, "deviceid").join(cur_blank.select(*keys, "deviceid").distinct(), keys + ["deviceid"], "left_semi")
    new_dev = cur_blank.join(known.distinct(), keys + ["deviceid"], "left_anti")
    return rolled.unionByName(new_dev.select(*keys, "deviceid", "account", "timestamp", "score"))


def rolled_scores(daily: DataFrame, last_day, day: str = "dy", decay: float = 0.5, first_day=None) -> DataFrame:
    """The score table at the end of every day up to ``last_day``, as W08's
    roll from day to day leaves it for the named pairs: deviceid, account,
    timestamp, score, ``day``. ``daily``: W07 by day.

    A day turns a score s into s + the day's score, or into ``decay`` * s: an
    affine map. Days are cut into buckets. Inside a bucket a hit's score is a
    running sum of the hits, each weighted by the days missed since the
    bucket's start; the bucket as a whole is one affine map, and what enters a
    bucket is the scan over the maps of the buckets before it (one row per pair
    and bucket). The rows between two hits follow from the first one. No pair's
    days are gathered, and the work is linear in the hits and the rows returned.
    ``first_day``, if known, bounds the number of scan steps.
    """
    if not 0 < decay <= 1:
        raise ValueError("decay must be above 0 and at most 1")
    # weights of a bucket stay below decay^-size, far inside the range of doubles
    size = 400 if decay == 1 else max(1, min(400, int(300 / -math.log(decay))))
    last = F.lit(last_day).cast("date")
    pair = ["deviceid", "account"]
    at = F.unix_date(F.col(day))
    d = daily.filter(not_blank("account") & (F.col(day) <= last)).select(
        *pair, F.col(day).alias("_d"), "score", "timestamp", F.floor(at / size).cast("long").alias("_b"),
        F.pmod(at, F.lit(size)).alias("_in"))
    w = Window.partitionBy(*pair, "_b").orderBy("_d")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_miss", F.col("_in") - F.row_number().over(w) + 1)  # days without a hit since the bucket's start
    d = d.select("*", F.sum(F.col("score") * F.pow(F.lit(1.0 / decay), "_miss")).over(upto).alias("_sum"),
                 F.last("timestamp", ignorenulls=True).over(upto).alias("_ts"), F.lead("_d").over(w).alias("_next"))
    # one row per pair and bucket: misses, what its hits leave at its end, last timestamp, first day
    buckets = d.groupBy(*pair, "_b").agg(
        (F.lit(size) - F.count(F.lit(1))).alias("_m"), F.max_by("_sum", "_d").alias("_end"),
        F.max_by("_ts", "_d").alias("_end_ts"), F.min("_d").alias("_first"))
    wb = Window.partitionBy(*pair).orderBy("_b")
    empty = (F.coalesce(F.lead("_b").over(wb), F.col("_b") + 1) - F.col("_b") - 1) * size
    buckets = buckets.select(
        "*", F.pow(F.lit(decay), F.col("_m") + empty).alias("_f"), F.lead("_first").over(wb).alias("_after"),
        F.last("_end_ts", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_ts_in"))
    first = _dt.date.min if first_day is None else first_day
    n = (_as_date(last_day) - _as_date(first)).days // size + 2
    buckets = affine_scan(buckets, pair, "_b", F.col("_f"), F.col("_f") * F.col("_end"), n, "_in_score")
    buckets = rekeyed(buckets.select(*pair, "_b", "_in_score", "_ts_in", "_after"), *pair, "_b")
    d = d.join(buckets, [*pair, "_b"]).select(
        *pair, "_d", (F.pow(F.lit(decay), "_miss") * (F.col("_in_score") + F.col("_sum"))).alias("_s"),
        F.coalesce("_ts", "_ts_in").alias("timestamp"),
        F.coalesce(F.date_sub(F.coalesce("_next", "_after"), 1), last).alias("_until"))
    return d.select("*", F.explode(F.sequence("_d", "_until")).alias(day)).select(
        *pair, "timestamp", (F.col("_s") * F.pow(F.lit(decay), F.datediff(day, "_d"))).alias("score"), day)


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def best_account(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Highest-score account per device, then latest timestamp, then the
    larger account on a full tie (W09). Blank accounts never win (Q50).
    ``max_by`` over a struct is a partial aggregate, so a device bound to
    very many accounts is combined map-side instead of sorted in one task."""
    s = scores.filter(not_blank("account"))
    return s.groupBy(*by, "deviceid").agg(
        F.max_by("account", F.struct("score", "timestamp", "account")).alias("account"))


def assign_guid(log: DataFrame, best: DataFrame, day: str | None = None) -> DataFrame:
    """guid = the event's account, else the device's best account, else the
    device id (W10). With ``day`` set, ``best`` of day d serves day d+1."""
    keys = ([day] if day else [])
    b = rekeyed(_advance(best.select(*keys, "deviceid", F.col("account").alias("_bind")), day), *keys, "deviceid")
    j = log.join(b, keys + ["deviceid"], "left")
    guid = F.coalesce(F.when(not_blank("account"), F.col("account")),
                      F.when(not_blank("_bind"), F.col("_bind")), F.col("deviceid"))
    return j.withColumn("guid", guid).drop("_bind")
