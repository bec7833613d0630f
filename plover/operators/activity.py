"""Activity state across days: validity ranges (W26), visit intervals
(W27, W28), active-days distribution (W29) and the 31-day bitmap (W32).

Daily state is state(d) = f(state(d−1), activity(d)). Every function takes
an optional ``day`` column so that many days can be rolled in one job:
state rows of day d−1 are matched with activity of day d.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plover.operators.usersets import user_sets, with_numbers

# Fixed value: the open end of a validity range.
OPEN_END = _dt.date(9999, 12, 31)


def _open():
    return F.lit(OPEN_END)


def active_users(sessions_or_log: DataFrame, day: str = "dy") -> DataFrame:
    """Distinct (guid, day) pairs: who was active on which day."""
    return sessions_or_log.select("guid", F.col(day).alias("dy")).distinct()


def rollover_ranges(prev: DataFrame, today: DataFrame, cur_dy=None, day: str | None = None,
                    new_user_open: bool = True) -> DataFrame:
    """Roll the activity-range (zipper) table by one day (W26): first_dt, guid,
    range_start, range_end (+ ``day``). ``prev`` has these columns, ``today``
    the guids (+ ``day``) of the day's active users.

    Ranges are islands of active days, and one day can only touch the island
    that reaches the day before it. So finished ranges pass through as they
    are, without a shuffle, and each guid has one small summary, combined
    map-side: when it was first seen and where its island begins. An island
    grows by the day or ends the day before; a guid without one that came
    begins a new island. On a state table bucketed by guid
    (``sources.state``) only the day's guids are shuffled. Open ranges of one guid are one
    island, from the earliest start. ``new_user_open=False`` gives unknown
    users the literal first range that ends today (SURVEY Q29).
    """
    keys = [day] if day else []
    p = prev.select(*keys, "first_dt", "guid", "range_start", "range_end")
    if day:
        p = p.withColumn(day, F.date_add(F.col(day), 1))
    now = F.col(day) if day else F.lit(cur_dy).cast("date")
    finished = p.filter(F.col("range_end") != _open())
    known = p.groupBy(*keys, "guid").agg(
        F.min("first_dt").alias("first_dt"), F.min(F.when(F.col("range_end") == _open(), F.col("range_start"))).alias("island"))
    came = today.select(*keys, "guid").distinct().withColumn("came", F.lit(True))
    per = known.join(came, [*keys, "guid"], "full").filter("came OR island IS NOT NULL")
    grows = _open() if new_user_open else F.when(F.col("first_dt").isNull(), now).otherwise(_open())
    live = per.select(F.coalesce("first_dt", now).alias("first_dt"), "guid", F.coalesce("island", now).alias("range_start"),
                      F.when(F.col("came"), grows).otherwise(F.date_sub(now, 1)).alias("range_end"), *keys)
    return finished.select("first_dt", "guid", "range_start", "range_end", *keys).unionByName(live)


def range_snapshots(active: DataFrame, first_day=None, last_day=None) -> DataFrame:
    """Zipper table of every day e from scratch (gaps and islands): for each
    run of consecutive active days [s, t] with s ≤ e, the range is [s, t]
    when t < e and [s, open] when the run reaches e. Columns first_dt, guid,
    range_start, range_end, dy (= e). ``last_day`` bounds e; the islands are
    one window per guid over its active days (one row per day)."""
    w = Window.partitionBy("guid").orderBy("dy")
    isl = (active.select("guid", "dy")
           .withColumn("_grp", F.date_sub(F.col("dy"), F.row_number().over(w).cast("int")))
           .groupBy("guid", "_grp").agg(F.min("dy").alias("s"), F.max("dy").alias("t")))
    first = active.groupBy("guid").agg(F.min("dy").alias("first_dt"))
    isl = isl.join(first, "guid")
    lo = F.col("s") if first_day is None else F.greatest(F.col("s"), F.lit(first_day).cast("date"))
    e = F.explode(F.sequence(lo, F.lit(last_day).cast("date")))
    # sequence() counts down when start > stop: keep only islands that start by last_day
    snap = isl.filter(lo <= F.lit(last_day).cast("date")).select("guid", "first_dt", "s", "t", e.alias("dy"))
    return snap.select("first_dt", "guid", F.col("s").alias("range_start"),
                       F.when(F.col("t") < F.col("dy"), F.col("t")).otherwise(_open()).alias("range_end"), "dy")


def visit_interval_detail(ranges: DataFrame, as_of=None, window_days: int = 30,
                          day: str | None = None) -> DataFrame:
    """Lengths of visits and of the gaps between them (W27): (guid, 0, days) per
    range inside the last ``window_days`` and (guid, gap in days, 1) per pair
    of neighbouring ranges. ``as_of`` is a date, or with ``day`` set each row's
    own day is its as-of.

    Each range puts its two ends on the guid's time line, cut to the window;
    along the line every step is a visit or a gap, by the kind of end it leads to.
    """
    keys = [day] if day else []
    now = F.col(day) if day else F.lit(as_of).cast("date")
    oldest = F.date_sub(now, window_days)
    ends = ranges.filter(F.col("range_end") >= oldest).select(
        *keys, "guid", F.greatest("range_start", oldest).alias("a"), F.least("range_end", now).alias("z"))
    line = ends.select(*keys, "guid", F.col("z").alias("of"), F.col("a").alias("from"), F.explode(F.array(
        F.struct(F.lit(0).alias("leaves"), F.col("a").alias("at")), F.struct(F.lit(1).alias("leaves"), F.col("z").alias("at"))))
        .alias("end"))
    along = Window.partitionBy(*keys, "guid").orderBy("of", "from", "end.leaves")
    step = F.datediff("end.at", F.lag("end.at").over(along))
    leaves = F.col("end.leaves") == 1
    return (line.select(*keys, "guid", leaves.alias("leaves"), step.alias("step")).filter("step IS NOT NULL")
            .select(*keys, "guid", F.when(F.col("leaves"), 0).otherwise(F.col("step")).alias("interval"),
                    F.when(F.col("leaves"), F.col("step")).otherwise(1).alias("times")))


def visit_intervals(ranges: DataFrame, as_of=None, window_days: int = 30, day: str | None = None) -> DataFrame:
    """W27 summed per (guid, interval) (W28)."""
    keys = [day] if day else []
    d = visit_interval_detail(ranges, as_of, window_days, day)
    return d.groupBy(*keys, "guid", "interval").agg(F.sum("times").cast("long").alias("times"))


def _open_days(ranges: DataFrame, as_of, day: str | None):
    keys = [day] if day else []
    a = F.col(day) if day else F.lit(as_of).cast("date")
    return (ranges.filter(F.col("range_end") == _open())
            .select(*keys, "guid", (F.datediff(a, F.col("range_start")) + 1).alias("_n"))
            .filter(F.col("_n") >= 1)), keys, a


def active_days(ranges: DataFrame, as_of=None, day: str | None = None) -> DataFrame:
    """Users active at least N consecutive days up to ``as_of``, for every N
    (W29): dt, days, user_cnt. Counted from the histogram of run lengths
    (one row per distinct length), so the cost does not grow with the
    number of users times their run lengths."""
    runs, keys, a = _open_days(ranges, as_of, day)
    hist = runs.groupBy(*keys, "_n").agg(F.count(F.lit(1)).alias("_c"))
    per_n = hist.select(*keys, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("days"), "_c")
    out = per_n.groupBy(*keys, "days").agg(F.sum("_c").cast("long").alias("user_cnt"))
    dt = F.col(day) if day else F.lit(as_of).cast("date")
    # ordered by day count as the reference prints it; the table is tiny
    return out.select(dt.alias("dt"), "days", "user_cnt").orderBy("dt", "days")


def active_days_members(ranges: DataFrame, as_of=None, day: str | None = None) -> DataFrame:
    """The user sets of W29 in long form: (dt, days, guid) for every N up
    to the user's run length. Kept as rows, never gathered into one array."""
    runs, keys, a = _open_days(ranges, as_of, day)
    dt = F.col(day) if day else F.lit(as_of).cast("date")
    return runs.select(dt.alias("dt"), F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("days"), "guid")


def active_days_sets(ranges: DataFrame, dictionary: DataFrame, as_of=None, day: str | None = None) -> DataFrame:
    """The user sets of W29 as bitmaps: dt, days, bucket, users for every N. A
    user is one row, in the set of the own run length; the set for N is the
    union of those for N and more, so the rows are run lengths times buckets."""
    runs, keys, a = _open_days(ranges, as_of, day)
    dt = F.col(day) if day else F.lit(as_of).cast("date")
    own = user_sets(with_numbers(runs, dictionary).select(dt.alias("dt"), F.col("_n").alias("days"), "num"), ["dt", "days"])
    # every N up to the longest run of the bucket, then the union from the longest down
    longest = Window.partitionBy("dt", "bucket").orderBy("days")
    own = own.withColumn("_before", F.coalesce(F.lag("days").over(longest), F.lit(0)))
    down = Window.partitionBy("dt", "bucket").orderBy(F.col("days").desc()).rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("users", F.bitmap_or_agg("users").over(down))
    return own.select("dt", F.explode(F.sequence(F.col("_before") + 1, F.col("days"))).alias("days"), "bucket", "users")


def update_bitmap(prev: DataFrame, today: DataFrame, n_days: int = 31, day: str | None = None) -> DataFrame:
    """Shift yesterday's activity bitmap by one day and set today's bit
    (W32): ((prev << 1) | active) & (2^n_days − 1); unknown users start at
    1. Bit i = active i days ago. One full outer join on guid."""
    keys = [day] if day else []
    p = prev.select(*keys, "guid", F.col("bitmap").cast("long").alias("_p"))
    if day:
        p = p.withColumn(day, F.date_add(F.col(day), 1))
    cur = today.select(*keys, "guid").distinct().withColumn("_a", F.lit(1).cast("long"))
    j = p.join(cur, keys + ["guid"], "full")
    mask = (1 << n_days) - 1
    bm = F.shiftleft(F.coalesce(F.col("_p"), F.lit(0).cast("long")), 1) \
        .bitwiseOR(F.coalesce(F.col("_a"), F.lit(0).cast("long"))).bitwiseAND(F.lit(mask).cast("long"))
    return j.select("guid", bm.alias("bitmap"), *keys)


def bitmap_snapshots(active: DataFrame, last_day, n_days: int = 31) -> DataFrame:
    """Activity bitmap of every day e from scratch: Σ 2^(e−a) over active
    days a in (e − n_days, e], for every user already seen by e."""
    last = F.lit(last_day).cast("date")
    # sequence() counts down when start > stop, so days after last_day must go first
    active = active.filter(F.col("dy") <= last)
    contrib = active.select("guid", "dy",
                            F.explode(F.sequence(F.col("dy"), F.least(F.date_add("dy", n_days - 1), last)))
                            .alias("e"))
    bits = contrib.groupBy("guid", "e").agg(
        F.sum(F.expr("shiftleft(1L, datediff(e, dy))")).cast("long").alias("bitmap"))
    first = active.groupBy("guid").agg(F.min("dy").alias("f"))
    spine = first.select("guid", F.explode(F.sequence(F.col("f"), last)).alias("e"))
    return (spine.join(bits, ["guid", "e"], "left")
            .select("guid", F.coalesce("bitmap", F.lit(0).cast("long")).alias("bitmap"), F.col("e").alias("dy")))
