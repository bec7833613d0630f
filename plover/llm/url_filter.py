"""URL filters as a temporal list join.

List entries are dated: (pattern, action, day), where an ``add`` puts the
pattern on the list from that day on and a ``remove`` takes it off. Entries
become validity intervals [valid_from, valid_to) per pattern. A capture
(URL and fetch time) is evaluated against the entries active when it was
fetched: its host, every parent domain, and host plus each leading path
segment are looked up, as deep as the list's deepest pattern.

Intervals are cut at the borders of fixed time slots and joined on (pattern,
slot), so a pattern whose captures or changes are a large share of all rows
is spread over slots, and each capture meets only the intervals of its slot.
The intervals are stored first, so that a hot (pattern, slot) can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plover.llm.common import stage

SLOT_DAYS = 30


def host_of(url) -> Column:
    """Lower-case host without port, user and closing dot; empty if there is none."""
    url = F.col(url) if isinstance(url, str) else url
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.lower(F.regexp_replace(authority, r"^.*@|:[0-9]*$", "")), r"\.$", "")


def path_of(url) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def normal_pattern(pattern) -> Column:
    """A list pattern as captures are looked up: host without scheme, user, port
    and closing dot in lower case, then its path segments as they are, without
    empty ones and what follows ? or #. Null if there is no host."""
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    url = F.concat(F.lit("x://"), F.regexp_replace(F.trim(p), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", ""))
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    return F.when(host_of(url) != "", F.array_join(F.concat(F.array(host_of(url)), segments), "/"))


def lookup_keys(url, segments: int) -> Column:
    """Patterns that would match a URL: the host, its parent domains of two
    labels and more, and the host with its leading path segments, at most
    ``segments`` of them."""
    labels = F.split(host_of(url), r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(labels, i, n), "."))
    parts = F.slice(F.filter(F.split(path_of(url), "/"), lambda p: p != ""), 1, segments)
    paths = F.transform(parts, lambda _, i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, 1, i + 1), "/")))
    return F.when(host_of(url) != "", F.array_distinct(F.concat(parents, paths)))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """pattern, category, valid_from, valid_to (exclusive, null: open) from
    entries (pattern, category, action, day). The same pattern may be in many
    categories; each is a list of its own. Of several entries on one day a
    removal wins; a repeated add or a remove without an add changes nothing.
    Patterns are compared and returned as ``normal_pattern`` writes them.
    Entries with a null day or action or a pattern without a host are ignored."""
    e = entries.select(normal_pattern("pattern").alias("pattern"), "category", "action", "day")
    e = (e.filter("pattern is not null and day is not null and action in ('add', 'remove')")
         .groupBy("pattern", "category", "day").agg(F.max(F.col("action") == "remove").alias("gone")))
    w = Window.partitionBy("pattern", "category").orderBy("day")
    e = e.withColumn("was", F.lag("gone").over(w)).filter(F.coalesce("was", F.lit(True)) != F.col("gone"))
    return (e.withColumn("valid_to", F.lead("day").over(w)).filter(~F.col("gone"))
            .select("pattern", "category", F.col("day").alias("valid_from"), "valid_to"))


def _slot(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / SLOT_DAYS).cast("int")


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    fetched_col: str = "fetched") -> DataFrame:
    """The captures' id, url and fetch day with blocked, n_entries, category (of
    the longest matching pattern, then the smallest name) and pattern,
    valid_from of that entry (null: none active).

    One row per distinct (id, url, fetch day). A null or malformed URL and a
    null fetch day match nothing and are not blocked; an empty list blocks
    nothing. A very long URL has a key per label and listed depth of its path.
    Further columns of either side are not looked at."""
    c = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.col(fetched_col).cast("date").alias("day")).distinct()
    span = c.agg(F.min("day"), F.max("day")).first()  # two dates
    lists = validity_intervals(entries)
    if span[0] is None:
        lists, span = lists.limit(0), ("1970-01-01", "1970-01-01")
    first, last = (F.lit(str(x)).cast("date") for x in span)
    till = F.least(F.coalesce(F.date_sub("valid_to", 1), last), last)
    since = F.greatest("valid_from", first)
    lists = lists.filter(since <= till).withColumn("slot", F.explode(F.sequence(_slot(since), _slot(till))))
    lists = stage(lists, "url-intervals")
    deepest = lists.agg(F.max(F.regexp_count("pattern", F.lit("/")))).first()[0] or 0  # one number
    asked = c.withColumn("key", F.explode(lookup_keys("url", deepest))).withColumn("slot", _slot(F.col("day")))
    met = asked.join(lists, (asked["key"] == lists["pattern"]) & (asked["slot"] == lists["slot"])
                     & (asked["day"] >= lists["valid_from"])
                     & (lists["valid_to"].isNull() | (asked["day"] < lists["valid_to"])))
    best = F.struct(-F.length("pattern"), "category", "pattern", "valid_from")
    met = met.groupBy("id", asked["url"], asked["day"]).agg(F.count("*").alias("n_entries"), F.min(best).alias("best"))
    met = stage(met.select(F.col("id").alias("_id"), F.col("url").alias("_url"), F.col("day").alias("_day"),
                           "n_entries", "best"), "url-verdicts")
    out = c.join(met, c["id"].eqNullSafe(met["_id"]) & (c["url"] == met["_url"]) & (c["day"] == met["_day"]), "left")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("day").alias(fetched_col),
                      F.col("best").isNotNull().alias("blocked"),
                      F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
                      F.col("best.category").alias("category"), F.col("best.pattern").alias("pattern"),
                      F.col("best.valid_from").alias("valid_from"))
