"""Geography: geohash dictionary (W03), geohash enrichment (W04) and the
IP-range fallback (W05)."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.functions.columns import geohash, ip_to_long
from plover.operators.joins import rekeyed


def build_geo_dictionary(lines: DataFrame, precision: int = 6, col: str = "value") -> DataFrame:
    """Parse ``_ _ lon lat province:city:district`` lines into one row per
    geohash cell (W03): geo, province, city, district. Several lines in one
    cell keep the smallest (province, city, district) so the dictionary is
    unique (SURVEY Q48). Lines with unparsable or out-of-range coordinates
    are dropped."""
    parts = F.split(F.col(col), " ", 5)  # the area (last field) may itself contain spaces
    area = F.split(F.get(parts, 4), ":")
    p = lines.select(F.get(parts, 2).try_cast("double").alias("lon"),
                     F.get(parts, 3).try_cast("double").alias("lat"),
                     F.get(area, 0).alias("province"), F.get(area, 1).alias("city"), F.get(area, 2).alias("district"))
    p = p.filter(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    g = (p.groupBy(geohash("lat", "lon", precision).alias("geo"))
         .agg(F.min(F.struct("province", "city", "district")).alias("a")))
    return g.select("geo", "a.province", "a.city", "a.district")


def geo_enrich(log: DataFrame, geo_dict: DataFrame, precision: int = 6) -> DataFrame:
    """Add province/city/district by the geohash of (latitude, longitude)
    (W04). Spark broadcasts the dictionary if its bytes allow it; else both
    sides shuffle on the cell and AQE can split a hot cell."""
    d = rekeyed(geo_dict, "geo").select("geo", F.col("province").alias("_gp"), F.col("city").alias("_gc"),
                        F.col("district").alias("_gd"))
    j = (log.withColumn("_geo", geohash("latitude", "longitude", precision))
         .join(d, F.col("_geo") == d["geo"], "left"))
    return (j.withColumn("province", F.col("_gp")).withColumn("city", F.col("_gc"))
            .withColumn("district", F.col("_gd")).drop("_geo", "geo", "_gp", "_gc", "_gd"))


def parse_ip_regions(lines: DataFrame, col: str = "value") -> DataFrame:
    """``ip_start ip_end country|area|province|city|isp`` text lines into the
    range table (ip_start, ip_end, country, area, province, city, isp)."""
    parts = F.split(F.col(col), " ", 3)
    reg = F.split(F.get(parts, 2), r"\|")
    return lines.select(F.get(parts, 0).try_cast("long").alias("ip_start"),
                        F.get(parts, 1).try_cast("long").alias("ip_end"),
                        *[F.get(reg, i).alias(n) for i, n in enumerate(["country", "area", "province", "city", "isp"])],
                        F.size(reg).alias("_nf")).filter(F.col("_nf") == 5).drop("_nf")


_PIECES = "_blk long, _s long, _e long, _ip_p string, _ip_c string"


def _sweep(batches):
    """Pieces of the blocks' ranges, which come sorted by block and start. A heap
    holds the open ranges, the best one on top; it answers until it ends or the
    next range starts. Each range enters and leaves the heap once."""
    out, heap, blk, at, last = [], [], None, 0, None

    def until(stop):
        """Pieces of the open ranges from ``at`` up to ``stop`` (None: to their ends)."""
        nonlocal at, last
        while heap and (stop is None or at < stop):
            _, end, names = heap[0]
            if end < at:
                heapq.heappop(heap)
                continue
            end = end if stop is None else min(end, stop - 1)
            if last is not None and last[0] == blk and last[2] == at - 1 and last[3:] == names:
                last = (*last[:2], end, *names)
            else:
                if last is not None:
                    out.append(last)
                last = (blk, at, end, *names)
            at = end + 1

    def batch():
        cols = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 3 + [pa.string()] * 2)]
        out.clear()
        return pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in _PIECES.split(", ")])

    for b in batches:
        for k, a, z, w, start, *names in zip(*[c.to_pylist() for c in b.columns]):
            if k != blk:
                until(None)
                blk, at = k, a
            until(a)
            at = max(at, a)
            rank = (w, -start, *[x for n in names for x in (n is not None, n or "")])  # a null name is the smallest
            heapq.heappush(heap, (rank, z, tuple(names)))
        if len(out) >= 8192:
            yield batch()
    until(None)
    if last is not None:
        out.append(last)
    if out:
        yield batch()


def disjoint_ranges(ranges: DataFrame, bucket_bits: int = 16) -> DataFrame:
    """_blk, _s, _e, _ip_p, _ip_c: the ranges cut at block borders and at each
    other's ends, each piece with the answer of its narrowest range (then the
    latest start, then the smallest names); neighbours with one answer are one
    piece. A block of 2^bucket_bits addresses is swept once in the order of the
    starts, so the work grows with its ranges, however they overlap."""
    r = ranges.filter((F.col("country") != "0") & (F.col("ip_start") <= F.col("ip_end"))).select(
        (F.col("ip_end") - F.col("ip_start")).alias("_w"), F.col("ip_start").alias("_from"), "province", "city",
        F.col("ip_start").alias("_a"), F.col("ip_end").alias("_z"))
    r = r.withColumn("_blk", F.explode(F.sequence(F.shiftright("_a", bucket_bits), F.shiftright("_z", bucket_bits))))
    first = F.shiftleft("_blk", bucket_bits)
    r = r.select("_blk", F.greatest("_a", first).alias("_a"), F.least("_z", first + F.lit((1 << bucket_bits) - 1)).alias("_z"),
                 "_w", "_from", "province", "city")
    # equal spans of a block keep their best range, before the shuffle
    r = r.groupBy("_blk", "_a", "_z").agg(F.min(F.struct("_w", (-F.col("_from")).alias("s"), "province", "city")).alias("b"))
    r = r.select("_blk", "_a", "_z", F.col("b._w").alias("_w"), (-F.col("b.s")).alias("_from"), "b.province", "b.city")
    return r.repartition("_blk").sortWithinPartitions("_blk", "_a").mapInArrow(_sweep, _PIECES)


def ip_region_enrich(log: DataFrame, ip_ranges: DataFrame, bucket_bits: int = 16,
                     only_missing: bool = True) -> DataFrame:
    """Fill province and city from the IP range that contains the address
    for rows without a geo hit (W05); a range whose country is '0' is no
    answer (SURVEY Q03). Where ranges overlap the narrowest answers, so a
    row stays one row.

    Rows join on their block of addresses with the ``between`` as a
    residual, so each row meets only the pieces of its block. Rows that need
    no answer get a block that no range has, one per input partition.
    """
    r = rekeyed(disjoint_ranges(ip_ranges, bucket_bits), "_blk")
    miss = F.col("province").isNull() if only_missing else F.lit(True)
    x = log.withColumn("_miss", miss).withColumn("_ip", F.when(F.col("_miss"), ip_to_long(F.col("ip"))))
    x = x.withColumn("_blk", F.when(F.col("_ip").isNotNull(), F.shiftright("_ip", bucket_bits))
                     .otherwise(-1 - F.spark_partition_id().cast("long")))
    j = x.join(r, (x["_blk"] == r["_blk"]) & x["_ip"].between(r["_s"], r["_e"]), "left")
    return (j.withColumn("province", F.when(F.col("_miss"), F.col("_ip_p")).otherwise(F.col("province")))
            .withColumn("city", F.when(F.col("_miss"), F.col("_ip_c")).otherwise(F.col("city")))
            .drop("_miss", "_ip", "_blk", "_s", "_e", "_ip_p", "_ip_c"))
