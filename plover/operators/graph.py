"""Identity graph: edges from identifier columns (W11), connected
components (W12), incremental components (W13), guid carry-over (W14) and
row labelling (W15).

Components use the large-star / small-star alternation (Kiveris et al.,
"Connected Components in MapReduce and Beyond", SoCC 2014) on an edge
DataFrame. Each step is a grouped ``min`` (partial aggregation, so a hub
vertex with millions of neighbours is combined map-side) and a join to the
one-row-per-vertex minima, which are shuffled anew (``joins.rekeyed``) so
that AQE can split a hub's edges. A round is one job that writes its edges to
the shared folder, which cuts lineage and survives executor loss, the moved ones
apart; the loop ends with the first round without any. New
edges join old labels by contraction (W13). Vertex ids may be strings or longs; the label of a
component is its smallest id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.functions.columns import not_blank
from plover.operators.joins import rekeyed, spread_key
from plover.session import remove_path, scratch_path, stored


def _ids_array(cols: Sequence[str]):
    return F.filter(F.array(*[F.col(c).cast("string") for c in cols]), lambda x: not_blank(x))


def identity_vertices(rows: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Every non-blank identifier of the rows, once: id."""
    return rows.select(F.explode(_ids_array(id_cols)).alias("id")).distinct()


def identity_edges(rows: DataFrame, id_cols: Sequence[str], mode: str = "pairs",
                   min_support: int = 2) -> DataFrame:
    """Edges between the identifiers of each row (W11): src, dst.

    ``pairs``: every pair i < j of the row's non-blank identifiers, kept when
    seen more than ``min_support`` times. ``chain``: consecutive non-blank
    identifiers, only for rows whose first column is non-blank, no
    threshold (SURVEY Q20). The number of pairs per row is fixed by the
    column list, so edges grow linearly with the rows.
    """
    ids = _ids_array(id_cols)
    k = len(id_cols)
    if mode == "pairs":
        cand = F.array(*[F.struct(F.get(ids, i).alias("src"), F.get(ids, j).alias("dst"))
                         for i in range(k) for j in range(i + 1, k)])
        e = rows.select(F.explode(cand).alias("e")).select("e.src", "e.dst")
        e = e.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        return e.groupBy("src", "dst").count().filter(F.col("count") > min_support).select("src", "dst")
    if mode == "chain":
        cand = F.array(*[F.struct(F.get(ids, i).alias("src"), F.get(ids, i + 1).alias("dst")) for i in range(k - 1)])
        e = (rows.filter(not_blank(F.col(id_cols[0]).cast("string")))
             .select(F.explode(cand).alias("e")).select("e.src", "e.dst"))
        return e.filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()
    raise ValueError(f"unknown mode {mode!r}")


def _canon(e: DataFrame) -> DataFrame:
    return (e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
            .filter(F.col("u") != F.col("v")).distinct())


def _lowest(e: DataFrame, *aggs) -> DataFrame:
    """Each upper end's smallest lower neighbour, combined map-side."""
    return e.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("low"), *aggs)


def _large_star(e: DataFrame) -> DataFrame:
    """Every vertex hands its larger neighbours to its smallest neighbour. In
    edges with u < v the smallest neighbour of u is a lower one, if it has any."""
    j = e.join(rekeyed(_lowest(e), "x"), F.col("u") == F.col("x"), "left")
    return j.select(F.coalesce("low", "u").alias("u"), "v", F.col("low").isNotNull().alias("moved"))


def _small_star(e: DataFrame) -> DataFrame:
    """Every vertex hands itself and its smaller neighbours to the smallest of
    them. A vertex's own edge comes from the grouped minima, so edges never
    become more, and duplicates vanish as the stars form."""
    if "moved" not in e.columns:
        e = e.withColumn("moved", F.lit(False))
    low = _lowest(e, F.max("moved").alias("any_moved"))
    others = e.join(rekeyed(low, "x"), F.col("v") == F.col("x")).filter(F.col("u") != F.col("low"))
    return (low.select(F.col("low").alias("u"), F.col("x").alias("v"), F.col("any_moved").alias("moved"))
            .unionByName(others.select(F.col("low").alias("u"), F.col("u").alias("v"), F.lit(True).alias("moved"))))


def _stars(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex that is not its component's smallest.
    A round is one job: it writes the next edges, those that moved to a folder
    of their own. Without such a folder the edges are stars around their
    smallest vertices, and no job is needed to see that."""
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    e = stored(_canon(edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))), path)
    while True:
        out, after = _small_star(_large_star(e)), scratch_path(spark, "edges")
        e, moved = _written(out, after)
        remove_path(spark, path)
        path = after
        if not moved:
            return e.select(F.col("v").alias("id"), F.col("u").alias("component"))


def _written(edges: DataFrame, path: str) -> tuple[DataFrame, bool]:
    """The edges (u, v) as written to ``path``, and whether any had moved."""
    edges.select("u", "v", "moved").write.partitionBy("moved").parquet(path)
    back = edges.sparkSession.read.schema(edges.select("u", "v", "moved").schema).parquet(path)
    return back.select("u", "v"), any("/moved=true/" in f for f in back.inputFiles())


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Label every vertex with the smallest id of its component (W12):
    id, component. Isolated vertices label themselves. Rounds go on until
    the edges are stars, however long the longest chain is."""
    return (vertices.select("id").distinct().join(_stars(edges), "id", "left")
            .select("id", F.coalesce(F.col("component"), F.col("id")).alias("component")))


def incremental_components(vertices: DataFrame, edges: DataFrame, prev: DataFrame) -> DataFrame:
    """Today's graph united with yesterday's labels (W13): id, component for
    every identifier of either. ``prev``: id, guid, where a guid names its class.

    Yesterday's classes are contracted: the ends of today's edges that
    yesterday knew are replaced by their guids, components are found on those
    edges alone, and the names of merged classes are replaced. Yesterday's edges
    are never looked at; its labels are read for the lookup and for the result,
    and the rounds depend on today's edges only. A class is named by the
    smallest of yesterday's guids and new ids in it – its smallest id, if
    that is what yesterday's labels were.
    """
    spark = edges.sparkSession
    ends = edges.select("src", "dst")
    today = (vertices.select(F.col("id").alias("t_id")).unionByName(
        ends.select(F.explode(F.array("src", "dst")).alias("t_id"))).distinct())
    known = prev.select(F.col("id").alias("k_id"), F.col("guid").alias("k_guid"))
    path = scratch_path(spark, "ends")
    # one row per identifier of today, with yesterday's class
    today = stored(today.join(known, F.col("t_id") == F.col("k_id"), "left").select("t_id", "k_guid"), path)
    name = today.filter("k_guid IS NOT NULL")
    src = rekeyed(name.select(F.col("t_id").alias("s_id"), F.col("k_guid").alias("s_guid")), "s_id")
    dst = rekeyed(name.select(F.col("t_id").alias("d_id"), F.col("k_guid").alias("d_guid")), "d_id")
    contracted = (ends.join(src, F.col("src") == F.col("s_id"), "left").join(dst, F.col("dst") == F.col("d_id"), "left")
                  .select(F.coalesce("s_guid", "src").alias("src"), F.coalesce("d_guid", "dst").alias("dst")))
    moved = rekeyed(_stars(contracted).select(F.col("id").alias("m_id"), F.col("component").alias("m_to")), "m_id")
    named = known.select(F.col("k_id").alias("id"), F.col("k_guid").alias("name")).unionByName(
        today.filter("k_guid IS NULL").select(F.col("t_id").alias("id"), F.col("t_id").alias("name")))
    return (named.join(moved, F.col("name") == F.col("m_id"), "left")
            .select("id", F.coalesce("m_to", "name").alias("component")))


def carry_over_guid(today: DataFrame, prev: DataFrame) -> DataFrame:
    """Each of today's components takes yesterday's guid when any member
    had one – the smallest of them (SURVEY Q17) – else keeps its own (W14).
    ``today``: id, guid (today's component label); ``prev``: id, guid."""
    p = prev.select("id", F.col("guid").alias("_prev"))
    j = today.join(p, "id", "left")
    per = rekeyed(j.groupBy("guid").agg(F.min("_prev").alias("_carry")), "guid")
    return (today.join(per, "guid", "left")
            .select("id", F.coalesce(F.col("_carry"), F.col("guid")).alias("guid")))


def label_rows(rows: DataFrame, components: DataFrame, id_cols: Sequence[str], out: str = "guid") -> DataFrame:
    """Attach the component of each row's first non-blank identifier (W15)."""
    first = F.get(_ids_array(id_cols), 0)
    comp = rekeyed(components.select(F.col("id").cast("string").alias("_first"), F.col("component").alias(out)), "_first")
    return (rows.withColumn("_first", spread_key(first, first.isNotNull()))
            .join(comp, "_first", "left").drop("_first"))
