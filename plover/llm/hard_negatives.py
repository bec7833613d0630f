"""Hard-negative mining by inner products, pruned coordinate by coordinate.

For every anchor: its best rows of the same label are positives, and for each
positive the best rows of other labels whose score lies within a share of
the positive's score are hard negatives. Every anchor meets every row of its
side, so both are cut into pieces and a task takes one block of anchors and
one tile of rows:

* rows fall into length classes (lengths within ``RATIO``), a class into
  tiles of about ``TILE`` rows by a hash of the row. Within a tile, buckets of
  ``BUCKET`` rows of falling length hold, for each coordinate, the list of
  normalised values in order;
* a row can reach a score only if its angle to the anchor is small enough,
  which bounds each normalised coordinate. The feasible ranges of the anchor's
  ``FOCUS`` largest coordinates are looked up in the sorted lists and their
  row sets intersected; only rows in all of them are verified exactly;
* the score to reach is the worst of the best found so far in the tile; for
  negatives it starts at the lower end of the positives' bands. A bucket whose
  longest row cannot reach it is skipped.

Nothing is dropped: bounds are widened by more than their rounding error, and
where no bound holds (scores of zero or less, zero vectors) all rows are
verified. A tile hands on at most ``k`` rows per anchor (and positive), and
these are merged by a window per anchor.

Rows without an id, a label or a vector, or with a null or non-finite
component, take no part. Equal rows (id, label, components) count once; rows
of one id that differ are different rows. Ties go to the smaller id. Missing
components of a shorter vector are zero, an empty vector scores zero.
Components and scores beyond 64 bits stay at the end of that range. Empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plover.llm.common import stage
from plover.operators.joins import rekeyed

TILE = 4096  # rows
BLOCK = 4096  # anchors
BUCKET = 256
FOCUS = 4  # coordinates whose ranges are intersected
RATIO = 1.1  # of the longest to the shortest row of a class
SLACK = 1e-7  # of a normalised coordinate; far above its rounding error
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def integer_vectors(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = 256) -> DataFrame:
    """Rows that take part: id, label, v array<long>, the components floored
    after multiplication by ``scale``."""
    x = F.col(vector_col).cast("array<double>")
    r = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    r = r.filter("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").filter(
        F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return r.select("id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _classes(rows: DataFrame) -> DataFrame:
    """Equal rows once, with a hash of the row and its length class (zero vectors: null)."""
    n = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.dropDuplicates(["id", "label", "v"]).select(
        "id", "label", "v", F.xxhash64("id", "label", "v").alias("row"),
        F.when(n > 0, F.floor(F.log(n) / (2 * float(np.log(RATIO))))).otherwise(F.lit(-1)).cast("int").alias("cls"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


class _Bucket:
    def __init__(self, at: np.ndarray, ints: np.ndarray, norms: np.ndarray):
        self.at, self.longest = at, float(norms[0])
        self.zero = not norms[-1]
        self.ints = ints
        self.real = ints.astype(np.float64)
        if not self.zero:
            unit = self.real / norms[:, None]
            self.order = np.argsort(unit, axis=0, kind="stable")
            self.sorted = np.ascontiguousarray(np.take_along_axis(unit, self.order, 0).T)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, norm: float, least: float):
        """Places in the bucket that may score ``least`` with an anchor of that
        unit vector; None for all, an empty array for none."""
        if least <= 0 or self.zero or not norm:
            return None
        cos = least / (norm * self.longest)
        if cos > 1 + SLACK:
            return np.zeros(0, np.int64)
        angle = np.arccos(min(cos, 1.0))
        hits, asked = None, 0
        for f in focus:
            own = np.arccos(min(max(unit[f], -1.0), 1.0))
            lo, hi = np.cos(min(np.pi, own + angle)) - SLACK, np.cos(max(0.0, own - angle)) + SLACK
            values = self.sorted[f]
            a, b = np.searchsorted(values, lo), np.searchsorted(values, hi, "right")
            if b - a == len(values):
                continue
            if a >= b:
                return np.zeros(0, np.int64)
            if hits is None:
                hits = np.zeros(len(values), np.int8)
            hits[self.order[a:b, f]] += 1
            asked += 1
        return None if hits is None else np.flatnonzero(hits == asked)


class _Tile:
    """Length buckets of one tile's rows."""

    def __init__(self, vectors, width: int):
        ints = _matrix(vectors, width)
        norms = np.sqrt((ints.astype(np.float64) ** 2).sum(1))
        order = np.argsort(-norms, kind="stable")
        self.buckets = [_Bucket(at, ints[at], norms[at]) for at in
                        (order[k:k + BUCKET] for k in range(0, len(order), BUCKET))]
        self.largest = float(np.abs(ints.astype(np.float64)).max(initial=0))

    def search(self, anchor: np.ndarray, least, take) -> None:
        """Calls ``take(rows, scores)`` for the verified rows of one bucket after
        the other; ``least()`` is the score that is worth finding by then."""
        real = anchor.astype(np.float64)
        norm = float(np.sqrt((real ** 2).sum()))
        unit = real / norm if norm else real
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        # sums of products of integers below 2**53 are exact in double precision
        exact = len(anchor) * self.largest * float(np.abs(real).max(initial=0)) < 2.0 ** 53
        for b in self.buckets:
            found = b.candidates(unit, focus, norm, least())
            if found is not None and not len(found):
                continue
            rows = slice(None) if found is None else found
            if exact:
                scores = (b.real[rows] @ real).astype(np.int64)
            else:
                big = [int(x) for x in anchor]
                scores = np.array([min(max(sum(int(x) * y for x, y in zip(v, big)), _LOW), _HIGH) for v in b.ints[rows]], np.int64)
            take(b.at[rows], scores)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    return np.lexsort((ids, ~scores))[:k]  # ~ reverses the order and cannot overflow


def _positives(k: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            width = max(map(len, [*anchors["v"], *rows["v"]]))
            tile, ids, marks = _Tile(rows["v"].tolist(), width), rows["id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64)
            for a_id, a_row, v in zip(anchors["id"], anchors["row"], _matrix(anchors["v"].tolist(), width)):
                at, score = np.zeros(0, np.int64), np.zeros(0, np.int64)

                def take(rows_at, scores):
                    nonlocal at, score
                    other = (ids[rows_at] != a_id) | (marks[rows_at] != a_row)
                    at, score = np.concatenate([at, rows_at[other]]), np.concatenate([score, scores[other]])
                    best = _best(score, ids[at], k)
                    at, score = at[best], score[best]

                tile.search(v, lambda: float(score[-1]) if len(score) == k else -np.inf, take)
                out.append(pd.DataFrame({"id": a_id, "row": a_row, "p_id": ids[at], "p_row": marks[at], "p_score": score}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(
            {c: np.zeros(0, np.int64) for c in ("id", "row", "p_id", "p_row", "p_score")})
    return run


def _negatives(k: int, low: int, high: int, whole: int):
    names = ("id", "row", "p_rank", "p_id", "p_score", "n_id", "n_row", "n_score")

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            width = max(map(len, [*anchors["v"], *rows["v"]]))
            tile, ids, marks = _Tile(rows["v"].tolist(), width), rows["id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64)
            labels = rows["label"].to_numpy(np.int64)
            vectors = _matrix(anchors["v"].tolist(), width)
            for n, (a_id, a_row, label, wanted) in enumerate(zip(anchors["id"], anchors["row"], anchors["label"], anchors["pos"])):
                # low * p <= whole * n <= high * p in whole numbers
                bands = [(x["p_rank"], x["p_id"], x["p_score"], -(-low * int(x["p_score"]) // whole), high * int(x["p_score"]) // whole)
                         for x in wanted]
                bands = [b for b in bands if b[3] <= b[4]]
                if not bands:
                    continue
                found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in bands]

                def least():
                    return min(float(b[3]) if len(f[1]) < k else max(float(b[3]), float(f[1][-1])) for b, f in zip(bands, found))

                def take(rows_at, scores):
                    other = labels[rows_at] != label
                    rows_at, scores = rows_at[other], scores[other]
                    for j, (_, _, _, lo, hi) in enumerate(bands):
                        inside = (scores >= lo) & (scores <= hi)
                        if inside.any():
                            at = np.concatenate([found[j][0], rows_at[inside]])
                            score = np.concatenate([found[j][1], scores[inside]])
                            best = _best(score, ids[at], k)
                            found[j] = at[best], score[best]

                tile.search(vectors[n], least, take)
                out += [pd.DataFrame(dict(zip(names, (a_id, a_row, r, p, s, ids[at], marks[at], score))))
                        for (r, p, s, _, _), (at, score) in zip(bands, found) if len(at)]
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in names})
    return run


def _meet(anchors: DataFrame, index: DataFrame, run, schema: str, tile: int, block: int, small) -> DataFrame:
    """Every anchor with every index row of its group g, in (block, tile) pieces.
    ``small`` prepares the table of piece counts for its joins."""
    tiles = index.groupBy("g", "cls").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    blocks = anchors.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))

    def named(df, *keys):
        return small(df.select(*[F.col(c).alias(f"k_{c}") for c in keys], *[c for c in df.columns if c not in keys]),
                     *[f"k_{c}" for c in keys])

    def upto(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    of_tiles, of_blocks = named(tiles, "g", "cls"), named(blocks, "g")
    i = (index.join(of_tiles, (F.col("g") == F.col("k_g")) & (F.col("cls") == F.col("k_cls"))).drop("k_g", "k_cls")
         .withColumn("tile", F.pmod(F.col("row"), F.col("tiles").cast("long")))
         .join(of_blocks, F.col("g") == F.col("k_g")).drop("k_g")
         .withColumn("blk", upto("blocks")).drop("tiles", "blocks"))
    a = (anchors.join(of_blocks, F.col("g") == F.col("k_g")).drop("k_g")
         .withColumn("blk", F.pmod(F.col("row"), F.col("blocks").cast("long")))
         .join(of_tiles, F.col("g") == F.col("k_g")).withColumnRenamed("k_cls", "cls")
         .withColumn("tile", upto("tiles")).drop("k_g", "tiles", "blocks"))
    a = a.select(*[F.col(c).alias(c) for c in a.columns])  # attributes of its own: both sides may be one table
    keys = ["g", "blk", "cls", "tile"]
    return a.groupBy(*keys).cogroup(i.groupBy(*keys)).applyInPandas(run, schema=schema)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         whole: int = 100, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (id, label, v array<long>).
    For each anchor and each of its ``positives`` best rows of the same label,
    the ``negatives`` best rows of other labels with
    low * positive <= whole * negative <= high * positive: anchor_id, positive_rank,
    positive_id, rank (from 1), negative_id, positive_score, negative_score."""
    index = stage(_classes(rows), "negatives-rows")
    anchors = index.filter(is_anchor).drop("cls")
    # same label: labels may be many and one may be hot, so the piece counts are joined by shuffles that can split
    found = _meet(anchors.withColumn("g", F.col("label")), index.withColumn("g", F.col("label")), _positives(positives),
                  "id long, row long, p_id long, p_row long, p_score long", tile, block, rekeyed)
    w = Window.partitionBy("id", "row").orderBy(F.col("p_score").desc(), "p_id", "p_row")
    found = found.withColumn("p_rank", F.row_number().over(w)).filter(F.col("p_rank") <= positives)
    pos = found.groupBy(F.col("id").alias("p_of"), F.col("row").alias("p_of_row")).agg(
        F.array_sort(F.collect_list(F.struct("p_rank", "p_id", "p_score"))).alias("pos"))
    wanted = stage(anchors.join(pos, (F.col("id") == F.col("p_of")) & (F.col("row") == F.col("p_of_row")))
                   .select("id", "row", "label", "v", "pos"), "negatives-positives")
    # other labels: one group; its table has a row per length class, of which doubles allow under 16,000
    zero = F.pmod(F.col("row"), F.lit(1).cast("long"))  # not a literal, which would make the joins of the counts nested loops
    out = _meet(wanted.withColumn("g", zero), index.withColumn("g", zero), _negatives(negatives, low, high, whole),
                "id long, row long, p_rank long, p_id long, p_score long, n_id long, n_row long, n_score long",
                tile, block, lambda df, *_: F.broadcast(df))
    w = Window.partitionBy("id", "row", "p_rank").orderBy(F.col("n_score").desc(), "n_id", "n_row")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= negatives).select(
        F.col("id").alias("anchor_id"), F.col("p_rank").cast("int").alias("positive_rank"), F.col("p_id").alias("positive_id"),
        "rank", F.col("n_id").alias("negative_id"), F.col("p_score").alias("positive_score"),
        F.col("n_score").alias("negative_score"))
