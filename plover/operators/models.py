"""Profile models: nearest-neighbour classification (W34), churn logistic
regression (W35), TF-IDF + naive Bayes text classification (W36) and the
profile naive Bayes (W37). Fitting is MLlib's distributed training."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import IDF, HashingTF, MinMaxScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plover.operators.joins import join_by_frequency
from plover.session import remove_path, scratch_path, stored


# --- W34 nearest neighbours --------------------------------------------------


def _matrix(column):
    """The vectors of an Arrow list column as rows of a matrix; a null vector, a
    null component and a vector of another width than the widest are NaN."""
    import numpy as np

    column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    width = max(int(sizes.max(initial=0)), 0)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), np.nan, values.dtype)
    out[sizes == width] = values[np.repeat(sizes == width, np.maximum(sizes, 0))].reshape(-1, width)
    return out


def _same_ids(a, b):
    """Positions (in a, in b) of all pairs of equal ids of two Arrow columns; nulls equal nothing."""
    import numpy as np
    import pandas as pd

    codes, _ = pd.factorize(pd.concat([a.to_pandas(), b.to_pandas()], ignore_index=True))
    ca, cb = codes[:len(a)], codes[len(a):]
    order = np.argsort(cb, kind="stable")
    lo, hi = (np.searchsorted(cb[order], ca, side) for side in ("left", "right"))
    n = np.where(ca >= 0, hi - lo, 0)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.arange(len(a)), n), order[np.repeat(lo, n) + at]


def _nearest(a, b, k, rank, same=None, step_cells=4 << 20):
    """The ``k`` nearest rows of matrix ``b`` for each row of ``a``: (row of a, row
    of b, squared distance), nearest first, equal distances by ``rank``. Rows with
    a NaN or an infinite component take no part, nor do the pairs ``same``.

    Distances of ``step_cells`` pairs at a time are a matrix product, in single
    precision while that tells enough pairs apart. The k-th smallest of the minima
    of groups of rows bounds the k-th distance from above; the few pairs below that
    bound, widened by the product's rounding error, are computed anew from the
    differences in double precision.
    """
    import numpy as np

    width = a.shape[1]
    rows, cols = (np.flatnonzero(np.isfinite(m).all(1)) for m in (a, b))
    found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
    if len(rows) and len(cols) and b.shape[1] == width:
        x, y = a[rows].astype(np.float64), b[cols].astype(np.float64)
        with np.errstate(all="ignore"):
            middle = y.mean(0)  # a cloud far from the origin would lose digits in the product
            if np.isfinite(middle).all():
                x, y = x - middle, y - middle
            xx, yy = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
        group = max(1, min(64, len(y) // (4 * k)))
        groups = math.ceil(len(y) / group)
        # x·y' of these is |y|² - 2xy, the distance less |x|²
        x, y = np.column_stack([-2 * x, np.ones(len(x))]), np.column_stack([y, yy])
        y = np.concatenate([y, np.zeros((groups * group - len(y), width + 1))])
        most = max(xx.max(), yy.max())
        kinds = [np.float64] if not most < 1e30 else [np.float32, np.float64]
        sides = {np.float64: (x, y), np.float32: (x.astype(np.float32), y.astype(np.float32))} if len(kinds) > 1 else {np.float64: (x, y)}
        left = right = np.zeros(0, int)
        if same is not None and len(same[0]):
            to_row, to_col = np.full(len(a), -1), np.full(len(b), -1)
            to_row[rows], to_col[cols] = np.arange(len(rows)), np.arange(len(cols))
            left, right = to_row[same[0]], to_col[same[1]]
            left, right = left[(left >= 0) & (right >= 0)], right[(left >= 0) & (right >= 0)]
            by = np.argsort(left, kind="stable")
            left, right = left[by], right[by]
        step = max(1, step_cells // len(y))
        for s in range(0, len(x), step):
            first, last = np.searchsorted(left, [s, s + step])
            for kind in kinds:
                p, q = sides[kind]
                with np.errstate(all="ignore"):
                    near = p[s:s + step] @ q.T
                    near[:, len(cols):] = np.inf
                    near[left[first:last] - s, right[first:last]] = np.inf
                    if not most < 1e300:
                        near[~np.isfinite(near)] = np.inf
                    least = near.reshape(len(near), groups, group).min(2)
                    nth = min(k, groups) - 1
                    slack = max(1e-9, 4 * (width + 8) * float(np.finfo(kind).eps)) * (xx[s:s + step] + 2 * yy.max()) + 1e-37
                    cut = (np.partition(least, nth, axis=1)[:, nth] + slack)[:, None]
                r, g = np.nonzero((least <= cut) & (least < np.inf))
                if kind is np.float64 or len(r) <= 32 * k * len(near):
                    break
            some = near.reshape(len(near), groups, group)[r, g]
            i, j = np.nonzero((some <= cut[r]) & (some < np.inf))
            r, c = r[i], g[i] * group + j
            d = np.empty(len(r))
            with np.errstate(over="ignore"):
                for n in range(0, len(r), 1 << 15):
                    diff = a[rows[s + r[n:n + (1 << 15)]]].astype(np.float64) - b[cols[c[n:n + (1 << 15)]]]
                    d[n:n + (1 << 15)] = np.einsum("ij,ij->i", diff, diff)
            order = np.lexsort((rank[cols[c]], d, r))
            r, c, d = r[order], c[order], d[order]
            keep = (np.arange(len(r)) - np.searchsorted(r, r) < k) & (d < np.inf)
            found.append((rows[s + r[keep]], cols[c[keep]], d[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _nearest_of_pieces(k: int, exclude_self: bool, names):
    """For a cogroup's two Arrow tables (_id, _f and _id, _lab, _f): a table of the
    query id, the neighbour's id, label and squared distance under ``names``."""
    def best(q, lab):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        rank = np.empty(len(lab), int)
        rank[pc.sort_indices(lab["_id"]).to_numpy()] = np.arange(len(lab))
        same = _same_ids(q["_id"], lab["_id"]) if exclude_self else None
        r, c, d = _nearest(_matrix(q["_f"]), _matrix(lab["_f"]), k, rank, same)
        return pa.table([q["_id"].take(pa.array(r)), lab["_id"].take(pa.array(c)), lab["_lab"].take(pa.array(c)), pa.array(d)], names=names)
    return best


def _vector(df: DataFrame, features: str) -> Column:
    """The vectors as shuffled: float stays float, any other number becomes double."""
    return F.col(features) if df.schema[features].dataType.simpleString() == "array<float>" else F.col(features).cast("array<double>")


def knn_classify(queries: DataFrame, labelled: DataFrame, k: int = 1, metric: str = "distance",
                 id_col: str = "id", label_col: str = "label", features: str = "features",
                 block_bytes: int = 16 << 20, exclude_self: bool = False) -> DataFrame:
    """Exact k-nearest-neighbour label of every query row (W34).

    ``features`` is a numeric array column on both sides. Every query has to
    meet every labelled row, so both sides are cut into pieces of about
    ``block_bytes``; each query is listed once per labelled piece and each
    labelled row once per query piece, and one task computes one pair of
    pieces: a matrix product, the best k and their ties, recomputed exactly.
    For a fixed labelled side the shuffled rows grow with the queries alone.
    The k best over all pieces are picked by a windowed top-k per query.

    ``metric``: 'distance' (squared Euclidean, smaller is nearer) or
    'similarity' (1 / (1 + Euclidean), larger is nearer); both rank the
    same way, only the reported score differs (SURVEY Q36). Equal distances
    go to the smaller neighbour id, equal votes to the smaller label.
    ``exclude_self`` drops a row's pair with itself. Ids and labels may be of
    any ordered type. Every query has a row: one without a neighbour at a
    finite distance (a vector with NaN, null or no values, or nothing to
    compare with) has a null label.
    """
    def sized(df):  # rows and the widest vector: two numbers
        n, w = df.agg(F.count(F.lit(1)), F.max(F.size(features))).first()
        return max(1, math.ceil(n * max(w or 1, 1) * 8 / block_bytes)), n

    tiles, n_lab = sized(labelled)
    blocks, n_q = sized(queries)
    per_side = math.ceil(math.sqrt(queries.sparkSession.sparkContext.defaultParallelism))
    tiles, blocks = max(tiles, min(per_side, n_lab)), max(blocks, min(per_side, n_q))  # occupy every core
    id_type, n_type = (d.schema[id_col].dataType.simpleString() for d in (queries, labelled))
    lab_type = labelled.schema[label_col].dataType.simpleString()
    lab = labelled.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_lab"), _vector(labelled, features).alias("_f"),
                          F.pmod(F.xxhash64(id_col), F.lit(tiles)).alias("_tile"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_blk"))
    q = queries.select(F.col(id_col).alias("_id"), _vector(queries, features).alias("_f"),
                       F.pmod(F.xxhash64(id_col), F.lit(blocks)).alias("_blk"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("_tile"))
    # an explicit width keeps AQE from merging the CPU-heavy groups
    q, lab = (d.repartition(blocks * tiles, "_blk", "_tile") for d in (q, lab))
    cand = (q.groupBy("_blk", "_tile").cogroup(lab.groupBy("_blk", "_tile"))
            .applyInArrow(_nearest_of_pieces(k, exclude_self, ["qid", "nid", "lab", "d"]),
                          schema=f"qid {id_type}, nid {n_type}, lab {lab_type}, d double"))
    w = Window.partitionBy("qid").orderBy("d", "nid")
    top = cand.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k)
    score = F.col("d") if metric == "distance" else F.lit(1.0) / (F.lit(1.0) + F.sqrt(F.col("d")))
    if k == 1:
        out = top.select("qid", F.col("lab").alias(label_col), F.col("nid").alias("neighbour"), score.alias("score"))
    else:
        votes = top.groupBy("qid", "lab").agg(F.count(F.lit(1)).alias("_v"))
        out = votes.groupBy("qid").agg(F.min(F.struct((-F.col("_v")).alias("v"), F.col("lab").alias("l"))).alias("_w")) \
            .select("qid", F.col("_w.l").alias(label_col))
    every = queries.select(F.col(id_col).alias("_q"))
    return every.join(out, every["_q"] == out["qid"], "left").drop("qid").withColumnRenamed("_q", id_col) \
        .select(id_col, *out.columns[1:])


def _pivot_distances(pivots):
    """Distances of an array of vectors to the pivots; rows that are no finite
    vector of the pivots' width are NaN."""
    import numpy as np

    def distances(vectors):
        width = pivots.shape[1]
        x = np.array([v if v is not None and len(v) == width else [np.nan] * width for v in vectors], np.float64).reshape(-1, width)
        x[~np.isfinite(x).all(1)] = np.nan
        # by differences, not by a product: bounds must not suffer from cancellation
        return np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], 1) if len(pivots) else np.zeros((len(x), 0))
    return distances


def knn_pruned(queries: DataFrame, labelled: DataFrame, k: int = 1, id_col: str = "id", label_col: str = "label",
               features: str = "features", n_pivots: int = 64, tile_rows: int = 32768, block_rows: int = 32768,
               exclude_self: bool = False, counted: dict | None = None) -> DataFrame:
    """W34's exact nearest neighbours with tiles left out by the triangle
    inequality: query id, neighbour, label, score (squared distance), rank (from 1).

    ``n_pivots`` labelled rows (those of smallest hash) are pivots; every labelled
    row is in the cell of its nearest one, cut into tiles. A cell knows its
    radius and the distances of its first k + 1 rows. A query's distances to the
    pivots then bound its k-th neighbour from above (a pivot's distance plus
    that of the pivot's k-th row) and every row of a cell from below (a pivot's
    distance less the radius); cells that cannot hold a neighbour are never
    paired with it. A pair of pieces is one task, computed as in :func:`knn_classify`.
    Ties go to the smaller neighbour id. Queries and labelled rows
    without a finite vector of the pivots' width have no neighbours. ``counted``, if
    given, receives the (query, cell) pairs listed and possible.
    """
    import numpy as np
    import pandas as pd

    id_type, lab_type = (labelled.schema[c].dataType.simpleString() for c in (id_col, label_col))
    q_type = queries.schema[id_col].dataType.simpleString()
    whole = F.forall("_f", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = labelled.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_lab"), _vector(labelled, features).alias("_f")).filter(whole & (F.size("_f") > 0))
    # at most n_pivots vectors
    some = rows.orderBy(F.xxhash64("_id"), "_id").limit(n_pivots).select("_f").collect()
    if not some:
        return labelled.sparkSession.createDataFrame([], f"`{id_col}` {q_type}, neighbour {id_type}, `{label_col}` {lab_type}, score double, rank int")
    width = len(some[0]["_f"])
    pivots = np.unique(np.array([r["_f"] for r in some if len(r["_f"]) == width]), axis=0)
    distances = _pivot_distances(pivots)

    @F.pandas_udf("cell int, d double")
    def nearest(f):
        d = distances(f)
        at = np.where(np.isnan(d).any(1), -1, np.argmin(np.nan_to_num(d, nan=np.inf), 1))
        return pd.DataFrame({"cell": at.astype("int32"), "d": d[np.arange(len(d)), np.maximum(at, 0)]})

    rows = rows.withColumn("_at", nearest("_f")).filter("_at.cell >= 0").select(
        "_id", "_lab", "_f", F.col("_at.cell").alias("_cell"), F.col("_at.d").alias("_d"))
    path = scratch_path(labelled.sparkSession, "knn-cells")
    rows = stored(rows, path)
    need = k + (1 if exclude_self else 0)
    w = Window.partitionBy("_cell").orderBy("_d")
    near = (rows.select("_cell", "_d").withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= need)
            .groupBy("_cell").agg(F.max("_d").alias("near"), F.max("_r").alias("n_near")))
    # a row per pivot
    cells = {r["_cell"]: r for r in rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_d").alias("radius"))
             .join(near, "_cell").collect()}
    radius = np.array([cells[c]["radius"] if c in cells else -np.inf for c in range(len(pivots))])
    reach = np.array([cells[c]["near"] if c in cells and cells[c]["n_near"] >= need else np.inf for c in range(len(pivots))])
    tiles = np.array([math.ceil(cells[c]["n"] / tile_rows) if c in cells else 0 for c in range(len(pivots))])

    @F.pandas_udf("array<int>")
    def worth(f):
        d = distances(f)
        slack = 1e-9 * (1 + np.nan_to_num(d).max(initial=0))
        upper = (d + reach).min(1, keepdims=True) if len(d) else np.zeros((0, 1))
        with np.errstate(invalid="ignore"):
            keep = (d - radius <= upper + slack) & (tiles > 0)
        return pd.Series([np.flatnonzero(r).astype("int32") for r in keep])

    asked = queries.select(F.col(id_col).alias("_id"), _vector(queries, features).alias("_f")).filter(whole & (F.size("_f") == width))
    # a vector once, with the list of its cells
    asked = stored(asked.withColumn("_cells", worth("_f")), scratch_path(labelled.sparkSession, "knn-asked"))
    listed = {r["_cell"]: r["n"] for r in asked.select(F.explode("_cells").alias("_cell")).groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per pivot
    if counted is not None:
        counted["pairs"], counted["possible"] = sum(listed.values()), queries.count() * int((tiles > 0).sum())
    spark = labelled.sparkSession
    sizes = spark.createDataFrame([(c, int(tiles[c]), math.ceil(n / block_rows)) for c, n in listed.items()], "_c int, _tiles int, _blocks int")
    sizes = F.broadcast(sizes)  # a row per pivot

    def upto(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (asked.select("_id", "_f", F.explode("_cells").alias("_cell")).join(sizes, F.col("_cell") == F.col("_c")).withColumn("_tile", upto("_tiles"))
            .withColumn("_blk", F.pmod(F.xxhash64("_id"), F.col("_blocks").cast("long")).cast("int")).select("_id", "_f", "_cell", "_tile", "_blk"))
    right = (rows.join(sizes, F.col("_cell") == F.col("_c")).withColumn("_blk", upto("_blocks"))
             .withColumn("_tile", F.pmod(F.xxhash64("_id"), F.col("_tiles").cast("long")).cast("int")).select("_id", "_lab", "_f", "_cell", "_tile", "_blk"))
    # about a pair of pieces to a task; an explicit width keeps AQE from merging them
    keys = ["_cell", "_tile", "_blk"]
    pairs = sum(int(tiles[c]) * math.ceil(n / block_rows) for c, n in listed.items())
    left, right = (d.repartition(max(1, min(pairs, 10_000)), *keys) for d in (left, right))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _nearest_of_pieces(k, exclude_self, ["_q", "neighbour", "_lab", "score"]), f"_q {q_type}, neighbour {id_type}, _lab {lab_type}, score double")
    rank = F.row_number().over(Window.partitionBy("_q").orderBy("score", "neighbour"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("_q").alias(id_col), "neighbour", F.col("_lab").alias(label_col), "score", "rank")


# --- W35 churn model ----------------------------------------------------------


def churn_pipeline(feature_cols: Sequence[str], label_col: str = "label", max_iter: int = 1000,
                   tol: float = 1e-10) -> Pipeline:
    """Vector assembly → min-max scaling → logistic regression (W35)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(feature_cols), outputCol="vec"),
        MinMaxScaler(inputCol="vec", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter, tol=tol),
    ])


def fit_churn(train: DataFrame, feature_cols: Sequence[str], label_col: str = "label", max_iter: int = 1000) -> PipelineModel:
    """The fitted pipeline, as saved and read back; an optimiser that stopped
    before it converged raises. A model fresh from the fit holds its training
    summary and with it the session, which tasks cannot take along once the
    caller has observed a query's metrics in it."""
    train = train.persist()  # the optimiser reads it once per iteration
    try:
        model = churn_pipeline(feature_cols, label_col, max_iter).fit(train)
    finally:
        train.unpersist()
    if model.stages[-1].summary.totalIterations >= max_iter:
        raise RuntimeError(f"logistic regression did not converge in {max_iter} iterations")
    path = scratch_path(train.sparkSession, "churn-model")
    model.write().save(path)
    model = PipelineModel.load(path)
    remove_path(train.sparkSession, path)
    return model


def churn_gradient(model: PipelineModel, train: DataFrame, feature_cols: Sequence[str],
                   label_col: str = "label") -> DataFrame:
    """feature, gradient: the mean loss' derivative for each scaled feature and
    the intercept. At the optimum all are 0."""
    from pyspark.ml.functions import vector_to_array
    p = model.transform(train).select(vector_to_array("features").alias("x"), F.col(label_col).alias("y"),
                                      vector_to_array("probability")[1].alias("p"))
    names = [*feature_cols, "intercept"]
    cells = [F.avg((F.col("p") - F.col("y")) * (F.col("x")[i] if i < len(feature_cols) else F.lit(1.0))).alias(n)
             for i, n in enumerate(names)]
    return p.agg(*cells).select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(n).alias("gradient")) for n in names])).alias("r")).select("r.*")


def predict(model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return model.transform(df).select(*keep, "prediction")


def min_max_scale(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Min-max scaling of each column to [0, 1] as plain aggregates (the
    scaler of W35 without vectors; constant columns give 0.5 as MLlib's
    MinMaxScaler does). One global aggregate (partial per task) yields two
    numbers per column, which become literals of the scaling expression."""
    stats = df.agg(*[F.min(c).cast("double").alias(f"mn{i}") for i, c in enumerate(feature_cols)],
                   *[F.max(c).cast("double").alias(f"mx{i}") for i, c in enumerate(feature_cols)]).first()
    out = []
    for i, c in enumerate(feature_cols):
        mn, mx = stats[f"mn{i}"], stats[f"mx{i}"]
        x = F.col(c).cast("double")
        out.append((F.lit(0.5) if mx == mn else (x - F.lit(mn)) / F.lit(mx - mn)).alias(c))
    return df.select(*[x for x in df.columns if x not in feature_cols], *out)


def split_by_key(df: DataFrame, key: str, test_fraction: float = 0.2):
    """Deterministic train/test split on a hash of ``key``: the
    first 8 hex digits of md5(key) modulo 1000, so any engine can repeat it."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 1000
    cut = int(round(test_fraction * 1000))
    return df.filter(h >= cut), df.filter(h < cut)


# --- W36 text classification --------------------------------------------------

# The tokenizer drops punctuation and one-character tokens; this word is left to drop.
DEFAULT_STOP_WORDS = ["哪里"]

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"

TASK_TEXT_BYTES = 8 << 20  # text whose terms one task counts
MOST_FREQUENT = 200_000  # numbers by term that a join broadcasts


def tokenize(text: Column | str, stop_words: Sequence[str] = DEFAULT_STOP_WORDS, min_len: int = 2) -> Column:
    """Lower-cased letter/digit runs of the whole text, minus stop words and
    tokens shorter than ``min_len``."""
    t = F.col(text) if isinstance(text, str) else text
    toks = F.split(F.lower(t), TOKEN_SPLIT)
    stops = F.array(*[F.lit(s) for s in stop_words]) if stop_words else F.array().cast("array<string>")
    return F.filter(toks, lambda w: (F.length(w) >= min_len) & ~F.array_contains(stops, w))


def hashed_tf(docs: DataFrame, text_col: str = "text", num_features: int = 100_000,
              stop_words: Sequence[str] = DEFAULT_STOP_WORDS) -> DataFrame:
    """Adds ``words`` and ``tf_vec``, the counts of the words' hash buckets (W36);
    a null text has no words."""
    w = docs.withColumn("words", F.coalesce(tokenize(text_col, stop_words), F.array().cast("array<string>")))
    return HashingTF(inputCol="words", outputCol="tf_vec", numFeatures=num_features).transform(w)


def tfidf(docs: DataFrame, text_col: str = "text", num_features: int = 100_000,
          stop_words: Sequence[str] = DEFAULT_STOP_WORDS):
    """Hashed term frequencies and IDF weights (W36): adds ``words``,
    ``tf_vec`` and ``tf_idf_vec``; returns (DataFrame, IDF model)."""
    tf = hashed_tf(docs, text_col, num_features, stop_words)
    model = IDF(inputCol="tf_vec", outputCol="tf_idf_vec").fit(tf)
    return model.transform(tf), model


def term_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               stop_words: Sequence[str] = DEFAULT_STOP_WORDS, buckets: int | None = None,
               more: DataFrame | None = None) -> DataFrame:
    """TF-IDF per (document, term): tf, df, idf = ln((m + 1) / (df + 1)) as
    MLlib's IDF computes it. With ``buckets`` a term is its hash bucket (the
    first 8 hex digits of its md5, modulo), so any engine can repeat it. The
    counts of the terms in each document are written once, for the document
    frequencies and for the join with them. ``more``, one row per id at most,
    adds its other columns to all rows of a document, null where it has none.
    """
    spark = docs.sparkSession
    d = docs.select(id_col, text_col)
    m, n_bytes = d.agg(F.count(F.lit(1)), F.sum(F.octet_length(text_col))).first()
    # Hash partitioning on the id already satisfies the (id, term) grouping, so
    # the term counts need no second shuffle; an explicit width bounds the text,
    # and with it the counts, of one task. Explode, then filter with plain
    # predicates (codegen) rather than a per-element lambda.
    parts = max(spark.sparkContext.defaultParallelism, math.ceil((n_bytes or 0) / TASK_TEXT_BYTES))
    d = d.repartition(parts, id_col)
    toks = d.select(id_col, F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)).alias("term"))
    toks = toks.filter((F.length("term") >= 2) & ~F.col("term").isin(list(stop_words)))
    if buckets:
        toks = toks.select(id_col, (F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("long") % buckets).alias("term"))
    tf = toks.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    extra = [] if more is None else [c for c in more.columns if c != id_col]
    if more is not None:
        # dealt out like the text, so it comes to the counts, which neither move nor are sorted
        tf = tf.join(more.repartition(parts, id_col).hint("shuffle_hash"), id_col, "left")
    tf = stored(tf, scratch_path(spark, "term-counts"))
    df_ = stored(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), scratch_path(spark, "term-documents"))
    idf = df_.select("term", "df", F.log(F.lit(float(m + 1)) / (F.col("df") + 1)).alias("idf"))
    return join_by_frequency(tf, idf, "term", "df", MOST_FREQUENT).select(
        id_col, "term", "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf"), *extra)


def fit_text_nb(train: DataFrame, label_col: str = "label", smoothing: float = 1.0) -> NaiveBayesModel:
    return NaiveBayes(featuresCol="tf_idf_vec", labelCol=label_col, smoothing=smoothing,
                      modelType="multinomial").fit(train)


def fit_text_model(docs: DataFrame, train: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "label", num_features: int = 100_000, smoothing: float = 1.0) -> PipelineModel:
    """The whole chain of W36: hashed term counts, inverse document frequencies
    over all ``docs``, naive Bayes on the labelled ``train`` (id, label) – saved
    to ``path`` as one model and read back. Labels are 0, 1, 2, ...; the model
    holds a number per class and bucket, whatever the corpus."""
    weighted, idf = tfidf(docs.select(id_col, text_col), text_col, num_features)
    t = train.select(F.col(id_col).alias("_t"), F.col(label_col).cast("double").alias(label_col))
    nb = fit_text_nb(weighted.join(t, F.col(id_col) == F.col("_t")).select("tf_idf_vec", label_col), label_col, smoothing)
    chain = PipelineModel([HashingTF(inputCol="words", outputCol="tf_vec", numFeatures=num_features), idf, nb])
    chain.write().overwrite().save(path)
    return PipelineModel.load(path)


def classify_texts(model: PipelineModel, docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with the prediction of a model of :func:`fit_text_model`."""
    words = docs.withColumn("words", F.coalesce(tokenize(text_col), F.array().cast("array<string>")))
    return model.transform(words).select(*keep, "prediction")


# --- W37 profile model --------------------------------------------------------


def bucket(c: Column | str, width: float, n: int) -> Column:
    """0 .. n−1 by steps of ``width``; the last bucket is open-ended."""
    col = F.col(c) if isinstance(c, str) else c
    return F.least(F.greatest(F.floor(col / F.lit(width)), F.lit(0)), F.lit(n - 1)).cast("double")


def code(c: Column | str, mapping: dict) -> Column:
    """Categorical value → numeric code by a fixed mapping (CASE WHEN)."""
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(float(v))) if out is None else out.when(col == k, F.lit(float(v)))
    # a value that the mapping lacks is a category of its own, after the others
    return out.otherwise(F.lit(float(max(mapping.values()) + 1))).cast("double")


def fit_profile_nb(train: DataFrame, feature_cols: Sequence[str], label_col: str = "label",
                   smoothing: float = 0.01, path: str | None = None) -> NaiveBayesModel:
    """Multinomial naive Bayes on the encoded profile (W37); saved to
    ``path`` when given (the caller reloads it with :func:`load_profile_nb`)."""
    v = VectorAssembler(inputCols=list(feature_cols), outputCol="features").transform(train)
    model = NaiveBayes(featuresCol="features", labelCol=label_col, smoothing=smoothing,
                       predictionCol="cheat").fit(v)
    if path:
        model.write().overwrite().save(path)
    return model


def load_profile_nb(path: str) -> NaiveBayesModel:
    return NaiveBayesModel.load(path)


def predict_profile(model: NaiveBayesModel, df: DataFrame, feature_cols: Sequence[str],
                    keep: Sequence[str] = ()) -> DataFrame:
    v = VectorAssembler(inputCols=list(feature_cols), outputCol="features").transform(df)
    return model.transform(v).select(*keep, "cheat")


MOST_CLASSES = 1000  # every document is scored for every class


def classes_by_id(train: DataFrame, id_col: str = "doc_id", label_col: str = "label") -> DataFrame:
    """A row per id: ``classes``, its labels c in ``train`` with the number n of their rows."""
    return (train.groupBy(id_col, F.col(label_col).alias("c")).agg(F.count(F.lit(1)).alias("n"))
            .groupBy(id_col).agg(F.collect_list(F.struct("c", "n")).alias("classes")))


def naive_bayes_terms(weights: DataFrame, train: DataFrame, smoothing: float = 1.0,
                      id_col: str = "doc_id", label_col: str = "label") -> DataFrame:
    """Multinomial naive Bayes on (document, term, weight) rows, as joins
    and aggregates (W36 without hashing the terms).

    ``weights``: id, term, w (e.g. TF-IDF) for every document to score;
    ``train``: id, label of the training documents. ``weights`` may bring
    the ``classes`` of :func:`classes_by_id` along; without them all its rows
    are shuffled to the labels. With λ = ``smoothing``,
    V the vocabulary of ``weights`` and S(c, t) the summed weight of term t
    in class c: π_c = ln(n_c + λ) − ln(N + Kλ), θ(c, t) = ln(S(c, t) + λ) −
    ln(Σ_t S(c, t) + Vλ), and each document's class maximises
    π_c + Σ_t w_t θ(c, t) (ties to the smaller label), as MLlib's
    multinomial model does on its feature vectors. The sum over unseen
    terms is folded into a per-document total. The weights are written once,
    with their document's classes; the sums of the most frequent terms come to
    them by broadcast. Classes are a handful of labels.
    """
    spark = weights.sparkSession
    lam = float(smoothing)
    tr = train.select(F.col(id_col).alias("_d"), F.col(label_col).alias("c"))
    if "classes" not in weights.columns:  # the hash of the few labels spares the weights a sort
        weights = weights.join(classes_by_id(train, id_col, label_col).hint("shuffle_hash"), id_col, "left")
    w = stored(weights.select(F.col(id_col).alias("_d"), "term", F.col("w").cast("double").alias("w"), F.col("classes").alias("_cs")),
               scratch_path(spark, "nb-weights"))
    # a row per term and class; a null class holds the terms of the documents without one
    s_ct = stored(w.select("term", "w", F.explode_outer("_cs").alias("e")).groupBy("term", F.col("e.c").alias("c")).agg(
        F.sum(F.col("w") * F.col("e.n")).alias("s"), F.count(F.lit(1)).alias("n")), scratch_path(spark, "nb-sums"))
    n_c = tr.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    t_c = s_ct.groupBy("c").agg(F.sum("s").alias("t"))
    vocab = s_ct.select("term").distinct().count()
    stats = n_c.join(t_c, "c", "left").limit(MOST_CLASSES + 1).collect()  # one row per class
    if len(stats) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    n_total, k = sum(r["n"] for r in stats), len(stats)
    classes = sorted(r["c"] for r in stats)
    prior = {r["c"]: math.log(r["n"] + lam) - math.log(n_total + k * lam) for r in stats}
    log_den = {r["c"]: math.log((r["t"] or 0.0) + vocab * lam) for r in stats}

    def per_class(mapping):
        expr = None
        for c in classes:
            expr = (F.when(F.col("c") == F.lit(c), F.lit(mapping[c])) if expr is None
                    else expr.when(F.col("c") == F.lit(c), F.lit(mapping[c])))
        return expr

    kind = tr.schema["c"].dataType.simpleString()
    gain = F.when(F.col("c").isNotNull(), F.struct("c", (F.log(F.col("s") + lam) - math.log(lam)).alias("g")))
    terms = stored(s_ct.groupBy("term").agg(F.sum("n").alias("n"), F.collect_list(gain).alias("_gs")), scratch_path(spark, "nb-terms"))
    met = join_by_frequency(w.select("_d", "term", "w"), terms, "term", "n", MOST_FREQUENT // max(k, 1), "left")
    # the entry without a class sums the weights themselves
    whole = F.array(F.struct(F.lit(None).cast(kind).alias("c"), F.lit(1.0).alias("g")))
    parts = met.select("_d", "w", F.explode(F.concat(whole, F.coalesce("_gs", F.array().cast(f"array<struct<c:{kind},g:double>>")))).alias("e"))
    sums = parts.groupBy("_d", F.col("e.c").alias("c")).agg(F.sum(F.col("w") * F.col("e.g")).alias("v"))
    by_doc = sums.groupBy("_d").agg(
        F.max(F.when(F.col("c").isNull(), F.col("v"))).alias("_wd"),
        F.map_from_entries(F.collect_list(F.when(F.col("c").isNotNull(), F.struct("c", "v")))).alias("_seen"))
    grid = by_doc.select("_d", "_wd", "_seen", F.explode(F.array(*[F.lit(c) for c in classes]).cast(f"array<{kind}>")).alias("c"))
    scored = grid.select("_d", "c", (per_class(prior) + (F.lit(math.log(lam)) - per_class(log_den)) * F.col("_wd")
                                     + F.coalesce(F.col("_seen")[F.col("c")], F.lit(0.0))).alias("_score"))
    best = scored.groupBy("_d").agg(F.max_by("c", F.struct(F.col("_score"), -F.col("c"))).alias("prediction"))
    return best.select(F.col("_d").alias(id_col), "prediction")
