"""Quality classifier by co-training.

Two views of a document, a text classifier (shape of the content) and a
metadata classifier (language, source, stated length), start from the labels
of a training part. Over some rounds each view labels the unlabelled
documents it is confident about, and the other view learns from them. At
the end both views are calibrated on labels that no round has seen, and
their calibrated odds are combined to score every document.

Both classifiers are naive Bayes over binned features, so a round is one
grouped count over all documents: nothing is sampled, and what reaches the
driver is a table of (feature, bin, label) counts. Languages and sources are
counted by value (64-bit hashes); there may be many, so the odds of a value
are a stored table that is joined, and rare values have odds near the prior.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plover.llm.common import stage, text_key

ROUNDS = 3
CONFIDENT = 0.95  # calibrated probability that a view needs to label a document
PSEUDO_WEIGHT = 0.2  # of a pseudo-label, as a share of a label
RARE = 2.0  # labels at the prior that each metadata value has besides its own
KEEP = 0.5
STEPS = 40  # calibration bins over log-odds from -10 to 10
_RATIOS = (0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.8)
_SIZES = (0, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10000, 50000)


def _bins(values: Column, edges) -> Column:
    """For each value of an array the number of edges that it is above. The
    values stand once in the expression, so it stays small."""
    ends = F.lit([float(e) for e in edges])
    return F.transform(values, lambda x: F.size(F.filter(ends, lambda e: x > e)))


def text_shape(text: str) -> Column:
    """Eight ratios, the word length and the number of words."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.split(F.trim(t), "[ \\t\\r\\n]+")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.split(t, "\n")

    def gone(shorter):
        return F.length(t) - F.length(shorter)

    ratios = [
        gone(F.replace(t, F.lit("|"), F.lit(""))) / n_words,
        gone(F.translate(t, "%$#&*@^~", "")) / chars,
        gone(F.replace(t, F.lit("!"), F.lit(""))) / n_words,
        gone(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")) / chars,
        gone(F.translate(t, "0123456789", "")) / chars,
        F.lit(1.0) - F.size(F.array_distinct(words)) / n_words,
        F.lit(1.0) - F.size(F.array_distinct(lines)) / F.size(lines),
        F.size(lines) / n_words,
    ]
    return F.array(*ratios, chars / n_words, n_words)


def text_bins(shape: Column) -> Column:
    return F.concat(_bins(F.slice(shape, 1, 8), _RATIOS), _bins(F.slice(shape, 9, 1), range(1, 14)),
                    _bins(F.slice(shape, 10, 1), _SIZES))


def meta_keys(docs: DataFrame, columns: tuple[str, ...]) -> Column:
    """Hashes of the values of the metadata columns that the documents have."""
    return F.array(*[F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns if c in docs.columns]) \
        .cast("array<bigint>")


def meta_bins(docs: DataFrame, size_col: str | None) -> Column:
    sized = [_bins(F.array(F.coalesce(F.col(size_col).cast("double"), F.lit(0.0))), _SIZES)] if size_col in docs.columns else []
    return F.concat(F.array(F.lit(0)), *sized)


def _counts(rows: DataFrame, taught: dict[str, Column]) -> dict[str, dict]:
    """For each view {(feature, bin): {(label, is pseudo): rows}}, with totals at
    (-1, 0). One count serves all views."""
    def cells(view):
        bins = F.transform(view, lambda b, f: F.struct(F.lit(view).alias("v"), f.alias("f"), b.alias("b"),
                                                       F.col("y_" + view).alias("y")))
        return F.concat(F.array(F.struct(F.lit(view).alias("v"), F.lit(-1).alias("f"), F.lit(0).alias("b"),
                                         F.col("y_" + view).alias("y"))), bins)

    got = (rows.select(*taught, F.col("label").isNull().alias("pseudo"), *[y.alias("y_" + v) for v, y in taught.items()])
           .select("pseudo", F.explode(F.concat(*[cells(v) for v in taught])).alias("x")).filter("x.y is not null")
           .groupBy("x.v", "x.f", "x.b", "x.y", "pseudo").count().collect())
    out: dict = {v: {} for v in taught}
    for r in got:
        out[r["v"]].setdefault((r["f"], r["b"]), {})[(r["y"], r["pseudo"])] = r["count"]
    return out


def _log_odds(counts: dict) -> dict:
    """Smoothed log-odds by (feature, bin); the prior is at (-1, 0)."""
    def weight(cell, y):
        return cell.get((y, False), 0) + PSEUDO_WEIGHT * cell.get((y, True), 0)

    total = counts.get((-1, 0), {})
    good, bad = weight(total, 1) + 1, weight(total, 0) + 1
    out = {k: math.log((weight(c, 1) + 0.5) / (good + 1)) - math.log((weight(c, 0) + 0.5) / (bad + 1))
           for k, c in counts.items()}
    return out | {(-1, 0): math.log(good / bad)}


def _value_odds(rows: DataFrame, y: Column, counts: dict) -> DataFrame:
    """f, b, odds: the smoothed log-odds of every taught value of ``meta_keys``."""
    total = counts.get((-1, 0), {})
    good, bad = (total.get((k, False), 0) + PSEUDO_WEIGHT * total.get((k, True), 0) + 1 for k in (1, 0))

    def weight(k):
        own, pseudo = (F.sum(((F.col("y") == k) & (F.col("pseudo") == p)).cast("long")) for p in (False, True))
        return own + PSEUDO_WEIGHT * pseudo

    said = rows.select(F.col("label").isNull().alias("pseudo"), y.alias("y"), F.posexplode("meta_keys").alias("f", "b"))
    said = said.filter("y is not null").groupBy("f", "b").agg(
        (F.log((weight(1) + RARE * good / (good + bad)) / good)
         - F.log((weight(0) + RARE * bad / (good + bad)) / bad)).alias("odds"))
    return stage(said, "quality-value-odds")


def _with_value_odds(rows: DataFrame, odds: DataFrame, n: int) -> DataFrame:
    """Adds value_odds, the sum over the n metadata values of a row (0 for values
    that no label has)."""
    for k in range(n):
        t = odds.filter(F.col("f") == k).select(F.col("b").alias(f"_b{k}"), F.col("odds").alias(f"_o{k}"))
        rows = rows.join(t, F.get("meta_keys", F.lit(k)) == t[f"_b{k}"], "left")
    total = F.lit(0.0)
    for k in range(n):
        total = total + F.coalesce(f"_o{k}", F.lit(0.0))
    return rows.withColumn("value_odds", total).drop(*[f"_{c}{k}" for k in range(n) for c in "bo"])


def _score(odds: dict, view: str) -> Column:
    """Log-odds of a view's bins; bins that no label has count nothing."""
    last = max((f for f, _ in odds), default=-1)
    known = [{b: v for (g, b), v in odds.items() if g == f} for f in range(last + 1)]
    tables = F.lit([[k.get(b, 0.0) for b in range(max(k, default=0) + 1)] for k in known] or [[0.0]])
    return F.aggregate(F.transform(view, lambda b, f: F.coalesce(F.get(F.get(tables, f), b), F.lit(0.0))),
                       F.lit(odds.get((-1, 0), 0.0)), lambda total, x: total + x)


def _step(score: Column) -> Column:
    return F.floor(F.least(F.greatest(score, F.lit(-10.0)), F.lit(9.999)) * (STEPS / 20) + STEPS / 2).cast("int")


def _calibrate(counts: dict) -> list[float]:
    """Non-decreasing probability for each step, by pooling neighbours whose
    smoothed shares fall; steps without labels take their pool's."""
    prior_good, prior_bad = (sum(c[y] for c in counts.values()) for y in (1, 0))
    prior = (prior_good + 1) / (prior_good + prior_bad + 2)
    pools: list[list] = []
    for k in range(STEPS):
        c = counts.get(k)
        if c is None:
            continue
        pools.append([c[1] + prior, c[0] + c[1] + 1.0, [k]])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            g, n, ks = pools.pop()
            pools[-1] = [pools[-1][0] + g - prior, pools[-1][1] + n - 1.0, pools[-1][2] + ks]
    if not pools:
        return [prior] * STEPS
    out, at = [], 0
    for k in range(STEPS):
        while at + 1 < len(pools) and k >= pools[at + 1][2][0]:
            at += 1
        out.append(pools[at][0] / pools[at][1])
    return out


def _calibrations(rows: DataFrame, scores: dict[str, Column]) -> dict[str, list[float]]:
    """Probability tables of the views, from the calibration part."""
    got = (rows.filter("part = 'calibrate'").select("label", *[_step(s).alias(v) for v, s in scores.items()])
           .groupBy("label", *scores).count().collect())  # at most 2 * STEPS**2 rows
    out = {}
    for v in scores:
        counts: dict = {}
        for r in got:
            counts.setdefault(r[v], {0: 0, 1: 0})[r["label"]] += r["count"]
        out[v] = _calibrate(counts)
    return out


def _by_step(values: list, score: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in values]), _step(score))


def _pseudo_label(p: float) -> int | None:
    return 1 if p >= CONFIDENT else 0 if p <= 1 - CONFIDENT else None


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, meta_cols: tuple[str, ...],
         size_col: str | None, rounds: int) -> tuple[DataFrame, dict[str, Column], DataFrame]:
    """The documents' views with label and part, the columns p_text, p_meta
    and score as expressions over the view columns, and the odds of metadata
    values."""
    said = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
            .filter("id is not null and y is not null").groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("label")))
    said = stage(said, "quality-labels")
    d = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"), text_shape(text_col).alias("shape"),
                    meta_bins(docs, size_col).alias("meta_view"), meta_keys(docs, meta_cols).alias("meta_keys"))
    n_keys = sum(c in docs.columns for c in meta_cols)
    fold = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("part")), F.lit(4))
    part = F.when(F.col("label").isNotNull(), F.when(fold < 2, "train").when(fold == 2, "calibrate").otherwise("test"))
    views = stage(d.join(said, "id", "left").withColumns({"text_view": text_bins(F.col("shape")), "part": part})
                 .drop("shape"), "quality-views")
    own = F.when(F.col("part") == "train", F.col("label"))
    other = {"text_view": "meta_view", "meta_view": "text_view"}
    taught = {v: own for v in other}
    rows, scores, tables = views, {}, {}
    for _ in range(rounds + 1):
        counts = _counts(rows, taught)
        values = _value_odds(rows, taught["meta_view"], counts["meta_view"])
        rows = _with_value_odds(views, values, n_keys)
        scores = {v: _score(_log_odds(counts[v]), v) for v in other}
        scores["meta_view"] = scores["meta_view"] + F.col("value_odds")
        tables = _calibrations(rows, scores)
        taught = {v: F.when(F.col("label").isNull(), _by_step([_pseudo_label(p) for p in tables[o]], scores[o])).otherwise(own)
                  for v, o in other.items()}
    totals = rows.filter("part = 'calibrate'").agg(F.sum("label"), F.count("label")).first()
    prior = ((totals[0] or 0) + 1) / (totals[1] + 2)
    p_text, p_meta = (_by_step(tables[v], scores[v]) for v in other)
    l_text, l_meta = (_by_step([_logit(p) for p in tables[v]], scores[v]) for v in other)
    odds = l_text + l_meta - F.lit(_logit(prior))
    return rows, {"p_text": p_text, "p_meta": p_meta, "score": F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))}, values


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", meta_cols: tuple[str, ...] = ("lang", "source"),
                    size_col: str | None = "n_chars", rounds: int = ROUNDS, keep: float = KEEP) -> DataFrame:
    """One row per input row: id, t (64-bit text hash), label (the given one or
    null), part (train, calibrate, test or null), p_text, p_meta, score and
    accepted (score >= keep).

    Labelled documents fall into the parts by a hash of their id (half, a
    quarter, a quarter); rounds see the first, calibration the second, and
    the third is for measuring. Several labels of an id count by majority
    (ties: good); null ids and labels are ignored. Null and empty texts are
    scored by their (empty) features, so are missing metadata columns. With
    no labels the score is 0.5 and everything is accepted."""
    rows, out, _ = _fit(docs, labels, id_col, text_col, label_col, meta_cols, size_col, rounds)
    return rows.withColumns(out).select(F.col("id").alias(id_col), "t", "label", "part", *out,
                                        _accepts(F.col("score"), keep).alias("accepted"))


def _accepts(score: Column, keep: float) -> Column:
    return F.round(score, 9) >= keep


def accepted_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       label_col: str = "quality", meta_cols: tuple[str, ...] = ("lang", "source"),
                       size_col: str | None = "n_chars", rounds: int = ROUNDS, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns unchanged. The
    fitted score is an expression over a row and the odds of its metadata
    values, a table that Spark broadcasts unless there are very many."""
    _, out, values = _fit(docs, labels, id_col, text_col, label_col, meta_cols, size_col, rounds)
    seen = docs.select(F.struct(*docs.columns).alias("doc"), text_shape(text_col).alias("shape"),
                       meta_bins(docs, size_col).alias("meta_view"), meta_keys(docs, meta_cols).alias("meta_keys"))
    seen = _with_value_odds(seen, values, sum(c in docs.columns for c in meta_cols))
    # One row each; a filter isn't pushed below it, where it would compute the shape several times for a row.
    seen = seen.select("doc", "meta_view", "value_odds", F.explode(F.array("shape")).alias("shape"))
    seen = seen.withColumn("text_view", text_bins(F.col("shape")))
    return seen.filter(_accepts(out["score"], keep)).select("doc.*")
