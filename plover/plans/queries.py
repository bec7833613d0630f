"""Registered queries over the driver tables: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole tables (or data Spark derives from them); the
matching DuckDB SQL is in ``plover.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plover.functions.columns import epoch_ms
from plover.operators import activity as A
from plover.operators import attribution as AT
from plover.operators import detail as D
from plover.operators import geo as GEO
from plover.operators import graph as G
from plover.operators import models as M
from plover.operators import report as RP
from plover.operators import series as SR
from plover.operators import sessions as S
from plover.operators import usersets as U
from plover.plans import etl as ETL
from plover.session import scratch_path, stored
from plover.sources import io as IO
from plover.sources.applog import app_log, detail_log

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _detail(spark, sf_dir):
    return detail_log(table(spark, sf_dir, "events"))


@register("w17_session_aggregate")
def q_session_aggregate(spark, sf_dir):
    return S.session_aggregate(_detail(spark, sf_dir))


@register("w17_session_aggregate_windowed")
def q_session_aggregate_windowed(spark, sf_dir):
    """W17 merged from per-hour parts."""
    return S.session_aggregate_bucketed(_detail(spark, sf_dir))


@register("w18_traffic_cube")
def q_traffic_cube(spark, sf_dir):
    return S.traffic_cube(S.session_aggregate(_detail(spark, sf_dir)))


@register("w18_traffic_cube_span")
def q_traffic_cube_span(spark, sf_dir):
    """One cube over all days, from the days' stored measures and user sets."""
    sessions = S.session_aggregate(_detail(spark, sf_dir))
    state = S.cube_state(sessions, U.extend_dictionary(sessions))
    return S.cube_of_span(*(stored(part, scratch_path(spark, "cube")) for part in state))


FUNNEL_STEPS_EVENTS = ("pageView", "share", "addCart")


def _funnel_steps():
    return [F.col("eventid") == e for e in FUNNEL_STEPS_EVENTS]


@register("w19_funnel_depth")
def q_funnel_depth(spark, sf_dir):
    return S.funnel_depth(_detail(spark, sf_dir), _funnel_steps(), "view_share_cart",
                          group_cols=("dy", "guid"))


FUNNEL_STEPS_PAGES = (("pageView", "77"), ("share", "91"), ("addCart", "72"))


@register("w19_funnel_pages")
def q_funnel_pages(spark, sf_dir):
    """Steps of an event on a page, over the whole log of a guid."""
    return S.funnel_depth(_detail(spark, sf_dir), S.page_steps(FUNNEL_STEPS_PAGES), "view_share_cart")


# --- detail layer -----------------------------------------------------------


def _log(spark, sf_dir):
    return app_log(table(spark, sf_dir, "events"))


def _clean(spark, sf_dir):
    return D.clean_events(_log(spark, sf_dir))


@register("w01_clean_events")
def q_clean(spark, sf_dir):
    return _clean(spark, sf_dir).select("event_id", "account", "deviceid", "eventid", "sessionid",
                                        "latitude", "longitude", "timestamp", "dy")


@register("w02_sessionize")
def q_sessionize(spark, sf_dir):
    return (D.sessionize(_clean(spark, sf_dir), tiebreak="event_id")
            .select("event_id", "sessionid", "timestamp", "newsession"))


@register("w06_new_users")
def q_new_users(spark, sf_dir):
    return D.flag_new_users_by_day(_log(spark, sf_dir)).select("event_id", "account", "dy", "newuser")


def _scores(spark, sf_dir):
    return D.device_account_scores(_clean(spark, sf_dir), by=["dy"])


@register("w07_device_account_scores")
def q_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


@register("w08_rollover_scores")
def q_rollover(spark, sf_dir):
    return D.rollover_scores(_scores(spark, sf_dir), _clean(spark, sf_dir), day="dy")


def _rolled(spark, sf_dir):
    """W08's score table at the end of each day of the log."""
    daily = _scores(spark, sf_dir)
    first, last = daily.agg(F.min("dy"), F.max("dy")).first()  # two dates
    return D.rolled_scores(daily, last or _dt.date.min, first_day=first)


@register("w09_best_account")
def q_best(spark, sf_dir):
    return D.best_account(_rolled(spark, sf_dir), by=["dy"]).select("dy", "deviceid", "account")


@register("w10_assign_guid")
def q_guid(spark, sf_dir):
    best = D.best_account(_rolled(spark, sf_dir), by=["dy"])
    return (D.assign_guid(_clean(spark, sf_dir), best, day="dy")
            .select("event_id", "deviceid", "account", "guid", "dy"))


# --- activity state ---------------------------------------------------------


def _active(spark, sf_dir):
    return A.active_users(_detail(spark, sf_dir))


def _last_day(active) -> _dt.date:
    # one scalar, the newest day present; it bounds the day spine
    return active.agg(F.max("dy")).first()[0]


def _range_snaps(spark, sf_dir):
    act = _active(spark, sf_dir)
    return A.range_snapshots(act, last_day=_last_day(act))


@register("w26_rollover_ranges")
def q_rollover_ranges(spark, sf_dir):
    act = _active(spark, sf_dir)
    last = _last_day(act)
    prev = A.range_snapshots(act, last_day=last - _dt.timedelta(days=1))
    return A.rollover_ranges(prev, act, day="dy")


@register("w27_visit_interval_detail")
def q_visit_detail(spark, sf_dir):
    return A.visit_interval_detail(_range_snaps(spark, sf_dir), day="dy")


@register("w28_visit_intervals")
def q_visit_intervals(spark, sf_dir):
    return A.visit_intervals(_range_snaps(spark, sf_dir), day="dy")


@register("w29_active_days")
def q_active_days(spark, sf_dir):
    return A.active_days(_range_snaps(spark, sf_dir), day="dy")


@register("w29_active_days_sets")
def q_active_days_sets(spark, sf_dir):
    """W29's counts from its member sets as bitmaps."""
    snaps = _range_snaps(spark, sf_dir)
    sets = A.active_days_sets(snaps, U.extend_dictionary(snaps), day="dy")
    return U.set_sizes(sets, ["dt", "days"], "user_cnt")


@register("w29_active_days_members")
def q_active_days_members(spark, sf_dir):
    return A.active_days_members(_range_snaps(spark, sf_dir), day="dy")


@register("w32_update_bitmap")
def q_bitmap(spark, sf_dir):
    act = _active(spark, sf_dir)
    last = _last_day(act)
    prev = A.bitmap_snapshots(act, last_day=last - _dt.timedelta(days=1))
    return A.update_bitmap(prev, act, day="dy")


@register("w32_update_bitmap_text")
def q_bitmap_text(spark, sf_dir):
    """W32's bitmaps as sums of day values instead of yesterday's bitmap."""
    act = _active(spark, sf_dir)
    return A.bitmap_snapshots(act, last_day=_last_day(act))


# --- attribution ------------------------------------------------------------


TOUCHES = ("click", "view", "signup")
TARGET = "purchase"


def _touch_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("guid"), F.col("event_type").alias("event"),
                     epoch_ms("ts").alias("timestamp"), "event_id")


_AKW = dict(tiebreak="event_id")


@register("w20_event_paths")
def q_paths(spark, sf_dir):
    return AT.event_paths(_touch_events(spark, sf_dir), TOUCHES, TARGET, **_AKW)


@register("w21_first_touch_overall")
def q_first_overall(spark, sf_dir):
    return AT.first_touch_overall(_touch_events(spark, sf_dir), TOUCHES, TARGET, **_AKW)


@register("w22_first_touch")
def q_first_touch(spark, sf_dir):
    return AT.first_touch(_touch_events(spark, sf_dir), TOUCHES, TARGET, **_AKW)


@register("w23_last_touch")
def q_last_touch(spark, sf_dir):
    return AT.last_touch(_touch_events(spark, sf_dir), TOUCHES, TARGET, **_AKW)


@register("w24_linear_attribution")
def q_linear(spark, sf_dir):
    return AT.linear_attribution(_touch_events(spark, sf_dir), TOUCHES, TARGET, **_AKW)


@register("w25_decay_attribution")
def q_decay(spark, sf_dir):
    d = AT.decay_attribution(_touch_events(spark, sf_dir), TOUCHES, TARGET, **_AKW)
    return d.withColumn("weight", F.round("weight", 6))


# --- series and report ------------------------------------------------------


def _daily_series(spark, sf_dir):
    """Per user and day between the user's first and last event: the value
    of the day's last purchase, null on days without one."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id", "ts",
                                               F.to_date("ts").alias("dy"))
    spine = (ev.groupBy("user_id").agg(F.min("dy").alias("a"), F.max("dy").alias("b"))
             .select("user_id", F.explode(F.sequence("a", "b")).alias("dy")))
    last = (ev.filter(F.col("event_type") == "purchase").groupBy("user_id", "dy")
            .agg(F.max_by("value", F.struct("ts", "event_id")).alias("value")))
    return spine.join(last, ["user_id", "dy"], "left")


@register("w30_forward_fill")
def q_ffill(spark, sf_dir):
    return SR.forward_fill(_daily_series(spark, sf_dir), "dy", "value", by=["user_id"])


@register("w31_fill_by_range_join")
def q_range_fill(spark, sf_dir):
    return SR.fill_by_range_join(_daily_series(spark, sf_dir), "dy", "value", by=["user_id"])


@register("w33_sales_report")
def q_sales_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    sales = orders.join(table(spark, sf_dir, "customer"), orders.o_custkey == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("shop"), F.trunc("o_orderdate", "month").alias("month"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("sale"))
    region = (table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"),
                                                   F.col("n_regionkey") == F.col("r_regionkey"))
              .select(F.col("n_nationkey").alias("shop"), F.col("r_name").alias("province")))
    r = RP.sales_report(sales, region)
    return r.select("shop", "month", "province",
                    *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("sale_cnt", "province_sale", "shop_account_cnt")])


# --- identity graph ---------------------------------------------------------


ID_COLS = ("account", "deviceid")
SPLIT_DAY = "2024-01-16"  # yesterday/today boundary of the incremental jobs


def _graph(log):
    return G.identity_vertices(log, ID_COLS), G.identity_edges(log, ID_COLS, "pairs", 2)


@register("w11_identity_edges")
def q_edges(spark, sf_dir):
    return _graph(_log(spark, sf_dir))[1]


@register("w11_chain_edges")
def q_chain_edges(spark, sf_dir):
    return G.identity_edges(_log(spark, sf_dir), ("sessionid", "account", "deviceid"), "chain")


@register("w12_connected_components")
def q_components(spark, sf_dir):
    return G.connected_components(*_graph(_log(spark, sf_dir)))


def _halves(spark, sf_dir):
    log = _log(spark, sf_dir)
    cut = F.lit(SPLIT_DAY).cast("date")
    return log.filter(F.col("dy") < cut), log.filter(F.col("dy") >= cut)


@register("w13_incremental_components")
def q_incremental(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    prev = G.connected_components(*_graph(old)).select("id", F.col("component").alias("guid"))
    v, e = _graph(new)
    return G.incremental_components(v, e, prev)


@register("w14_carry_over_guid")
def q_carry(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    prev = G.connected_components(*_graph(old)).select("id", F.col("component").alias("guid"))
    today = G.connected_components(*_graph(new)).select("id", F.col("component").alias("guid"))
    return G.carry_over_guid(today, prev)


@register("w15_label_rows")
def q_label(spark, sf_dir):
    log = _log(spark, sf_dir)
    comp = G.connected_components(*_graph(log))
    return G.label_rows(log, comp, ID_COLS).select("event_id", "guid")


# --- geography --------------------------------------------------------------


IP_SPAN = 4294967296 // 25


def geo_lines(spark, sf_dir):
    """Geo dictionary text lines derived from customer ⋈ nation ⋈ region:
    ``c <custkey> <lon> <lat> <region>:<nation>:<segment>``."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    k = F.col("c_custkey")
    lat = ((k * 37 + k % 100) % 200) - 100
    lon = ((k * 53 + k % 100) % 380) - 190
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(F.concat_ws(" ", F.lit("c"), k.cast("string"), lon.cast("string"), lat.cast("string"),
                                F.concat_ws(":", "r_name", "n_name", "c_mktsegment")).alias("value"))


def ip_lines(spark, sf_dir):
    """IP range text lines derived from nation ⋈ region: 25 equal ranges of
    the IPv4 space, ``start end country|area|province|city|isp``; every
    fifth nation has country '0' (no answer)."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    k = F.col("n_nationkey").cast("long")
    start = k * IP_SPAN
    end = F.when(k == 24, F.lit(4294967295)).otherwise((k + 1) * IP_SPAN - 1)
    region = F.concat_ws("|", F.when(k % 5 == 0, "0").otherwise("CN"), F.lit("0"), F.col("r_name"),
                         F.col("n_name"), F.concat(F.lit("isp"), (k % 3).cast("string")))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat_ws(" ", start.cast("string"), end.cast("string"), region).alias("value"))


@register("w03_geo_dictionary")
def q_geo_dict(spark, sf_dir):
    return GEO.build_geo_dictionary(geo_lines(spark, sf_dir))


def _geo_enriched(spark, sf_dir):
    return GEO.geo_enrich(_clean(spark, sf_dir), GEO.build_geo_dictionary(geo_lines(spark, sf_dir)))


@register("w04_geo_enrich")
def q_geo_enrich(spark, sf_dir):
    return _geo_enriched(spark, sf_dir).select("event_id", "province", "city", "district")


@register("w05_ip_region_enrich")
def q_ip_enrich(spark, sf_dir):
    ranges = GEO.parse_ip_regions(ip_lines(spark, sf_dir))
    return GEO.ip_region_enrich(_geo_enriched(spark, sf_dir), ranges).select(
        "event_id", "ip", "province", "city", "district")


# --- detail ETL pipeline ----------------------------------------------------


@register("w16_detail_etl")
def q_detail_etl(spark, sf_dir):
    geo_dict = GEO.build_geo_dictionary(geo_lines(spark, sf_dir))
    ranges = GEO.parse_ip_regions(ip_lines(spark, sf_dir))
    out = scratch_path(spark, "detail")
    ETL.run_detail_etl(_log(spark, sf_dir), geo_dict, ranges, out, tiebreak="event_id")
    back = spark.read.parquet(out)
    return back.select("event_id", "newsession", "province", "city", "district", "newuser", "guid",
                       F.col("dy").cast("date").alias("dy"))


# --- sources ------------------------------------------------------------------


def customer_lines(spark, sf_dir):
    """Customers as comma-separated lines; one in seven lacks its last field, one
    in eleven has a balance that is no number, one in thirteen a field too many."""
    k = F.col("c_custkey")
    balance = F.when(k % 11 == 0, "n/a").otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    fields = F.concat_ws(",", k.cast("string"), "c_name", balance)
    line = (F.when(k % 7 == 0, fields).when(k % 13 == 0, F.concat_ws(",", fields, "c_mktsegment", F.lit("x")))
            .otherwise(F.concat_ws(",", fields, "c_mktsegment")))
    return table(spark, sf_dir, "customer").select(line.alias("value"))


@register("b_csv_quarantine")
def q_csv_quarantine(spark, sf_dir):
    """A load of text lines: rows that fit the schema, and the broken lines."""
    path = scratch_path(spark, "customer-lines")
    customer_lines(spark, sf_dir).write.text(path)
    rows, broken = IO.read_csv_quarantine(spark, path, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string")
    return rows.withColumn("broken_line", F.lit(None).cast("string")).unionByName(
        broken.select(F.col("line").alias("broken_line")), allowMissingColumns=True)


@register("b_text_table")
def q_text_table(spark, sf_dir):
    """Lines written as text, scanned, counted by segment into a catalog table
    and read from there."""
    path, name = scratch_path(spark, "lines"), f"plover_lines_{uuid.uuid4().hex[:12]}"
    customer_lines(spark, sf_dir).write.text(path)
    parts = F.split("value", ",")
    counted = IO.read_text(spark, path).groupBy(F.size(parts).alias("n_fields")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).cast("long").alias("n_chars"))
    IO.save_table(counted, name)
    out = stored(IO.read_table(spark, name), scratch_path(spark, "lines-back"))
    spark.sql(f"DROP TABLE {name}")
    return out


# --- profile models -----------------------------------------------------------


@register("w34_knn_classify")
def q_knn(spark, sf_dir):
    """Leave-one-out 1-NN over the whole embeddings table: every vector's
    label predicted from its nearest other vector."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label",
                                                  F.col("embedding").alias("features"))
    r = M.knn_classify(e, e, k=1, exclude_self=True)
    return r.select(F.col("id").alias("vec_id"), "label", "neighbour")


@register("w34_knn_pruned")
def q_knn_pruned(spark, sf_dir):
    """Leave-one-out 3-NN over the whole embeddings table, cells left out by the
    triangle inequality."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label",
                                                  F.col("embedding").alias("features"))
    r = M.knn_pruned(e, e, k=3, exclude_self=True)
    return r.select(F.col("id").alias("vec_id"), "neighbour", "label", F.round("score", 6).alias("score"), "rank")


def _held_out(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label",
                                                  F.col("embedding").alias("features"))
    train, test = M.split_by_key(e, "id")
    return test, train


@register("w34_knn_vote")
def q_knn_vote(spark, sf_dir):
    """Majority label of the three nearest vectors of the training part."""
    test, train = _held_out(spark, sf_dir)
    return M.knn_classify(test, train, k=3).select(F.col("id").alias("vec_id"), "label")


@register("w34_knn_similarity")
def q_knn_similarity(spark, sf_dir):
    test, train = _held_out(spark, sf_dir)
    r = M.knn_classify(test, train, metric="similarity")
    return r.select(F.col("id").alias("vec_id"), "label", "neighbour", F.round("score", 6).alias("score"))


CHURN_FEATURES = ["n_orders", "total_price", "avg_price", "max_price", "n_urgent", "n_open"]


def _churn_frame(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    feats = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        F.sum("o_totalprice").alias("total_price"),
        F.avg("o_totalprice").alias("avg_price"),
        F.max("o_totalprice").alias("max_price"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).cast("double").alias("n_urgent"),
        F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).cast("double").alias("n_open"))
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, 1.0).otherwise(0.0).alias("label"))
    return c.join(feats, "c_custkey", "left").na.fill(0.0, CHURN_FEATURES)


@register("w35_minmax_scale")
def q_minmax(spark, sf_dir):
    s = M.min_max_scale(_churn_frame(spark, sf_dir).drop("label"), CHURN_FEATURES)
    return s.select("c_custkey", *[F.round(c, 6).alias(c) for c in CHURN_FEATURES])


@register("w35_churn_predict")
def q_churn(spark, sf_dir):
    df = _churn_frame(spark, sf_dir)
    train, _ = M.split_by_key(df, "c_custkey")
    model = M.fit_churn(train, CHURN_FEATURES)
    return M.predict(model, df, keep=["c_custkey", "label"])


@register("w35_churn_optimality")
def q_churn_optimality(spark, sf_dir):
    """The fitted model's mean gradient per scaled feature; 0 at the optimum."""
    train, _ = M.split_by_key(_churn_frame(spark, sf_dir), "c_custkey")
    g = M.churn_gradient(M.fit_churn(train, CHURN_FEATURES), train, CHURN_FEATURES)
    return g.select("feature", (F.round("gradient", 5) + F.lit(0.0)).alias("gradient"))


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@register("w36_tfidf_terms")
def q_tfidf_terms(spark, sf_dir):
    t = M.term_stats(_docs(spark, sf_dir))
    return t.select("doc_id", "term", "tf", "df", F.round("idf", 6).alias("idf"), F.round("tf_idf", 6).alias("tf_idf"))


TERM_BUCKETS = 100_000


def _text_nb(spark, sf_dir, buckets):
    """Labels from the md5 split train; all documents give the inverse document
    frequencies and get a prediction."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    docs = _docs(spark, sf_dir)
    train, _ = M.split_by_key(lab, "doc_id")
    weights = (M.term_stats(docs, buckets=buckets, more=M.classes_by_id(train))
               .select("doc_id", "term", F.col("tf_idf").alias("w"), "classes"))
    pred = M.naive_bayes_terms(weights, train)
    return (docs.select("doc_id").join(lab, "doc_id", "left").join(pred, "doc_id", "left")
            .select("doc_id", "label", "prediction"))


@register("w36_text_nb_predict")
def q_text_nb(spark, sf_dir):
    """Naive Bayes on TF-IDF of terms hashed into a fixed number of buckets."""
    return _text_nb(spark, sf_dir, TERM_BUCKETS)


@register("w36_text_nb_terms")
def q_text_nb_terms(spark, sf_dir):
    """Naive Bayes on term-level TF-IDF weights."""
    return _text_nb(spark, sf_dir, None)


@register("w36_text_pipeline_predict")
def q_text_pipeline(spark, sf_dir):
    """The library's chain (hashed counts, IDF, naive Bayes), fitted on the md5
    split, saved, read back and applied to all documents."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    train, _ = M.split_by_key(lab, "doc_id")
    docs = _docs(spark, sf_dir)
    model = M.fit_text_model(docs, train, scratch_path(spark, "text-model"), num_features=TERM_BUCKETS)
    return M.classify_texts(model, docs)


# Fixed coding of the market segment (stands in for the profile's job).
SEGMENT_CODE = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}
PROFILE_FEATURES = ["job", "income", "age", "sex"]


def _profile(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("_n"))
    c = table(spark, sf_dir, "customer")
    j = c.join(per, "c_custkey", "left")
    return j.select("c_custkey",
                    M.code("c_mktsegment", SEGMENT_CODE).alias("job"),
                    M.bucket("c_acctbal", 2000.0, 5).alias("income"),
                    M.bucket(F.coalesce(F.col("_n"), F.lit(0)), 10.0, 3).alias("age"),
                    (F.col("c_nationkey") % 2).cast("double").alias("sex"),
                    # label: a balance above 4500 (partly visible through the income bucket)
                    F.when(F.col("c_acctbal") > 4500, 1.0).otherwise(0.0).alias("label"))


@register("w37_encode_profile")
def q_encode_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@register("w37_profile_nb_predict")
def q_profile_nb(spark, sf_dir):
    df = _profile(spark, sf_dir)
    train, _ = M.split_by_key(df, "c_custkey")
    path = scratch_path(spark, "profile-nb")
    M.fit_profile_nb(train, PROFILE_FEATURES, path=path)
    model = M.load_profile_nb(path)
    return M.predict_profile(model, df, PROFILE_FEATURES, keep=["c_custkey", "label"])
