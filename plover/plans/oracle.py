"""DuckDB SQL twins of the registered queries.

Each oracle is written independently of the Spark code (window/row_number
or string-path methods where the Spark side uses aggregates), over the
driver's tables registered as views. ``ctes`` chains the shared fragments.
"""

from __future__ import annotations

# --- shared fragments -------------------------------------------------------

EV = """ev AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS "timestamp",
         CAST(ts AS DATE) AS dy
  FROM events)"""

APPLOG = """applog AS (
  SELECT event_id, user_id, k, dy, "timestamp",
    CASE WHEN event_id % 4 = 0 THEN NULL
         WHEN event_id % 4 = 1 AND k < 10 THEN ''
         ELSE 'a' || CAST((user_id + CASE WHEN k % 33 = 0 THEN 1 ELSE 0 END) % 60 AS VARCHAR) END AS account,
    'v' || CAST(user_id % 3 AS VARCHAR) AS appversion,
    'd' || CAST(user_id AS VARCHAR) AS deviceid,
    'type' || CAST(user_id % 3 AS VARCHAR) AS devicetype,
    CASE event_type WHEN 'view' THEN 'pageView' WHEN 'click' THEN 'share'
                    WHEN 'purchase' THEN 'addCart' ELSE event_type END AS eventid,
    ((user_id * 7919 + k) * 65536) % 4294967296 AS ip_long,
    CAST(((user_id * 37 + k) % 200) - 100 AS DOUBLE) AS latitude,
    CAST(((user_id * 53 + k) % 380) - 190 AS DOUBLE) AS longitude,
    CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS osname,
    'ch' || CAST(user_id % 4 AS VARCHAR) AS releasechannel,
    CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) || '_' || CAST(dy AS VARCHAR) END AS sessionid,
    CAST(k AS VARCHAR) AS page
  FROM ev)"""

DETAIL = """detail AS (
  SELECT event_id, user_id,
    COALESCE(CASE WHEN trim(account) <> '' THEN account END, deviceid) AS guid,
    sessionid AS "sessionId", "timestamp", eventid, page, k,
    'P' || CAST(user_id % 5 AS VARCHAR) AS province,
    'P' || CAST(user_id % 5 AS VARCHAR) || '-C' || CAST(user_id % 3 AS VARCHAR) AS city,
    'P' || CAST(user_id % 5 AS VARCHAR) || '-C' || CAST(user_id % 3 AS VARCHAR)
        || '-D' || CAST(user_id % 2 AS VARCHAR) AS district,
    devicetype, releasechannel, appversion, osname,
    CASE WHEN (user_id + day(dy)) % 7 = 0 THEN 1 ELSE 0 END AS newuser,
    dy
  FROM applog WHERE sessionid IS NOT NULL)"""

SESSIONS = """pv AS (SELECT * FROM detail WHERE eventid = 'pageView'),
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY dy, guid, "sessionId" ORDER BY "timestamp", event_id) AS rn_first,
    row_number() OVER (PARTITION BY dy, guid, "sessionId" ORDER BY "timestamp" DESC, event_id DESC) AS rn_last
  FROM pv),
sessions AS (
  SELECT guid, "sessionId",
    min("timestamp") AS start_time, max("timestamp") AS end_time,
    max(CASE WHEN rn_first = 1 THEN page END) AS in_page,
    max(CASE WHEN rn_last = 1 THEN page END) AS out_page,
    count(*) AS pv_cnt,
    CAST(min(newuser) AS INTEGER) AS isnew,
    CAST((min("timestamp") // 3600000) % 24 AS INTEGER) AS hour_segment,
    max(CASE WHEN rn_first = 1 THEN province END) AS province,
    max(CASE WHEN rn_first = 1 THEN city END) AS city,
    max(CASE WHEN rn_first = 1 THEN district END) AS district,
    min(devicetype) AS device_type, min(releasechannel) AS release_channel,
    min(appversion) AS app_version, min(osname) AS os_name, dy
  FROM ranked GROUP BY dy, guid, "sessionId")"""


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


Q = {}

Q["w17_session_aggregate"] = ctes(EV, APPLOG, DETAIL, SESSIONS) + "SELECT * FROM sessions"

Q["w18_traffic_cube"] = ctes(EV, APPLOG, DETAIL, SESSIONS) + """
SELECT province, city, district, device_type, release_channel, app_version, os_name, hour_segment,
  count(*) AS session_cnt,
  CAST(sum(pv_cnt) AS BIGINT) AS pv_cnt,
  CAST(sum(end_time - start_time) AS BIGINT) AS time_long,
  count(DISTINCT guid) AS uv_cnt,
  CAST(GROUPING(province, city, district, device_type, release_channel, app_version, os_name, hour_segment) AS BIGINT)
    AS grouping_id,
  dy
FROM sessions
GROUP BY GROUPING SETS ((dy), (dy, province), (dy, province, city), (dy, province, city, district),
  (dy, device_type), (dy, release_channel), (dy, device_type, app_version), (dy, hour_segment),
  (dy, os_name, app_version))"""

Q["w18_traffic_cube_span"] = ctes(EV, APPLOG, DETAIL, SESSIONS) + """
SELECT province, city, district, device_type, release_channel, app_version, os_name, hour_segment,
  count(*) AS session_cnt, CAST(sum(pv_cnt) AS BIGINT) AS pv_cnt, CAST(sum(end_time - start_time) AS BIGINT) AS time_long,
  count(DISTINCT guid) AS uv_cnt,
  CAST(GROUPING(province, city, district, device_type, release_channel, app_version, os_name, hour_segment) AS BIGINT)
    AS grouping_id
FROM sessions
GROUP BY GROUPING SETS ((), (province), (province, city), (province, city, district), (device_type), (release_channel),
  (device_type, app_version), (hour_segment), (os_name, app_version))"""

Q["w19_funnel_depth"] = ctes(EV, APPLOG, DETAIL) + """,
e AS (SELECT dy, guid, eventid, struct_pack(t := "timestamp", n := eventid, i := event_id) AS pos FROM detail
      WHERE eventid IN ('pageView', 'share', 'addCart')),
one AS (SELECT dy, guid, min(pos) AS pos FROM e WHERE eventid = 'pageView' GROUP BY dy, guid),
two AS (SELECT e.dy, e.guid, min(e.pos) AS pos FROM e JOIN one USING (dy, guid)
        WHERE eventid = 'share' AND e.pos > one.pos GROUP BY e.dy, e.guid),
three AS (SELECT DISTINCT e.dy, e.guid FROM e JOIN two USING (dy, guid) WHERE eventid = 'addCart' AND e.pos > two.pos)
SELECT 'view_share_cart' AS funnel_name, g.dy, g.guid,
  CAST((one.guid IS NOT NULL)::INT + (two.guid IS NOT NULL)::INT + (three.guid IS NOT NULL)::INT AS INTEGER) AS comp_step
FROM (SELECT DISTINCT dy, guid FROM e) g LEFT JOIN one USING (dy, guid) LEFT JOIN two USING (dy, guid)
LEFT JOIN three USING (dy, guid)"""

Q["w19_funnel_pages"] = ctes(EV, APPLOG, DETAIL) + """,
steps AS (SELECT * FROM (VALUES (1, 'pageView', '77'), (2, 'share', '91'), (3, 'addCart', '72')) s(step, event, page)),
e AS (SELECT guid, step, row_number() OVER (PARTITION BY guid ORDER BY "timestamp", eventid, event_id) AS pos
      FROM detail JOIN steps ON eventid = event AND detail.page = steps.page),
hit AS (
  SELECT a.guid, max(CASE WHEN c.guid IS NOT NULL THEN 3 WHEN b.guid IS NOT NULL THEN 2 ELSE 1 END) AS depth
  FROM e a LEFT JOIN e b ON b.guid = a.guid AND b.step = 2 AND b.pos > a.pos
  LEFT JOIN e c ON c.guid = b.guid AND c.step = 3 AND c.pos > b.pos WHERE a.step = 1 GROUP BY a.guid)
SELECT 'view_share_cart' AS funnel_name, g.guid, CAST(coalesce(depth, 0) AS INTEGER) AS comp_step
FROM (SELECT DISTINCT guid FROM e) g LEFT JOIN hit USING (guid)"""

# --- detail layer -----------------------------------------------------------

CLEAN = """clean AS (
  SELECT * FROM applog
  WHERE (account IS NOT NULL OR deviceid IS NOT NULL)
    AND eventid IS NOT NULL AND trim(eventid) <> ''
    AND sessionid IS NOT NULL AND trim(sessionid) <> ''
    AND latitude > -90 AND latitude < 90 AND longitude > -180 AND longitude < 180)"""

SCORES = """scores AS (
  SELECT dy, deviceid, account, CAST(count(DISTINCT sessionid) * 100 AS DOUBLE) AS score,
         CAST(max("timestamp") AS DOUBLE) AS "timestamp"
  FROM clean GROUP BY dy, deviceid, account)"""

# Scores rolled pair by pair from day to day: today's are added, a day without events halves them.
BEST = """named AS (SELECT * FROM scores WHERE account IS NOT NULL AND trim(account) <> ''),
rolled_pairs AS (SELECT * FROM (
  WITH RECURSIVE st(deviceid, account, dy, score, ts) AS (
    SELECT deviceid, account, min(dy), arg_min(score, dy), arg_min("timestamp", dy) FROM named GROUP BY deviceid, account
    UNION ALL
    SELECT st.deviceid, st.account, st.dy + 1, CASE WHEN n.score IS NULL THEN st.score * 0.5 ELSE st.score + n.score END,
           coalesce(n."timestamp", st.ts)
    FROM st LEFT JOIN named n ON n.deviceid = st.deviceid AND n.account = st.account AND n.dy = st.dy + 1
    WHERE st.dy < (SELECT max(dy) FROM scores))
  SELECT * FROM st) q),
best AS (SELECT dy, deviceid, arg_max(account, struct_pack(s := score, t := ts, a := account)) AS account
         FROM rolled_pairs GROUP BY dy, deviceid)"""

Q["w01_clean_events"] = ctes(EV, APPLOG, CLEAN) + """
SELECT event_id, account, deviceid, eventid, sessionid, latitude, longitude, "timestamp", dy FROM clean"""

Q["w02_sessionize"] = ctes(EV, APPLOG, CLEAN) + """,
s1 AS (SELECT event_id, sessionid, "timestamp",
         lag("timestamp") OVER (PARTITION BY sessionid ORDER BY "timestamp", event_id) AS prev FROM clean),
s2 AS (SELECT *, CASE WHEN prev IS NULL OR "timestamp" - prev >= 1800000 THEN 1 ELSE 0 END AS st FROM s1)
SELECT event_id, sessionid, "timestamp",
  sessionid || '-' || CAST(sum(st) OVER (PARTITION BY sessionid ORDER BY "timestamp", event_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS newsession
FROM s2"""

Q["w06_new_users"] = ctes(EV, APPLOG) + """,
first_seen AS (SELECT account, min(dy) AS first_dy FROM applog
               WHERE account IS NOT NULL AND trim(account) <> '' GROUP BY account)
SELECT a.event_id, a.account, a.dy,
  CAST(CASE WHEN a.account IS NULL OR trim(a.account) = '' OR f.first_dy >= a.dy THEN 1 ELSE 0 END AS INTEGER) AS newuser
FROM applog a LEFT JOIN first_seen f ON a.account = f.account"""

Q["w07_device_account_scores"] = ctes(EV, APPLOG, CLEAN, SCORES) + "SELECT * FROM scores"

Q["w08_rollover_scores"] = ctes(EV, APPLOG, CLEAN, SCORES) + """,
prev AS (SELECT dy + 1 AS dy, deviceid, account, "timestamp" AS p_ts, score AS p_score FROM scores),
cur AS (SELECT * FROM scores WHERE account IS NOT NULL AND trim(account) <> ''),
curb AS (SELECT * FROM scores WHERE account IS NULL OR trim(account) = ''),
rolled AS (
  SELECT COALESCE(c.dy, p.dy) AS dy, COALESCE(c.deviceid, p.deviceid) AS deviceid,
         COALESCE(c.account, p.account) AS account, COALESCE(c."timestamp", p.p_ts) AS "timestamp",
         CASE WHEN p.deviceid IS NOT NULL AND c.deviceid IS NOT NULL THEN p.p_score + c.score
              WHEN p.deviceid IS NOT NULL THEN p.p_score * 0.5 ELSE c.score END AS score
  FROM prev p FULL JOIN cur c ON p.dy = c.dy AND p.deviceid = c.deviceid AND p.account = c.account)
SELECT * FROM rolled
UNION ALL
SELECT dy, deviceid, account, "timestamp", score FROM curb
WHERE NOT EXISTS (SELECT 1 FROM prev p WHERE p.dy = curb.dy AND p.deviceid = curb.deviceid)"""

Q["w09_best_account"] = ctes(EV, APPLOG, CLEAN, SCORES, BEST) + "SELECT * FROM best"

Q["w10_assign_guid"] = ctes(EV, APPLOG, CLEAN, SCORES, BEST) + """,
b2 AS (SELECT dy + 1 AS dy, deviceid, account AS bind FROM best)
SELECT c.event_id, c.deviceid, c.account,
  COALESCE(CASE WHEN trim(c.account) <> '' THEN c.account END,
           CASE WHEN trim(b.bind) <> '' THEN b.bind END, c.deviceid) AS guid, c.dy
FROM clean c LEFT JOIN b2 b ON c.dy = b.dy AND c.deviceid = b.deviceid"""

# --- activity state ---------------------------------------------------------

SNAPS = """act AS (SELECT DISTINCT guid, dy FROM detail),
isl0 AS (SELECT guid, dy, dy - CAST(row_number() OVER (PARTITION BY guid ORDER BY dy) AS INTEGER) AS grp FROM act),
isl AS (SELECT guid, grp, min(dy) AS s, max(dy) AS t FROM isl0 GROUP BY guid, grp),
firsts AS (SELECT guid, min(dy) AS first_dt FROM act GROUP BY guid),
lastd AS (SELECT max(dy) AS last_dy FROM act),
snap0 AS (
  SELECT f.first_dt, i.guid, i.s, i.t,
    CAST(unnest(generate_series(CAST(i.s AS TIMESTAMP), CAST(l.last_dy AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dy
  FROM isl i JOIN firsts f ON i.guid = f.guid CROSS JOIN lastd l),
snaps AS (
  SELECT first_dt, guid, s AS range_start,
    CASE WHEN t < dy THEN t ELSE DATE '9999-12-31' END AS range_end, dy
  FROM snap0)"""

# Intervals of each day from its last 30 days' active days one by one.
DAYS30 = """seen AS (
  SELECT s.dy, s.guid, a.dy AS d, lag(a.dy) OVER (PARTITION BY s.dy, s.guid ORDER BY a.dy) AS before
  FROM (SELECT DISTINCT dy, guid FROM snaps) s JOIN act a ON a.guid = s.guid AND a.dy BETWEEN s.dy - 30 AND s.dy),
runs30 AS (SELECT *, sum(CASE WHEN d - before = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY dy, guid ORDER BY d) AS run FROM seen),
detail27 AS (
  SELECT dy, guid, 0 AS "interval", count(*) - 1 AS times FROM runs30 GROUP BY dy, guid, run
  UNION ALL
  SELECT dy, guid, d - before, 1 FROM seen WHERE d - before > 1)"""

OPENRUNS = """runs AS (
  SELECT dy, guid, datediff('day', range_start, dy) + 1 AS n FROM snaps
  WHERE range_end = DATE '9999-12-31' AND datediff('day', range_start, dy) + 1 >= 1),
members AS (SELECT dy AS dt, CAST(unnest(generate_series(1, n)) AS INTEGER) AS days, guid FROM runs)"""

Q["w26_rollover_ranges"] = ctes(EV, APPLOG, DETAIL, SNAPS) + "SELECT * FROM snaps"

Q["w27_visit_interval_detail"] = ctes(EV, APPLOG, DETAIL, SNAPS, DAYS30) + """
SELECT dy, guid, CAST("interval" AS INTEGER) AS "interval", CAST(times AS INTEGER) AS times FROM detail27"""

Q["w28_visit_intervals"] = ctes(EV, APPLOG, DETAIL, SNAPS, DAYS30) + """
SELECT dy, guid, CAST("interval" AS INTEGER) AS "interval", CAST(sum(times) AS BIGINT) AS times
FROM detail27 GROUP BY dy, guid, "interval\""""

Q["w29_active_days"] = ctes(EV, APPLOG, DETAIL, SNAPS, OPENRUNS) + """
SELECT dt, days, count(*) AS user_cnt FROM members GROUP BY dt, days"""

Q["w29_active_days_sets"] = Q["w29_active_days"]

Q["w29_active_days_members"] = ctes(EV, APPLOG, DETAIL, SNAPS, OPENRUNS) + "SELECT * FROM members"

Q["w32_update_bitmap"] = ctes(EV, APPLOG, DETAIL) + """,
act AS (SELECT DISTINCT guid, dy FROM detail),
firsts AS (SELECT guid, min(dy) AS f FROM act GROUP BY guid),
lastd AS (SELECT max(dy) AS last_dy FROM act),
spine AS (
  SELECT guid, CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(l.last_dy AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dy
  FROM firsts CROSS JOIN lastd l)
SELECT s.guid, CAST(COALESCE(sum(CAST(1 AS BIGINT) << CAST(datediff('day', a.dy, s.dy) AS INTEGER)), 0) AS BIGINT) AS bitmap, s.dy
FROM spine s LEFT JOIN act a ON a.guid = s.guid AND a.dy <= s.dy AND a.dy > s.dy - 31
GROUP BY s.guid, s.dy"""

# --- attribution ------------------------------------------------------------

ATT = """att AS (
  SELECT user_id AS guid, event_type AS event, "timestamp", event_id FROM ev
  WHERE event_type IN ('click', 'view', 'signup', 'purchase')),
segd AS (
  SELECT *,
    COALESCE(sum(CASE WHEN event = 'purchase' THEN 1 ELSE 0 END) OVER (
      PARTITION BY guid ORDER BY "timestamp", event, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS conversion,
    sum(CASE WHEN event = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY guid) AS n_targets
  FROM att),
touch AS (SELECT guid, CAST(conversion AS BIGINT) AS conversion, event, "timestamp", event_id FROM segd
          WHERE event <> 'purchase' AND conversion < n_targets)"""

Q["w20_event_paths"] = ctes(EV) + """,
att AS (SELECT user_id AS guid, event_type AS event, "timestamp", event_id FROM ev
        WHERE event_type IN ('click', 'view', 'signup', 'purchase')
          AND user_id IN (SELECT user_id FROM ev WHERE event_type = 'purchase'))
SELECT guid, row_number() OVER (PARTITION BY guid ORDER BY "timestamp", event, event_id) AS step, event, "timestamp"
FROM att"""

Q["w21_first_touch_overall"] = ctes(EV) + """,
att AS (SELECT user_id AS guid, event_type AS event, "timestamp", event_id FROM ev
        WHERE event_type IN ('click', 'view', 'signup', 'purchase'))
SELECT guid, first(CASE WHEN event <> 'purchase' THEN event END
                   ORDER BY CASE WHEN event <> 'purchase' THEN 0 ELSE 1 END, "timestamp", event, event_id) AS event
FROM att GROUP BY guid HAVING max(CASE WHEN event = 'purchase' THEN 1 ELSE 0 END) = 1"""

Q["w22_first_touch"] = ctes(EV, ATT) + """
SELECT guid, conversion, first(event ORDER BY "timestamp", event, event_id) AS event FROM touch GROUP BY guid, conversion"""

Q["w23_last_touch"] = ctes(EV, ATT) + """
SELECT guid, conversion, last(event ORDER BY "timestamp", event, event_id) AS event FROM touch GROUP BY guid, conversion"""

Q["w24_linear_attribution"] = ctes(EV, ATT) + """
SELECT guid, conversion, event, CAST(100 // count(*) OVER (PARTITION BY guid, conversion) AS INTEGER) AS weight
FROM (SELECT DISTINCT guid, conversion, event FROM touch) t"""

Q["w25_decay_attribution"] = ctes(EV, ATT) + """,
firsts AS (SELECT guid, conversion, event,
             min(struct_pack(t := "timestamp", e := event, i := event_id)) AS fk FROM touch GROUP BY guid, conversion, event),
ranked AS (SELECT *, row_number() OVER (PARTITION BY guid, conversion ORDER BY fk) - 1 AS i FROM firsts)
SELECT guid, conversion, event,
  round(pow(0.9, i) / sum(pow(0.9, i)) OVER (PARTITION BY guid, conversion), 6) AS weight
FROM ranked"""

# --- series and report ------------------------------------------------------

SERIES = """evd AS (SELECT user_id, event_type, value, event_id, ts, CAST(ts AS DATE) AS dy FROM events),
bounds AS (SELECT user_id, min(dy) AS a, max(dy) AS b FROM evd GROUP BY user_id),
spine AS (SELECT user_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dy
          FROM bounds),
lastp AS (SELECT user_id, dy, arg_max(value, (ts, event_id)) AS value FROM evd WHERE event_type = 'purchase'
          GROUP BY user_id, dy),
series AS (SELECT s.user_id, s.dy, l.value FROM spine s LEFT JOIN lastp l ON s.user_id = l.user_id AND s.dy = l.dy)"""

Q["w30_forward_fill"] = ctes(SERIES) + """
SELECT user_id, dy, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY dy
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM series"""

Q["w31_fill_by_range_join"] = ctes(SERIES) + """,
around AS (
  SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY dy ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v,
         count(value) OVER (PARTITION BY user_id ORDER BY dy ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead
  FROM series)
SELECT user_id, dy, v AS value FROM around WHERE v IS NOT NULL AND ahead > 0"""

Q["w33_sales_report"] = """WITH s AS (
  SELECT c_nationkey AS shop, r_name AS province, date_trunc('month', o_orderdate)::DATE AS month,
         o_totalprice::DECIMAL(18,2) AS sale
  FROM orders, customer, nation, region
  WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey)
SELECT k.shop, k.month, k.province,
  (SELECT sum(sale) FROM s WHERE s.shop = k.shop AND s.month = k.month)::DECIMAL(18,2) AS sale_cnt,
  (SELECT sum(sale) FROM s WHERE s.province = k.province AND s.month = k.month)::DECIMAL(18,2) AS province_sale,
  (SELECT sum(sale) FROM s WHERE s.shop = k.shop AND s.month <= k.month)::DECIMAL(18,2) AS shop_account_cnt
FROM (SELECT DISTINCT shop, month, province FROM s) k"""

# --- identity graph ---------------------------------------------------------


def _graph_ctes(name: str, where: str) -> str:
    """vertices / edges / components of the adapter log rows matching ``where``
    (components by a recursive reachability closure, min label)."""
    return f"""{name}_rows AS (SELECT * FROM applog WHERE {where}),
{name}_v AS (
  SELECT DISTINCT id FROM (
    SELECT account AS id FROM {name}_rows WHERE account IS NOT NULL AND trim(account) <> ''
    UNION ALL SELECT deviceid FROM {name}_rows WHERE deviceid IS NOT NULL AND trim(deviceid) <> '') t),
{name}_e AS (
  SELECT account AS src, deviceid AS dst FROM {name}_rows
  WHERE account IS NOT NULL AND trim(account) <> '' AND deviceid IS NOT NULL AND trim(deviceid) <> ''
  GROUP BY account, deviceid HAVING count(*) > 2)"""


def _cc(name: str, v: str, e: str) -> str:
    return f"""{name}_und AS (SELECT src AS a, dst AS b FROM {e} UNION SELECT dst, src FROM {e}),
{name}_reach AS (SELECT * FROM (
  WITH RECURSIVE r(id, lbl) AS (
    SELECT id, id FROM {v}
    UNION
    SELECT u.b, r.lbl FROM r JOIN {name}_und u ON r.id = u.a)
  SELECT id, min(lbl) AS component FROM r GROUP BY id) q)"""


_ALL = _graph_ctes("g", "true")
_OLD = _graph_ctes("o", "dy < DATE '2024-01-16'")
_NEW = _graph_ctes("n", "dy >= DATE '2024-01-16'")

Q["w11_identity_edges"] = ctes(EV, APPLOG, _ALL) + "SELECT * FROM g_e"

Q["w11_chain_edges"] = ctes(EV, APPLOG) + """,
r AS (SELECT [x FOR x IN [sessionid, account, deviceid] IF x IS NOT NULL AND trim(x) <> ''] AS ids FROM applog
      WHERE sessionid IS NOT NULL AND trim(sessionid) <> '')
SELECT DISTINCT ids[i] AS src, ids[i + 1] AS dst FROM r, range(1, 3) t(i) WHERE i < len(ids)"""

Q["w12_connected_components"] = ctes(EV, APPLOG, _ALL, _cc("g", "g_v", "g_e")) + "SELECT * FROM g_reach"

Q["w13_incremental_components"] = ctes(
    EV, APPLOG, _OLD, _cc("o", "o_v", "o_e"), _NEW,
    """i_v AS (SELECT id FROM n_v UNION SELECT id FROM o_reach),
i_e AS (SELECT src, dst FROM n_e UNION ALL SELECT id, component FROM o_reach)""",
    _cc("i", "i_v", "i_e")) + "SELECT * FROM i_reach"

Q["w14_carry_over_guid"] = ctes(EV, APPLOG, _OLD, _cc("o", "o_v", "o_e"), _NEW, _cc("n", "n_v", "n_e")) + """,
per AS (SELECT n.component, min(o.component) AS carry FROM n_reach n LEFT JOIN o_reach o ON n.id = o.id
        GROUP BY n.component)
SELECT n.id, COALESCE(p.carry, n.component) AS guid FROM n_reach n JOIN per p ON n.component = p.component"""

Q["w15_label_rows"] = ctes(EV, APPLOG, _ALL, _cc("g", "g_v", "g_e")) + """
SELECT a.event_id, r.component AS guid FROM applog a
LEFT JOIN g_reach r ON r.id = COALESCE(CASE WHEN trim(a.account) <> '' THEN a.account END,
                                        CASE WHEN trim(a.deviceid) <> '' THEN a.deviceid END)"""

# --- geography --------------------------------------------------------------

GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash_sql(lat: str, lon: str, precision: int = 6) -> str:
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    lo = f"least(CAST(floor(({lon} + 180.0) / 360.0 * {float(1 << lon_bits)}) AS BIGINT), {(1 << lon_bits) - 1})"
    la = f"least(CAST(floor(({lat} + 90.0) / 180.0 * {float(1 << lat_bits)}) AS BIGINT), {(1 << lat_bits) - 1})"
    chars = []
    for i in range(precision):
        terms = []
        for j in range(5):
            p = 5 * i + j
            src, width = (lo, lon_bits) if p % 2 == 0 else (la, lat_bits)
            terms.append(f"(((({src}) >> {width - 1 - p // 2}) & 1) << {4 - j})")
        chars.append(f"substr('{GEOHASH_ALPHABET}', CAST(({' | '.join(terms)}) + 1 AS INTEGER), 1)")
    return " || ".join(chars)


GEODICT = f"""geo_pts AS (
  SELECT CAST(((c_custkey * 53 + c_custkey % 100) % 380) - 190 AS DOUBLE) AS lon,
         CAST(((c_custkey * 37 + c_custkey % 100) % 200) - 100 AS DOUBLE) AS lat,
         r_name AS province, n_name AS city, c_mktsegment AS district
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
geodict AS (
  SELECT geo, min(struct_pack(p := province, c := city, d := district)) AS a FROM (
    SELECT {geohash_sql('lat', 'lon')} AS geo, province, city, district FROM geo_pts
    WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) t GROUP BY geo),
geoenr AS (
  SELECT c.*, g.a.p AS province, g.a.c AS city, g.a.d AS district
  FROM clean c LEFT JOIN geodict g ON g.geo = {geohash_sql('c.latitude', 'c.longitude')})"""

IPRANGES = f"""ipr AS (
  SELECT CAST(n_nationkey AS BIGINT) * {4294967296 // 25} AS s,
         CASE WHEN n_nationkey = 24 THEN 4294967295 ELSE (CAST(n_nationkey AS BIGINT) + 1) * {4294967296 // 25} - 1 END AS e,
         CASE WHEN n_nationkey % 5 = 0 THEN '0' ELSE 'CN' END AS country, r_name AS province, n_name AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey),
ipenr AS (
  SELECT g.event_id, g.ip_long, g.district, g.dy, g.sessionid, g."timestamp", g.account, g.deviceid,
    CASE WHEN g.province IS NULL THEN r.province ELSE g.province END AS province,
    CASE WHEN g.province IS NULL THEN r.city ELSE g.city END AS city
  FROM geoenr g LEFT JOIN ipr r ON r.country <> '0' AND g.ip_long BETWEEN r.s AND r.e)"""

IPTEXT = """CAST(ip_long >> 24 AS VARCHAR) || '.' || CAST((ip_long >> 16) & 255 AS VARCHAR) || '.' ||
  CAST((ip_long >> 8) & 255 AS VARCHAR) || '.' || CAST(ip_long & 255 AS VARCHAR)"""

Q["w03_geo_dictionary"] = ctes(GEODICT.split(",\ngeoenr AS")[0]) + \
    "SELECT geo, a.p AS province, a.c AS city, a.d AS district FROM geodict"

Q["w04_geo_enrich"] = ctes(EV, APPLOG, CLEAN, GEODICT) + "SELECT event_id, province, city, district FROM geoenr"

Q["w05_ip_region_enrich"] = ctes(EV, APPLOG, CLEAN, GEODICT, IPRANGES) + f"""
SELECT event_id, {IPTEXT} AS ip, province, city, district FROM ipenr"""

# --- detail ETL pipeline ----------------------------------------------------

Q["w16_detail_etl"] = ctes(EV, APPLOG, CLEAN, GEODICT, IPRANGES, SCORES, BEST) + """,
s1 AS (SELECT event_id, sessionid, "timestamp",
         lag("timestamp") OVER (PARTITION BY sessionid ORDER BY "timestamp", event_id) AS prev FROM clean),
s2 AS (SELECT *, CASE WHEN prev IS NULL OR "timestamp" - prev >= 1800000 THEN 1 ELSE 0 END AS st FROM s1),
sess AS (SELECT event_id, sessionid || '-' || CAST(sum(st) OVER (PARTITION BY sessionid ORDER BY "timestamp", event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS newsession FROM s2),
first_seen AS (SELECT account, min(dy) AS first_dy FROM clean
               WHERE account IS NOT NULL AND trim(account) <> '' GROUP BY account),
b2 AS (SELECT dy + 1 AS dy, deviceid, account AS bind FROM best)
SELECT i.event_id, s.newsession, i.province, i.city, i.district,
  CAST(CASE WHEN i.account IS NULL OR trim(i.account) = '' OR f.first_dy >= i.dy THEN 1 ELSE 0 END AS INTEGER) AS newuser,
  COALESCE(CASE WHEN trim(i.account) <> '' THEN i.account END,
           CASE WHEN trim(b.bind) <> '' THEN b.bind END, i.deviceid) AS guid,
  i.dy
FROM ipenr i JOIN sess s ON i.event_id = s.event_id
LEFT JOIN first_seen f ON i.account = f.account
LEFT JOIN b2 b ON i.dy = b.dy AND i.deviceid = b.deviceid"""

# --- profile models -----------------------------------------------------------

Q["w34_knn_classify"] = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
pairs AS (SELECT a.vec_id, b.vec_id AS neighbour, b.label, list_distance(a.f, b.f) AS d
          FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, label, neighbour FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) AS rn FROM pairs) t
WHERE rn = 1"""

Q["w34_knn_pruned"] = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
pairs AS (SELECT a.vec_id, b.vec_id AS neighbour, b.label, list_distance(a.f, b.f) ** 2 AS d
          FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, neighbour, label, round(d, 6) AS score, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) AS rn FROM pairs) t
WHERE rn <= 3"""

_HELD = """WITH e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS f,
         CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 >= 200 AS train FROM embeddings),
near AS (
  SELECT a.vec_id, b.vec_id AS neighbour, b.label, list_distance(a.f, b.f) AS d,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.f, b.f), b.vec_id) AS rn
  FROM e a JOIN e b ON NOT a.train AND b.train)
"""

Q["w34_knn_vote"] = _HELD + """SELECT vec_id, label FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, label) AS place
  FROM near WHERE rn <= 3 GROUP BY vec_id, label) v WHERE place = 1"""

Q["w34_knn_similarity"] = _HELD + """SELECT vec_id, label, neighbour, round(1 / (1 + d), 6) AS score FROM near WHERE rn = 1"""

_LINES = """lines AS (
  SELECT *, concat_ws(',', c_custkey, c_name, CASE WHEN c_custkey % 11 = 0 THEN 'n/a'
                      ELSE CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) END,
                      CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END,
                      CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 13 = 0 THEN 'x' END) AS line,
         c_custkey % 7 = 0 OR c_custkey % 11 = 0 OR c_custkey % 13 = 0 AS broken
  FROM customer)"""
Q["b_csv_quarantine"] = "WITH " + _LINES + """
SELECT CASE WHEN NOT broken THEN c_custkey END AS c_custkey, CASE WHEN NOT broken THEN c_name END AS c_name,
  CASE WHEN NOT broken THEN c_acctbal END AS c_acctbal, CASE WHEN NOT broken THEN c_mktsegment END AS c_mktsegment,
  CASE WHEN broken THEN line END AS broken_line FROM lines"""
Q["b_text_table"] = "WITH " + _LINES + """
SELECT CAST(len(string_split(line, ',')) AS INTEGER) AS n_fields, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM lines GROUP BY 1"""

_CHURN = """feats AS (
  SELECT o_custkey AS c_custkey, CAST(count(*) AS DOUBLE) AS n_orders, sum(o_totalprice) AS total_price,
    avg(o_totalprice) AS avg_price, max(o_totalprice) AS max_price,
    CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS DOUBLE) AS n_urgent,
    CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) AS n_open
  FROM orders GROUP BY o_custkey),
churn AS (SELECT c.c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(total_price, 0) AS total_price,
            coalesce(avg_price, 0) AS avg_price, coalesce(max_price, 0) AS max_price, coalesce(n_urgent, 0) AS n_urgent,
            coalesce(n_open, 0) AS n_open FROM customer c LEFT JOIN feats f ON f.c_custkey = c.c_custkey)"""

# a maximum-likelihood fit has no gradient in any feature
Q["w35_churn_optimality"] = """SELECT unnest(['n_orders', 'total_price', 'avg_price', 'max_price', 'n_urgent', 'n_open',
  'intercept']) AS feature, 0.0::DOUBLE AS gradient"""

Q["w35_minmax_scale"] = "WITH " + _CHURN + "\nSELECT c_custkey, " + ", ".join(
    f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.5 "
    f"ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 6) AS {c}"
    for c in ["n_orders", "total_price", "avg_price", "max_price", "n_urgent", "n_open"]) + " FROM churn"

_CHURN_FEATURES = ["n_orders", "total_price", "avg_price", "max_price", "n_urgent", "n_open"]


def _logistic(features: list[str], steps: int = 12) -> str:
    """CTEs that end in ``fit`` (one row, w: weights and intercept): logistic
    regression of ``train`` (x: list, y) by Newton steps, each solved by
    Gauss-Jordan elimination."""
    n = len(features) + 1
    out = [f"fit0 AS (SELECT [{', '.join(['0.0::DOUBLE'] * n)}] AS w)"]
    for k in range(steps):
        rows = ", ".join("[" + ", ".join([f"sum(p * (1 - p) * x[{i}] * x[{j}])" for j in range(1, n + 1)]
                                         + [f"sum((y - p) * x[{i}])"]) + "]" for i in range(1, n + 1))
        out.append(f"s{k}_0 AS (SELECT any_value(w) AS w, [{rows}] AS a FROM "
                   f"(SELECT w, x, y, 1 / (1 + exp(-list_inner_product(w, x))) AS p FROM train CROSS JOIN fit{k}) t)")
        for c in range(1, n + 1):
            out.append(f"s{k}_{c} AS (SELECT w, [CASE WHEN i = {c} THEN a[i] ELSE [a[i][j] - a[i][{c}] / a[{c}][{c}] * a[{c}][j] "
                       f"FOR j IN range(1, {n + 2})] END FOR i IN range(1, {n + 1})] AS a FROM s{k}_{c - 1})")
        out.append(f"fit{k + 1} AS MATERIALIZED (SELECT [w[i] + a[i][{n + 1}] / a[i][i] FOR i IN range(1, {n + 1})] AS w FROM s{k}_{n})")
    return ",\n".join([*out, f"fit AS (SELECT w FROM fit{steps})"])


_SCALED = ", ".join(f"CASE WHEN b.hi_{c} = b.lo_{c} THEN 0.5 ELSE ({c} - b.lo_{c}) / (b.hi_{c} - b.lo_{c}) END" for c in _CHURN_FEATURES)
Q["w35_churn_predict"] = "WITH " + _CHURN + f""",
part AS (SELECT *, CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 >= 200 AS used,
                CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM churn JOIN customer USING (c_custkey)),
b AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in _CHURN_FEATURES)} FROM part WHERE used),
scaled AS MATERIALIZED (SELECT c_custkey, y, used, [{_SCALED}, 1.0]::DOUBLE[] AS x FROM part CROSS JOIN b),
train AS MATERIALIZED (SELECT x, y FROM scaled WHERE used),
{_logistic(_CHURN_FEATURES)}
SELECT c_custkey, y AS label, CASE WHEN list_inner_product(w, x) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM scaled CROSS JOIN fit"""

_STOP = "'哪里'"

Q["w36_tfidf_terms"] = f"""WITH toks AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE length(term) >= 2 AND term NOT IN ({_STOP})
       GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT count(*) AS m FROM documents)
SELECT tf.doc_id, tf.term, tf.tf, dfs.df, round(ln((m.m + 1.0) / (dfs.df + 1)), 6) AS idf,
       round(tf.tf * ln((m.m + 1.0) / (dfs.df + 1)), 6) AS tf_idf
FROM tf JOIN dfs ON tf.term = dfs.term CROSS JOIN m"""

Q["w37_encode_profile"] = """WITH per AS (
  SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c.c_custkey,
  CAST(CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
       WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS DOUBLE) AS job,
  CAST(least(greatest(floor(c.c_acctbal / 2000.0), 0), 4) AS DOUBLE) AS income,
  CAST(least(greatest(floor(COALESCE(p.n, 0) / 10.0), 0), 2) AS DOUBLE) AS age,
  CAST(c.c_nationkey % 2 AS DOUBLE) AS sex,
  CAST(CASE WHEN c.c_acctbal > 4500 THEN 1 ELSE 0 END AS DOUBLE) AS label
FROM customer c LEFT JOIN per p ON c.c_custkey = p.c_custkey"""

Q["w37_profile_nb_predict"] = """WITH per AS (
  SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
prof AS (
  SELECT c.c_custkey,
    CAST(CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
         WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS DOUBLE) AS job,
    CAST(least(greatest(floor(c.c_acctbal / 2000.0), 0), 4) AS DOUBLE) AS income,
    CAST(least(greatest(floor(COALESCE(p.n, 0) / 10.0), 0), 2) AS DOUBLE) AS age,
    CAST(c.c_nationkey % 2 AS DOUBLE) AS sex,
    CAST(CASE WHEN c.c_acctbal > 4500 THEN 1 ELSE 0 END AS DOUBLE) AS label
  FROM customer c LEFT JOIN per p ON c.c_custkey = p.c_custkey),
train AS (SELECT * FROM prof
          WHERE CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 >= 200),
cls AS (SELECT label, count(*) AS n, sum(job) AS s1, sum(income) AS s2, sum(age) AS s3, sum(sex) AS s4
        FROM train GROUP BY label),
tot AS (SELECT count(*) AS k, sum(n) AS docs FROM cls),
params AS (
  SELECT label, ln(n + 0.01) - ln(docs + k * 0.01) AS pi,
    ln(s1 + 0.01) - ln(s1 + s2 + s3 + s4 + 4 * 0.01) AS t1, ln(s2 + 0.01) - ln(s1 + s2 + s3 + s4 + 4 * 0.01) AS t2,
    ln(s3 + 0.01) - ln(s1 + s2 + s3 + s4 + 4 * 0.01) AS t3, ln(s4 + 0.01) - ln(s1 + s2 + s3 + s4 + 4 * 0.01) AS t4
  FROM cls CROSS JOIN tot),
scored AS (
  SELECT p.c_custkey, p.label, m.label AS cls,
         p.job * m.t1 + p.income * m.t2 + p.age * m.t3 + p.sex * m.t4 + m.pi AS score
  FROM prof p CROSS JOIN params m)
SELECT c_custkey, label, cls AS cheat FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, cls) AS rn FROM scored) t
WHERE rn = 1"""

Q["w32_update_bitmap_text"] = Q["w32_update_bitmap"]



def _text_nb(term: str, vocabulary: str = "count(DISTINCT term)") -> str:
    """Naive Bayes over ``term`` of each token, trained on the md5 split."""
    return f"""WITH lab AS (SELECT doc_id, CAST(quality AS DOUBLE) AS label FROM labels),
docs AS (SELECT doc_id, text FROM documents),
toks AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM docs),
counted AS (SELECT doc_id, term AS word, count(*) AS n FROM toks WHERE length(term) >= 2 AND term NOT IN ({_STOP})
            GROUP BY ALL),
words AS (SELECT word, {term} AS term FROM (SELECT DISTINCT word, word AS term FROM counted) t),
tf AS (SELECT doc_id, term, sum(n) AS tf FROM counted JOIN words USING (word) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT count(*) AS m FROM docs),
w AS (SELECT tf.doc_id, tf.term, tf.tf * ln((m.m + 1.0) / (dfs.df + 1)) AS w
      FROM tf JOIN dfs ON tf.term = dfs.term CROSS JOIN m),
train AS (SELECT * FROM lab
          WHERE CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 >= 200),
cls AS (SELECT label AS c, count(*) AS n FROM train GROUP BY label),
s AS (SELECT t.label AS c, w.term, sum(w.w) AS s FROM w JOIN train t ON w.doc_id = t.doc_id GROUP BY t.label, w.term),
tc AS (SELECT c, sum(s) AS t FROM s GROUP BY c),
v AS (SELECT {vocabulary} AS v FROM w),
k AS (SELECT count(*) AS k, sum(n) AS total FROM cls),
theta_den AS (SELECT cls.c, ln(COALESCE(tc.t, 0) + v.v * 1.0) AS den,
                     ln(cls.n + 1.0) - ln(k.total + k.k * 1.0) AS pi
              FROM cls LEFT JOIN tc ON cls.c = tc.c CROSS JOIN v CROSS JOIN k),
scored AS (
  SELECT w.doc_id, d.c, d.pi + sum(w.w * (ln(COALESCE(s.s, 0) + 1.0) - d.den)) AS score
  FROM w CROSS JOIN theta_den d LEFT JOIN s ON s.c = d.c AND s.term = w.term
  GROUP BY w.doc_id, d.c, d.pi),
best AS (SELECT doc_id, c AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c) AS rn FROM scored) t WHERE rn = 1)
SELECT docs.doc_id, lab.label, best.prediction FROM docs LEFT JOIN lab USING (doc_id) LEFT JOIN best USING (doc_id)"""


def _murmur3(text: str) -> str:
    """32-bit MurmurHash3 (public algorithm, seed 42) of the UTF-8 bytes, as a signed number."""
    def let(value, body):  # binds x to a value
        return f"[{body} FOR x IN [{value}]][1]"

    def mul(a, c):
        return f"((({a})::HUGEINT * {c}) % 4294967296)::BIGINT"

    def rotl(bits):
        return f"((x << {bits}) | (x >> {32 - bits})) & 4294967295"

    def word(at, n):
        return " | ".join(f"(b[{at} + {i + 1}] << {8 * i})" for i in range(n))

    def scramble(k):
        return let(mul(k, 3432918353), mul(rotl(15), 461845907))
    data = f"[('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(length(h) // 2)]"
    rounds = (f"list_reduce(list_concat([42::BIGINT], [{scramble(word('4 * i', 4))} FOR i IN range(len(b) // 4)]), "
              f"lambda s, k: {let('xor(s, k)', mul(rotl(13), 5) + ' + 3864292196')} % 4294967296)")
    tail = " ".join(f"WHEN {n} THEN {scramble(word('len(b) // 4 * 4', n))}" for n in (1, 2, 3))
    mixed = f"xor(xor({rounds}, CASE len(b) % 4 {tail} ELSE 0 END), len(b))"
    for c, shift in ((None, 16), (2246822507, 13), (3266489909, 16)):
        mixed = let(mixed if c is None else mul(mixed, c), f"xor(x, x >> {shift})")
    signed = let(mixed, "CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END")
    return f"[[{signed} FOR b IN [{data}]][1] FOR h IN [hex(encode({text}))]][1]"


Q["w36_text_pipeline_predict"] = _text_nb(
    f"(({_murmur3('term')}) % 100000 + 100000) % 100000", "max(100000)").replace(
    "SELECT docs.doc_id, lab.label, best.prediction FROM docs LEFT JOIN lab USING (doc_id) LEFT JOIN best USING (doc_id)",
    """SELECT docs.doc_id, coalesce(best.prediction, (SELECT c FROM theta_den ORDER BY pi DESC, c LIMIT 1)) AS prediction
FROM docs LEFT JOIN best USING (doc_id)""")

Q["w36_text_nb_terms"] = _text_nb("term")
Q["w36_text_nb_predict"] = _text_nb("CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 100000")


Q["w17_session_aggregate_windowed"] = Q["w17_session_aggregate"]
