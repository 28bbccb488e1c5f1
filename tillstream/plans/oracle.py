"""SQL for DuckDB over the same tables, written on its own, not from the operators."""

from __future__ import annotations

def _digest_half(multiplier: int) -> str:
    h = "0"
    for field in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "num", "line_cents", "disc", "tax",
                  "ascii(l_returnflag)", "ascii(l_linestatus)", "date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))"):
        h = f"(CAST({h} AS BIGINT) * {multiplier} + coalesce({field}, -1000003)) % 2147483647"
    return h


LINES = f"""item AS (
  SELECT *, CAST(l_quantity AS BIGINT) AS num, CAST(round(l_extendedprice * 100) AS BIGINT) AS line_cents,
         CAST(round(l_discount * 100) AS BIGINT) AS disc, CAST(round(l_tax * 100) AS BIGINT) AS tax
  FROM lineitem),
lines AS (
  SELECT ({_digest_half(16807)}) * 2147483648 + {_digest_half(48271)} AS order_detail_id,
         l_orderkey AS order_id, l_partkey AS sku_id, num AS sku_num, line_cents,
         (line_cents * (100 - disc) + 50) // 100 AS paid_cents
  FROM item)"""

ORDERS = """ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS order_status,
         o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS create_ts,
         strftime(o_orderdate + to_seconds(o_orderkey * 7919 % 86400), '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(o_orderdate, '%Y-%m-%d') AS dt
  FROM orders)"""

TOTALS = """tot AS (
  SELECT order_id, CAST(sum(line_cents) AS BIGINT) AS original_total_cents,
         CAST(sum(paid_cents) AS BIGINT) AS final_total_cents
  FROM lines GROUP BY order_id)"""

AMOUNTS = """amt AS (
  SELECT ord.*, original_total_cents, final_total_cents FROM ord JOIN tot USING (order_id))"""

SPLIT = """raw AS (
  SELECT l.*, o.user_id, o.order_status, o.create_ts, o.create_time, o.dt, o.original_total_cents, o.final_total_cents,
         CASE WHEN original_total_cents = 0 THEN 0
              ELSE (2 * line_cents * final_total_cents + original_total_cents) // (2 * original_total_cents) END AS part,
         row_number() OVER (PARTITION BY l.order_id ORDER BY order_detail_id) AS rn,
         count(*) OVER (PARTITION BY l.order_id) AS n
  FROM lines l JOIN amt o ON l.order_id = o.order_id),
split AS (
  SELECT *, CAST(CASE WHEN rn = n THEN final_total_cents - coalesce(sum(part) OVER (
             PARTITION BY order_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            ELSE part END AS BIGINT) AS final_detail_cents
  FROM raw)"""

USERS = """usr AS (
  SELECT c_custkey AS user_id, c_mktsegment AS user_level, c_nationkey AS province_id,
         DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer),
person AS (
  SELECT *, date_diff('day', birthday, DATE '2020-12-01') // 365 AS age,
         CASE WHEN date_diff('day', birthday, DATE '2020-12-01') // 365 < 20 THEN '20岁及以下'
              WHEN date_diff('day', birthday, DATE '2020-12-01') // 365 > 30 THEN '30岁以上'
              ELSE '21岁到30岁' END AS age_group,
         CASE gender WHEN 'M' THEN '男' ELSE '女' END AS gender_name
  FROM usr)"""

PROVINCES = """prov AS (
  SELECT CAST(n_nationkey AS BIGINT) AS province_id, n_name AS province_name,
         CAST(n_regionkey AS VARCHAR) AS region_id,
         CAST(n_nationkey * 10000 + 110000 AS VARCHAR) AS province_area_code,
         'N-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS province_iso_code,
         'R' || n_regionkey || '-N' || n_nationkey AS province_iso_3166_2
  FROM nation)"""

SKUS = """sku AS (
  SELECT p_partkey AS sku_id, CAST(p_size AS BIGINT) AS spu_id,
         CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents, p_name AS sku_name,
         CAST(substr(p_brand, 7) AS BIGINT) AS tm_id, upper(p_type) AS category3_id,
         p_type AS category3_name, 'spu ' || p_size AS spu_name, p_brand AS tm_name
  FROM part)"""

FIRST = """flag AS (
  SELECT order_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_ts, order_id) = 1
         THEN '1' ELSE '0' END AS if_first_order FROM ord)"""

EVENTS = """ev AS (
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CAST(user_id % 25 AS VARCHAR) AS ar, event_type AS ch, json_extract_string(props, '$.k') AS vc,
         strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, strftime(ts, '%M') AS mi
  FROM events),
dau AS (
  SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts_ms FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, dt ORDER BY ts, event_id) AS rn FROM ev) WHERE rn = 1)"""

CDC = """cdc AS (
  SELECT "table", CASE key % 10 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' WHEN 2 THEN NULL ELSE 'insert' END AS type,
         CASE WHEN key % 20 = 3 THEN '{}' ELSE body END AS data
  FROM (
    SELECT 'order_info' AS "table", order_id AS key, CAST(json_object('order_id', order_id, 'user_id', user_id, 'order_status', order_status) AS VARCHAR) AS body FROM ord
    UNION ALL SELECT 'order_detail', order_detail_id, CAST(json_object('order_detail_id', order_detail_id, 'order_id', order_id, 'sku_id', sku_id, 'sku_num', sku_num) AS VARCHAR) FROM lines
    UNION ALL SELECT 'base_province', province_id, CAST(json_object('province_id', province_id, 'province_name', province_name) AS VARCHAR) FROM prov
    UNION ALL SELECT 'user_info', user_id, CAST(json_object('user_id', user_id, 'user_level', user_level, 'gender', gender) AS VARCHAR) FROM usr
    UNION ALL SELECT 'sku_info', sku_id, CAST(json_object('sku_id', sku_id, 'spu_id', spu_id, 'sku_name', sku_name, 'tm_id', tm_id) AS VARCHAR) FROM sku
    UNION ALL SELECT DISTINCT 'spu_info', spu_id, CAST(json_object('spu_id', spu_id, 'spu_name', spu_name) AS VARCHAR) FROM sku
    UNION ALL SELECT DISTINCT 'base_trademark', tm_id, CAST(json_object('tm_id', tm_id, 'tm_name', tm_name) AS VARCHAR) FROM sku
    UNION ALL SELECT DISTINCT 'base_category3', length(category3_name), CAST(json_object('category3_id', category3_id, 'category3_name', category3_name, 'n', length(category3_name)) AS VARCHAR) FROM sku
    UNION ALL SELECT 'comment_info', event_id, CAST(json_object('event_id', event_id, 'event_type', event_type) AS VARCHAR) FROM events)),
kept AS (
  SELECT * FROM cdc WHERE data <> '{}' AND type IS DISTINCT FROM 'delete'
    AND (("table" = 'order_info' AND type = 'insert')
         OR "table" IN ('order_detail', 'base_province', 'user_info', 'sku_info', 'spu_info', 'base_trademark', 'base_category3')))"""


def _sql(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


_AMT = (LINES, ORDERS, TOTALS, AMOUNTS)
_SPL = (*_AMT, SPLIT)

_STAT = """stat AS (
  SELECT dt AS stat_time, CAST(tm_id AS VARCHAR) AS trademark_id, tm_name AS trademark_name,
         CAST(sum(final_detail_cents) AS BIGINT) AS amount_cents
  FROM split JOIN sku USING (sku_id) GROUP BY dt, tm_id, tm_name)"""

_TOP = """top AS (
  SELECT trademark_id, trademark_name, CAST(sum(amount_cents) AS BIGINT) AS order_amount_cents
  FROM stat WHERE stat_time > '1996-01-01' AND stat_time < '1999-01-01'
  GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10)"""

_HOURS = "hours AS (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS hr FROM range(24))"


def _word(column: str, *words: str) -> str:
    alt = "|".join(words)
    return f"regexp_matches({column}, '(?i)(^|[^\\p{{L}}\\p{{N}}_])({alt})($|[^\\p{{L}}\\p{{N}}_])')"


_HITS = f"""hits AS (
  SELECT * FROM documents WHERE n_chars >= 300
    AND {_word('text', 'the', 'orders', 'for')} AND {_word('lang', 'en', 'de')})"""

_DETAIL = f"hit AS (SELECT l.*, s.* EXCLUDE (sku_id) FROM lines l JOIN sku s USING (sku_id) WHERE {_word('sku_name', 'red')})"


def _share(source: str, name: str) -> str:
    return (
        f"SELECT {name}, n, CAST((n * 20000 + sum(n) OVER ()) // (2 * sum(n) OVER ()) AS BIGINT) AS share_bp"
        f" FROM (SELECT {name}, count(*) AS n FROM {source} GROUP BY 1)"
    )


def _user_sum(name: str) -> str:
    return _sql(
        *_AMT, USERS,
        body=f"SELECT {name}, CAST(sum(final_total_cents) AS BIGINT) AS amount_cents, count(*) AS order_count"
        f" FROM amt LEFT JOIN person USING (user_id) GROUP BY 1",
    )


_STATE = """before AS (SELECT DISTINCT user_id FROM ord WHERE dt < '1998-01-01'),
since AS (SELECT * FROM ord WHERE dt >= '1998-01-01')"""

SQL: dict[str, str] = {
    "json_field_extract": _sql(EVENTS, body="SELECT event_id, ts_ms AS ts, mid, ch FROM ev"),
    "json_typed_parse": _sql(EVENTS, body="""SELECT ts_ms AS ts, CASE WHEN ch = 'signup' THEN '1' END AS start,
        mid, uid, ar, ch, vc FROM ev"""),
    "app_log_route": "SELECT event_id, CASE WHEN event_type = 'signup' THEN 'APP_STARTUP' ELSE 'APP_EVENT' END AS topic FROM events",
    "raw_log_landing": _sql(EVENTS, body="""SELECT dt, count(*) AS n_lines, CAST(sum(length(
        '{"ts":' || ts_ms || CASE WHEN ch = 'signup' THEN ',"start":"1"' ELSE '' END || ',"common":{"mid":"' || mid ||
        '","uid":"' || uid || '","ar":"' || ar || '","ch":"' || ch || '","vc":"' || vc || '"}}')) AS BIGINT) AS n_chars
        FROM ev GROUP BY dt"""),
    "cdc_single_filter": _sql(LINES, ORDERS, USERS, PROVINCES, SKUS, CDC, body='SELECT "table", type, data FROM kept'),
    "cdc_route_topic": _sql(LINES, ORDERS, USERS, PROVINCES, SKUS, CDC, body="""
        SELECT 'ODS_' || upper("table") AS topic, count(*) AS n_messages, CAST(sum(length(data)) AS BIGINT) AS n_chars
        FROM kept GROUP BY 1"""),
    "cdc_array_explode": """SELECT 'ODS_ORDER_STATUS_LOG' AS topic, CAST(json_object('id', o_orderkey * 10 + i,
        'order_id', o_orderkey, 'order_status', o_orderstatus) AS VARCHAR) AS data
        FROM (SELECT *, unnest(range(1, o_orderkey % 4 + 1)) AS i FROM orders)""",
    "ods_to_json": _sql(ORDERS, body="""SELECT CAST(json_object('order_id', order_id, 'user_id', user_id,
        'order_status', order_status, 'create_time', create_time) AS VARCHAR) AS value FROM ord"""),
    "dwd_order_keyed_json": _sql(*_AMT, body="""SELECT CAST(order_id AS VARCHAR) AS key, CAST(json_object('order_id', order_id,
        'user_id', user_id, 'final_total_cents', final_total_cents, 'dt', dt) AS VARCHAR) AS value FROM amt"""),
    "dim_scan": _sql(PROVINCES, body="SELECT * FROM prov"),
    "dim_point_lookup": _sql(ORDERS, USERS, body="""SELECT user_id, user_level, gender FROM usr
        WHERE user_id IN (SELECT user_id FROM ord WHERE dt = '1996-09-17')"""),
    "dim_query_rows": _sql(SKUS, body="SELECT tm_id, count(*) AS n_sku, max(price_cents) AS max_price_cents FROM sku GROUP BY tm_id"),
    "dim_upsert_latest": _sql(USERS, body="SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'VIP' ELSE user_level END AS user_level, gender FROM usr"),
    "user_age_group": _sql(USERS, body="SELECT user_id, strftime(birthday, '%Y-%m-%d') AS birthday, age_group FROM person"),
    "user_gender_name": _sql(USERS, body="SELECT user_id, gender, gender_name FROM person"),
    "sku_enrich": _sql(SKUS, body="SELECT * FROM sku"),
    "event_time_parts": _sql(EVENTS, body="SELECT event_id, dt, hr, mi FROM ev"),
    "order_time_parts": _sql(ORDERS, body="SELECT order_id, substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour FROM ord"),
    "dau_dedup": _sql(EVENTS, body="SELECT mid, dt, ts_ms FROM dau"),
    "dau_project": _sql(EVENTS, body="SELECT * FROM dau"),
    "dau_index_write": _sql(EVENTS, body="SELECT * FROM dau"),
    "order_province_join": _sql(ORDERS, USERS, PROVINCES, body="""SELECT order_id, province_name, province_area_code,
        province_iso_code, province_iso_3166_2 FROM ord LEFT JOIN usr USING (user_id) LEFT JOIN prov USING (province_id)"""),
    "order_user_join": _sql(ORDERS, USERS, body="""SELECT order_id, ord.user_id, age_group AS user_age_group,
        gender_name AS user_gender FROM ord LEFT JOIN person USING (user_id)"""),
    "detail_sku_join": _sql(LINES, SKUS, body="""SELECT order_detail_id, order_id, l.sku_id, sku_name, spu_id, tm_id,
        category3_id, spu_name, tm_name, category3_name FROM lines l LEFT JOIN sku s ON l.sku_id = s.sku_id"""),
    "order_first_flag": _sql(ORDERS, FIRST, body="SELECT * FROM flag"),
    "order_first_flag_with_state": _sql(ORDERS, _STATE, body="""SELECT order_id, user_id, CASE WHEN
        row_number() OVER (PARTITION BY user_id ORDER BY create_ts, order_id) = 1
        AND user_id NOT IN (SELECT user_id FROM before) THEN '1' ELSE '0' END AS if_first_order FROM since"""),
    "order_user_state": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, '1' AS if_consumed FROM orders",
    "new_customers_anti": _sql(ORDERS, _STATE, body="SELECT DISTINCT user_id FROM since WHERE user_id NOT IN (SELECT user_id FROM before)"),
    "order_wide_join": _sql(*_SPL, USERS, PROVINCES, SKUS, FIRST, body="""
        SELECT order_detail_id, s.order_id, order_status, create_time, s.user_id, s.sku_id,
               (2 * line_cents + sku_num) // (2 * sku_num) AS sku_price_cents, sku_num, sku_name,
               original_total_cents - final_total_cents AS benefit_reduce_cents, original_total_cents,
               CAST(0 AS BIGINT) AS freight_cents, final_total_cents, final_detail_cents, if_first_order,
               province_name, province_area_code, age_group AS user_age_group, gender_name AS user_gender, dt,
               spu_id, tm_id, category3_id, spu_name, tm_name, category3_name
        FROM split s JOIN flag f ON f.order_id = s.order_id LEFT JOIN person p ON p.user_id = s.user_id
        LEFT JOIN prov v ON v.province_id = p.province_id LEFT JOIN sku k ON k.sku_id = s.sku_id"""),
    "order_wide_dedup": _sql(LINES, body="""SELECT order_detail_id, order_id, sku_id, line_cents FROM lines
        WHERE order_id IN (SELECT o_orderkey FROM orders)"""),
    "order_wide_latest": _sql(LINES, ORDERS, body="""
        SELECT order_detail_id, dt, order_status, strftime(create_ts, '%Y-%m-%d %H:%M:%S') AS create_time FROM (
          SELECT *, row_number() OVER (PARTITION BY dt, order_detail_id ORDER BY create_ts DESC) AS rn FROM (
            SELECT order_detail_id, dt, order_status, create_ts FROM lines JOIN ord USING (order_id)
            UNION ALL
            SELECT order_detail_id, dt, 'RESENT', create_ts + INTERVAL 1 MINUTE FROM lines JOIN ord USING (order_id)
            WHERE order_id % 5 = 0)) WHERE rn = 1"""),
    "order_wide_latest_amount": _sql(LINES, ORDERS, body="""SELECT dt, CAST(sum(line_cents) AS BIGINT) AS amount_cents,
        count(*) AS n_lines FROM lines JOIN ord USING (order_id) GROUP BY dt"""),
    "order_wide_shard_counts": _sql(LINES, body="SELECT order_detail_id % 8 AS shard, count(*) AS n_rows FROM lines GROUP BY 1"),
    "order_split_amount": _sql(*_SPL, body="SELECT order_id, order_detail_id, line_cents, final_detail_cents FROM split"),
    "order_split_check": _sql(LINES, TOTALS, body="SELECT order_id, final_total_cents, final_total_cents AS split_sum_cents FROM tot JOIN orders ON o_orderkey = order_id"),
    "order_detail_unmatched": _sql(LINES, body="""
        SELECT 'order' AS kind, o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT order_id FROM lines)
        UNION ALL SELECT 'line', order_detail_id FROM lines WHERE order_id NOT IN (SELECT o_orderkey FROM orders)"""),
    "trademark_batch_amount": _sql(*_SPL, SKUS, _STAT, body="SELECT * FROM stat"),
    "trademark_topn": _sql(*_SPL, SKUS, _STAT, _TOP, body="SELECT * FROM top"),
    "trademark_topn_xy": _sql(*_SPL, SKUS, _STAT, _TOP, body="SELECT trademark_name AS x, order_amount_cents AS y, '1' AS s FROM top"),
    "spu_amount": _sql(*_SPL, SKUS, body="""SELECT spu_id, spu_name, CAST(sum(final_detail_cents) AS BIGINT) AS amount_cents
        FROM split JOIN sku USING (sku_id) GROUP BY 1, 2"""),
    "category_amount": _sql(*_SPL, SKUS, body="""SELECT category3_id, category3_name,
        CAST(sum(final_detail_cents) AS BIGINT) AS amount_cents, count(*) AS line_count
        FROM split JOIN sku USING (sku_id) GROUP BY 1, 2"""),
    "province_amount": _sql(*_SPL, USERS, PROVINCES, body="""SELECT p.province_id, province_name,
        CAST(sum(final_detail_cents) AS BIGINT) AS amount_cents, count(DISTINCT order_id) AS order_count
        FROM split JOIN usr USING (user_id) JOIN prov p ON p.province_id = usr.province_id GROUP BY 1, 2"""),
    "age_group_amount": _user_sum("age_group"),
    "gender_amount": _user_sum("gender_name"),
    "dim_grouping_sets": _sql(*_SPL, USERS, SKUS, body="""
        SELECT CAST(province_id AS BIGINT) AS province_id, age_group, gender_name, category3_id,
               CAST(GROUPING(province_id, age_group, gender_name, category3_id) AS BIGINT) AS grouping_id,
               CAST(sum(final_detail_cents) AS BIGINT) AS amount_cents, count(*) AS line_count
        FROM split LEFT JOIN person USING (user_id) LEFT JOIN sku USING (sku_id)
        GROUP BY GROUPING SETS ((province_id), (age_group), (gender_name), (category3_id), ())"""),
    "gender_share": _sql(LINES, ORDERS, USERS, body=_share("lines JOIN ord USING (order_id) JOIN person USING (user_id)", "gender_name")),
    "age_share": _sql(LINES, ORDERS, USERS, body=_share("lines JOIN ord USING (order_id) JOIN person USING (user_id)", "age_group")),
    "province_map_bands": _sql(*_AMT, USERS, PROVINCES, body="""
        SELECT province_name, order_count, least(order_count * 6 // (max(order_count) OVER () + 1), 5) AS band
        FROM (SELECT province_name, count(*) AS order_count FROM amt JOIN usr USING (user_id)
              JOIN prov ON prov.province_id = usr.province_id GROUP BY 1)"""),
    "dau_total": _sql(EVENTS, body="SELECT count(*) AS dau FROM dau WHERE dt = '2024-01-15'"),
    "dau_hour": _sql(EVENTS, body="SELECT hr, count(*) AS dau FROM dau WHERE dt = '2024-01-15' GROUP BY hr"),
    "dau_hour_compare": _sql(EVENTS, _HOURS, body="""
        SELECT hr, (SELECT count(*) FROM dau WHERE dau.hr = hours.hr AND dt = '2024-01-15') AS today,
               (SELECT count(*) FROM dau WHERE dau.hr = hours.hr AND dt = '2024-01-14') AS yesterday FROM hours"""),
    "dau_hour_map": _sql(EVENTS, body="""
        SELECT '{' || string_agg('"' || hr || '":' || n, ',' ORDER BY hr) || '}' AS value
        FROM (SELECT hr, count(*) AS n FROM dau WHERE dt = '2024-01-15' GROUP BY hr)"""),
    "new_device_day": _sql(EVENTS, body="SELECT dt, count(*) AS new_devices FROM (SELECT mid, min(dt) AS dt FROM ev GROUP BY mid) GROUP BY dt"),
    "order_amount_day": _sql(*_SPL, body="SELECT CAST(sum(final_detail_cents) AS BIGINT) AS order_amount_cents FROM split WHERE dt = '1996-09-17'"),
    "order_amount_hour": _sql(*_SPL, body="""SELECT substr(create_time, 12, 2) AS hr,
        CAST(sum(final_detail_cents) AS BIGINT) AS order_amount_cents FROM split WHERE dt = '1996-09-17' GROUP BY 1"""),
    "order_amount_hour_compare": _sql(*_SPL, _HOURS, body="""
        SELECT hours.hr, CAST(coalesce(sum(final_detail_cents) FILTER (WHERE dt = '1996-09-17'), 0) AS BIGINT) AS today,
               CAST(coalesce(sum(final_detail_cents) FILTER (WHERE dt = '1996-09-16'), 0) AS BIGINT) AS yesterday
        FROM hours LEFT JOIN split ON substr(create_time, 12, 2) = hours.hr GROUP BY 1"""),
    "kpi_total": _sql(*_SPL, EVENTS, body="""
        SELECT 'dau' AS id, '新增日活' AS name, count(*) AS value FROM dau WHERE dt = '2024-01-15'
        UNION ALL SELECT 'new_mid', '新增设备', count(*) FROM (SELECT mid FROM ev GROUP BY mid HAVING min(dt) = '2024-01-15')
        UNION ALL SELECT 'order_amount', '新增交易额', CAST(coalesce(sum(final_detail_cents), 0) AS BIGINT) FROM split WHERE dt = '1996-09-17'"""),
    "event_sliding_counts": """
        SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM (
          SELECT unnest([time_bucket(INTERVAL 5 SECOND, ts), time_bucket(INTERVAL 5 SECOND, ts) - INTERVAL 5 SECOND]) AS w
          FROM events) GROUP BY w""",
    "keyword_match": _sql(_HITS, body="SELECT doc_id, lang, n_chars FROM hits"),
    "keyword_should": f"""SELECT doc_id, lang, source, n_chars FROM documents WHERE n_chars >= 300
        AND ({_word('text', 'que', 'der')} OR {_word('source', 'src1')})""",
    "keyword_highlight": _sql(_HITS, body="""
        SELECT doc_id, array_to_string(list_transform(
          regexp_extract_all(text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+'),
          lambda t: CASE WHEN lower(t) IN ('the', 'orders', 'for') THEN '<em>' || t || '</em>' ELSE t END), '') AS highlight
        FROM hits"""),
    "keyword_page": _sql(_HITS, body="SELECT doc_id, lang, n_chars FROM hits ORDER BY n_chars, doc_id LIMIT 20 OFFSET 20"),
    "detail_search_total": _sql(LINES, SKUS, _DETAIL, body="SELECT count(*) AS total FROM hit"),
    "detail_search_page": _sql(LINES, ORDERS, USERS, SKUS, _DETAIL, body="""
        SELECT order_detail_id, o.user_id, sku_id, gender AS user_gender, age AS user_age, user_level,
               price_cents AS order_price_cents, sku_name, tm_id, category3_id, category3_name, spu_id, sku_num,
               CAST(1 AS BIGINT) AS order_count, line_cents AS order_amount_cents, dt
        FROM (SELECT * FROM hit ORDER BY order_detail_id LIMIT 20 OFFSET 20) h
        JOIN ord o USING (order_id) LEFT JOIN person p ON p.user_id = o.user_id"""),
    "detail_search_gender_share": _sql(LINES, ORDERS, USERS, SKUS, _DETAIL, body=_share(
        "hit JOIN ord USING (order_id) JOIN person USING (user_id)", "gender_name")),
    "detail_search_age_share": _sql(LINES, ORDERS, USERS, SKUS, _DETAIL, body=_share(
        "hit JOIN ord USING (order_id) JOIN person USING (user_id)", "age_group")),
    "detail_search_day": _sql(LINES, ORDERS, SKUS, _DETAIL, body="""
        SELECT order_detail_id, order_id, user_id, sku_name, tm_name, line_cents, dt
        FROM hit JOIN ord USING (order_id) WHERE dt = '1996-09-17' ORDER BY order_detail_id LIMIT 10"""),
    "doc_with_array": """SELECT doc_id, CAST(CASE WHEN doc_id % 4 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n_tags,
        lang || ',' || source || CASE WHEN doc_id % 4 = 0 THEN ',again' ELSE '' END AS tags FROM documents""",
    "stream_events_source": _sql(EVENTS, body="SELECT ts_ms, mid, ch, vc FROM ev"),
    "stream_restart_exact": _sql(EVENTS, body="SELECT dt, count(*) AS n FROM ev GROUP BY dt"),
    "stream_dim_upsert": _sql(USERS, body="""SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'VIP' ELSE user_level END AS user_level,
        age_group, gender_name FROM person"""),
    "stream_order_enrich": _sql(ORDERS, USERS, PROVINCES, body="""SELECT order_id, province_name, province_area_code,
        age_group AS user_age_group, gender_name AS user_gender
        FROM ord LEFT JOIN person USING (user_id) LEFT JOIN prov USING (province_id)"""),
    "stream_order_full_outer": _sql(LINES, body="""
        SELECT 'order' AS kind, o_orderkey AS id FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey NOT IN (SELECT order_id FROM lines)
        UNION ALL SELECT 'line', order_detail_id FROM lines WHERE order_id % 7 = 0"""),
    "stream_trademark_sink": _sql(*_SPL, SKUS, body="""SELECT tm_id, tm_name, CAST(sum(final_detail_cents) AS BIGINT) AS amount_cents
        FROM split JOIN sku USING (sku_id) GROUP BY 1, 2"""),
}

# A stream over all of a table gives what the batch query gives.
for _stream, _batch in {
    "stream_cdc_route": "cdc_route_topic",
    "stream_dau_dedup": "dau_dedup",
    "stream_sliding_counts": "event_sliding_counts",
    "stream_order_first_flag": "order_first_flag",
    "stream_order_wide": "order_wide_dedup",
    "stream_order_split": "order_split_amount",
    "stream_layers": "stream_trademark_sink",
    "stream_detail_enrich": "detail_sku_join",
}.items():
    SQL[_stream] = SQL[_batch]

# The store gives back every column of the wide table.
SQL["order_wide_store"] = SQL["order_wide_join"]
SQL["stream_layers_wide"] = SQL["order_wide_join"]

SQL["stream_corrupt_side"] = _sql(EVENTS, body="""
    SELECT 'stored' AS kind, CAST(ts_ms AS VARCHAR) AS value FROM ev WHERE event_id % 50 <> 0
    UNION ALL SELECT 'corrupt', substr('{"ts":' || ts_ms || ',', 1, 20) FROM ev WHERE event_id % 50 = 0""")

SQL["keyword_page_after"] = SQL["keyword_page"]
SQL["stream_sku_late_names"] = SQL["sku_enrich"]
SQL["order_user_level"] = _sql(ORDERS, USERS, body="""
    SELECT order_id, user_id, CASE WHEN user_id % 3 = 0 AND create_ts >= TIMESTAMP '1998-01-01' THEN 'VIP'
           ELSE user_level END AS user_level
    FROM ord LEFT JOIN usr USING (user_id)""")


def _loaded(dimension: str, source: str, key: str, number: str, label: str) -> str:
    return (
        f"SELECT DISTINCT '{dimension}' AS dimension, CAST({key} AS VARCHAR) AS key,"
        f" {label} || CASE WHEN {number} % 3 = 0 THEN '+' ELSE '' END AS label FROM {source}"
    )


SQL["stream_dim_loaders"] = _sql(PROVINCES, USERS, SKUS, body=" UNION ALL ".join((
    _loaded("province", "prov", "province_id", "province_id", "province_name"),
    _loaded("user", "usr", "user_id", "user_id", "user_level"),
    _loaded("sku", "sku", "sku_id", "sku_id", "sku_name"),
    _loaded("spu", "sku", "spu_id", "spu_id", "spu_name"),
    _loaded("trademark", "sku", "tm_id", "tm_id", "tm_name"),
    _loaded("category3", "sku", "category3_id", "length(category3_id)", "category3_name"),
)))

_FORM = f"""form AS (
  SELECT order_detail_id, s.order_id, s.user_id, sku_name, tm_name, final_detail_cents,
         age_group AS user_age_group, gender_name AS user_gender, dt
  FROM split s JOIN sku USING (sku_id) LEFT JOIN person p ON p.user_id = s.user_id
  WHERE dt = '1996-09-17' AND {_word('sku_name', 'red')})"""


def _form(body: str) -> str:
    return _sql(*_SPL, USERS, SKUS, _FORM, body=body)


SQL["detail_form_total"] = _form("SELECT count(*) AS total FROM form")
SQL["detail_form_gender_share"] = _form(_share("form", "user_gender"))
SQL["detail_form_age_share"] = _form(_share("form", "user_age_group"))
SQL["detail_form_page"] = _form("SELECT * FROM form ORDER BY order_detail_id, order_id LIMIT 3 OFFSET 3")

SQL["dau_kept_actives"] = _sql(EVENTS, """late AS (
  SELECT *, ts + to_hours(CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 23 ELSE 48 END) AS came FROM ev),
gaps AS (
  SELECT *, CASE WHEN came - lag(came) OVER (PARTITION BY mid, dt ORDER BY came, ts_ms, event_id) <= INTERVAL 24 HOUR
                 THEN 0 ELSE 1 END AS begins FROM late),
stretch AS (
  SELECT *, sum(begins) OVER (PARTITION BY mid, dt ORDER BY came, ts_ms, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nr FROM gaps)""", body="""
  SELECT mid, dt, first(ts_ms ORDER BY came, ts_ms, event_id) AS ts_ms,
         strftime(min(came), '%Y-%m-%d %H:%M:%S') AS arrived,
         strftime(max(came) + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS kept_until, count(*) AS n_events
  FROM stretch GROUP BY mid, dt, nr""")
SQL["stream_dau_kept_actives"] = SQL["dau_kept_actives"]
