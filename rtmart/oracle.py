"""SQL equivalents of the registered queries, over the same parquet tables, for result checks."""

from __future__ import annotations

from rtmart import schemas as S
from rtmart.registry import (
    ASOF, DAU_DATE, DEFAULT_RULE, GMV_DATE, HOURLY, INDEXED, KEYWORD, MINUTES, SEEN_UNTIL, SERVER_TS,
)

DAU_YESTERDAY, GMV_YESTERDAY = "2024-01-01", "1996-09-16"

VIEWS = {
    "startup_log": """
        SELECT 'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid, 'mart' AS appid,
               'area_' || (user_id % 10) AS area,
               CASE WHEN user_id % 10 < 3 THEN 'ios' ELSE 'android' END AS os,
               CASE WHEN user_id % 10 < 3 THEN 'appstore' ELSE 'ch_' || (user_id % 7) END AS ch,
               'startup' AS type, '1.' || (user_id % 4) AS vs, epoch_us(ts) // 1000 AS ts,
               strftime(ts, '%Y-%m-%d') AS "logDate", strftime(ts, '%H') AS "logHour"
        FROM events""",
    "event_log": """
        SELECT 'mid_' || (user_id % 5) AS mid, CAST(user_id AS VARCHAR) AS uid,
               CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem' WHEN 'view' THEN 'addCart'
                    WHEN 'signup' THEN 'addFavor' WHEN 'error' THEN 'addComment' END AS evid,
               json_extract_string(props, '$.k') AS itemid, epoch_us(ts) // 1000 AS ts
        FROM events""",
    "order_info": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
               o_orderstatus AS order_status, o_orderpriority AS payment_way, o_totalprice AS total_amount,
               '138' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS tel,
               strftime(o_orderdate + to_seconds((o_orderkey * 37) % 86400), '%Y-%m-%d %H:%M:%S') AS create_time,
               strftime(o_orderdate, '%Y-%m-%d') AS create_date,
               strftime(o_orderdate + to_seconds((o_orderkey * 37) % 86400), '%H') AS create_hour
        FROM orders""",
    "order_detail": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
               CAST(l_orderkey AS VARCHAR) AS order_id, p_name AS sku_name, CAST(l_partkey AS VARCHAR) AS sku_id,
               p_retailprice AS order_price, l_linenumber
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "user_info": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
               DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS birthday,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
        FROM customer""",
    "black_list": "SELECT CAST(c_custkey AS VARCHAR) AS userid FROM customer WHERE c_acctbal < 0",
    "dau": 'SELECT mid, "logDate", min("logHour") AS "logHour" FROM startup_log GROUP BY ALL',
    "user_latest": """
        SELECT u.id, u.login_name, o_orderpriority AS user_level, strftime(u.birthday, '%Y-%m-%d') AS birthday,
               u.gender, epoch_ms(o_orderdate) AS ts, o_orderkey AS "offset"
        FROM orders JOIN user_info u ON u.id = CAST(o_custkey AS VARCHAR)
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "sales": f"""
        SELECT d.id AS order_detail_id, d.order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
               u.gender AS user_gender,
               CAST(coalesce((epoch_ms(TIMESTAMP '{ASOF}') - epoch_ms(u.birthday)) // 31536000000, 0) AS INTEGER)
                   AS user_age,
               u.user_level, d.order_price AS sku_price, d.sku_name, o.create_date AS dt, d.l_linenumber
        FROM order_info o JOIN order_detail d ON o.id = d.order_id LEFT JOIN user_info u ON u.id = o.user_id""",
    "hits": f"""
        SELECT * FROM sales
        WHERE dt = '{GMV_DATE}'
          AND list_has_all(regexp_split_to_array(lower(sku_name), '[^\\p{{L}}\\p{{N}}]+'), ['{KEYWORD}'])""",
}

SALE_FIELDS = (
    "order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, user_age, user_level, "
    "sku_price, sku_name, dt"
)


def _with(names: str, body: str) -> str:
    views = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names.split())
    return f"WITH {views} {body}"


def _dau_hours_sql(where: str) -> str:
    return f'SELECT "logDate", "logHour", count(*) AS ct FROM dau WHERE {where} GROUP BY ALL'


MONEY = "CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"


def _ranked(part: str) -> str:
    """Sales of a day by BM25 of their name over all order lines."""
    words = ["old", "ring"]
    times = [f"len(list_filter(w, lambda x: x = '{w}'))" for w in words]
    known = ", ".join(f"count(*) FILTER ({t} > 0) AS d{i}" for i, t in enumerate(times))
    score = " + ".join(
        f"ln(1 + (n - d{i} + 0.5) / (d{i} + 0.5)) * {t} * 2.2 / ({t} + 1.2 * (0.25 + 0.75 * len(w) / average))" for i, t in enumerate(times)
    )
    split = "list_filter(regexp_split_to_array(lower(sku_name), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""SELECT {SALE_FIELDS}, round({score}, 6) AS score
        FROM (SELECT *, {split} AS w FROM sales WHERE dt = '{GMV_DATE}'),
             (SELECT count(*) AS n, avg(len(w)) AS average, {known} FROM (SELECT {split} AS w FROM order_detail WHERE sku_name IS NOT NULL))
        WHERE {" + ".join(times)} > 0 ORDER BY score DESC, order_id, order_detail_id {part}"""


def _series(kind: str) -> str:
    if kind == "gmv":
        return f"""SELECT CASE WHEN create_date = '{GMV_DATE}' THEN 'today' ELSE 'yesterday' END AS series,
                   create_hour AS hour, {MONEY} AS value FROM order_info
                   WHERE create_date IN ('{GMV_DATE}', '{GMV_YESTERDAY}') GROUP BY ALL"""
    return f"""SELECT CASE WHEN "logDate" = '{DAU_DATE}' THEN 'today' ELSE 'yesterday' END AS series,
               "logHour" AS hour, CAST(count(*) AS DOUBLE) AS value FROM dau
               WHERE "logDate" IN ('{DAU_DATE}', '{DAU_YESTERDAY}') GROUP BY ALL"""


def _hours_24(views: str, kind: str) -> str:
    return _with(
        views,
        f""", hours AS ({_series(kind)})
        SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hour,
               coalesce(max(CASE WHEN series = 'yesterday' THEN value END), 0.0) AS yesterday,
               coalesce(max(CASE WHEN series = 'today' THEN value END), 0.0) AS today
        FROM range(24) r(h) LEFT JOIN hours ON hours.hour = lpad(CAST(h AS VARCHAR), 2, '0') GROUP BY h""",
    )


def _half_up(x: str) -> str:
    return f"floor({x} + 0.5) / 10"


def _pct(part: str) -> str:
    return f"CASE WHEN count(*) = 0 THEN 0.0 ELSE {_half_up(f'{part} * 1000.0 / count(*)')} END"


FEMALE = _pct("count(*) FILTER (WHERE user_gender = 'F')")
YOUNG = _pct("count(*) FILTER (WHERE user_age < 20)")
OLD = _pct("count(*) FILTER (WHERE user_age >= 30)")


def _rates(source: str) -> str:
    return f"""SELECT total, round(100 - female, 1) AS male, female, under_20,
               floor((100.0 - under_20 - from_30) * 10 + 0.5) / 10 AS from_20_to_30, from_30
        FROM (SELECT count(*) AS total, CAST({FEMALE} AS DOUBLE) AS female, CAST({YOUNG} AS DOUBLE) AS under_20,
              CAST({OLD} AS DOUBLE) AS from_30 FROM {source})"""


def _windows(rule, source: str = "event_log") -> str:
    """CTEs ``w`` (event, window) and ``facts`` for a rule."""
    w, s, slot = rule.window, rule.slide, rule.slot
    return f""", w AS (
            SELECT mid, uid, itemid, evid, ts - ts % {slot} AS slot,
                   unnest(generate_series((((ts - {w}) // {s}) + 1) * {s}, (ts // {s}) * {s}, {s})) AS window_start
            FROM {source}),
        facts AS (
            SELECT mid, window_start, count(DISTINCT uid) FILTER (WHERE evid = 'coupon') AS n_uids,
                   count(DISTINCT itemid) FILTER (WHERE evid = 'coupon') AS n_items, count(*) AS n_events
            FROM w GROUP BY mid, window_start
            HAVING count(DISTINCT uid) FILTER (WHERE evid = 'coupon') >= {rule.min_accounts}
               AND count(*) FILTER (WHERE evid = 'clickItem') = 0)"""


DOCUMENTS = """, listed AS (
            SELECT mid, window_start, 'uid' AS kind, NULL::BIGINT AS slot, uid AS member, count(*) AS n
            FROM w SEMI JOIN facts USING (mid, window_start) WHERE evid = 'coupon' GROUP BY ALL
            UNION ALL
            SELECT mid, window_start, 'item', NULL, itemid, count(*)
            FROM w SEMI JOIN facts USING (mid, window_start) WHERE evid = 'coupon' GROUP BY ALL
            UNION ALL
            SELECT mid, window_start, 'event', slot, evid, count(*)
            FROM w SEMI JOIN facts USING (mid, window_start) GROUP BY ALL)"""

LAST_PER_MINUTE = f""", ended AS (SELECT *, make_timestamp((window_start + {MINUTES.window}) * 1000) AS ended FROM facts),
        last AS (
            SELECT mid, strftime(ended, '%Y-%m-%d') AS index_day, mid || '-' || strftime(ended, '%H:%M') AS doc_id,
                   window_start, n_uids, n_items, n_events
            FROM ended
            QUALIFY row_number() OVER (PARTITION BY mid, date_trunc('minute', ended) ORDER BY window_start DESC) = 1)"""

JSON_ROW = "{" + ", ".join(f"'{f}': {f}" for f in SALE_FIELDS.split(", ")) + "}"


def _options(*pairs: tuple[str, str]) -> str:
    return "[" + ", ".join(f"{{'name': '{n}', 'value': {c}}}" for n, c in pairs) + "]"


SEARCH_DOCUMENT = f""", rates AS ({_rates('hits')}),
        page AS (SELECT {JSON_ROW} AS r, order_id, order_detail_id FROM hits ORDER BY order_id, order_detail_id LIMIT 10)
        SELECT CAST(to_json({{'total': total,
            'stat': [{{'options': {_options((S.OPTION_UNDER_20, 'under_20'), (S.OPTION_20_TO_30, 'from_20_to_30'),
                                            (S.OPTION_FROM_30, 'from_30'))}, 'title': '{S.TITLE_AGE}'}},
                     {{'options': {_options((S.OPTION_MALE, 'male'), (S.OPTION_FEMALE, 'female'))},
                       'title': '{S.TITLE_GENDER}'}}],
            'detail': (SELECT coalesce(list(r ORDER BY order_id, order_detail_id), []) FROM page)}}) AS VARCHAR) AS value
        FROM rates"""


def oracle_sql() -> dict[str, str]:
    start, dau, order = "startup_log", "startup_log dau", "order_info"
    sales, hits = "order_info order_detail user_info sales", "order_info order_detail user_info sales hits"
    first = """SELECT mid, uid, appid, area, os, ch, type, vs, ts, "logDate", "logHour" FROM startup_log"""
    rank = """row_number() OVER (PARTITION BY mid, "logDate" ORDER BY ts, uid)"""
    upsert = "ship_date, l_partkey, l_suppkey, l_quantity, l_extendedprice"
    json_hours = "'\"' || hour || '\":' || value"
    return {
        "dau_first_start": _with(start, f"{first} QUALIFY {rank} = 1"),
        "dau_stream_dedup": _with(start, 'SELECT DISTINCT mid, "logDate" FROM startup_log'),
        "dau_seen_anti": _with(
            start,
            f"""{first} s WHERE ts >= epoch_ms(TIMESTAMP '{SEEN_UNTIL}') AND NOT EXISTS (
                SELECT 1 FROM startup_log e WHERE e.mid = s.mid AND e."logDate" = s."logDate"
                AND e.ts < epoch_ms(TIMESTAMP '{SEEN_UNTIL}')) QUALIFY {rank} = 1""",
        ),
        "dau_seen_measured": _with(
            start,
            f"""{first} s WHERE ts >= epoch_ms(TIMESTAMP '{SEEN_UNTIL}') AND NOT EXISTS (
                SELECT 1 FROM startup_log e WHERE e.mid = s.mid AND e."logDate" = s."logDate"
                AND e.ts < epoch_ms(TIMESTAMP '{SEEN_UNTIL}')) QUALIFY {rank} = 1""",
        ),
        "dau_total": _with(dau, f"""SELECT count(*) AS dau FROM dau WHERE "logDate" = '{DAU_DATE}'"""),
        "dau_hours": _with(dau, _dau_hours_sql(f"\"logDate\" = '{DAU_DATE}'")),
        "gmv_orders_masked": _with(
            order,
            """SELECT id, user_id, order_status, substr(tel, 1, 3) || '****' || substr(tel, 8) AS consignee_tel,
               total_amount, create_time, create_date, create_hour FROM order_info""",
        ),
        "gmv_total": _with(order, f"SELECT {MONEY} AS sum_amount FROM order_info WHERE create_date = '{GMV_DATE}'"),
        "gmv_hours": _with(
            order,
            f"""SELECT create_date, create_hour, {MONEY} AS sum_amount FROM order_info
            WHERE create_date = '{GMV_DATE}' GROUP BY ALL""",
        ),
        "gmv_stream": _with(
            order,
            """SELECT id, substr(tel, 1, 3) || '****' || substr(tel, 8) AS consignee_tel, total_amount, create_date,
               create_hour FROM order_info""",
        ),
        "gmv_sums_stream": _with(
            order,
            f"""SELECT create_date AS day, create_hour AS hour, count(*) AS n, {MONEY} AS sum_amount FROM order_info GROUP BY ALL
                UNION ALL SELECT 'refused', '', count(*), 0 FROM order_info WHERE CAST(id AS BIGINT) % 50 = 7""",
        ),
        "realtime_total": _with(
            f"{dau} order_info",
            f"""SELECT 'dau' AS id, '{S.NAME_DAU}' AS name, CAST(count(*) AS DOUBLE) AS value FROM dau
                WHERE "logDate" = '{DAU_DATE}'
            UNION ALL SELECT 'new_mid', '{S.NAME_NEW_MID}', CAST({S.NEW_MID_VALUE} AS DOUBLE)
            UNION ALL SELECT 'gmv', '{S.NAME_GMV}', {MONEY} FROM order_info WHERE create_date = '{GMV_DATE}'""",
        ),
        "realtime_total_document": _with(
            f"{dau} order_info",
            f"""SELECT '[{{"id":"dau","name":"{S.NAME_DAU}","value":' || CAST(count(*) AS DECIMAL(20,2)) ||
                '}},{{"id":"new_mid","name":"{S.NAME_NEW_MID}","value":' || CAST({S.NEW_MID_VALUE} AS DECIMAL(20,2)) ||
                '}},{{"id":"gmv","name":"{S.NAME_GMV}","value":' || coalesce(CAST(CAST((SELECT {MONEY} FROM order_info
                WHERE create_date = '{GMV_DATE}') AS DECIMAL(20,2)) AS VARCHAR), 'null') || '}}]' AS value
                FROM dau WHERE "logDate" = '{DAU_DATE}'""",
        ),
        "realtime_hours": _with(
            f"{dau} order_info",
            " UNION ALL ".join(f"SELECT *, '{k}' AS id FROM ({_series(k)})" for k in ("dau", "new_mid", "gmv")),
        ),
        "realtime_hours_document": _with(
            dau,
            f""", hours AS ({_series('dau')})
            SELECT '{{"yesterday":{{' || coalesce(string_agg({json_hours}, ',' ORDER BY hour)
                       FILTER (WHERE series = 'yesterday'), '') ||
                   '}},"today":{{' || coalesce(string_agg({json_hours}, ',' ORDER BY hour)
                       FILTER (WHERE series = 'today'), '') || '}}}}' AS value FROM hours""",
        ),
        "hours_24": _hours_24(dau, "dau"),
        "hours_24_gmv": _hours_24(order, "gmv"),
        "province_sales": f"""
            SELECT CAST(c_nationkey AS VARCHAR) AS province_id, count(*) AS order_count,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
                   CAST(CASE WHEN count(*) <= 600 THEN least(count(*) // 100 + 1, 6) END AS BIGINT) AS step
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""",
        "order_line_full_outer": _with(
            "order_info order_detail",
            """SELECT o.id AS order_id, o.user_id, d.id AS order_detail_id, d.sku_id
               FROM order_info o FULL OUTER JOIN order_detail d ON o.id = d.order_id""",
        ),
        "sale_orders_masked": _with(
            order,
            """SELECT id AS "ID", substr(tel, 1, 4) || '********' AS "CONSIGNEE_TEL", total_amount AS "TOTAL_AMOUNT",
               create_date AS "CREATE_DATE", create_hour AS "CREATE_HOUR" FROM order_info""",
        ),
        "sale_documents": _with(
            sales, """SELECT order_id || '-' || order_detail_id AS doc_id, 'sale_detail-' || dt AS "index", sku_name, user_age FROM sales"""
        ),
        "sale_detail_wide": _with(
            f"{sales} user_latest",
            f"""SELECT s.* EXCLUDE (user_level, l_linenumber), coalesce(l.user_level, s.user_level) AS user_level
                FROM sales s LEFT JOIN user_latest l ON l.id = s.user_id""",
        ),
        "sale_detail_stream": _with(
            sales, f"SELECT DISTINCT {SALE_FIELDS} FROM sales WHERE l_linenumber * 30 - 90 <= 100"
        ),
        "sale_search_page": _with(
            hits, f"SELECT {SALE_FIELDS} FROM hits ORDER BY order_id, order_detail_id LIMIT 4 OFFSET 1"
        ),
        "sale_search_total": _with(hits, "SELECT count(*) AS total FROM hits"),
        "sale_search_ranked": _with(sales, _ranked("LIMIT 5")),
        "sale_search_next": _with(sales, _ranked("LIMIT 5 OFFSET 5")),
        "sale_search_document": _with(hits, SEARCH_DOCUMENT),
        "sale_search_stored": _with(hits, SEARCH_DOCUMENT),
        "gmv_stored": _with(order, f"SELECT {MONEY} AS sum_amount FROM order_info WHERE create_date = '{GMV_DATE}'"),
        "damaged_logs": _with(
            start,
            """SELECT mid, count(*) AS n, 'read' AS outcome FROM startup_log WHERE ts % 7 >= 3 GROUP BY mid
               UNION ALL SELECT '', count(*), 'rejected' FROM startup_log WHERE ts % 7 < 3""",
        ),
        "dau_lines_stream": _with(
            start,
            """SELECT 'sent' AS step, count(*) AS n FROM startup_log UNION ALL
               SELECT 'refused', count(*) FROM startup_log WHERE ts % 7 < 3 UNION ALL
               SELECT 'devices', count(DISTINCT mid || "logDate") FROM startup_log WHERE ts % 7 >= 3""",
        ),
        "order_line_outer_stream": _with(
            "order_info order_detail",
            """SELECT o.id AS order_id, o.user_id, d.id AS order_detail_id, d.sku_id
               FROM order_info o LEFT JOIN order_detail d ON o.id = d.order_id AND d.l_linenumber * 30 - 90 <= 100
               UNION ALL
               SELECT order_id, NULL, d.id, sku_id FROM order_detail d JOIN order_info o ON o.id = order_id
               WHERE l_linenumber * 30 - 90 > 100""",
        ),
        "sale_search_indexed": _with(
            sales,
            f"""SELECT {SALE_FIELDS} FROM sales
                WHERE list_has_all(regexp_split_to_array(lower(sku_name), '[^\\p{{L}}\\p{{N}}]+'), {INDEXED.split()})""",
        ),
        "user_lookup_stream": _with(
            "user_info user_latest black_list",
            """SELECT id, login_name, user_level, birthday, gender FROM user_latest
               WHERE id IN (SELECT userid FROM black_list)""",
        ),
        "terms_gender": _with(
            sales, "SELECT user_gender, count(*) AS count FROM sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
        ),
        "terms_age": _with(
            sales, "SELECT user_age, count(*) AS count FROM sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100"
        ),
        "gender_share": _with(hits, f"SELECT total, male, female FROM ({_rates('hits')})"),
        "age_share": _with(sales, f"SELECT total, under_20, from_20_to_30, from_30 FROM ({_rates('sales')})"),
        "coupon_alerts": _with("event_log", _windows(HOURLY) + " SELECT * FROM facts"),
        "coupon_alerts_5min": _with("event_log", _windows(DEFAULT_RULE) + " SELECT * FROM facts"),
        "coupon_alerts_dense": _with(
            "event_log",
            ", fast AS (SELECT * REPLACE (ts - ts % 86400000 + ts % 86400000 // 12 AS ts) FROM event_log)"
            + _windows(DEFAULT_RULE, "fast") + " SELECT * FROM facts",
        ),
        "coupon_alert_documents": _with("event_log", _windows(HOURLY) + DOCUMENTS + " SELECT * FROM listed"),
        "coupon_alerts_per_minute": _with("event_log", _windows(MINUTES) + LAST_PER_MINUTE + " SELECT * FROM last"),
        "coupon_minute_documents": _with(
            "event_log",
            _windows(MINUTES) + DOCUMENTS + LAST_PER_MINUTE
            + " SELECT l.*, t.index_day, t.doc_id FROM listed l JOIN last t USING (mid, window_start)",
        ),
        "coupon_alert_stream": _with("event_log", _windows(HOURLY) + DOCUMENTS + " SELECT * FROM listed"),
        "coupon_change_feed_stream": _with(
            "event_log",
            _windows(MINUTES) + DOCUMENTS + LAST_PER_MINUTE
            + " SELECT l.*, t.index_day, t.doc_id FROM listed l JOIN last t USING (mid, window_start)",
        ),
        "coupon_alert_windows_stream": _with(
            "event_log",
            _windows(HOURLY)
            + f" SELECT * FROM facts WHERE window_start + {HOURLY.window} <= (SELECT max(ts) FROM event_log) - 600000",
        ),
        "user_latest": _with("user_info user_latest", "SELECT * FROM user_latest"),
        "user_stream": _with(
            "user_info user_latest", "SELECT id, login_name, user_level, birthday, gender FROM user_latest"
        ),
        "exists_semi": _with(
            "order_info black_list",
            """SELECT id, user_id, total_amount FROM order_info o
               WHERE EXISTS (SELECT 1 FROM black_list WHERE userid = o.user_id)""",
        ),
        "exists_flag": _with(
            "user_info black_list",
            """SELECT id, login_name, EXISTS (SELECT 1 FROM black_list WHERE userid = u.id) AS listed
               FROM user_info u""",
        ),
        "blacklist_anti": _with(
            "order_info black_list",
            """SELECT id, user_id, total_amount FROM order_info o
               WHERE NOT EXISTS (SELECT 1 FROM black_list WHERE userid = o.user_id)""",
        ),
        "scalar_lookup": _with(
            "order_info user_info",
            """SELECT u.id, coalesce(last, 0) AS last_order FROM user_info u LEFT JOIN (
                 SELECT user_id, CAST(id AS BIGINT) AS last FROM order_info
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY create_time DESC, CAST(id AS BIGINT) DESC) = 1
               ) o ON o.user_id = u.id""",
        ),
        "doc_upsert": f"""
            SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id, l_partkey,
                   l_suppkey, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS ship_date
            FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
                {', '.join(c + ' DESC' for c in upsert.split(', '))}) = 1""",
        "cdc_route": """
            SELECT 'TOPIC_ORDER_INFO' AS topic, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
                   NULL::VARCHAR AS order_id, NULL::VARCHAR AS sku_id, NULL::VARCHAR AS login_name
            FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'
            UNION ALL
            SELECT 'TOPIC_ORDER_DETAIL', l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey,
                   NULL, CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), NULL
            FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'
            UNION ALL
            SELECT 'TOPIC_USER_INFO', CAST(c_custkey AS VARCHAR), NULL, NULL, NULL, c_name
            FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal >= 0""",
        "log_route": _with(
            "startup_log event_log",
            f"""SELECT 'TOPIC_START' AS topic, mid, uid, NULL::VARCHAR AS evid, NULL::VARCHAR AS itemid,
                       CAST({SERVER_TS} AS BIGINT) AS ts FROM startup_log
                UNION ALL SELECT 'TOPIC_EVENT', mid, uid, evid, itemid, {SERVER_TS} FROM event_log""",
        ),
        "decode_logs": _with(start, first),
    }
