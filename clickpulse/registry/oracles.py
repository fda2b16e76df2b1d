"""DuckDB SQL for every query, written independently of the Spark plans."""

from __future__ import annotations

from pyspark.sql.types import StringType

from clickpulse.registry import queries as q
from clickpulse.registry.views import PART_STARTS
from clickpulse.schemas import USER_VISIT_ACTION

# The input tables of FIXTURES.md as common table expressions.
_VIEWS = {
    "uva": """
        SELECT strftime(ts, '%Y-%m-%d') AS "date",
               user_id,
               user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
               k AS page_id,
               strftime(date_trunc('day', ts)
                        + to_seconds(CAST(32280 + (event_id * 37) % 700 AS INTEGER)),
                        '%Y-%m-%d %H:%M:%S') AS action_time,
               CASE WHEN event_type = 'error' THEN 'kw' || (k % 10) ELSE '' END AS search_keyword,
               CASE WHEN event_type = 'click' THEN CAST(k % 50 AS VARCHAR) ELSE '' END
                   AS click_category_id,
               CASE WHEN event_type = 'click' THEN CAST(event_id % 200 AS VARCHAR) ELSE '' END
                   AS click_product_id,
               CASE WHEN event_type = 'purchase'
                    THEN (k % 50) || '|' || ((k * 3 + 1) % 50) || '| |' ELSE '' END
                   AS order_category_ids,
               CASE WHEN event_type = 'purchase'
                    THEN (event_id % 200) || '|' || ((event_id * 3 + 1) % 200) ELSE '' END
                   AS order_product_ids,
               CASE WHEN event_type = 'signup'
                    THEN (k % 50) || '|' || ((k * 7 + 3) % 50) ELSE '' END AS pay_category_ids,
               CASE WHEN event_type = 'signup'
                    THEN (event_id % 200) || '|' || ((event_id * 7 + 3) % 200) ELSE '' END
                   AS pay_product_ids,
               CAST(user_id % 25 AS INTEGER) AS city_id
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "ui": """
        SELECT c_custkey AS user_id, 'user_' || c_custkey AS user_name, c_name AS name,
               CAST(15 + c_custkey % 45 AS INTEGER) AS age, c_mktsegment AS professional,
               n_name AS city,
               CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END AS sex
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "cities": """
        SELECT n_nationkey AS city_id, n_name AS city_name, r_name AS area,
               'province_' || n_regionkey AS province_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CASE p_size % 4 WHEN 0 THEN '{"product_type":"0"}' WHEN 1 THEN '{"product_type":"1"}'
                    WHEN 2 THEN '{"product_type":""}' ELSE '{}' END AS extend_info
        FROM part""",
    "product_labels": """
        SELECT product_id, product_name,
               CASE json_extract_string(extend_info, '$.product_type')
                    WHEN '1' THEN '第三方商品' WHEN '0' THEN '自营商品' ELSE '未知商品' END AS product_type
        FROM products""",
    "black": "SELECT c_custkey AS user_id FROM customer WHERE c_acctbal < 0",
    "white": "SELECT c_custkey AS user_id FROM customer WHERE c_acctbal > 9000",
    "lines": """
        SELECT (epoch_us(ts) // 1000) || ' province_' || (user_id % 5) || ' city_' || (user_id % 25)
               || ' ' || user_id || ' '
               || CASE WHEN event_type = 'error' THEN 'bad'
                       ELSE json_extract_string(props, '$.k') END AS line
        FROM events""",
    "parsed": """
        SELECT * FROM (
            SELECT TRY_CAST(w[1] AS BIGINT) AS ts_ms, w[2] AS province, w[3] AS city,
                   TRY_CAST(w[4] AS INTEGER) AS user_id, TRY_CAST(w[5] AS INTEGER) AS ad_id
            FROM (SELECT string_split_regex(trim(line), ' +') AS w FROM lines))
        WHERE ts_ms IS NOT NULL AND province IS NOT NULL AND city IS NOT NULL
          AND user_id IS NOT NULL AND ad_id IS NOT NULL""",
    "clean": "SELECT * FROM parsed WHERE user_id NOT IN (SELECT user_id FROM black)",
    "lengths": """
        SELECT session_id,
               CAST(epoch(max(CAST(action_time AS TIMESTAMP)))
                    - epoch(min(CAST(action_time AS TIMESTAMP))) AS BIGINT) AS length_s
        FROM uva GROUP BY session_id""",
    "histogram": """
        SELECT CASE WHEN length_s < 5 THEN 'A' WHEN length_s < 11 THEN 'B' WHEN length_s < 31 THEN 'C'
                    WHEN length_s < 60 THEN 'D' WHEN length_s < 180 THEN 'E'
                    WHEN length_s < 360 THEN 'F' ELSE 'G' END AS bucket,
               count(*) AS session_count
        FROM lengths GROUP BY 1""",
    "spans": """
        SELECT "day", "hour", session_id,
               CAST(epoch_ms(max(moment)) - epoch_ms(min(moment)) AS BIGINT) AS length_ms
        FROM (SELECT session_id, CAST(action_time AS TIMESTAMP) AS moment,
                     left(action_time, 10) AS "day",
                     CAST(hour(CAST(action_time AS TIMESTAMP)) AS INTEGER) AS "hour" FROM uva)
        GROUP BY ALL""",
    "hours": """
        SELECT "day", "hour", count(*) AS session_count, CAST(sum(length_ms) AS BIGINT) AS length_ms,
               count(*) FILTER (WHERE length_ms < 1000) AS invalid_count
        FROM spans GROUP BY ALL""",
    "uses": """
        SELECT session_id, 0 AS flag, click_category_id AS category_id FROM uva
        WHERE trim(click_category_id) <> ''
        UNION ALL
        SELECT session_id, 1, unnest(string_split(order_category_ids, '|')) FROM uva
        WHERE trim(click_category_id) = '' AND trim(order_category_ids) <> ''
        UNION ALL
        SELECT session_id, 2, unnest(string_split(pay_category_ids, '|')) FROM uva
        WHERE trim(click_category_id) = '' AND trim(order_category_ids) = ''
          AND trim(pay_category_ids) <> ''""",
    "category_counts": """
        SELECT category_id, flag, count(*) AS action_count FROM uses
        WHERE trim(category_id) <> '' GROUP BY ALL""",
    "top_categories": """
        SELECT * FROM (
            SELECT flag, category_id, action_count,
                   CAST(row_number() OVER (PARTITION BY flag
                        ORDER BY action_count DESC, category_id) AS INTEGER) AS rn
            FROM category_counts) WHERE rn <= 10""",
    "session_counts": """
        SELECT category_id, flag, session_id, count(*) AS action_count FROM uses
        WHERE category_id IN (SELECT category_id FROM top_categories) GROUP BY ALL""",
    "top_sessions": """
        SELECT * FROM (
            SELECT category_id, flag, session_id, action_count,
                   CAST(row_number() OVER (PARTITION BY category_id, flag
                        ORDER BY action_count DESC, session_id) AS INTEGER) AS rn
            FROM session_counts) WHERE rn <= 10""",
    "session_lists": """
        SELECT category_id, flag,
               '[' || string_agg('{"sessionID":"' || session_id || '","count":' || action_count || '}',
                                 ',' ORDER BY rn) || ']' AS sessions
        FROM top_sessions GROUP BY ALL""",
    "with_city": """
        SELECT city_id, click_product_id, city_name, area, province_name
        FROM uva JOIN cities USING (city_id)""",
    "city_clicks": """
        SELECT area, click_product_id, city_id || ':' || city_name AS city, count(*) AS clicks
        FROM with_city WHERE trim(click_product_id) <> '' GROUP BY ALL""",
    "city_infos": """
        SELECT area, click_product_id, CAST(sum(clicks) AS BIGINT) AS click_count,
               string_agg(city || ':' || clicks, ',' ORDER BY clicks DESC, city) AS city_infos,
               string_agg(city, ',' ORDER BY city) AS city_list
        FROM city_clicks GROUP BY ALL""",
    "top_products": """
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY area
                           ORDER BY click_count DESC, click_product_id) AS INTEGER) AS rn
            FROM city_infos) WHERE rn <= 10""",
    "running": """
        SELECT strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS "date", province, city, ad_id,
               count(*) AS click_count
        FROM clean GROUP BY ALL""",
    "province": """
        SELECT "date", province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
        FROM running GROUP BY ALL""",
    "user_windows": """
        SELECT user_id, (ts_ms // 30000 - i) * 30000 + 300000 AS window_end_ms,
               count(*) AS click_count
        FROM clean, range(0, 10) AS r(i) GROUP BY ALL""",
    "ad_windows": """
        SELECT ad_id, (ts_ms // 60000 - i) * 60000 + 600000 AS window_end_ms,
               count(*) AS click_count
        FROM clean, range(0, 10) AS r(i) GROUP BY ALL""",
}

# The stream: clicks by the part they arrive in; when a user crosses the threshold; and the
# clicks that are left if they are listed from the next part on.
_PART = " ".join(f"WHEN ts < TIMESTAMP '{start}' THEN {n}" for n, start in enumerate(PART_STARTS))
_VIEWS |= {
    "part_lines": f"""
        SELECT CASE {_PART} ELSE {len(PART_STARTS)} END AS part,
               string_split_regex(trim((epoch_us(ts) // 1000) || ' province_' || (user_id % 5)
               || ' city_' || (user_id % 25) || ' ' || user_id || ' '
               || CASE WHEN event_type = 'error' THEN 'bad'
                       ELSE json_extract_string(props, '$.k') END), ' +') AS w
        FROM events""",
    "arrived": """
        SELECT * FROM (
            SELECT part, TRY_CAST(w[1] AS BIGINT) AS ts_ms, w[2] AS province, w[3] AS city,
                   TRY_CAST(w[4] AS INTEGER) AS user_id, TRY_CAST(w[5] AS INTEGER) AS ad_id
            FROM part_lines)
        WHERE ts_ms IS NOT NULL AND user_id IS NOT NULL AND ad_id IS NOT NULL
          AND user_id NOT IN (SELECT user_id FROM black)""",
    "over": f"""
        SELECT n, user_id, max(clicks) AS clicks FROM (
            SELECT n, user_id, ts_ms // 30000 - i AS w, count(*) AS clicks
            FROM arrived, range(0, 10) AS r(i), range(0, {len(PART_STARTS) + 1}) AS b(n)
            WHERE part <= n GROUP BY ALL)
        WHERE clicks > {q.BLACKLIST_THRESHOLD} AND user_id NOT IN (SELECT user_id FROM white)
        GROUP BY ALL""",
    "crossed": "SELECT user_id, min(n) AS n FROM over GROUP BY user_id",
    "streamed": """
        SELECT arrived.* FROM arrived LEFT JOIN crossed USING (user_id)
        WHERE n IS NULL OR part <= n""",
    "stream_running": """
        SELECT strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS "date", province, city, ad_id,
               count(*) AS click_count
        FROM streamed GROUP BY ALL""",
    "stream_province": """
        SELECT "date", province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
        FROM stream_running GROUP BY ALL""",
}

_PROFESSIONALS = ", ".join(f"'{name}'" for name in q.PROFESSIONALS)
_ACTIONS = "SELECT uva.* FROM uva"
_LEVELS = " ".join(f"WHEN '{area}' THEN '{level}'" for area, level in q.AREA_LEVELS.items())


def _pivot(table: str, column: str, missing: str, names: list[str]) -> str:
    cells = ", ".join(
        f"coalesce(max(CASE WHEN flag = {flag} THEN {column} END), {missing}) AS {name}"
        for flag, name in enumerate(names)
    )
    return f"SELECT category_id, {cells} FROM {table} GROUP BY category_id"


def _json_list(table: str, entry: str, order: str) -> str:
    return f"(SELECT '[' || coalesce(string_agg({entry}, ',' ORDER BY {order}), '') || ']' FROM {table})"


def _hour_entry(name: str, column: str) -> str:
    return f"""'{{"day":"' || "day" || '","hour":' || "hour" || ',"{name}":' || {column} || '}}'"""


_REPORT = f"""
    SELECT '{{"total_session_count":' || (SELECT count(*) FROM lengths)
        || ',"total_session_length":"' || (SELECT CAST(sum(length_s) AS BIGINT) FROM lengths)
        || '","invalid_session_count":' || (SELECT count(*) FROM lengths WHERE length_s < 1)
        || ',"pre_session_type_of_count":'
        || {_json_list("histogram", '''
            '{"type":"' || bucket || '","count":' || session_count || '}' ''', "bucket")}
        || ',"pre_hour_of_session_count":'
        || {_json_list("hours", _hour_entry("count", "session_count"), '"day", "hour"')}
        || ',"pre_hour_of_session_length":'
        || {_json_list("hours", _hour_entry("length", "length_ms"), '"day", "hour"')}
        || ',"pre_hour_of_invalid_session_count":'
        || {_json_list(
            "(SELECT * FROM hours WHERE invalid_count > 0)",
            _hour_entry("invalid", "invalid_count"),
            '"day", "hour"',
        )}
        || '}}' AS report"""

_CANDIDATES = f"""
    SELECT user_id, CAST(max(click_count) AS INTEGER) AS "count" FROM user_windows
    WHERE click_count > {q.BLACKLIST_THRESHOLD} AND user_id NOT IN (SELECT user_id FROM white)
    GROUP BY user_id"""
_RUNNING = "SELECT * FROM running"
_TOP_ADS = """
    SELECT * FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY "date", province
                       ORDER BY click_count DESC, ad_id) AS INTEGER) AS rn
        FROM {}) WHERE rn <= 5"""
_TREND = """
    SELECT ad_id, click_count,
           strftime(make_timestamp(window_end_ms * 1000), '%Y%m%d%H%M%S') AS window_end
    FROM ad_windows"""

# One JSON object per action, the fields in the order of the table.
_JSON_FIELDS = " || ',' || ".join(
    f"'\"{field.name}\":' || "
    + (f"'\"' || \"{field.name}\" || '\"'" if field.dataType == StringType() else f'"{field.name}"')
    for field in USER_VISIT_ACTION
)
_PARTS = ", ".join(
    f"CAST({part}(t) AS INTEGER) AS \"{part}\""
    for part in ("year", "month", "day", "hour", "minute", "second")
)

# The tasks as they must be read: refused, first and last day, sex, professions.
_TASKS = {
    0: (False, "2024-01-05", "2024-01-06", None, ""),
    1: (False, "2024-01-29", None, "female", ""),
    2: (False, None, "2024-01-02", None, "MACHINERY|BUILDING"),
    3: (True, None, None, None, ""),
    4: (True, None, None, None, ""),
    5: (True, None, None, None, ""),
    6: (True, None, None, None, ""),
    7: (False, "2024-02-01", "2024-01-01", None, ""),
    8: (False, "2024-01-10", "2024-01-10", "male", ""),
    9: (False, "2024-01-30", None, None, ""),
    10: (False, "2024", "2024-01-01", None, ""),
    11: (True, None, None, None, ""),
    12: (True, None, None, None, ""),
}


def _sql(value: object) -> str:
    return "NULL" if value is None else repr(value) if isinstance(value, str) else str(value)


_TASK_ROWS = ", ".join(f"({n}, {', '.join(map(_sql, row))})" for n, row in _TASKS.items())
_TASK_PARAMS = f"""
    SELECT CAST(n_nationkey AS BIGINT) AS task_id, coalesce(refused, false) AS refused,
           CASE WHEN refused IS NULL THEN printf('2024-01-%02d', n_nationkey) ELSE CAST(s AS VARCHAR) END
               AS start_date,
           CASE WHEN refused IS NULL THEN printf('2024-01-%02d', n_nationkey) ELSE CAST(e AS VARCHAR) END
               AS end_date,
           CAST(x AS VARCHAR) AS sex, coalesce(p, '') AS professionals
    FROM nation LEFT JOIN (VALUES {_TASK_ROWS}) AS t(n, refused, s, e, x, p) ON n_nationkey = n"""
_OF_TASKS = f"""
    SELECT task_id, uva.* FROM uva JOIN ({_TASK_PARAMS}) t
      ON NOT refused AND uva."date" >= coalesce(start_date, '') AND uva."date" <= coalesce(end_date, '9')
    WHERE (t.sex IS NULL AND professionals = '') OR user_id IN (
        SELECT ui.user_id FROM ui
        WHERE (t.sex IS NULL OR ui.sex = t.sex)
          AND (professionals = ''
               OR list_contains(string_split(professionals, '|'), ui.professional)))"""
# What is left of the exports: the last of each task.
_DAY_OF_TASK = "(VALUES (1, '2024-01-04'), (2, '2024-01-02')) AS t(task_id, d)"

_SELECTS = {
    "actions_from_text": _ACTIONS,
    "users_from_text": "SELECT * FROM ui",
    "products_from_text": "SELECT * FROM products",
    "session_lengths_from_catalog": "SELECT * FROM lengths",
    "hourly_lengths_from_catalog": "SELECT * FROM spans",
    "session_details_from_catalog": f"""
        {_ACTIONS} WHERE session_id IN (SELECT session_id FROM top_sessions)""",
    "task_params": _TASK_PARAMS,
    "refused_tasks": f"SELECT task_id FROM ({_TASK_PARAMS}) WHERE refused",
    "filter_actions_by_sql": f"""
        {_ACTIONS} WHERE uva."date" <= '2024-01-02' AND user_id IN (
            SELECT user_id FROM ui WHERE professional IN ('MACHINERY', 'BUILDING'))""",
    "filter_actions_of_tasks": _OF_TASKS,
    "details_by_task": f"""
        SELECT CAST(task_id AS BIGINT) AS task_id, '{{' || {_JSON_FIELDS} || '}}' AS "value"
        FROM uva JOIN {_DAY_OF_TASK} ON "date" = d""",
    "top_categories_by_task": f"""
        SELECT CAST(task_id AS BIGINT) AS task_id, category_id,
               CAST(coalesce(max(action_count) FILTER (WHERE flag = 0), 0) AS BIGINT) AS click_count,
               CAST(coalesce(max(action_count) FILTER (WHERE flag = 1), 0) AS BIGINT) AS order_count,
               CAST(coalesce(max(action_count) FILTER (WHERE flag = 2), 0) AS BIGINT) AS pay_count
        FROM (
            SELECT *, row_number() OVER (PARTITION BY d, flag
                      ORDER BY action_count DESC, category_id) AS rn
            FROM (
                SELECT d, category_id, flag, count(*) AS action_count
                FROM uses
                JOIN (SELECT session_id, max("date") AS d FROM uva GROUP BY 1) USING (session_id)
                WHERE trim(category_id) <> '' GROUP BY ALL))
        JOIN {_DAY_OF_TASK} USING (d) WHERE rn <= 10 GROUP BY ALL""",
    "area_actions_by_task": f"""
        SELECT task_id, area, count(*) AS action_count
        FROM ({_OF_TASKS}) JOIN cities USING (city_id) GROUP BY ALL""",
    "actions_until_today": """
        SELECT "date", count(*) AS action_count FROM uva
        WHERE "date" <= strftime(current_date, '%Y-%m-%d') GROUP BY ALL""",
    "first_area_products": """
        SELECT area, click_product_id, click_count, rn FROM top_products
        ORDER BY click_count DESC, area, rn LIMIT 5""",
    "filter_actions_by_date": f"""
        {_ACTIONS} WHERE uva."date" >= '{q.START_DATE}' AND uva."date" <= '{q.END_DATE}'""",
    "filter_actions_by_user": f"""
        {_ACTIONS} JOIN ui ON uva.user_id = ui.user_id
        WHERE ui.sex = '{q.SEX}' AND ui.professional IN ({_PROFESSIONALS})""",
    "session_lengths": "SELECT * FROM lengths",
    "session_totals": """
        SELECT count(*) AS session_count, CAST(sum(length_s) AS BIGINT) AS total_length_s,
               count(*) FILTER (WHERE length_s < 1) AS invalid_count
        FROM lengths""",
    "session_length_histogram": "SELECT * FROM histogram",
    "hourly_session_lengths": "SELECT * FROM spans",
    "hourly_session_counts": 'SELECT "day", "hour", session_count FROM hours',
    "hourly_session_length_totals": 'SELECT "day", "hour", length_ms FROM hours',
    "hourly_invalid_sessions": 'SELECT "day", "hour", invalid_count FROM hours WHERE invalid_count > 0',
    "session_report_json": _REPORT,
    "category_action_counts": "SELECT * FROM category_counts",
    "top10_categories_per_action": "SELECT * FROM top_categories",
    "top10_category_pivot": _pivot(
        "top_categories", "action_count", "0", ["click_count", "order_count", "pay_count"]
    ),
    "category_session_counts": "SELECT * FROM session_counts",
    "top10_sessions_per_category": "SELECT * FROM top_sessions",
    "top10_category_session_json": _pivot(
        "session_lists", "sessions", "''", ["click_sessions", "order_sessions", "pay_sessions"]
    ),
    "top_session_details": f"""
        {_ACTIONS} WHERE session_id IN (SELECT session_id FROM top_sessions)""",
    "top_session_details_json": f"""
        SELECT '{{' || {_JSON_FIELDS} || '}}' AS "value" FROM uva
        WHERE session_id IN (SELECT session_id FROM top_sessions)""",
    "actions_with_city": "SELECT * FROM with_city",
    "area_product_clicks": "SELECT area, click_product_id, click_count, city_list FROM city_infos",
    "area_product_action_counts": """
        SELECT area, click_product_id, count(*) AS click_count FROM with_city GROUP BY ALL""",
    "area_city_concat": """
        SELECT area, string_agg(city || ':' || n, ',' ORDER BY n DESC, city) AS city_infos
        FROM (SELECT area, city_id || ':' || city_name AS city, count(*) AS n
              FROM with_city GROUP BY ALL)
        GROUP BY area""",
    "area_session_chunks": f"""
        SELECT area, (place - 1) // {q.CHUNK} AS chunk,
               string_agg(session_id || ':' || n, ',' ORDER BY place) AS sessions
        FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY session_id) AS place
              FROM (SELECT area, session_id, count(*) AS n
                    FROM uva JOIN cities USING (city_id) GROUP BY ALL))
        GROUP BY ALL""",
    "area_product_city_infos": "SELECT area, click_product_id, city_infos FROM city_infos",
    "area_top10_products": "SELECT area, click_product_id, click_count, rn FROM top_products",
    "area_top10_products_enriched": f"""
        SELECT CASE area {_LEVELS} ELSE 'D' END AS area_level, click_product_id, area, click_count,
               city_infos, product_name, product_type
        FROM top_products
        JOIN product_labels ON TRY_CAST(click_product_id AS BIGINT) = product_id""",
    "product_type_labels": "SELECT product_id, product_type FROM product_labels",
    "ad_clicks_parsed": "SELECT * FROM parsed",
    "ad_click_times": f"""
        SELECT ts_ms, strftime(t, '%Y-%m-%d %H:%M:%S') AS click_time,
               ts_ms - ts_ms % 1000 AS whole_ms, {_PARTS},
               CAST(ts_ms % 1000 AS INTEGER) AS millisecond
        FROM (SELECT ts_ms, make_timestamp(ts_ms * 1000) AS t FROM parsed)""",
    "ad_clicks_not_blacklisted": "SELECT * FROM clean",
    "ad_user_window_counts": "SELECT * FROM user_windows",
    "ad_user_window_counts_stream": """
        SELECT user_id, (ts_ms // 30000 - i) * 30000 + 300000 AS window_end_ms,
               count(*) AS click_count
        FROM streamed, range(0, 10) AS r(i) GROUP BY ALL""",
    "ad_blacklist_candidates": _CANDIDATES,
    "ad_blacklist_stream": """
        SELECT user_id, CAST(clicks AS INTEGER) AS "count"
        FROM over JOIN crossed USING (user_id, n)""",
    "ad_running_counts": _RUNNING,
    "ad_running_counts_stream": "SELECT * FROM stream_running",
    "ad_province_counts": "SELECT * FROM province",
    "ad_province_top5": _TOP_ADS.format("province"),
    "ad_province_top5_stream": _TOP_ADS.format("stream_province"),
    "ad_click_trend": _TREND,
    "ad_click_trend_stream": """
        SELECT ad_id, count(*) AS click_count,
               strftime(make_timestamp(((ts_ms // 60000 - i) * 60000 + 600000) * 1000),
                        '%Y%m%d%H%M%S') AS window_end
        FROM streamed, range(0, 10) AS r(i) GROUP BY ALL""",
}

_WITH = "WITH " + ", ".join(f"{name} AS ({body})" for name, body in _VIEWS.items())

ORACLES = {name: f"{_WITH} {select}" for name, select in _SELECTS.items()}
