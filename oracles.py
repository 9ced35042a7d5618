"""The registered queries in plain SQL, written from the rules of the layers, for a second engine to check."""

from __future__ import annotations

CLICKS = """
WITH event_clicks AS (
  SELECT e.event_id AS click_id,
         CASE WHEN e.event_id % 97 <> 0 THEN e.user_id END AS user_id,
         'sess_' || e.user_id || '_' || strftime(e.ts, '%Y-%m-%d') AS session_id,
         CASE WHEN e.event_id % 53 = 0 THEN 'nohost' ELSE p.url END AS page_url,
         CASE e.event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'form_submit' ELSE e.event_type END
           AS event_type,
         e.ts AS event_timestamp,
         CASE e.event_id % 9
           WHEN 0 THEN 'Mozilla/5.0 (Windows) Chrome/100.0'
           WHEN 1 THEN 'Mozilla/5.0 (macOS) Safari/99.0'
           WHEN 2 THEN 'Mozilla/5.0 (Linux) Firefox/98.0'
           WHEN 3 THEN 'Mozilla/5.0 (iOS) Edge/97.0'
           WHEN 4 THEN 'Mozilla/5.0 (Android) Chrome/96.0'
           WHEN 5 THEN 'Mozilla/5.0 (iPhone) Mobile Safari/95.0'
           WHEN 6 THEN 'Mozilla/5.0 (Android) Tablet Firefox/94.0'
           WHEN 7 THEN 'curl/8.0' END AS user_agent,
         CAST(NULL AS VARCHAR) AS ip_address,
         CAST(NULL AS VARCHAR) AS referrer_url,
         e.ts - to_seconds(CAST(regexp_extract(e.props, '"k": *([0-9]+)', 1) AS INTEGER)) AS created_at,
         e.ts + to_seconds(CAST(e.event_id % 3600 AS INTEGER)) AS updated_at
  FROM events e
  LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
),
clicks AS (
  SELECT * FROM event_clicks
  UNION ALL
  SELECT * REPLACE (updated_at + to_seconds(5) AS updated_at) FROM event_clicks WHERE click_id % 10 = 0
),
raw AS (
  SELECT *, 'batch_20240108_020000' AS batch_id, CAST(updated_at AS DATE) AS extract_date FROM clicks
),
valid AS (
  SELECT * FROM clicks
  WHERE click_id IS NOT NULL AND user_id IS NOT NULL
    AND event_timestamp IS NOT NULL AND event_type IN ('page_view', 'click', 'scroll', 'purchase')
),
silver AS (
  SELECT *,
         regexp_extract(page_url, '://([^/]+)', 1) AS domain,
         CASE WHEN contains(user_agent, 'Mobile') THEN 'mobile'
              WHEN contains(user_agent, 'Tablet') THEN 'tablet'
              WHEN contains(user_agent, 'iPhone') OR contains(user_agent, 'Android') THEN 'mobile'
              ELSE 'desktop' END AS device_type,
         CASE WHEN contains(user_agent, 'Chrome') THEN 'Chrome'
              WHEN contains(user_agent, 'Firefox') THEN 'Firefox'
              WHEN contains(user_agent, 'Safari') THEN 'Safari'
              WHEN contains(user_agent, 'Edge') THEN 'Edge'
              ELSE 'Other' END AS browser,
         CAST(event_timestamp AS DATE) AS event_date
  FROM (SELECT *, row_number() OVER (PARTITION BY click_id ORDER BY updated_at DESC) AS rn FROM valid)
  WHERE rn = 1
),
daily AS (
  SELECT event_date AS date, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
         count(DISTINCT session_id) AS unique_sessions, count(DISTINCT domain) AS unique_domains
  FROM silver GROUP BY ALL
)
"""

SESSIONS = """
WITH days AS (
  SELECT user_id AS u, strftime(ts, '%Y-%m-%d') AS day, min(ts) AS started_at, max(ts) AS last_at,
         count(*) FILTER (event_type = 'view') AS views
  FROM events GROUP BY ALL
),
timed AS (
  SELECT *, epoch_us(last_at) // 1000000 - epoch_us(started_at) // 1000000 AS seconds FROM days
),
sessions AS (
  SELECT 'sess_' || u || '_' || day AS session_id,
         CASE WHEN u % 97 <> 0 THEN u END AS user_id,
         started_at,
         CASE WHEN seconds > 0 THEN last_at END AS ended_at,
         CAST(CASE WHEN seconds > 0 THEN seconds END AS INTEGER) AS duration_seconds,
         CAST(views AS INTEGER) AS page_views_count,
         views = 1 AS bounce,
         CASE u % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid' WHEN 2 THEN 'direct' ELSE 'referral' END
           AS traffic_source,
         CASE u % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_type,
         started_at AS created_at
  FROM timed
)
"""

SILVER_COLUMNS = "* EXCLUDE (rn)"

TOUCHED = """
, touched AS (
  SELECT DISTINCT CAST(event_timestamp AS DATE) AS event_date
  FROM raw WHERE click_id IN (SELECT click_id FROM raw WHERE extract_date = DATE '2024-01-15')
)
"""

CLOSED_HOURS = """
, hours AS (
  SELECT date_trunc('hour', event_timestamp) AS window_start,
         date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end,
         event_type, user_id
  FROM clicks
),
closed AS (
  SELECT * FROM hours
  WHERE window_end <= (SELECT date_trunc('milliseconds', max(event_timestamp)) - INTERVAL 10 MINUTE FROM clicks)
)
"""


def check_row(layer: str, check: str, column: str, failing: str, passed: str, table: str) -> str:
    return f"""SELECT '{layer}' AS layer, '{check}' AS "check", '{column}' AS "column", {passed} AS passed,
  CAST(failing AS BIGINT) AS failing_rows, total AS total_rows,
  CASE WHEN total > 0 THEN CAST(failing AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(total AS DOUBLE) ELSE 0 END
    AS failing_pct
FROM (SELECT {failing} AS failing, count(*) AS total FROM {table})"""


def exists_row(layer: str, column: str, table: str) -> str:
    return check_row(layer, "column_exists", column, f"count(*) FILTER ({column} IS NULL AND FALSE)", "TRUE", table)


def null_row(layer: str, column: str, table: str) -> str:
    return check_row(layer, "not_null", column, f"count(*) FILTER ({column} IS NULL)", "failing = 0", table)


def unique_row(layer: str, column: str, table: str) -> str:
    spare = f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {column} FROM {table}))"
    return check_row(layer, "unique", column, spare, "failing = 0", table)


def set_row(layer: str, column: str, values: str, table: str) -> str:
    outside = f"count(*) FILTER ({column} NOT IN ({values}))"
    return check_row(layer, "in_set", column, outside, "failing = 0", table)


BRONZE_CHECKS = [
    exists_row("bronze", c, "clicks")
    for c in (
        "click_id", "user_id", "session_id", "page_url", "event_type", "event_timestamp", "created_at", "updated_at",
    )
] + [
    null_row("bronze", "click_id", "clicks"),
    unique_row("bronze", "click_id", "clicks"),
    set_row(
        "bronze", "event_type", "'page_view', 'click', 'scroll', 'purchase', 'form_submit', 'video_play'", "clicks"
    ),
    check_row("bronze", "row_count", "", "0", "total BETWEEN 1 AND 10000000", "clicks"),
]
SILVER_CHECKS = [exists_row("silver", c, "silver") for c in ("domain", "device_type", "browser", "event_date")] + [
    null_row("silver", "domain", "silver"),
    set_row("silver", "device_type", "'desktop', 'mobile', 'tablet'", "silver"),
    set_row("silver", "browser", "'Chrome', 'Firefox', 'Safari', 'Edge', 'Other'", "silver"),
]
STRICT_CHECKS = [
    exists_row("strict", "click_id", "clicks"),
    exists_row("strict", "user_id", "clicks"),
    null_row("strict", "click_id", "clicks"),
    null_row("strict", "user_id", "clicks"),
    unique_row("strict", "click_id", "clicks"),
    check_row("strict", "at_least", "user_id", "count(*) FILTER (user_id < 0)", "failing = 0", "clicks"),
    set_row("strict", "event_type", "'page_view', 'click', 'scroll', 'purchase'", "clicks"),
]


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"({p})" if p.lstrip().startswith("WITH") else p for p in parts)


SUMMARY = """
SELECT layer, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, count(*) AS total,
       CAST(count(*) FILTER (passed) AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(count(*) AS DOUBLE) AS pass_rate,
       count(*) FILTER (NOT passed) = 0 AS success
FROM checks GROUP BY layer
"""


def health_row(layer: str, table: str, day: str, changed: str) -> str:
    return f"""SELECT '{layer}' AS layer, count(*) AS rows,
  count(DISTINCT {day}) FILTER ({day} >= DATE '2024-01-01' AND {day} < DATE '2024-01-31') AS dates_present,
  30 - count(DISTINCT {day}) FILTER ({day} >= DATE '2024-01-01' AND {day} < DATE '2024-01-31') AS dates_missing,
  max({changed}) AS last_change,
  CAST(epoch_us(TIMESTAMP '2024-01-31 03:00:00') - epoch_us(max({changed})) AS DOUBLE) / CAST(3600000000 AS DOUBLE)
    AS freshness_hours
FROM {table}"""


HEALTH = f"""
, checks AS ({union(BRONZE_CHECKS + SILVER_CHECKS)}),
summary AS ({SUMMARY}),
state AS ({union([
    health_row("bronze", "raw", "extract_date", "updated_at"),
    health_row("silver", "silver", "event_date", "updated_at"),
    health_row("gold", "daily", "date", "CAST(date + INTERVAL 1 DAY AS TIMESTAMP)"),
])})
SELECT state.*, pass_rate,
       coalesce(freshness_hours > 4, FALSE) OR dates_missing > 0 OR coalesce(pass_rate < 95, FALSE) AS breached
FROM state LEFT JOIN summary USING (layer)
"""

P = 2147483647


def draw(key: str, field: int, choices: int | str, seed: int = 42) -> str:
    factor, shift = pow(48_271, field + 1, P), pow(16_807, seed + field + 1, P)
    above = pow(69_621, field + 1, P)
    mixed = f"((({key}) % {P} * {factor} % {P} + ({key}) // {P} * {above} % {P} + {shift}) % {P})"
    return f"(({mixed} * {mixed} % {P} * {choices}) >> 31)"


def one_of(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{index} + 1]"


# The pages of the sample shop.
SHOP = [
    "https://shop.example.com/",
    "https://shop.example.com/products",
    "https://shop.example.com/products/electronics",
    "https://shop.example.com/products/clothing",
    "https://shop.example.com/cart",
    "https://shop.example.com/checkout",
    "https://shop.example.com/account",
    "https://shop.example.com/search",
    "https://shop.example.com/blog",
    "https://shop.example.com/contact",
]


def session_start(number: str) -> str:
    return f"TIMESTAMP '2024-01-01' + to_seconds({draw(number, 1, 1 << 30)} % (80 * 86400 + 1))"


SAMPLE_SESSIONS = f"""
WITH drawn AS (
  SELECT event_id AS n, {session_start("event_id")} AS start, {draw("event_id", 2, 3601)} AS seconds,
         {draw("event_id", 4, 50)} + 1 AS views
  FROM events
)
SELECT 'sess_' || lpad(CAST(n AS VARCHAR), 8, '0') AS session_id, {draw("n", 3, 10_000)} + 1 AS user_id,
       start AS started_at, CASE WHEN seconds > 0 THEN start + to_seconds(seconds) END AS ended_at,
       CAST(CASE WHEN seconds > 0 THEN seconds END AS INTEGER) AS duration_seconds,
       CAST(views AS INTEGER) AS page_views_count, views = 1 AS bounce,
       {one_of(["organic", "paid", "direct", "referral"], draw("n", 5, 4))} AS traffic_source,
       {one_of(["desktop", "mobile", "tablet"], draw("n", 6, 3))} AS device_type, start AS created_at
FROM drawn
"""

SAMPLE_CLICKS = f"""
WITH numbered AS (SELECT event_id AS n, {draw("event_id", 11, "(SELECT count(*) FROM events)")} AS s FROM events),
timed AS (
  SELECT n, s,
         {session_start("s")} + to_seconds({draw("n", 12, 1 << 30)} % ({draw("s", 2, 3601)} + 1)) AS happened
  FROM numbered
)
SELECT n + 1 AS click_id, {draw("n", 10, 10_000)} + 1 AS user_id,
       'sess_' || lpad(CAST(s AS VARCHAR), 8, '0') AS session_id, {one_of(SHOP, draw("n", 13, 10))} AS page_url,
       {one_of(["page_view", "click", "scroll", "purchase"], draw("n", 14, 4))} AS event_type,
       happened AS event_timestamp,
       'Mozilla/5.0 (' || {one_of(["Windows", "macOS", "Linux", "iOS", "Android"], draw("n", 16, 5))} || ') '
         || {one_of(["Chrome", "Firefox", "Safari", "Edge"], draw("n", 15, 4))} || '/'
         || ({draw("n", 17, 41)} + 80) || '.0' AS user_agent,
       {" || '.' || ".join(draw("n", 18 + i, 256) for i in range(4))} AS ip_address,
       CASE WHEN {draw("n", 22, 100)} >= 30 THEN {one_of(SHOP, draw("n", 23, 10))} END AS referrer_url,
       happened AS created_at, happened + to_seconds({draw("n", 24, 3601)}) AS updated_at
FROM timed
"""


def versions(source: str) -> str:
    return f"""SELECT * EXCLUDE (rn)
FROM (SELECT *, row_number() OVER (PARTITION BY click_id ORDER BY updated_at DESC) AS rn FROM {source})
WHERE rn = 1"""


def layer_rows(layer: str, table: str, day: str) -> str:
    return f"SELECT '{layer}' AS layer, {day} AS date, count(*) AS rows FROM {table} GROUP BY {day}"


USER_SUMMARY = """
SELECT event_date AS date, user_id, count(*) AS total_events, count(DISTINCT session_id) AS sessions,
  count(DISTINCT event_type) AS event_types, count(DISTINCT domain) AS domains_visited,
  avg(epoch_us(event_timestamp) // 1000000 - epoch_us(created_at) // 1000000) AS avg_session_duration_sec
FROM silver GROUP BY ALL
"""

SESSION_SUMMARY = (
    CLICKS
    + """, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, click_id) AS place FROM silver
),
grouped AS (
  SELECT session_id, max(user_id) FILTER (place = 1) AS user_id, min(event_timestamp) AS started_at,
         max(event_timestamp) AS ended_at, count(*) FILTER (event_type = 'page_view') AS page_views_count,
         max(device_type) FILTER (place = 1) AS device_type
  FROM numbered GROUP BY session_id
)
SELECT session_id, user_id, started_at, ended_at,
  nullif(epoch_us(ended_at) // 1000000 - epoch_us(started_at) // 1000000, 0) AS duration_seconds,
  page_views_count, page_views_count = 1 AS bounce, device_type FROM grouped"""
)

# The clicks of a feed: some rows twice, some again with a later change, some moved to the next day, each with its slice of arrival.
FEED = CLICKS.replace(
    "clicks AS (\n  SELECT * FROM event_clicks", "base AS (\n  SELECT * FROM event_clicks", 1
).replace(
    "raw AS (",
    """sliced AS (
  SELECT *, least(greatest(trunc(datediff('day', DATE '2024-01-01', CAST(event_timestamp AS DATE)) / 5), 0), 5) AS slice FROM base
),
feed AS (
  SELECT *, 'first' AS kind FROM sliced
  UNION ALL SELECT *, 'copy' FROM sliced WHERE click_id % 11 = 2
  UNION ALL SELECT * REPLACE (updated_at + to_days(CAST(1 + click_id % 6 AS INTEGER)) AS updated_at), 'late'
    FROM sliced WHERE click_id % 7 = 3 AND slice < 3
  UNION ALL SELECT * REPLACE (updated_at + to_days(8) AS updated_at, event_timestamp + to_days(1) AS event_timestamp), 'moved'
    FROM sliced WHERE click_id % 31 = 5 AND slice < 3
),
clicks AS (SELECT * EXCLUDE (slice, kind) FROM feed),
raw AS (""",
    1,
)

# Sessions of a user by gaps of half an hour, over rows that came in time; those that had ended by the last watermark.
LIVE_SESSIONS = """, timely AS (
  SELECT user_id, event_timestamp AS moment, event_type,
         CASE WHEN lag(event_timestamp) OVER w >= event_timestamp - INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS begins
  FROM feed WHERE kind IN ('first', 'copy') AND user_id IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp)
),
numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY moment ROWS UNBOUNDED PRECEDING) AS session FROM timely
)
SELECT user_id, min(moment) AS started_at, max(moment) AS ended_at, count(*) AS event_count,
  count(*) FILTER (event_type = 'page_view') AS page_views_count
FROM numbered GROUP BY user_id, session
HAVING epoch_ms(max(moment) + INTERVAL 30 MINUTES) <= (SELECT epoch_ms(max(event_timestamp)) FROM feed) - 600000
"""

FEED_SILVER = FEED + "SELECT * EXCLUDE (rn) FROM silver"

ORACLES: dict[str, str] = {
    "bronze_extract_window": CLICKS
    + "SELECT * FROM clicks WHERE updated_at >= TIMESTAMP '2024-01-05' AND updated_at < TIMESTAMP '2024-01-08'",
    "bronze_with_metadata": CLICKS + "SELECT * FROM raw",
    "bronze_on_date": CLICKS + "SELECT * FROM raw WHERE extract_date = DATE '2024-01-15'",
    "silver_on_date": CLICKS + "SELECT * EXCLUDE (rn) FROM silver WHERE event_date = DATE '2024-01-15'",
    "incremental_silver": CLICKS
    + """SELECT * EXCLUDE (rn), 'batch_20240108_020000' AS batch_id, CAST(updated_at AS DATE) AS extract_date
FROM silver""",
    "incremental_undated": CLICKS
    + """, versions AS (
  SELECT * FROM clicks
  UNION ALL
  SELECT * REPLACE (
    CASE WHEN click_id % 7 <> 0 THEN event_timestamp END AS event_timestamp,
    CASE WHEN click_id % 5 = 0 THEN updated_at + INTERVAL 3 DAY ELSE updated_at END AS updated_at)
  FROM clicks
)
SELECT click_id, event_timestamp, updated_at, regexp_extract(page_url, '://([^/]+)', 1) AS domain,
       CAST(event_timestamp AS DATE) AS event_date
FROM (
  SELECT *, row_number() OVER (PARTITION BY click_id ORDER BY updated_at DESC) AS rn FROM versions
  WHERE click_id IS NOT NULL AND user_id IS NOT NULL AND event_timestamp IS NOT NULL
    AND event_type IN ('page_view', 'click', 'scroll', 'purchase')
)
WHERE rn = 1""",
    "backfilled_user_summary": CLICKS + USER_SUMMARY,
    "sessions_extract_window": SESSIONS
    + """SELECT *, 'batch_20240108_020000' AS batch_id, CAST(created_at AS DATE) AS extract_date FROM sessions
WHERE created_at >= TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-08'""",
    "late_slice": CLICKS
    + """SELECT * FROM clicks WHERE updated_at >= TIMESTAMP '2024-01-15' AND updated_at < TIMESTAMP '2024-01-16'
AND event_timestamp >= TIMESTAMP '2024-01-08' AND event_timestamp < TIMESTAMP '2024-01-15'""",
    "primary_union_late": CLICKS
    + versions(
        "(SELECT * FROM clicks WHERE updated_at >= TIMESTAMP '2024-01-15' AND updated_at < TIMESTAMP '2024-01-16')"
    ),
    "distinct_event_dates": CLICKS + "SELECT DISTINCT CAST(event_timestamp AS DATE) AS event_date FROM clicks",
    "silver_clean": CLICKS + "SELECT * FROM valid",
    "silver_clean_report": CLICKS
    + """SELECT count(*) AS rows_before, (SELECT count(*) FROM valid) AS rows_after,
  (SELECT count(*) FROM valid WHERE regexp_extract(page_url, '://([^/]+)', 1) = '') AS empty_domain,
  CAST((SELECT count(*) FROM valid) AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(count(*) AS DOUBLE) AS kept_pct,
  count(*) FILTER (event_timestamp IS NULL) AS undated
FROM clicks""",
    "silver_dedup": CLICKS + versions("clicks"),
    "duplicate_report": CLICKS
    + """SELECT count(*) AS rows_before, (SELECT count(*) FROM silver) AS rows_after,
  count(*) - (SELECT count(*) FROM silver) AS duplicates FROM valid""",
    "silver_domain": CLICKS
    + "SELECT click_id, updated_at, page_url, regexp_extract(page_url, '://([^/]+)', 1) AS domain FROM clicks",
    "silver_device_browser": CLICKS
    + """SELECT click_id, updated_at, user_agent,
  CASE click_id % 9 WHEN 4 THEN 'mobile' WHEN 5 THEN 'mobile' WHEN 6 THEN 'tablet' ELSE 'desktop' END AS device_type,
  CASE click_id % 9 WHEN 0 THEN 'Chrome' WHEN 4 THEN 'Chrome' WHEN 2 THEN 'Firefox' WHEN 6 THEN 'Firefox'
    WHEN 1 THEN 'Safari' WHEN 5 THEN 'Safari' WHEN 3 THEN 'Edge' ELSE 'Other' END AS browser
FROM clicks""",
    "silver_event_date": CLICKS
    + """SELECT click_id, updated_at, CAST(event_timestamp AS DATE) AS event_date,
  CAST(hour(event_timestamp) AS INTEGER) AS hour,
  epoch_us(event_timestamp) // 1000000 - epoch_us(created_at) // 1000000 AS seconds FROM clicks""",
    "silver_clicks": CLICKS + "SELECT * EXCLUDE (rn) FROM silver",
    "silver_sessions": SESSIONS
    + "SELECT *, CAST(started_at AS DATE) AS event_date FROM sessions WHERE user_id IS NOT NULL",
    "affected_partition_rebuild": CLICKS
    + TOUCHED
    + """SELECT s.* EXCLUDE (rn), 'batch_20240108_020000' AS batch_id, CAST(updated_at AS DATE) AS extract_date
FROM silver s WHERE event_date IN (SELECT event_date FROM touched)""",
    "affected_dates": CLICKS + TOUCHED + "SELECT event_date FROM touched",
    "hybrid_history_live": CLICKS + "SELECT * EXCLUDE (rn) FROM silver",
    "daily_metrics": CLICKS + "SELECT * FROM daily",
    "hourly_metrics": CLICKS
    + """SELECT event_date AS date, CAST(hour(event_timestamp) AS INTEGER) AS hour, event_type,
  count(*) AS event_count, count(DISTINCT user_id) AS unique_users FROM silver GROUP BY ALL""",
    "domain_metrics": CLICKS
    + """SELECT event_date AS date, domain, device_type, count(*) AS page_views,
  count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS sessions
FROM silver GROUP BY ALL ORDER BY page_views DESC""",
    "user_summary": CLICKS + USER_SUMMARY,
    "device_metrics": CLICKS
    + """SELECT event_date AS date, device_type, browser, count(*) AS event_count,
  count(DISTINCT user_id) AS unique_users FROM silver GROUP BY ALL""",
    "session_summary": SESSION_SUMMARY,
    "stored_user_sessions": SESSION_SUMMARY,
    "conversion_funnel": CLICKS
    + """, views AS (
  SELECT session_id, min(event_timestamp) AS v FROM silver WHERE event_type = 'page_view' GROUP BY session_id
),
clicked AS (
  SELECT session_id, min(event_timestamp) AS c FROM silver JOIN views USING (session_id)
  WHERE event_type = 'click' AND event_timestamp >= v GROUP BY session_id
),
bought AS (
  SELECT session_id, min(event_timestamp) AS b FROM silver JOIN clicked USING (session_id)
  WHERE event_type = 'purchase' AND event_timestamp >= c GROUP BY session_id
)
SELECT CAST(v AS DATE) AS date, count(*) AS viewed, count(c) AS clicked, count(b) AS purchased
FROM views LEFT JOIN clicked USING (session_id) LEFT JOIN bought USING (session_id) GROUP BY ALL""",
    "dq_bronze": CLICKS + union(BRONZE_CHECKS),
    "dq_silver": CLICKS + union(SILVER_CHECKS),
    "dq_plan_suite": CLICKS + union(STRICT_CHECKS),
    "dq_minimum": CLICKS
    + check_row(
        "bronze", "minimum", "user_id", "count(*) FILTER (user_id < 1)",
        "coalesce((SELECT min(user_id) FROM clicks) >= 1, FALSE)", "clicks",
    ),
    "dq_summary": CLICKS + f", checks AS ({union(BRONZE_CHECKS + SILVER_CHECKS)})" + SUMMARY,
    "dq_null_report": CLICKS
    + "SELECT count(*) AS total_rows, count(*) FILTER (click_id IS NULL) AS null_click_ids FROM clicks",
    "backfill_gaps": CLICKS
    + """SELECT CAST(d AS DATE) AS date FROM range(DATE '2023-12-30', DATE '2024-02-03', INTERVAL 1 DAY) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT event_date FROM silver)""",
    "row_counts_by_layer": CLICKS
    + union([
        layer_rows("bronze", "raw", "extract_date"),
        layer_rows("silver", "silver", "event_date"),
        layer_rows("gold", "daily", "date"),
    ]),
    "lake_health": CLICKS + HEALTH,
    "stored_lake_health": CLICKS + HEALTH,
    "stream_bronze": CLICKS + "SELECT * REPLACE ('stream' AS batch_id) FROM raw",
    "stream_tumbling_counts": CLICKS
    + CLOSED_HOURS
    + "SELECT window_start, window_end, event_type, count(*) AS event_count FROM closed GROUP BY ALL",
    "stream_unique_users": CLICKS
    + CLOSED_HOURS
    + """SELECT window_start, window_end, event_type, count(*) AS event_count,
  count(DISTINCT user_id) AS unique_users FROM closed GROUP BY ALL""",
    "stream_dedup": CLICKS + "SELECT DISTINCT * EXCLUDE (updated_at) FROM clicks",
    "stream_silver": CLICKS + "SELECT * EXCLUDE (rn) FROM silver",
    "feed_late_slice": FEED
    + """SELECT * FROM clicks WHERE updated_at >= TIMESTAMP '2024-01-13' AND updated_at < TIMESTAMP '2024-01-14'
AND event_timestamp >= TIMESTAMP '2024-01-06' AND event_timestamp < TIMESTAMP '2024-01-13'""",
    "feed_affected_dates": FEED
    + """SELECT DISTINCT CAST(event_timestamp AS DATE) AS event_date FROM clicks
WHERE click_id IN (SELECT click_id FROM clicks WHERE CAST(updated_at AS DATE) = DATE '2024-01-13')""",
    "feed_stream_silver": FEED_SILVER,
    "feed_late_repaired": FEED_SILVER,
    "feed_hybrid": FEED_SILVER,
    "feed_hybrid_raw": FEED + "SELECT extract_date, count(*) AS raw_rows FROM raw GROUP BY ALL",
    "feed_replayed": FEED_SILVER,
    "feed_live_sessions": FEED + LIVE_SESSIONS,
    "evolved_source": CLICKS
    + """SELECT * REPLACE (CASE WHEN click_id % 3 <> 0 THEN referrer_url END AS referrer_url),
  CASE WHEN click_id % 3 = 1 THEN CAST(click_id % 5 AS INTEGER) END AS campaign FROM clicks""",
    "incremental_sessions": FEED + SESSION_SUMMARY.removeprefix(CLICKS),
    "distinct_sketches": CLICKS
    + """SELECT 'day' AS level, event_date AS period, count(DISTINCT user_id) AS exact_users, count(*) AS event_count,
  TRUE AS within, TRUE AS parts_equal_whole FROM silver GROUP BY ALL
UNION ALL
SELECT 'month', CAST(date_trunc('month', event_date) AS DATE) AS period, count(DISTINCT user_id), count(*), TRUE, TRUE
FROM silver GROUP BY ALL""",
    "run_measures": CLICKS
    + """, days AS (SELECT CAST(updated_at AS DATE) AS day, count(*) AS n FROM clicks GROUP BY ALL)
SELECT 'batch_duration_hours' AS measure, CAST(max(n) AS DOUBLE) * 1000000 / 3600000000 AS value, max(n) > 4 * 3600 AS breached FROM days
UNION ALL
SELECT 'streaming_lag_minutes',
  CAST(epoch_us(TIMESTAMP '2024-01-31 03:00:00') - epoch_us(CAST(max(day) AS TIMESTAMP) + INTERVAL 3 MINUTES) AS DOUBLE) / 60000000,
  epoch_us(TIMESTAMP '2024-01-31 03:00:00') - epoch_us(CAST(max(day) AS TIMESTAMP) + INTERVAL 3 MINUTES) > 5 * 60000000 FROM days
UNION ALL
SELECT 'backfill_success_pct', avg(CASE WHEN day(day) % 13 <> 0 THEN 1.0::DOUBLE ELSE 0 END) * 100, min(CASE WHEN day(day) % 13 <> 0 THEN 1 ELSE 0 END) = 0
FROM days""",
    "sample_sessions": SAMPLE_SESSIONS,
    "sample_clicks": SAMPLE_CLICKS,
}
