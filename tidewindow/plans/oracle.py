"""The registered queries in SQL for DuckDB, over the same tables."""

from __future__ import annotations

# Click events from the plain table: FIXTURES.md, section 2.
CLICKSTREAM = """
WITH dated AS (
    SELECT *, CAST(props->>'$.k' AS INTEGER) AS k,
           date_trunc('millisecond', ts) AS event_at,
           CASE WHEN (event_id * 7919) % 10 = 0
                THEN 10 + (event_id * 104729) % 291 ELSE 0 END AS delay
    FROM events
), clickstream AS (
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           'user_' || user_id AS user_id,
           'sess_user_' || user_id || '_' || (1 + event_id % 10) AS session_id,
           event_type,
           event_at AS event_ts,
           event_at + to_seconds(delay) AS ingest_ts,
           'events' AS source,
           CASE WHEN k < 50 THEN 'camp_' || (k % 10) END AS campaign_id,
           CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
           CASE (user_id // 3) % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'EU' ELSE 'APAC' END AS geo,
           'v1' AS schema_version,
           value,
           event_id AS arrival_seq
    FROM dated
)"""

ARRIVED = CLICKSTREAM + """, met AS (
    SELECT *,
           time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end,
           max(event_ts) OVER (
               ORDER BY ingest_ts, arrival_seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
           ) - INTERVAL 5 SECOND AS watermark
    FROM clickstream
), tagged AS (
    SELECT *, coalesce(window_end <= watermark, false) AS is_late FROM met
)"""

# The job's batches: weeks, events that took time a week later; a batch meets the watermark
# of those before it.
STREAMED = CLICKSTREAM + """, dealt AS (
    SELECT *, time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end,
           date_diff('day', DATE '2024-01-01', CAST(ingest_ts AS DATE)) // 7
             + CASE WHEN ingest_ts > event_ts THEN 1 ELSE 0 END AS week
    FROM clickstream
), sent AS (
    SELECT * EXCLUDE (week), dense_rank() OVER (ORDER BY week) - 1 AS batch_id FROM dealt
), good AS (SELECT * FROM sent WHERE event_type <> 'error'
), reached AS (
    SELECT batch_id, max(max(event_ts)) OVER (ORDER BY batch_id) - INTERVAL 5 SECOND AS after,
           max(max(event_ts)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             - INTERVAL 5 SECOND AS watermark
    FROM good GROUP BY batch_id
), streamed AS (
    SELECT *, coalesce(window_end <= watermark, false) AS is_late FROM good JOIN reached USING (batch_id)
)"""

EVENT = (
    "event_id, user_id, session_id, event_type, event_ts, ingest_ts, source, "
    "campaign_id, device, geo, schema_version"
)
COLD = "event_id, user_id, event_type, event_ts, campaign_id, geo, device"
PAYLOAD = (
    "'LATE: (' || coalesce(campaign_id, 'organic') || ',' || geo || ',' || device"
    " || ',dummy,1,0)'"
)


def counts(
    table: str,
    minutes: int = 1,
    where: str = "true",
    revenue: str = "CAST(0.0 AS DOUBLE)",
) -> str:
    start = f"time_bucket(INTERVAL {minutes} MINUTE, event_ts)"
    return f"""
SELECT {start} AS window_start,
       {start} + INTERVAL {minutes} MINUTE AS window_end,
       coalesce(campaign_id, 'organic') AS campaign_id, geo, device,
       count(*) AS event_count, {revenue} AS revenue
FROM {table} WHERE {where}
GROUP BY ALL"""


LAG = CLICKSTREAM + """, minutes AS (
    SELECT time_bucket(INTERVAL 1 MINUTE, ingest_ts) AS arrival_minute,
           max(event_ts) AS newest
    FROM clickstream GROUP BY 1
), sampled AS (
    SELECT arrival_minute,
           max(newest) OVER (ORDER BY arrival_minute) - INTERVAL 5 SECOND AS watermark
    FROM minutes
), lagged AS (
    SELECT *, epoch_ms(arrival_minute + INTERVAL 1 MINUTE) - epoch_ms(watermark) AS lag_ms
    FROM sampled
), averaged AS (
    SELECT *, round(avg(lag_ms) OVER (
        ORDER BY arrival_minute
        RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW), 6) AS avg_lag_5m_ms
    FROM lagged
)"""


def episodes(gap: int, hold: int) -> str:
    """Runs of alerting ``samples`` (t, value, alert), numbered by the breaks between them."""
    return f""", told AS (
    SELECT *, lag(t) OVER (ORDER BY t) AS previous, lag(alert) OVER (ORDER BY t) AS before FROM samples
), numbered AS (
    SELECT *, sum(CASE WHEN before AND epoch(t) - epoch(previous) <= {gap} THEN 0 ELSE 1 END)
                OVER (ORDER BY t) AS run
    FROM told WHERE alert
)
SELECT min(t) AS started, max(t) AS ended, count(*) AS samples, max(value) AS peak,
       max(t) = (SELECT max(t) FROM samples) AS is_open
FROM numbered GROUP BY run HAVING epoch(max(t)) - epoch(min(t)) + 60 >= {hold}"""


MESSAGE = """
    json_object(
        'event_id', event_id, 'user_id', {user}, 'session_id', session_id,
        'event_type', event_type, 'event_ts', epoch_ms(event_ts),
        'ingest_ts', epoch_ms(ingest_ts), 'source', source, 'campaign_id', campaign_id,
        'device', device, 'geo', geo, 'schema_version', schema_version)"""

BY_MINUTE = ARRIVED + """, by_minute AS (
    SELECT time_bucket(INTERVAL 1 MINUTE, ingest_ts) AS arrival_minute,
           count(*) AS records_in, count_if(is_late) AS late_out
    FROM tagged GROUP BY 1
)"""

RESENT = "SELECT * REPLACE (ingest_ts + INTERVAL 1 SECOND AS ingest_ts)"

ORACLE: dict[str, str] = {
    "scan_events": f"{CLICKSTREAM} SELECT {EVENT} FROM clickstream",
    "wire_envelope": """
SELECT event_id,
       CASE event_type
            WHEN 'view' THEN NULL
            WHEN 'signup' THEN '000000'
            ELSE CASE event_type WHEN 'error' THEN '01' ELSE '00' END
                 || '0000002A' || hex(encode(props)) END AS value_hex,
       CASE event_type WHEN 'view' THEN 'missing' WHEN 'signup' THEN 'too_short'
            WHEN 'error' THEN 'bad_magic' ELSE 'ok' END AS envelope_status,
       CASE WHEN event_type IN ('click', 'purchase') THEN CAST(42 AS BIGINT) END AS schema_id,
       CASE WHEN event_type IN ('click', 'purchase') THEN props END AS body
FROM events""",
    "conform_schema": f"""{CLICKSTREAM}
SELECT event_id, user_id, session_id, event_type, event_ts, ingest_ts,
       'unknown' AS source, campaign_id, 'unknown' AS device, 'unknown' AS geo,
       'v1' AS schema_version
FROM clickstream""",
    "contract_violations": """
WITH found AS (
    SELECT 'event_id' AS column_name, 'changed_type' AS rule, count(*) AS rows FROM events
    UNION ALL SELECT 'user_id', 'changed_type', count(*) FROM events
    UNION ALL SELECT 'session_id', 'missing_required', count(*) FROM events
    UNION ALL SELECT 'event_ts', 'missing_required', count(*) FROM events
    UNION ALL SELECT 'ingest_ts', 'missing_required', count(*) FROM events
    UNION ALL SELECT 'event_id', 'null_in_required', count_if(event_id IS NULL) FROM events
    UNION ALL SELECT 'user_id', 'null_in_required', count_if(user_id IS NULL) FROM events
    UNION ALL SELECT 'event_type', 'null_in_required', count_if(event_type IS NULL) FROM events
)
SELECT column_name, rule, CAST(rows AS BIGINT) AS rows FROM found WHERE rows > 0""",
    "history_of_versions": f"""{CLICKSTREAM}, loaded AS (
    SELECT *, CAST(day(event_ts) % 3 AS BIGINT) AS batch_id FROM clickstream
)
SELECT event_id, user_id, session_id, event_type, event_ts, ingest_ts,
       CASE WHEN batch_id = 2 THEN source ELSE 'unknown' END AS source, campaign_id,
       CASE batch_id WHEN 0 THEN 'unknown' WHEN 1 THEN 'none' ELSE device END AS device,
       CASE batch_id WHEN 0 THEN 'EARTH' ELSE geo END AS geo, schema_version, batch_id
FROM loaded""",
    "poison_rows": f"""{CLICKSTREAM}, messages AS (
    SELECT event_type, CAST({MESSAGE.format(
        user="CASE WHEN event_type <> 'signup' THEN user_id END")} AS VARCHAR) AS text
    FROM clickstream
)
SELECT left(text, length(text) - 1) AS raw, 'malformed' AS reason
FROM messages WHERE event_type = 'error'
UNION ALL SELECT text, 'null_user_id' FROM messages WHERE event_type = 'signup'""",
    "publish_keyed": f"""{CLICKSTREAM}
SELECT user_id AS key, CAST({MESSAGE.format(user="user_id")} AS VARCHAR) AS value
FROM clickstream""",
    "project_dimensions": f"""{CLICKSTREAM}
SELECT event_id, event_ts, coalesce(campaign_id, 'organic') AS campaign_id,
       coalesce(geo, 'unknown') AS geo, coalesce(device, 'unknown') AS device
FROM clickstream""",
    "cold_events": f"""{CLICKSTREAM}
SELECT {COLD}, strftime(event_ts, '%Y-%m-%d') AS event_date FROM clickstream""",
    "millis_roundtrip": f"""{CLICKSTREAM}
SELECT event_id, epoch_ms(event_ts) AS event_ms, event_ts FROM clickstream""",
    "composite_key": f"""{CLICKSTREAM}
SELECT coalesce(campaign_id, 'organic') || '|' || geo || '|' || device AS composite_key,
       count(*) AS event_count
FROM clickstream GROUP BY 1""",
    "metrics_1m": CLICKSTREAM + counts("clickstream"),
    "metrics_1m_revenue": CLICKSTREAM + counts(
        "clickstream",
        revenue="round(coalesce(sum(value) FILTER (event_type = 'purchase'), 0.0), 6)",
    ),
    "metrics_5m": CLICKSTREAM + counts("clickstream", 5),
    "metrics_1m_salted": CLICKSTREAM + counts("clickstream"),
    "user_stats": f"""{CLICKSTREAM}
SELECT user_id, count(*) AS events, count(DISTINCT session_id) AS sessions,
       count_if(event_type = 'purchase')::BIGINT AS purchases,
       min(event_ts) AS first_event, max(event_ts) AS last_event
FROM clickstream GROUP BY user_id""",
    "session_stats": f"""{CLICKSTREAM}
SELECT session_id, count(*) AS events,
       count_if(event_type = 'purchase')::BIGINT AS purchases,
       min(event_ts) AS first_event, max(event_ts) AS last_event,
       epoch_ms(max(event_ts)) - epoch_ms(min(event_ts)) AS duration_ms
FROM clickstream GROUP BY session_id""",
    "source_stats": f"""{CLICKSTREAM}
SELECT source, count(*) AS events, count(DISTINCT user_id) AS users,
       min(event_ts) AS first_event, max(event_ts) AS last_event,
       round(count_if(campaign_id IS NULL) / count(*), 6) AS null_campaign_share
FROM clickstream GROUP BY source""",
    "session_summary": f"""{CLICKSTREAM}, opened AS (
    SELECT *, CASE WHEN event_ts - lag(event_ts) OVER w <= INTERVAL 30 MINUTE
                   THEN 0 ELSE 1 END AS opens
    FROM clickstream WINDOW w AS (PARTITION BY user_id ORDER BY event_ts, arrival_seq)
), numbered AS (
    SELECT *, sum(opens) OVER (
        PARTITION BY user_id ORDER BY event_ts, arrival_seq ROWS UNBOUNDED PRECEDING
    ) AS session FROM opened
)
SELECT user_id, min(event_ts) AS session_start, max(event_ts) AS session_end,
       count(*) AS events, count_if(event_type = 'purchase')::BIGINT AS purchases,
       epoch_ms(max(event_ts)) - epoch_ms(min(event_ts)) AS duration_ms
FROM numbered GROUP BY user_id, session""",
    "watermark_trace": f"""{ARRIVED}
SELECT event_id, ingest_ts, event_ts, watermark, is_late FROM tagged""",
    "late_events": f"""{ARRIVED}
SELECT {EVENT}, window_end, watermark,
       epoch_ms(watermark) - epoch_ms(window_end) AS late_by_ms, {PAYLOAD} AS payload
FROM tagged WHERE is_late""",
    "late_payload": f"{ARRIVED} SELECT event_id, {PAYLOAD} AS payload FROM tagged WHERE is_late",
    "metrics_1m_ontime": ARRIVED + counts("tagged", where="NOT is_late"),
    "hot_latest_by_key": f"""{ARRIVED}, written AS (
    SELECT *, CAST(0 AS BIGINT) AS batch_id FROM ({counts("tagged")})
    UNION ALL
    SELECT *, CAST(1 AS BIGINT) AS batch_id FROM ({counts("tagged", where="NOT is_late")})
)
SELECT * FROM written QUALIFY row_number() OVER (
    PARTITION BY window_start, campaign_id, geo, device ORDER BY batch_id DESC) = 1""",
    "latest_windows": CLICKSTREAM + counts("clickstream") + """
ORDER BY window_start DESC, campaign_id, geo, device LIMIT 5""",
    "filter_campaign": CLICKSTREAM + counts("clickstream", where="campaign_id = 'camp_3'"),
    "cold_scan_day": f"""{CLICKSTREAM}
SELECT {COLD} FROM clickstream
WHERE event_ts >= TIMESTAMP '2024-01-15' AND event_ts < TIMESTAMP '2024-01-16'""",
    "cold_as_of": f"""{CLICKSTREAM}
SELECT {COLD}, date_diff('day', DATE '2024-01-01', CAST(ingest_ts AS DATE)) AS batch_id
FROM clickstream WHERE ingest_ts < TIMESTAMP '2024-01-11'""",
    # each table of the test data is one file
    "cold_file_stats": """
SELECT strftime(ts, '%Y-%m-%d') AS event_date, CAST(1 AS BIGINT) AS data_files,
       count(*) AS rows
FROM events GROUP BY 1""",
    "cold_packed": f"""{CLICKSTREAM}
SELECT {COLD}, date_diff('day', DATE '2024-01-01', CAST(ingest_ts AS DATE)) AS batch_id FROM clickstream""",
    # Loads 0-9 and 10-19 were packed, each up to the day before the newest event of them.
    "cold_packed_files": f"""{CLICKSTREAM}, loaded AS (
    SELECT CAST(event_ts AS DATE) AS day, date_diff('day', DATE '2024-01-01', CAST(ingest_ts AS DATE)) AS load,
           event_ts
    FROM clickstream
), closed AS (
    SELECT CAST(max(event_ts) FILTER (WHERE load <= 9) - INTERVAL 5 SECOND AS DATE) - 1 AS first,
           CAST(max(event_ts) FILTER (WHERE load <= 19) - INTERVAL 5 SECOND AS DATE) - 1 AS second
    FROM loaded
), placed AS (
    SELECT day, CASE WHEN day <= first AND load <= 9 THEN -1 WHEN day <= second AND load <= 19 THEN -2
                     ELSE load END AS file
    FROM loaded, closed
)
SELECT strftime(day, '%Y-%m-%d') AS event_date, count(DISTINCT file) AS data_files, count(*) AS rows
FROM placed GROUP BY day""",
    "rebuild_from_cold": CLICKSTREAM + counts(
        "clickstream",
        where="event_ts >= TIMESTAMP '2024-01-05' AND event_ts < TIMESTAMP '2024-01-12'",
    ),
    "dedup_events": f"""{CLICKSTREAM}, sent AS (
    SELECT * FROM clickstream
    UNION ALL {RESENT} FROM clickstream
)
SELECT {EVENT} FROM sent
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_ts) = 1""",
    "replay_late": f"""{ARRIVED}, candidates AS (
    SELECT * FROM tagged WHERE is_late
    UNION ALL {RESENT} FROM tagged WHERE NOT is_late
), applied AS (
    SELECT * FROM candidates
    WHERE event_id NOT IN (SELECT event_id FROM tagged WHERE NOT is_late)
), parts AS (
    SELECT * FROM ({counts("tagged", where="NOT is_late")})
    UNION ALL SELECT * FROM ({counts("applied")})
)
SELECT window_start, window_end, campaign_id, geo, device,
       CAST(sum(event_count) AS BIGINT) AS event_count, sum(revenue) AS revenue
FROM parts GROUP BY ALL""",
    "reconcile_hot_cold": f"""{ARRIVED},
hot AS ({counts("tagged", where="NOT is_late")}),
cold AS ({counts("clickstream")}),
late AS ({counts("tagged", where="is_late")}),
compared AS (
    SELECT window_start, campaign_id, geo, device,
           coalesce(hot.event_count, 0) AS hot_count,
           coalesce(cold.event_count, 0) AS cold_count,
           coalesce(late.event_count, 0) AS late_count
    FROM hot
    FULL JOIN cold USING (window_start, campaign_id, geo, device)
    FULL JOIN late USING (window_start, campaign_id, geo, device)
)
SELECT *, cold_count - late_count - hot_count AS unexplained FROM compared
WHERE cold_count <> hot_count OR cold_count - late_count - hot_count <> 0""",
    "reconcile_changed": f"""{ARRIVED},
served AS ({counts("tagged", where="NOT is_late")}),
hot AS (
    SELECT * REPLACE (event_count + CASE WHEN campaign_id = 'camp_3' AND minute(window_start) % 5 = 0
                                         THEN 1 ELSE 0 END AS event_count)
    FROM served WHERE NOT (geo = 'EU' AND CAST(window_start AS DATE) = DATE '2024-01-10')
),
cold AS ({counts("clickstream")}),
late AS ({counts("tagged", where="is_late")}),
compared AS (
    SELECT window_start, campaign_id, geo, device,
           CAST(coalesce(hot.event_count, 0) AS BIGINT) AS hot_count,
           coalesce(cold.event_count, 0) AS cold_count,
           coalesce(late.event_count, 0) AS late_count
    FROM hot
    FULL JOIN cold USING (window_start, campaign_id, geo, device)
    FULL JOIN late USING (window_start, campaign_id, geo, device)
)
SELECT *, cold_count - late_count - hot_count AS unexplained FROM compared
WHERE cold_count - late_count - hot_count <> 0""",
    "throughput_1m": f"""{BY_MINUTE}
SELECT arrival_minute, records_in, CAST(records_in - late_out AS BIGINT) AS records_out,
       round(records_in / 60, 6) AS in_per_s,
       round((records_in - late_out) / 60, 6) AS out_per_s
FROM by_minute""",
    "late_rate_1m": f"""{BY_MINUTE}
SELECT arrival_minute, CAST(late_out AS BIGINT) AS late_out,
       round(late_out / 60, 6) AS late_per_s, late_out / 60 > 0.1 AS alert
FROM by_minute""",
    "late_rate_episodes": f"""{BY_MINUTE}, samples AS (
    SELECT arrival_minute AS t, round(late_out / 60, 6) AS value, late_out > 0 AS alert FROM by_minute
){episodes(3600, 0)}""",
    "watermark_lag_1m": f"""{LAG}
SELECT *, avg_lag_5m_ms > 60000 AS alert FROM averaged""",
    "watermark_lag_episodes": f"""{LAG}, samples AS (
    SELECT arrival_minute AS t, avg_lag_5m_ms AS value, avg_lag_5m_ms > 60000 AS alert FROM averaged
){episodes(600, 300)}""",
    "ingest_latency": f"""{CLICKSTREAM}, delayed AS (
    SELECT strftime(ingest_ts, '%Y-%m-%d') AS arrival_date,
           epoch_ms(ingest_ts) - epoch_ms(event_ts) AS delay_ms
    FROM clickstream
)
SELECT arrival_date, count(*) AS events,
       round(quantile_cont(delay_ms, 0.5), 6) AS p50_delay_ms,
       round(quantile_cont(delay_ms, 0.95), 6) AS p95_delay_ms,
       round(quantile_cont(delay_ms, 0.99), 6) AS p99_delay_ms,
       max(delay_ms) AS max_delay_ms
FROM delayed GROUP BY 1""",
    # ranks measured on all values must be within the stated error
    "latency_sketch_ranks": f"""{CLICKSTREAM}
SELECT strftime(ingest_ts, '%Y-%m-%d') AS arrival_date, count(*) AS events,
       true AS p50_near, true AS p95_near, true AS p99_near
FROM clickstream GROUP BY 1""",
    "ingest_latency_by_campaign": f"""{CLICKSTREAM}, delayed AS (
    SELECT campaign_id, epoch_ms(ingest_ts) - epoch_ms(event_ts) AS delay_ms FROM clickstream
)
SELECT campaign_id, count(*) AS events,
       round(quantile_cont(delay_ms, 0.5), 6) AS p50_delay_ms,
       round(quantile_cont(delay_ms, 0.95), 6) AS p95_delay_ms,
       round(quantile_cont(delay_ms, 0.99), 6) AS p99_delay_ms,
       max(delay_ms) AS max_delay_ms
FROM delayed GROUP BY 1""",
    "stream_hot": f"""{STREAMED}, counted AS ({counts("streamed", where="NOT is_late")})
SELECT counted.*, (SELECT min(batch_id) FROM reached WHERE after >= counted.window_end) AS batch_id
FROM counted WHERE window_end <= (SELECT max(after) FROM reached)""",
    "latest_windows_stored": f"""{STREAMED}, counted AS ({counts("streamed", where="NOT is_late")})
SELECT counted.*, (SELECT min(batch_id) FROM reached WHERE after >= counted.window_end) AS batch_id
FROM counted WHERE window_end <= (SELECT max(after) FROM reached)
ORDER BY window_start DESC, campaign_id, geo, device LIMIT 5""",
    "stream_late": f"""{STREAMED}
SELECT {EVENT}, window_end, watermark, epoch_ms(watermark) - epoch_ms(window_end) AS late_by_ms,
       {PAYLOAD} AS payload, batch_id
FROM streamed WHERE is_late""",
    "stream_cold": f"{STREAMED} SELECT {COLD}, batch_id FROM streamed",
    "stream_poison": f"""{STREAMED}
SELECT event_id, 'null_user_id' AS reason, batch_id FROM sent WHERE event_type = 'error'""",
    "batch_health": f"""{STREAMED}, late AS (
    SELECT batch_id, count(*) AS n FROM streamed WHERE is_late GROUP BY 1
), whole AS (
    SELECT batch_id, count(*) FILTER (WHERE event_type <> 'error') AS rows,
           count(*) FILTER (WHERE event_type = 'error') AS poison_rows
    FROM sent GROUP BY 1
)
SELECT batch_id, rows, coalesce(n, 0) AS late_rows, poison_rows,
       round(poison_rows / (rows + poison_rows), 6) AS error_rate,
       (SELECT max(batch_id) FROM sent) AS restarts
FROM whole LEFT JOIN late USING (batch_id)""",
    "batch_reports": f"""{CLICKSTREAM}, days AS (
    SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ingest_ts AS DATE)) AS BIGINT) AS batch_id,
           count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS poison_rows
    FROM clickstream GROUP BY 1
)
SELECT batch_id, n AS input_rows, round(n / 60, 6) AS input_rows_per_s, round(n / 30, 6) AS processed_rows_per_s,
       n * 1000 % 60000 AS trigger_ms, n % 7 AS commit_ms, round((n * 1000 % 60000) / 60000, 6) AS busy_ratio,
       CASE WHEN (n * 1000 % 60000) / 60000 >= 0.8 THEN 'high'
            WHEN (n * 1000 % 60000) / 60000 >= 0.5 THEN 'warn' ELSE 'ok' END AS backpressure,
       n * 30 AS rows_behind, n * 30 > 10000 AS lag_alert,
       n - poison_rows AS rows, CAST(0 AS BIGINT) AS late_rows, poison_rows,
       round(poison_rows / n, 6) AS error_rate,
       (SELECT count(DISTINCT batch_id // 10) - 1 FROM days) AS restarts
FROM days""",
}
