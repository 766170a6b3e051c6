from oracle.prelude import ADS, COUNTS, POINTS, REVENUE, percent

_SHOWN = 'event_id, event_type, "timestamp", user_id, campaign_id'


def _newest(where: str, limit: int) -> str:
    return ADS + f'SELECT {_SHOWN} FROM ev WHERE {where} ORDER BY "timestamp" DESC, event_id DESC LIMIT {limit}'


SQL = {
    "latest_events": _newest("true", 1000),
    "campaign_events": _newest("campaign_id = 'campaign_7' AND event_type = 'click'", 100),
    "campaign_day_events": _newest(
        "campaign_id = 'campaign_7' AND CAST(make_timestamp(\"timestamp\" * 1000) AS DATE) = DATE '2024-01-15'", 100),
    "user_events": _newest("user_id = 'user_8'", 50),
    "events_by_type": _newest("event_type = 'conversion'", 100),
    "user_recent_events": ADS + f"""
, r AS (SELECT {_SHOWN}, CAST(row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, event_id DESC) AS INTEGER) AS recency FROM ev)
SELECT * FROM r WHERE recency <= 10""",
    "campaign_recent_events": ADS + f"""
, r AS (SELECT {_SHOWN}, CAST(row_number() OVER (PARTITION BY campaign_id ORDER BY "timestamp" DESC, event_id DESC) AS INTEGER) AS recency
  FROM ev, nowrow WHERE CAST(make_timestamp("timestamp" * 1000) AS DATE) = CAST(make_timestamp(now_ms * 1000) AS DATE))
SELECT * FROM r WHERE recency <= 10""",
    "top_campaigns": ADS + f"""
, c AS (SELECT campaign_id, {COUNTS}, round(sum({REVENUE}), 2)::DOUBLE AS revenue FROM ev GROUP BY 1)
SELECT *, {percent('clicks', 'impressions')} AS ctr, {percent('conversions', 'clicks')} AS cvr
FROM c ORDER BY revenue DESC, campaign_id LIMIT 10""",
    "moving_latency": POINTS + """
SELECT name, point_id, "timestamp", CAST(sum(value) OVER w AS DOUBLE) / count(*) OVER w AS moving_average
FROM points WINDOW w AS (PARTITION BY name ORDER BY "timestamp", point_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)""",
    "rolling_5min": POINTS + """
, s AS (SELECT name, "timestamp" // 1000 AS second, sum(value) AS v, count(*) AS n, max(value) AS m FROM points GROUP BY 1, 2)
SELECT name, second, CAST(sum(v) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS DOUBLE) AS mean_5min, CAST(max(m) OVER w AS DOUBLE) AS peak_5min,
  CAST(sum(n) OVER w AS BIGINT) AS points_5min
FROM s WINDOW w AS (PARTITION BY name ORDER BY second RANGE BETWEEN 300 PRECEDING AND CURRENT ROW)""",
    "metric_trend": POINTS + """
, p AS (SELECT name, point_id, value, lag(value) OVER (PARTITION BY name ORDER BY "timestamp", point_id) AS prev FROM points)
SELECT name, point_id, CAST(value AS DOUBLE) AS value, CAST(prev AS DOUBLE) AS previous,
  CASE WHEN prev IS NULL THEN 'none' WHEN value > prev THEN 'up' WHEN value < prev THEN 'down' ELSE 'flat' END AS trend FROM p""",
    "recent_errors": """
SELECT event_id AS log_id, epoch_us(ts) // 1000 AS "timestamp", event_type AS level, props AS message
FROM events WHERE event_type = 'error' ORDER BY 2 DESC, 1 DESC LIMIT 100""",
    "throughput_series": POINTS + """
, r AS (SELECT name, "timestamp", point_id, CAST(value AS DOUBLE) AS value,
    CAST(row_number() OVER (PARTITION BY name ORDER BY "timestamp" DESC, point_id DESC) AS INTEGER) AS recency FROM points)
SELECT * FROM r WHERE recency <= 60""",
}
