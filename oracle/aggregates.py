from oracle.prelude import ADS, CONVERSION_REVENUE, COUNTS, FRACTIONS, REVENUE, percent

_METRICS = f"""{COUNTS},
  {CONVERSION_REVENUE} AS revenue_usd, count(DISTINCT user_id) AS unique_users"""


def _performance(key: str) -> str:
    return ADS + f"""
, c AS (SELECT {key}, {COUNTS}, round(sum({REVENUE}), 2)::DOUBLE AS revenue FROM ev GROUP BY 1)
SELECT {key}, impressions, clicks, conversions, {{}} {percent('clicks', 'impressions')} AS ctr, {percent('conversions', 'clicks')} AS cvr
FROM c"""


def _top(order: str) -> str:
    return ADS + f"""
, c AS (SELECT campaign_id, {COUNTS}, {CONVERSION_REVENUE} AS revenue_usd
  FROM ev, nowrow
  WHERE strftime(make_timestamp("timestamp" * 1000), '%Y-%m') = strftime(make_timestamp(now_ms * 1000), '%Y-%m') GROUP BY 1),
m AS (SELECT *, {FRACTIONS} FROM c),
b AS (SELECT *, count(*) OVER () AS total_analyzed FROM m ORDER BY {order} DESC, campaign_id LIMIT 50)
SELECT CAST(rank() OVER (ORDER BY {order} DESC) AS INTEGER) AS rank, campaign_id, revenue_usd, ctr, conversion_rate, clicks, conversions, total_analyzed
FROM b"""


_QUALITY = f"""
, c AS (SELECT count(*) AS rows, {COUNTS},
  count(*) FILTER (device_type = 'mobile') AS mobile_events, count(*) FILTER (device_type = 'desktop') AS desktop_events,
  count(*) FILTER (device_type = 'tablet') AS tablet_events, CAST(sum({REVENUE}) AS DOUBLE) AS total_revenue,
  count(DISTINCT campaign_id) AS unique_campaigns, count(DISTINCT country) AS unique_countries FROM {{source}})
SELECT *, CASE WHEN impressions > 0 THEN clicks::DOUBLE / impressions * 100 END AS ctr,
  CASE WHEN clicks > 0 THEN conversions::DOUBLE / clicks * 100 END AS cvr FROM c"""

_TODAY = 'CAST(make_timestamp("timestamp" * 1000) AS DATE) = CAST(make_timestamp(now_ms * 1000) AS DATE)'

SQL = {
    "processing_totals": ADS + f"""
SELECT count(*) AS events_processed, count(*) FILTER (event_type = 'impression') AS impressions_processed,
  count(*) FILTER (event_type = 'click') AS clicks_processed, count(*) FILTER (event_type = 'conversion') AS conversions_processed,
  CAST(sum({REVENUE}) AS DOUBLE) AS revenue_processed_usd, count(DISTINCT campaign_id) AS unique_campaigns,
  count(DISTINCT user_id) AS unique_users FROM ev""",
    "processing_rates": ADS + """
, c AS (SELECT count(*) FILTER (event_type <> 'unknown')::BIGINT AS processed, count(*) FILTER (event_type = 'unknown') AS errors,
  (SELECT count(*) FROM keyed) - count(*) AS deduped, count(*) AS ids,
  (SELECT (max("timestamp") - min("timestamp"))::DOUBLE / 1000 FROM keyed) AS elapsed_seconds FROM ev)
SELECT processed, errors, deduped, elapsed_seconds, processed / greatest(elapsed_seconds, 0.001) AS events_per_second,
  deduped::DOUBLE / greatest(processed, 1) AS deduplication_rate, errors::DOUBLE / greatest(processed + errors, 1) AS error_rate,
  ids::DOUBLE * 32 / 1048576 AS memory_usage_mb FROM c""",
    "events_by_campaign": ADS + "SELECT campaign_id, count(*) AS events FROM ev GROUP BY 1",
    "events_by_user": ADS + "SELECT user_id, count(*) AS events FROM ev GROUP BY 1",
    "events_by_type_device": ADS + "SELECT event_type, device_type, count(*) AS events FROM ev GROUP BY 1, 2",
    "realtime_totals": ADS + f"""
SELECT count(*) AS total_events, count(*) FILTER ("timestamp" >= now_ms - 3600000) AS events_last_hour,
  round(coalesce(sum({REVENUE}) FILTER ("timestamp" >= now_ms - 3600000), 0), 2)::DOUBLE AS revenue_last_hour FROM ev, nowrow""",
    "campaign_performance": _performance("campaign_id").format("revenue,"),
    "device_performance": _performance("device_type").format(""),
    "hourly_trends": ADS + f"""
SELECT CAST("timestamp" // 3600000 % 24 AS INTEGER) AS hour, {COUNTS}, CAST(sum({REVENUE}) AS DOUBLE) AS revenue
FROM ev, nowrow WHERE "timestamp" >= now_ms - 168 * 3600000 GROUP BY 1""",
    "peak_hour": ADS + """
SELECT CAST(coalesce((SELECT "timestamp" // 3600000 % 24 AS h FROM ev, nowrow WHERE "timestamp" >= now_ms - 24 * 3600000
  GROUP BY 1 ORDER BY count(*) FILTER (event_type <> 'unknown') DESC, h LIMIT 1), 0) AS INTEGER) AS peak_hour, 24 AS hours_analyzed""",
    "conversion_rates": ADS + f"""
, c AS (SELECT {COUNTS} FROM ev)
SELECT *, {percent('clicks', 'impressions')} AS overall_ctr, {percent('conversions', 'clicks')} AS overall_cvr,
  {percent('conversions', 'impressions')} AS impressions_to_conversion FROM c""",
    "campaign_performance_range": ADS + f"""
, c AS (SELECT campaign_id, count(*) AS total_events, {_METRICS} FROM ev
  WHERE CAST(make_timestamp("timestamp" * 1000) AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' GROUP BY 1)
SELECT *, {FRACTIONS} FROM c""",
    "campaign_metrics_bucketed": ADS + f"""
, g AS (SELECT *, unnest([{{'p': 'hour', 'f': '%Y-%m-%d-%H'}}, {{'p': 'day', 'f': '%Y-%m-%d'}}, {{'p': 'month', 'f': '%Y-%m'}}]) AS grain FROM ev),
c AS (SELECT campaign_id, grain.p AS time_period, CASE grain.p
    WHEN 'hour' THEN strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d-%H')
    WHEN 'day' THEN strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d')
    ELSE strftime(make_timestamp("timestamp" * 1000), '%Y-%m') END AS time_bucket, {_METRICS} FROM g GROUP BY 1, 2, 3)
SELECT *, {FRACTIONS} FROM c""",
    "campaign_metrics_today": ADS + f"""
, c AS (SELECT campaign_id, {_METRICS} FROM ev, nowrow WHERE {_TODAY} GROUP BY 1)
SELECT *, {FRACTIONS} FROM c""",
    "user_journey": ADS + f"""
SELECT user_id, count(*) AS total_events, min("timestamp") AS first_seen, max("timestamp") AS last_seen,
  (string_agg(DISTINCT campaign_id, ',' ORDER BY campaign_id)) AS campaigns_visited, {COUNTS},
  CAST(coalesce(sum(revenue_usd), 0) AS DOUBLE) AS total_revenue
FROM ev GROUP BY 1""",
    "dashboard_today": ADS + f"""
, t AS (SELECT *, {REVENUE} AS r FROM ev, nowrow WHERE {_TODAY}),
c AS (SELECT campaign_id, sum(r) AS r FROM t GROUP BY 1 ORDER BY r DESC, campaign_id LIMIT 3),
s AS (SELECT count(*) AS n, {COUNTS}, CAST(sum(r) AS DOUBLE) AS total, any_value(now_ms) AS now_ms FROM t)
SELECT n AS total_events_today, n::DOUBLE / greatest((now_ms % 86400000)::DOUBLE / 1000, 0.001) AS events_per_second,
  (SELECT string_agg(campaign_id, ',' ORDER BY r DESC, campaign_id) FROM c) AS top_campaigns, total AS total_revenue_today,
  CASE WHEN impressions > 0 THEN clicks::DOUBLE / impressions ELSE 0.0 END AS average_ctr,
  CASE WHEN clicks > 0 THEN conversions::DOUBLE / clicks ELSE 0.0 END AS conversion_rate FROM s""",
    "top_performers_revenue": _top("revenue_usd"),
    "top_performers_ctr": _top("ctr"),
    "top_performers_cvr": _top("conversion_rate"),
    "top_performers_clicks": _top("clicks"),
    "campaign_hourly": ADS + f"""
SELECT campaign_id, "timestamp" // 3600000 AS hour, {COUNTS},
  CAST(sum(CASE WHEN revenue_usd <> 0 THEN revenue_usd WHEN conversion_value_usd <> 0 THEN conversion_value_usd ELSE 0 END) AS DOUBLE) AS revenue
FROM ev GROUP BY 1, 2""",
    "top_campaigns_active": ADS + f"""
, c AS (SELECT campaign_id, {COUNTS},
  CAST(sum(CASE WHEN revenue_usd <> 0 THEN revenue_usd WHEN conversion_value_usd <> 0 THEN conversion_value_usd ELSE 0 END) AS DOUBLE) AS revenue
  FROM ev GROUP BY 1)
SELECT *, round(clicks::DOUBLE / impressions * 100, 2) AS ctr,
  CASE WHEN clicks > 0 THEN round(conversions::DOUBLE / clicks * 100, 2) ELSE 0.0 END AS cvr
FROM c WHERE impressions > 0 ORDER BY revenue DESC, campaign_id LIMIT 10""",
    "minute_history": ADS + f"""
, b AS (SELECT "timestamp" // 10000 AS batch, count(*) AS n, count(*) FILTER (event_type = 'unknown') AS bad, sum({REVENUE}) AS r,
    (max("timestamp") - min("timestamp"))::DOUBLE / 1000 AS d, max("timestamp") AS last FROM ev GROUP BY 1),
m AS (SELECT batch // 6 AS minute, max(last) AS "timestamp", CAST(sum(n) AS BIGINT) AS events_processed,
    arg_max(n::DOUBLE / greatest(d, 0.001), batch) AS processing_rate, arg_max(bad::DOUBLE / greatest(n, 1) * 100, batch) AS error_rate,
    CAST(sum(r) AS DOUBLE) AS total_revenue FROM b GROUP BY 1)
SELECT m.* FROM m, nowrow WHERE minute > now_ms // 60000 - 1440 AND minute <= now_ms // 60000""",
    "data_quality": ADS + _QUALITY.format(source="ev"),
    "data_distributions": ADS + """
SELECT 'event_type' AS dimension, event_type AS value, count(*) AS events FROM ev GROUP BY 2
UNION ALL SELECT 'device_type', device_type, count(*) FROM ev GROUP BY 2""",
    "data_quality_sample": ADS + ', sampled AS (SELECT * FROM ev ORDER BY "timestamp", event_id LIMIT 700)' + _QUALITY.format(source="sampled"),
    "distinct_users_exact": ADS + "SELECT campaign_id, event_type, count(DISTINCT user_id) AS unique_users FROM ev GROUP BY 1, 2",
}
