"""Common table expressions: the ad events and metric points formed from ``events``."""

ADS = """
WITH plain AS (
  SELECT event_id AS src_id, epoch_us(ts) // 1000 AS "timestamp", user_id AS uid, event_type AS raw_type,
         CAST(value AS DECIMAL(18,2)) AS amount, CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events
), gaps(raw, part, nth, gap) AS (VALUES
  ('click', 0, 1, 999), ('click', 1, 1, 1000), ('click', 2, 1, 60000), ('click', 2, 2, 60000), ('click', 3, 1, 300000), ('click', 4, 1, 300001),
  ('purchase', 0, 1, 359999), ('purchase', 1, 1, 360000), ('purchase', 2, 1, 86400000), ('purchase', 2, 2, 86400000),
  ('purchase', 3, 1, 604800000), ('purchase', 4, 1, 604800001)
), base AS (
  SELECT * FROM plain
  UNION ALL
  SELECT src_id + nth * 1000000000::BIGINT, "timestamp" - gap, uid, CASE raw_type WHEN 'click' THEN 'view' ELSE 'click' END, amount, k
  FROM plain JOIN gaps ON raw_type = raw AND src_id % 5 = part WHERE raw_type = 'click' OR src_id % 2 = 0
), typed AS (
  SELECT *, CASE raw_type WHEN 'view' THEN 'impression' WHEN 'signup' THEN 'impression' WHEN 'click' THEN 'click'
                          WHEN 'purchase' THEN 'conversion' ELSE 'unknown' END AS event_type
  FROM base
), single AS (
  SELECT src_id,
    CASE WHEN src_id % 97 <> 0 THEN 'evt_' || src_id END AS event_id,
    event_type, "timestamp", 'user_' || uid AS user_id,
    'session_' || uid || '_' || ("timestamp" // 86400000) AS session_id,
    CAST(NULL AS VARCHAR) AS ip_address,
    'campaign_' || k AS campaign_id, 'adgroup_' || (k % 25) AS ad_group_id, 'ad_' || (k % 50) AS ad_id,
    'advertiser_' || (k % 10) AS advertiser_id,
    CASE WHEN src_id % 20 < 12 THEN 'mobile' WHEN src_id % 20 < 19 THEN 'desktop' ELSE 'tablet' END AS device_type,
    CASE src_id % 4 WHEN 0 THEN 'banner' WHEN 1 THEN 'video' WHEN 2 THEN 'native' ELSE 'popup' END AS ad_format,
    'country_' || (src_id % 5) AS country, 'region_' || (src_id % 5) AS region, 'city_' || (src_id % 5) AS city,
    CAST(amount * 0.01 AS DECIMAL(18,4)) AS bid_price_usd,
    CASE WHEN src_id % 20 < 17 THEN CAST(amount * 0.008 AS DECIMAL(18,4)) END AS win_price_usd,
    CASE event_type WHEN 'click' THEN CAST(amount * 0.02 AS DECIMAL(18,4))
                    WHEN 'conversion' THEN CAST(amount AS DECIMAL(18,4)) END AS revenue_usd,
    CASE event_type WHEN 'conversion' THEN CAST(amount AS DECIMAL(18,4)) END AS conversion_value_usd,
    CASE WHEN event_type IN ('impression', 'click') THEN CAST(src_id % 71 + 30 AS DOUBLE) / 100 END AS viewability_score,
    CASE WHEN event_type IN ('impression', 'click') THEN src_id % 30000 + 100 END AS engagement_duration_ms,
    CASE event_type WHEN 'conversion' THEN 'campaign_' || k END AS attributed_campaign_id,
    CASE event_type WHEN 'conversion' THEN 'ad_' || (k % 50) END AS attributed_ad_id
  FROM typed
), ads AS (
  SELECT *, 0 AS ingest_seq FROM single
  UNION ALL
  SELECT *, 1 AS ingest_seq FROM single WHERE "timestamp" % 50 = 0
), keyed AS (
  SELECT * EXCLUDE (event_id), event_id AS raw_event_id,
    CASE WHEN event_id IS NULL OR event_id = ''
         THEN md5("timestamp" || '|' || coalesce(user_id, '') || '|' || coalesce(campaign_id, '') || '|' || coalesce(event_type, ''))[1:16]
         ELSE event_id END AS event_id
  FROM ads
), ev AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "timestamp", ingest_seq) = 1
), nowrow AS (SELECT max("timestamp") AS now_ms FROM ads)
"""

# Every event again 6, 8 and 16 days later.
REPLAYED = ADS + """
, replayed AS (
  SELECT ads.* EXCLUDE ("timestamp"), "timestamp" + shift * 86400000 AS "timestamp"
  FROM ads, (VALUES (0), (6), (8), (16)) AS s(shift)
)
"""

POINTS = """
WITH RECURSIVE points AS (
  SELECT event_id AS point_id,
    CASE event_type WHEN 'click' THEN 'ProcessingLatency' WHEN 'view' THEN 'EventsPerSecond' WHEN 'error' THEN 'ErrorRate'
                    WHEN 'purchase' THEN 'RevenuePerHour' ELSE 'CPUUtilization' END AS name,
    CAST(CASE event_type WHEN 'view' THEN CAST(value AS DECIMAL(18,2)) * 10000
                         WHEN 'purchase' THEN CAST(value AS DECIMAL(18,2)) * 100
                         WHEN 'error' THEN CAST(value AS DECIMAL(18,2)) * 0.1
                         ELSE CAST(value AS DECIMAL(18,2)) END AS DECIMAL(20,4)) AS value,
    epoch_us(ts) // 1000 AS "timestamp",
    CASE event_type WHEN 'view' THEN 'Count/Second' WHEN 'click' THEN 'Milliseconds' WHEN 'purchase' THEN 'None'
                    ELSE 'Percent' END AS unit
  FROM events
), rules AS (
  SELECT * FROM (VALUES
    ('HighLatency', 'ProcessingLatency', 50.0::DOUBLE, 'gt', 'warning'),
    ('LowThroughput', 'EventsPerSecond', 100000.0::DOUBLE, 'lt', 'critical'),
    ('HighErrorRate', 'ErrorRate', 1.0::DOUBLE, 'gt', 'critical'),
    ('HighCPUUsage', 'CPUUtilization', 80.0::DOUBLE, 'gt', 'warning'),
    ('HighMemoryUsage', 'MemoryUtilization', 85.0::DOUBLE, 'gt', 'warning'),
    ('LowRevenue', 'RevenuePerHour', 1000.0::DOUBLE, 'lt', 'warning')
  ) AS r(alert_name, metric_name, threshold, comparison, level)
), judged AS (
  SELECT r.*, p.point_id, p."timestamp", CAST(p.value AS DOUBLE) AS value, p.value AS exact,
    CASE WHEN (comparison = 'gt' AND CAST(p.value AS DOUBLE) > threshold)
           OR (comparison = 'lt' AND CAST(p.value AS DOUBLE) < threshold) THEN 'ALARM' ELSE 'OK' END AS state
  FROM points p JOIN rules r ON r.metric_name = p.name
), told AS (
  SELECT *, 'Metric ' || metric_name || ' = ' || CAST(CAST(exact AS DECIMAL(20,2)) AS VARCHAR)
    || CASE WHEN state = 'ALARM' THEN ' ' || comparison || ' ' || CAST(threshold AS VARCHAR) ELSE '' END AS reason
  FROM judged
), nowrow AS (SELECT max("timestamp") AS now_ms FROM points)
"""

# Latest state per rule.
STATES = POINTS + """
, newest AS (
  SELECT * FROM told QUALIFY row_number() OVER (PARTITION BY alert_name ORDER BY "timestamp" DESC, point_id DESC) = 1
), triggers AS (
  SELECT alert_name, count(*) FILTER (state = 'ALARM') AS trigger_count, max("timestamp") FILTER (state = 'ALARM') AS last_triggered
  FROM told GROUP BY 1
), states AS (
  SELECT r.alert_name, r.metric_name, r.level, coalesce(n.state, 'INSUFFICIENT_DATA') AS state,
    coalesce(n.reason, 'Alert just created') AS reason, n."timestamp", n.value AS metric_value,
    coalesce(t.trigger_count, 0) AS trigger_count, t.last_triggered
  FROM rules r LEFT JOIN newest n USING (alert_name) LEFT JOIN triggers t USING (alert_name)
)
"""

COUNTS = """count(*) FILTER (event_type = 'impression') AS impressions,
  count(*) FILTER (event_type = 'click') AS clicks,
  count(*) FILTER (event_type = 'conversion') AS conversions"""

REVENUE = "coalesce(revenue_usd, 0) + coalesce(conversion_value_usd, 0)"
CONVERSION_REVENUE = "coalesce(CAST(sum(revenue_usd) FILTER (event_type = 'conversion') AS DOUBLE), 0)"
FRACTIONS = """CASE WHEN impressions > 0 THEN clicks::DOUBLE / impressions ELSE 0.0 END AS ctr,
  CASE WHEN clicks > 0 THEN conversions::DOUBLE / clicks ELSE 0.0 END AS conversion_rate"""


def percent(num: str, den: str) -> str:
    return f"round({num}::DOUBLE / greatest({den}, 1) * 100, 2)"
