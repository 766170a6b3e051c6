from oracle.prelude import ADS, CONVERSION_REVENUE, COUNTS, FRACTIONS, POINTS, REVENUE, STATES

_BATCHES = ADS + f"""
, b AS (SELECT "timestamp" // 3600000 AS batch, count(*) AS n, count(*) FILTER (event_type = 'unknown') AS bad,
    sum({REVENUE}) AS cents, CAST(sum({REVENUE}) AS DOUBLE) AS r, (max("timestamp") - min("timestamp"))::DOUBLE / 1000 AS d, max("timestamp") AS last FROM ev GROUP BY 1)
"""

_DASHBOARD = """
, listed(name, unit) AS (VALUES ('EventsPerSecond', 'events/sec'), ('ProcessingLatency', 'ms'), ('ErrorRate', '%'),
  ('CPUUtilization', '%'), ('MemoryUtilization', '%'), ('TotalRevenue', '$')),
recent AS (SELECT name, CAST(sum(value) AS DOUBLE) / count(*) AS current, CAST(max(value) AS DOUBLE) AS peak
  FROM points, nowrow WHERE "timestamp" BETWEEN now_ms - 300000 AND now_ms GROUP BY 1),
dashboard AS (SELECT name, current, peak, listed.unit FROM listed LEFT JOIN recent USING (name))
"""

_HEALTH = """
CASE WHEN count(*) FILTER (state = 'ALARM' AND level IN ('critical', 'emergency')) > 0 THEN 'CRITICAL'
     WHEN count(*) FILTER (state = 'ALARM' AND level = 'warning') > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS overall_status,
count(*) FILTER (state = 'ALARM') AS active_alerts"""

SQL = {
    "batch_metrics": _BATCHES + """
SELECT batch, n AS events_processed, n::DOUBLE / greatest(d, 0.001) AS events_per_second,
  d / greatest(n, 1)::DOUBLE * 1000 AS processing_latency_ms, bad::DOUBLE / greatest(n, 1)::DOUBLE * 100 AS error_rate,
  r AS total_revenue, r * (3600.0::DOUBLE / greatest(d, 1.0::DOUBLE)) AS revenue_per_hour FROM b""",
    "consumer_status": _BATCHES + """
SELECT 'active' AS consumer_status, round(n::DOUBLE / greatest(d, 0.001)) AS events_per_second,
  round(d / greatest(n, 1)::DOUBLE * 1000, 2) AS avg_latency_ms, round(bad::DOUBLE / greatest(n, 1)::DOUBLE * 100, 2) AS error_rate,
  round(cents, 2)::DOUBLE AS total_revenue, last AS last_updated FROM b ORDER BY last DESC LIMIT 1""",
    "metric_statistics": POINTS + """
SELECT name, unit, CAST(sum(value) AS DOUBLE) / count(*) AS average, CAST(sum(value) AS DOUBLE) AS sum, CAST(max(value) AS DOUBLE) AS maximum,
  CAST(min(value) AS DOUBLE) AS minimum, count(*) AS count
FROM points, nowrow WHERE "timestamp" BETWEEN now_ms - 604800000 AND now_ms GROUP BY 1, 2""",
    "dashboard_metrics": POINTS + _DASHBOARD + "SELECT * FROM dashboard",
    "latency_summary": POINTS + """
, r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY value) AS low, count(*) OVER (PARTITION BY name) AS n,
    row_number() OVER (PARTITION BY name ORDER BY "timestamp" DESC, point_id DESC) AS recency FROM points)
SELECT name, count(*) AS samples, CAST(sum(value) AS DOUBLE) / count(*) AS mean, CAST(min(value) AS DOUBLE) AS minimum,
  CAST(max(value) AS DOUBLE) AS maximum, CAST(sum(value) FILTER (recency <= 1000) AS DOUBLE) / count(*) FILTER (recency <= 1000) AS recent_mean,
  CAST(min(value) FILTER (low * 100 >= n * 50) AS DOUBLE) AS p50, CAST(min(value) FILTER (low * 100 >= n * 95) AS DOUBLE) AS p95,
  CAST(min(value) FILTER (low * 100 >= n * 99) AS DOUBLE) AS p99
FROM r GROUP BY 1""",
    "alert_evaluation": POINTS + 'SELECT alert_name, metric_name, level, point_id, "timestamp", value, state FROM judged',
    "alert_transitions": POINTS + """
, s AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY alert_name ORDER BY "timestamp", point_id), 'INSUFFICIENT_DATA') AS old_state FROM told)
SELECT alert_name, metric_name, level, point_id, "timestamp", value, old_state, state AS new_state, reason, state = 'ALARM' AS notify
FROM s WHERE state <> old_state""",
    "alarm_current": STATES + "SELECT * FROM states",
    "overall_health": STATES + f"SELECT {_HEALTH} FROM states",
    "active_alerts": STATES + "SELECT alert_name, state, level, reason, last_triggered FROM states WHERE state = 'ALARM'",
    "dashboard_alerts": STATES + "SELECT alert_name, state, reason, level, last_triggered FROM states",
    "dashboard_health": STATES + f"SELECT {_HEALTH}, ({ADS} SELECT count(*)::DOUBLE FROM ev) AS total_events_processed FROM states",
    "sustained_alarms": POINTS + """
, alarms(alert_name, name, periods) AS (VALUES ('HighLatency', 'ProcessingLatency', 2), ('LowThroughput', 'EventsPerSecond', 3)),
m AS (SELECT name, "timestamp" // 300000 AS period, CAST(sum(value) AS DOUBLE) / count(*) AS mean FROM points GROUP BY 1, 2),
bad AS (SELECT alert_name, periods, period, mean FROM m JOIN alarms USING (name)
  WHERE (alert_name = 'HighLatency' AND mean > 50) OR (alert_name = 'LowThroughput' AND mean < 10000)),
run AS (
  SELECT alert_name, period, 1 AS len, mean, periods FROM bad b
  WHERE NOT EXISTS (SELECT 1 FROM bad p WHERE p.alert_name = b.alert_name AND p.period = b.period - 1)
  UNION ALL
  SELECT b.alert_name, b.period, run.len + 1, b.mean, b.periods FROM run JOIN bad b ON b.alert_name = run.alert_name AND b.period = run.period + 1
)
SELECT alert_name, period, mean, CAST(len AS BIGINT) AS breaching_periods FROM run WHERE len >= periods""",
    "tiered_status": POINTS + """
, d AS (SELECT name, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS day, value FROM points),
r AS (SELECT *, row_number() OVER (PARTITION BY name, day ORDER BY value) AS low, count(*) OVER (PARTITION BY name, day) AS n FROM d),
x AS (SELECT name, day, CASE WHEN name = 'ProcessingLatency' THEN CAST(min(value) FILTER (low * 100 >= n * 95) AS DOUBLE)
    ELSE CAST(sum(value) AS DOUBLE) / count(*) END AS reading
  FROM r WHERE name IN ('EventsPerSecond', 'ProcessingLatency', 'ErrorRate') GROUP BY 1, 2)
SELECT *, CASE
  WHEN name = 'EventsPerSecond' THEN CASE WHEN reading < 50000 THEN 'critical' WHEN reading < 100000 THEN 'warning' ELSE 'ok' END
  WHEN name = 'ProcessingLatency' THEN CASE WHEN reading > 100 THEN 'critical' WHEN reading > 50 THEN 'warning' ELSE 'ok' END
  ELSE CASE WHEN reading > 5 THEN 'critical' WHEN reading > 1 THEN 'warning' ELSE 'ok' END END AS status FROM x""",
    "heartbeat": POINTS + """
, n AS (SELECT name, max("timestamp") AS newest FROM points GROUP BY 1 UNION ALL SELECT 'ALL', max("timestamp") FROM points)
SELECT name, newest, CASE WHEN now_ms - newest > 300000 THEN 0 ELSE 1 END AS healthy FROM n, nowrow""",
    "campaign_alerts": ADS + f"""
, c AS (SELECT campaign_id, {COUNTS}, {CONVERSION_REVENUE} AS revenue_usd FROM ev
  WHERE CAST(make_timestamp("timestamp" * 1000) AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1),
m AS (SELECT *, {FRACTIONS} FROM c),
a AS (SELECT campaign_id, 'conversion_rate' AS metric, 'lt' AS comparison, 0.4::DOUBLE AS threshold, conversion_rate AS value FROM m
  UNION ALL SELECT campaign_id, 'revenue_usd', 'gt', 2000.0::DOUBLE, revenue_usd FROM m)
SELECT 'alert_' || campaign_id || '_' || (now_ms // 1000) AS alert_id, campaign_id, metric, comparison, threshold, value,
  CASE WHEN (comparison = 'lt' AND value < threshold) OR (comparison = 'gt' AND value > threshold) THEN 'ALARM' ELSE 'OK' END AS state
FROM a, nowrow""",
    "performance_grade": POINTS + """
, h AS (SELECT "timestamp" // 3600000 AS hour,
    CAST(sum(value) FILTER (name = 'EventsPerSecond') AS DOUBLE) / nullif(count(*) FILTER (name = 'EventsPerSecond'), 0) AS throughput,
    CAST(sum(value) FILTER (name = 'ProcessingLatency') AS DOUBLE) / nullif(count(*) FILTER (name = 'ProcessingLatency'), 0) AS latency_ms
  FROM points WHERE name IN ('EventsPerSecond', 'ProcessingLatency') GROUP BY 1),
a AS (SELECT *, throughput / 1000000.0::DOUBLE * 100 AS achieved FROM h)
SELECT hour, throughput, latency_ms,
  CASE WHEN throughput >= 800000 THEN 'OK' WHEN throughput >= 10000 THEN 'WARN' ELSE 'LOW' END AS consumer_status,
  CASE WHEN throughput >= 50000 THEN 'EXCELLENT' WHEN throughput >= 10000 THEN 'GOOD' ELSE 'NEEDS OPTIMIZATION' END AS throughput_status,
  CASE WHEN latency_ms < 20 THEN 'EXCELLENT' WHEN latency_ms < 100 THEN 'ACCEPTABLE' WHEN latency_ms >= 100 THEN 'HIGH' END AS latency_status,
  least(100.0::DOUBLE, achieved) AS target_achievement,
  CASE WHEN achieved >= 80 THEN 'A+ EXCELLENT' WHEN achieved >= 60 THEN 'A VERY GOOD' WHEN achieved >= 40 THEN 'B+ GOOD'
       WHEN achieved >= 20 THEN 'B FAIR' ELSE 'C NEEDS WORK' END AS grade,
  CASE WHEN throughput >= 1000000 THEN 5 WHEN throughput >= 500000 THEN 4 WHEN throughput >= 100000 THEN 3
       WHEN throughput >= 50000 THEN 2 WHEN throughput >= 10000 THEN 1 ELSE 0 END AS tiers_passed,
  CASE WHEN latency_ms < 20 THEN 100.0::DOUBLE WHEN latency_ms >= 20 THEN greatest(0.0::DOUBLE, 100.0::DOUBLE - (latency_ms - 20) / 20.0::DOUBLE * 100) END AS latency_score
FROM a""",
    "health_summary": STATES + _DASHBOARD + f"""
, h AS (SELECT {_HEALTH} FROM states)
SELECT CASE WHEN overall_status IN ('HEALTHY', 'WARNING') THEN 'healthy' ELSE 'unhealthy' END AS status, overall_status, active_alerts,
  (SELECT current FROM dashboard WHERE name = 'EventsPerSecond') AS events_per_second,
  (SELECT current FROM dashboard WHERE name = 'ProcessingLatency') AS processing_latency_ms,
  (SELECT current FROM dashboard WHERE name = 'ErrorRate') AS error_rate,
  (SELECT current FROM dashboard WHERE name = 'CPUUtilization') AS cpu_usage,
  (SELECT current FROM dashboard WHERE name = 'MemoryUtilization') AS memory_usage FROM h""",
}
