from oracle.prelude import ADS, REPLAYED

SQL = {
    "parse_quality": """
WITH lines AS (
  SELECT event_id AS n, '{"event_id":"evt_' || event_id || '","event_type":"' || event_type || '","revenue_usd":' ||
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || '}' AS line FROM events
), sent AS (
  SELECT CASE WHEN n % 41 = 0 THEN '   ' WHEN n % 43 = 0 THEN '{}' WHEN n % 47 = 0 THEN line[1:length(line) - 4] ELSE line END AS line
  FROM lines
), c AS (
  SELECT count(*) AS lines, count(*) FILTER (trim(line) = '') AS blank_lines, count(*) FILTER (trim(line) = '{}') AS empty_objects,
    count(*) FILTER (trim(line) <> '' AND NOT json_valid(line)) AS events_errors,
    count(*) FILTER (trim(line) NOT IN ('', '{}') AND json_valid(line)) AS events_parsed
  FROM sent
)
SELECT *, events_errors::DOUBLE / greatest(events_parsed + events_errors, 1) AS error_rate FROM c""",
    "event_identity": ADS + "SELECT src_id, ingest_seq, event_id FROM keyed",
    "enriched_events": ADS + """
SELECT event_id, event_type, "timestamp", user_id, session_id, device_type, ip_address, campaign_id, ad_group_id, ad_id,
  advertiser_id, ad_format, country, region, city, CAST(bid_price_usd AS DOUBLE) AS bid_price_usd,
  CAST(coalesce(revenue_usd, 0) AS DOUBLE) AS revenue_usd, CAST(coalesce(conversion_value_usd, 0) AS DOUBLE) AS conversion_value_usd,
  viewability_score, engagement_duration_ms,
  CAST("timestamp" // 3600000 % 24 AS INTEGER) AS hour_of_day, CAST(("timestamp" // 86400000 + 3) % 7 AS INTEGER) AS day_of_week
FROM ev""",
    "enriched_events_min": ADS + """
SELECT event_id, event_type, "timestamp", user_id, campaign_id, advertiser_id, device_type, country,
  CAST(bid_price_usd AS DOUBLE) AS bid_price_usd, CAST(coalesce(revenue_usd, 0) AS DOUBLE) AS revenue_usd,
  CAST(coalesce(conversion_value_usd, 0) AS DOUBLE) AS conversion_value_usd,
  CAST("timestamp" // 3600000 % 24 AS INTEGER) AS hour_of_day
FROM ev""",
    "dedup_events": ADS + 'SELECT event_id, event_type, "timestamp", user_id, campaign_id FROM ev',
    "dedup_ttl": REPLAYED.replace("WITH plain", "WITH RECURSIVE plain", 1) + """
, seen AS (
  SELECT event_id, "timestamp", min(event_type) AS event_type, min(campaign_id) AS campaign_id
  FROM replayed WHERE event_id IS NOT NULL GROUP BY 1, 2
), chain AS (
  SELECT event_id, min("timestamp") AS "timestamp" FROM seen GROUP BY 1
  UNION ALL
  SELECT c.event_id, (SELECT min(s."timestamp") FROM seen s WHERE s.event_id = c.event_id AND s."timestamp" - c."timestamp" > 604800000)
  FROM chain c
  WHERE EXISTS (SELECT 1 FROM seen s WHERE s.event_id = c.event_id AND s."timestamp" - c."timestamp" > 604800000)
)
SELECT s.event_id, s."timestamp", s.event_type, s.campaign_id FROM seen s JOIN chain c ON c.event_id = s.event_id AND c."timestamp" = s."timestamp"
""",
    "seen_check": REPLAYED + """
, cut AS (SELECT max("timestamp") - 864000000 AS c FROM replayed WHERE event_id IS NOT NULL)
SELECT DISTINCT event_id, event_id IN (SELECT event_id FROM replayed, cut WHERE "timestamp" < c AND event_id IS NOT NULL) AS already_seen
FROM replayed, cut WHERE "timestamp" >= c AND event_id IS NOT NULL""",
    "dedup_stats": ADS + """
, c AS (SELECT (SELECT count(*) FROM ev) AS processed, (SELECT count(*) FROM keyed) - (SELECT count(*) FROM ev) AS deduped,
  (SELECT count(*) FROM ev, nowrow WHERE "timestamp" >= now_ms - 604800000) AS tracked_ids)
SELECT tracked_ids, 168 AS ttl_hours, processed, deduped, deduped::DOUBLE / greatest(processed, 1) AS rate_of_processed,
  deduped::DOUBLE / greatest(processed + deduped, 1) AS rate_of_received FROM c""",
    "keyed_events": ADS + """
, k AS (
  SELECT coalesce(campaign_id, 'unknown') || '#' || strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d') AS partition_key,
    lpad(CAST("timestamp" AS VARCHAR), 16, '0') || '#' || coalesce(event_id, 'unknown') AS sort_key,
    ingest_seq, event_id, event_type, "timestamp", campaign_id, user_id,
    (SELECT now_ms FROM nowrow) // 1000 + 2592000 AS ttl
  FROM ads
)
SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY partition_key, sort_key ORDER BY ingest_seq DESC) = 1""",
    "retention_live_events": REPLAYED + """
, d AS (SELECT *, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS event_date FROM replayed)
SELECT src_id, ingest_seq, event_date, "timestamp" FROM d
WHERE event_date >= (SELECT CAST(make_timestamp(max("timestamp") * 1000) AS DATE) - 30 FROM replayed)""",
    "retention_policies": ADS + """
, p(policy, ttl_seconds) AS (VALUES ('events', 2592000::BIGINT), ('dedup_ids', 604800), ('minute_metrics', 3600),
  ('campaign_counters', 2592000), ('realtime_cache', 300))
SELECT policy, ttl_seconds, count(*) FILTER (now_ms - "timestamp" <= ttl_seconds * 1000) AS live_rows,
  count(*) FILTER (now_ms - "timestamp" > ttl_seconds * 1000) AS expired_rows
FROM ads, nowrow, p GROUP BY 1, 2""",
    "revenue_definitions": ADS + """
SELECT event_type, count(*) AS events,
  CAST(coalesce(sum(revenue_usd), 0) + coalesce(sum(conversion_value_usd), 0) AS DOUBLE) AS revenue_plus_value,
  CAST(sum(CASE WHEN revenue_usd <> 0 THEN revenue_usd WHEN conversion_value_usd <> 0 THEN conversion_value_usd ELSE 0 END) AS DOUBLE) AS first_nonzero,
  CAST(coalesce(sum(revenue_usd) FILTER (event_type = 'conversion'), 0) AS DOUBLE) AS conversions_only,
  CAST(coalesce(sum(revenue_usd), 0) AS DOUBLE) AS all_types,
  CAST(coalesce(sum(revenue_usd), 0) AS DOUBLE) AS revenue_or_zero
FROM ev GROUP BY 1""",
    "combined_sources": ADS + """
SELECT event_type AS feed, src_id, ingest_seq, "timestamp",
  CASE WHEN event_type = 'impression' THEN viewability_score END AS viewability_score,
  CAST(revenue_usd AS DOUBLE) AS revenue_usd,
  CASE WHEN event_type = 'click' THEN engagement_duration_ms END AS engagement_duration_ms,
  CAST(conversion_value_usd AS DOUBLE) AS conversion_value_usd
FROM ads""",
    "ingest_summary": REPLAYED + """
, d AS (SELECT *, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS batch_date FROM replayed),
firsts AS (SELECT * FROM d WHERE event_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "timestamp", ingest_seq) = 1),
n AS (SELECT batch_date, count(*) AS processed,
        sum(CASE WHEN revenue_usd <> 0 THEN revenue_usd WHEN conversion_value_usd <> 0 THEN conversion_value_usd ELSE 0 END) AS r
      FROM firsts GROUP BY 1),
t AS (SELECT batch_date, count(*) AS batch_size FROM d GROUP BY 1)
SELECT batch_date, batch_size, coalesce(processed, 0) AS processed, batch_size - coalesce(processed, 0) AS duplicates,
  CAST(0 AS BIGINT) AS errors, CAST(coalesce(r, 0) AS DOUBLE) AS total_revenue
FROM t LEFT JOIN n USING (batch_date)""",
    "source_stats": ADS + """
SELECT 'file' AS source_type, event_type, count(*) AS events_written, max("timestamp") AS last_write_time FROM ads GROUP BY 2""",
}
