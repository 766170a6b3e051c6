from oracle.prelude import ADS, COUNTS, REVENUE


def _linked(target: str, touch: str, same: list[str], least: int, most: int) -> str:
    keys = " AND ".join(f"t.{k} = g.{k}" for k in same)
    return ADS + f"""
, l AS (
  SELECT g.*, t.event_id AS touch_id, t."timestamp" AS touch_at, t.campaign_id AS touch_campaign, t.ad_id AS touch_ad,
    row_number() OVER (PARTITION BY g.event_id ORDER BY t."timestamp" DESC NULLS LAST, t.event_id DESC) AS pick
  FROM (SELECT * FROM ev WHERE event_type = '{target}') g
  LEFT JOIN (SELECT * FROM ev WHERE event_type = '{touch}') t
    ON {keys} AND g."timestamp" - t."timestamp" BETWEEN {least} AND {most}
), linked AS (SELECT * FROM l WHERE pick = 1)
"""


_CLICKS = """SELECT event_id AS click_id, user_id, "timestamp", touch_id AS impression_id,
  ("timestamp" - touch_at)::DOUBLE / 1000 AS seconds_to_click FROM linked"""
_CONVERSIONS = """SELECT event_id AS conversion_id, user_id, "timestamp", touch_id AS click_id, touch_campaign AS attributed_campaign_id,
  touch_ad AS attributed_ad_id, ("timestamp" - touch_at)::DOUBLE / 3600000 AS time_to_conversion_hours FROM linked"""
_WEEK = 604800000


def _share(*keys: str) -> str:
    k = ", ".join(keys)
    return ADS + f"SELECT {k}, count(*) AS events, count(*)::DOUBLE / (SELECT count(*) FROM ev) AS share FROM ev GROUP BY {k}"


SQL = {
    "attribute_clicks": _linked("click", "impression", ["user_id", "session_id", "campaign_id", "ad_id"], 1000, 300000) + _CLICKS,
    "attribute_clicks_by_user": _linked("click", "impression", ["user_id"], 1000, 86400000) + _CLICKS,
    "attribute_conversions": _linked("conversion", "click", ["user_id", "campaign_id", "ad_id"], 360000, _WEEK) + _CONVERSIONS,
    "attribute_conversions_by_user": _linked("conversion", "click", ["user_id"], 360000, _WEEK) + _CONVERSIONS,
    "attribution_check": _linked("conversion", "click", ["user_id"], 360000, _WEEK) + """
SELECT CASE WHEN touch_id IS NULL THEN 'unattributed'
            WHEN attributed_campaign_id = touch_campaign AND attributed_ad_id = touch_ad THEN 'agrees'
            WHEN attributed_campaign_id = touch_campaign THEN 'other_ad' ELSE 'other_campaign' END AS outcome,
  count(*) AS conversions, CAST(sum(conversion_value_usd) AS DOUBLE) AS conversion_value_usd
FROM linked GROUP BY 1""",
    "ctr_by_format": ADS + f"""
, c AS (SELECT ad_format, {COUNTS} FROM ev GROUP BY 1)
SELECT ad_format, impressions, clicks, CASE WHEN impressions > 0 THEN clicks::DOUBLE / impressions ELSE 0.0 END AS ctr FROM c""",
    "cvr_by_device": ADS + f"""
, c AS (SELECT device_type, {COUNTS} FROM ev GROUP BY 1)
SELECT device_type, clicks, conversions, CASE WHEN clicks > 0 THEN conversions::DOUBLE / clicks ELSE 0.0 END AS cvr FROM c""",
    "geo_share": _share("country", "region", "city"),
    "device_share": _share("device_type"),
    "funnel_mix": _share("event_type"),
    "session_summary": ADS + f"""
SELECT session_id, count(*) AS events, {COUNTS}, min("timestamp") AS session_start, max("timestamp") AS session_end,
  (max("timestamp") - min("timestamp"))::DOUBLE / 1000 AS duration_seconds, CAST(sum({REVENUE}) AS DOUBLE) AS revenue
FROM ev GROUP BY 1""",
    "auction_summary": ADS + """
, c AS (SELECT ad_format, count(bid_price_usd) AS bids, count(win_price_usd) AS wins,
  CAST(sum(bid_price_usd) AS DOUBLE) AS bid_total_usd, CAST(sum(win_price_usd) AS DOUBLE) AS spend_usd FROM ev GROUP BY 1)
SELECT *, CASE WHEN bids > 0 THEN wins::DOUBLE / bids ELSE 0.0 END AS win_rate FROM c""",
    "engagement_summary": ADS + """
, r AS (SELECT *, row_number() OVER (PARTITION BY ad_format ORDER BY engagement_duration_ms NULLS LAST) AS low,
    count(engagement_duration_ms) OVER (PARTITION BY ad_format) AS n FROM ev)
SELECT ad_format, count(engagement_duration_ms) AS measured,
  CAST(sum(CAST(viewability_score AS DECIMAL(18,4))) AS DOUBLE) / count(viewability_score) AS avg_viewability,
  CAST(sum(engagement_duration_ms) AS DOUBLE) / count(engagement_duration_ms) AS avg_engagement_ms,
  min(engagement_duration_ms) FILTER (low * 100 >= n * 50) AS p50_ms, min(engagement_duration_ms) FILTER (low * 100 >= n * 95) AS p95_ms
FROM r GROUP BY 1""",
}
