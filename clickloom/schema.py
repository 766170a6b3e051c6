"""Record layouts, allowed values and fixed settings."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _DOUBLE, _INT = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()

MONEY = T.DecimalType(18, 4)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The 36 fields of a raw event.
RAW_EVENT = _struct(
    ("event_id", _STRING), ("event_type", _STRING), ("timestamp", _LONG),
    ("user_id", _STRING), ("session_id", _STRING), ("ip_address", _STRING),
    ("user_agent", _STRING), ("device_type", _STRING),
    ("campaign_id", _STRING), ("ad_group_id", _STRING), ("ad_id", _STRING),
    ("advertiser_id", _STRING), ("creative_id", _STRING), ("ad_format", _STRING),
    ("publisher_id", _STRING), ("site_id", _STRING), ("placement_id", _STRING),
    ("page_url", _STRING), ("referrer_url", _STRING),
    ("country", _STRING), ("region", _STRING), ("city", _STRING), ("postal_code", _STRING),
    ("latitude", _DOUBLE), ("longitude", _DOUBLE),
    ("bid_price_usd", _DOUBLE), ("win_price_usd", _DOUBLE), ("revenue_usd", _DOUBLE),
    ("viewability_score", _DOUBLE), ("engagement_duration_ms", _LONG),
    ("click_position_x", _INT), ("click_position_y", _INT),
    ("attributed_campaign_id", _STRING), ("attributed_ad_id", _STRING),
    ("conversion_value_usd", _DOUBLE), ("time_to_conversion_hours", _DOUBLE),
)

# The 23 fields of an enriched event.
ENRICHED_COLUMNS = (
    "event_id", "event_type", "timestamp", "processing_timestamp",
    "user_id", "session_id", "device_type", "ip_address",
    "campaign_id", "ad_group_id", "ad_id", "advertiser_id", "ad_format",
    "country", "region", "city",
    "bid_price_usd", "revenue_usd", "conversion_value_usd",
    "viewability_score", "engagement_duration_ms",
    "hour_of_day", "day_of_week",
)

# The 13 fields of the reduced enriched event.
REDUCED_COLUMNS = (
    "event_id", "event_type", "timestamp", "processing_timestamp",
    "user_id", "campaign_id", "advertiser_id", "device_type", "country",
    "bid_price_usd", "revenue_usd", "conversion_value_usd",
    "hour_of_day",
)

MONEY_COLUMNS = ("bid_price_usd", "win_price_usd", "revenue_usd", "conversion_value_usd")

# The devices counted in the quality report.
DEVICE_TYPES = ("mobile", "desktop", "tablet")

METRIC_POINT = T.StructType([
    T.StructField("name", _STRING),
    T.StructField("point_id", _LONG),
    T.StructField("value", _DOUBLE),
    T.StructField("metric_type", _STRING),
    T.StructField("timestamp", _LONG),
    T.StructField("dimensions", T.MapType(_STRING, _STRING)),
    T.StructField("unit", _STRING),
])

RULE = _struct(
    ("alert_name", _STRING), ("metric_name", _STRING), ("threshold", _DOUBLE),
    ("comparison", _STRING), ("level", _STRING), ("enabled", T.BooleanType()),
)

# The six default alert rules.
DEFAULT_RULES = (
    ("HighLatency", "ProcessingLatency", 50.0, "gt", "warning", True),
    ("LowThroughput", "EventsPerSecond", 100000.0, "lt", "critical", True),
    ("HighErrorRate", "ErrorRate", 1.0, "gt", "critical", True),
    ("HighCPUUsage", "CPUUtilization", 80.0, "gt", "warning", True),
    ("HighMemoryUsage", "MemoryUtilization", 85.0, "gt", "warning", True),
    ("LowRevenue", "RevenuePerHour", 1000.0, "lt", "warning", True),
)

# Sustained alarms (alarm, metric, comparison, threshold, periods of 300 s).
SUSTAINED_ALARMS = (
    ("HighLatency", "ProcessingLatency", "gt", 50.0, 2),
    ("LowThroughput", "EventsPerSecond", "lt", 10000.0, 3),
)

# Metrics on the monitoring dashboard, with display units.
DASHBOARD_METRICS = (
    ("EventsPerSecond", "events/sec"),
    ("ProcessingLatency", "ms"),
    ("ErrorRate", "%"),
    ("CPUUtilization", "%"),
    ("MemoryUtilization", "%"),
    ("TotalRevenue", "$"),
)

# Unit names as a metrics service spells them; anything else is "Count".
SERVICE_UNITS = (
    ("count", "Count"), ("percent", "Percent"), ("ms", "Milliseconds"),
    ("count/sec", "Count/Second"), ("usd", "None"), ("usd/hour", "None"),
    ("gb", "Gigabytes"), ("bytes", "Bytes"),
)

# How long each kind of record lives, in seconds.
RETENTION_SECONDS = (
    ("events", 30 * 86400),
    ("dedup_ids", 7 * 86400),
    ("minute_metrics", 3600),
    ("campaign_counters", 30 * 86400),
    ("realtime_cache", 300),
)

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
DEDUP_TTL_MS = 7 * DAY_MS
