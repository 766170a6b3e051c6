"""Attribution, funnel and distribution reports."""

from __future__ import annotations

from clickloom.operators import attribution as at, funnel as fu
from clickloom.plans.common import events, registrar
from clickloom.schema import DAY_MS

QUERIES: dict = {}
query = registrar(QUERIES)

_LINKS = ("event_type", "timestamp", "user_id", "session_id", "campaign_id", "ad_id")


@query
def attribute_clicks(spark, sf_dir):
    return at.attribute_clicks(events(spark, sf_dir, *_LINKS))


@query
def attribute_clicks_by_user(spark, sf_dir):
    """The same operator on the user alone and a day's reach, where the test data has many links."""
    return at.attribute_clicks(events(spark, sf_dir, *_LINKS), ("user_id",), (1_000, DAY_MS))


@query
def attribute_conversions(spark, sf_dir):
    return at.attribute_conversions(events(spark, sf_dir, *_LINKS))


@query
def attribute_conversions_by_user(spark, sf_dir):
    return at.attribute_conversions(events(spark, sf_dir, *_LINKS), ("user_id",))


@query
def attribution_check(spark, sf_dir):
    return at.attribution_check(events(
        spark, sf_dir, *_LINKS, "attributed_campaign_id", "attributed_ad_id", "conversion_value_usd"))


@query
def ctr_by_format(spark, sf_dir):
    return fu.ctr_by_format(events(spark, sf_dir, "ad_format", "event_type"))


@query
def cvr_by_device(spark, sf_dir):
    return fu.cvr_by_device(events(spark, sf_dir, "device_type", "event_type"))


@query
def geo_share(spark, sf_dir):
    return fu.share_of_total(events(spark, sf_dir, "country", "region", "city"), "country", "region", "city")


@query
def device_share(spark, sf_dir):
    return fu.share_of_total(events(spark, sf_dir, "device_type"), "device_type")


@query
def funnel_mix(spark, sf_dir):
    return fu.share_of_total(events(spark, sf_dir, "event_type"), "event_type")


@query
def session_summary(spark, sf_dir):
    return fu.session_summary(events(
        spark, sf_dir, "session_id", "event_type", "timestamp", "revenue_usd", "conversion_value_usd"))


@query
def auction_summary(spark, sf_dir):
    return fu.auction_summary(events(spark, sf_dir, "ad_format", "bid_price_usd", "win_price_usd"))


@query
def engagement_summary(spark, sf_dir):
    return fu.engagement_summary(events(
        spark, sf_dir, "ad_format", "event_type", "viewability_score", "engagement_duration_ms"))
