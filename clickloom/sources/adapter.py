"""Ad events and metric points derived from the benchmark's ``events`` table.

The table holds no ad fields, so those are formed from its ids, types, amounts and times. Rows whose
millisecond stamp is a multiple of 50 are delivered twice (``ingest_seq`` 0, then 1).

Every click is preceded by an impression of the same user and ad, and every other conversion by such a click, at gaps that cover a
link's limits: just too near, nearest, in between (two touches at once), farthest, just too far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.schema import DAY_MS, MONEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TOUCH_GAPS_MS = {
    "click": ((999,), (1_000,), (60_000, 60_000), (300_000,), (300_001,)),
    "purchase": ((359_999,), (360_000,), (DAY_MS, DAY_MS), (7 * DAY_MS,), (7 * DAY_MS + 1,)),
}
_TOUCH_STEP = 1_000_000_000


def _with_touches(base: DataFrame) -> DataFrame:
    """The rows and the touches made for them."""
    src = F.col("src_id")

    def gaps(kind: str) -> Column:
        lists = [F.array(*[F.lit(g).cast("bigint") for g in gap]) for gap in _TOUCH_GAPS_MS[kind]]
        return F.element_at(F.array(*lists), (src % 5 + 1).cast("int"))
    chosen = F.when(F.col("raw_type") == "click", gaps("click")).when(
        (F.col("raw_type") == "purchase") & (src % 2 == 0), gaps("purchase")).otherwise(F.array().cast("array<bigint>"))
    touch = F.when(F.col("raw_type") == "click", "view").otherwise("click")
    made = F.transform(chosen, lambda gap, i: F.struct(
        (src + (i + 1) * F.lit(_TOUCH_STEP)).cast("bigint").alias("src_id"), (F.col("timestamp") - gap).alias("timestamp"), touch.alias("raw_type")))
    rows = F.concat(F.array(F.struct("src_id", "timestamp", "raw_type")), made)
    return base.select("uid", "amount", "k", F.inline(rows))


def _pick(index: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _name(prefix: str, part: Column) -> Column:
    return F.concat(F.lit(prefix), part.cast("string"))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("src_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("raw_type"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ad events as they arrive, re-deliveries included."""
    deliveries = F.sequence(F.lit(0), F.when(F.col("timestamp") % 50 == 0, 1).otherwise(0))
    src, k, kind = F.col("src_id"), F.col("k"), F.col("event_type")
    bid = (F.col("amount") * F.lit(0.01).cast("decimal(2,2)")).cast(MONEY)
    served = kind.isin("impression", "click")
    place = src % 5
    return (
        _with_touches(_base(spark, sf_dir))
        .withColumn(
            "event_type",
            F.when(F.col("raw_type").isin("view", "signup"), "impression")
            .when(F.col("raw_type") == "click", "click")
            .when(F.col("raw_type") == "purchase", "conversion")
            .otherwise("unknown"),
        )
        .select(
            "src_id",
            F.when(src % 97 != 0, _name("evt_", src)).alias("event_id"),
            "event_type",
            "timestamp",
            _name("user_", F.col("uid")).alias("user_id"),
            F.concat(F.lit("session_"), F.col("uid").cast("string"), F.lit("_"),
                     F.floor(F.col("timestamp") / DAY_MS).cast("string")).alias("session_id"),
            F.lit(None).cast("string").alias("ip_address"),
            _name("campaign_", k).alias("campaign_id"),
            _name("adgroup_", k % 25).alias("ad_group_id"),
            _name("ad_", k % 50).alias("ad_id"),
            _name("advertiser_", k % 10).alias("advertiser_id"),
            F.when(src % 20 < 12, "mobile").when(src % 20 < 19, "desktop").otherwise("tablet").alias("device_type"),
            _pick(src % 4, "banner", "video", "native", "popup").alias("ad_format"),
            _name("country_", place).alias("country"),
            _name("region_", place).alias("region"),
            _name("city_", place).alias("city"),
            bid.alias("bid_price_usd"),
            F.when(src % 20 < 17, (F.col("amount") * F.lit(0.008).cast("decimal(4,3)")).cast(MONEY)).alias("win_price_usd"),
            F.when(kind == "click", (F.col("amount") * F.lit(0.02).cast("decimal(2,2)")).cast(MONEY))
            .when(kind == "conversion", F.col("amount").cast(MONEY)).alias("revenue_usd"),
            F.when(kind == "conversion", F.col("amount").cast(MONEY)).alias("conversion_value_usd"),
            F.when(served, (src % 71 + 30).cast("double") / 100).alias("viewability_score"),
            F.when(served, src % 30000 + 100).alias("engagement_duration_ms"),
            F.when(kind == "conversion", _name("campaign_", k)).alias("attributed_campaign_id"),
            F.when(kind == "conversion", _name("ad_", k % 50)).alias("attributed_ad_id"),
            F.explode(deliveries).alias("ingest_seq"),
        )
    )


def ad_events_with_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad events, plus replays of every event 6, 8 and 16 days after it was first sent."""
    shifts = F.array(*[F.lit(days * DAY_MS).cast("bigint") for days in (0, 6, 8, 16)])
    sent = ad_events(spark, sf_dir)
    return (
        sent.withColumn("shift_ms", F.explode(shifts))
        .withColumn("timestamp", F.col("timestamp") + F.col("shift_ms"))
        .drop("shift_ms")
    )


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring samples, one per row of ``events``."""
    raw = F.col("raw_type")
    amount = F.col("amount").cast("decimal(20,4)")
    return _base(spark, sf_dir).select(
        F.col("src_id").alias("point_id"),
        F.when(raw == "click", "ProcessingLatency")
        .when(raw == "view", "EventsPerSecond")
        .when(raw == "error", "ErrorRate")
        .when(raw == "purchase", "RevenuePerHour")
        .otherwise("CPUUtilization").alias("name"),
        F.when(raw == "view", amount * 10000)
        .when(raw == "purchase", amount * 100)
        .when(raw == "error", amount / 10)
        .otherwise(amount).cast("decimal(20,4)").alias("value"),
        "timestamp",
        F.when(raw == "view", "count/sec").when(raw == "click", "ms")
        .when(raw == "purchase", "usd/hour").otherwise("percent").alias("unit"),
        F.create_map(F.lit("k"), F.col("k").cast("string")).alias("dimensions"),
    )
