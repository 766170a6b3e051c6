"""Lines to events: parsing, quarantine and line quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickloom.schema import RAW_EVENT

CORRUPT = "_corrupt_record"
_PARSED = T.StructType(RAW_EVENT.fields + [T.StructField(CORRUPT, T.StringType(), True)])
_TEXT = "_text_"
_TEXTS = T.StructType([T.StructField(f.name, T.StringType(), True) for f in RAW_EVENT.fields] + [T.StructField(CORRUPT, T.StringType(), True)])


def _from_text(field: T.StructField) -> Column:
    """A field of a line with some field of another type than ours: numbers may be text or have a fraction (which is cut off
    where ours are whole); what is no number at all is null."""
    text = F.col(_TEXT + field.name)
    if isinstance(field.dataType, T.StringType):
        return text
    if isinstance(field.dataType, T.DoubleType):
        value = text.try_cast("double")
        return F.when(F.abs(value) < float("inf"), value)
    return text.try_cast("decimal(38,6)").try_cast(field.dataType)


def _line_class() -> Column:
    """blank, empty, malformed or event. The pattern is only tried on lines that set none of the key fields."""
    line = F.col("raw_line")
    nothing_set = F.coalesce("event_id", "event_type", "user_id", "campaign_id", F.col("timestamp").cast("string")).isNull()
    return (
        F.when(line == "", "blank")
        .when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(nothing_set & line.rlike(r"^\{\s*\}$"), "empty")
        .otherwise("event")
    )


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse every line once; keeps the raw text and its class next to the 36 event fields.

    Only what is no JSON object is malformed. A line with a field of another type is parsed again, with all fields as text.

    The parsed struct goes through a generator, not a projection: a filter on its fields cannot be pushed below that,
    where the parser would be run again for every field the filter names.
    """
    parsed = F.from_json("raw_line", _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    texts = F.from_json("raw_line", _TEXTS, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    strict = F.col(CORRUPT).isNull()
    return (
        lines.select(F.trim(F.col(column), F.lit(" \t\r\n")).alias("raw_line"))
        .select("raw_line", F.inline(F.array(parsed)))
        .select("*", F.inline(F.array(F.when(~strict, texts))).alias(*[_TEXT + f.name for f in _TEXTS.fields]))
        .select("raw_line", F.when(~strict, F.col(_TEXT + CORRUPT)).alias(CORRUPT),
                *[F.when(strict, F.col(f.name)).otherwise(_from_text(f)).alias(f.name) for f in RAW_EVENT.fields])
        .select("raw_line", _line_class().alias("line_class"), *[f.name for f in RAW_EVENT.fields])
    )


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("line_class") == "event").drop("raw_line", "line_class")


# Times outside 1970 to 9999 would overflow a timestamp and stop the job.
LAST_TIME_MS = 253_402_300_799_999


def _time_fault(horizon_ms: Column | None) -> Column:
    time = F.col("timestamp")
    latest = F.lit(LAST_TIME_MS) if horizon_ms is None else F.least(horizon_ms, F.lit(LAST_TIME_MS))
    return (
        F.when(time.isNull(), "no_timestamp")
        .when(time < 0, "before_epoch")
        .when(time > latest, "beyond_horizon")
    )


def quarantine_reason(horizon_ms: Column | None = None) -> Column:
    """Why a parsed line yields no usable event (malformed, or no usable time); null for events, blanks and empty objects."""
    return (
        F.when(F.col("line_class") == "malformed", "malformed")
        .when(F.col("line_class") == "event", _time_fault(horizon_ms))
    )


def quarantined(parsed: DataFrame, horizon_ms: Column | None = None) -> DataFrame:
    """Lines that yield no usable event, with the reason."""
    return parsed.select("raw_line", quarantine_reason(horizon_ms).alias("reason")).where(F.col("reason").isNotNull())


def usable(parsed: DataFrame, horizon_ms: Column | None = None) -> DataFrame:
    """The complement of ``quarantined`` among events."""
    return well_formed(parsed).where(_time_fault(horizon_ms).isNull())


def line_quality(lines: DataFrame, column: str = "value") -> DataFrame:
    """How many lines were blank, empty, malformed or events, and the error rate."""
    counts = parse_lines(lines, column).agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.count_if(F.col("line_class") == c).alias(c) for c in ("blank", "empty", "malformed", "event")],
    )
    return counts.select(
        "lines",
        F.col("blank").alias("blank_lines"), F.col("empty").alias("empty_objects"),
        F.col("malformed").alias("events_errors"), F.col("event").alias("events_parsed"),
        (F.col("malformed").cast("double") / F.greatest(F.col("event") + F.col("malformed"), F.lit(1)).cast("double"))
        .alias("error_rate"),
    )
