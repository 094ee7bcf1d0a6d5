"""Scalar expressions used by the log, the features and the reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# Whitespace as text splitting usually understands it: ASCII, control separators, Unicode spaces.
WHITESPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"


def word_count(text: Column) -> Column:
    """Whitespace-separated tokens; blank text counts 0, null counts as one token ('None')."""
    words = F.coalesce(text, F.lit("None"))
    trimmed = F.regexp_replace(words, f"^{WHITESPACE}|{WHITESPACE}$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, WHITESPACE))).cast("int")


def intent_flag(intent: Column, name: str) -> Column:
    return F.coalesce((intent == name).cast("int"), F.lit(0))


def normalize_text(text: Column) -> Column:
    return F.lower(F.trim(text))


def event_day(ts: Column) -> Column:
    """Midnight of the day, without zone."""
    return F.to_date(ts).cast("timestamp_ntz")


def date_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def naive_utc(ts: Column) -> Column:
    """Parse to a timestamp without zone; zoned text is brought to UTC."""
    return F.to_timestamp(ts).cast("timestamp_ntz")


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio whose zero denominator counts as 1."""
    return numerator / F.when(denominator == 0, 1).otherwise(denominator)


def quality_score(intent_multiplier: bool = True) -> Column:
    """Composite 0-100 score from rank, reformulation, pogo-sticking and latency."""
    latency = F.col("latency_ms")
    penalty = F.when(latency > 150.0, F.lit(8.0) * F.log(latency / F.lit(150.0))).otherwise(0.0)
    if intent_multiplier:
        factor = F.when(F.col("search_intent") == "Commercial", 1.8).otherwise(1.0)
        penalty = penalty * factor
    raw = (
        F.lit(100.0)
        - F.col("position") * F.lit(2.2)
        - F.col("reformulation_flag") * F.lit(12.0)
        - F.col("pogo_stick_flag") * F.lit(18.0)
        - penalty
    )
    return F.round(clip(raw, 0.0, 100.0), 2)


def zero_without_click(value: Column) -> Column:
    return F.when(F.col("clicks") == 0, F.lit(0.0)).otherwise(value)


# Decimal places kept per metric.
METRIC_DECIMALS = {
    "latency_ms": 2,
    "page_speed_score": 1,
    "bounce_rate": 4,
    "dwell_time_sec": 2,
    "scroll_depth": 1,
    "revenue_estimate_usd": 4,
    "search_quality_score": 2,
}


def rounded_metrics(columns: list[str]) -> dict[str, Column]:
    return {c: F.round(F.col(c), n) for c, n in METRIC_DECIMALS.items() if c in columns}


def gauge_band(score: Column) -> Column:
    return F.when(score < 50, "red").when(score < 75, "amber").otherwise("green")


def score_bucket(score: Column) -> Column:
    return (
        F.when(score >= 90, "Excellent")
        .when(score >= 75, "Good")
        .when(score >= 50, "Fair")
        .otherwise("Poor")
    )
