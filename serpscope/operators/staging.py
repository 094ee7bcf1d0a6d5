"""Typed staging projections over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serpscope.functions import scalars as X


#: Longest text that the warehouse columns are declared for.
LIMITS = {"gender": 10, "user_segment": 10, "language": 10, "browser_version": 20}
LIMITS |= dict.fromkeys(["search_intent", "device_type", "browser_name", "os_name"], 30)
LIMITS |= dict.fromkeys(["signup_channel", "query_category", "country", "region"], 50)
LIMITS |= dict.fromkeys(
    ["event_id", "user_key", "query_key", "system_key", "geo_key", "session_id", "user_id_masked"],
    64,
)


def _text(name: str, source: str | None = None) -> Column:
    """Whole text: a value cut to the declared length could be mistaken for another."""
    return F.col(source or name).cast("string").alias(name)


def overlong_values(df: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """How many values of each text column are longer than declared."""
    limits = limits or LIMITS
    names = [c for c in df.columns if c in limits]
    counts = df.agg(*[F.count_if(F.length(F.col(c).cast("string")) > limits[c]).alias(c) for c in names])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(limits[c]).alias("declared"), F.col(c).alias("overlong")
        )
        for c in names
    ]
    return counts.select(F.inline(F.array(*rows)))


def _as(name: str, kind: str) -> Column:
    return F.col(name).cast(kind).alias(name)


def stg_search_events(df: DataFrame) -> DataFrame:
    return df.select(
        _text("event_id"),
        _as("event_timestamp", "timestamp_ntz"),
        *[
            _text(c)
            for c in ["user_key", "query_key", "system_key", "geo_key", "session_id"]
        ],
        *[_as(c, "int") for c in ["position", "clicks", "impressions"]],
        *[_as(c, "double") for c in ["latency_ms", "page_speed_score", "bounce_rate"]],
        *[_as(c, "int") for c in ["pogo_stick_flag", "reformulation_flag"]],
        *[
            _as(c, "double")
            for c in ["dwell_time_sec", "revenue_estimate_usd", "search_quality_score"]
        ],
    )


def stg_users(df: DataFrame) -> DataFrame:
    return df.select(
        _text("user_key"),
        _text("user_id_masked"),
        _text("gender"),
        _as("age", "int"),
        _text("signup_channel"),
        _as("signup_timestamp", "timestamp_ntz"),
        _text("user_segment"),
        _as("record_start_timestamp", "timestamp_ntz"),
        _as("record_end_timestamp", "timestamp_ntz"),
        _as("is_current_record", "int"),
    )


def stg_queries(df: DataFrame) -> DataFrame:
    flags = ["is_navigational", "is_informational", "is_transactional", "query_length_words"]
    return df.select(
        _text("query_key"),
        X.normalize_text(F.col("search_query_masked").cast("string")).alias(
            "search_query_masked"
        ),
        _text("search_intent"),
        _text("query_category"),
        *[_as(c, "int") for c in flags],
    )


def stg_systems(df: DataFrame) -> DataFrame:
    return df.select(
        _text("system_key"),
        *[_text(c) for c in ["device_type", "browser_name", "os_name"]],
        _text("browser_version"),
    )


def stg_geography(df: DataFrame) -> DataFrame:
    """Takes the language column under either of its two names."""
    source = "primary_language" if "primary_language" in df.columns else "language"
    return df.select(
        _text("geo_key"),
        _text("country"),
        _text("region"),
        _text("language", source),
    )
