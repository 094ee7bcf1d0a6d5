"""Schemas, column contracts and fixed values shared by all operators."""

from pyspark.sql import types as T

EVENT_LOG = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("user_id_masked", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("browser_name", T.StringType()),
        T.StructField("os_name", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("clicks", T.IntegerType()),
        T.StructField("impressions", T.IntegerType()),
        T.StructField("serp_features", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("page_speed_score", T.DoubleType()),
        T.StructField("bounce_rate", T.DoubleType()),
        T.StructField("pogo_stick_flag", T.IntegerType()),
        T.StructField("reformulation_flag", T.IntegerType()),
        T.StructField("dwell_time_sec", T.DoubleType()),
        T.StructField("scroll_depth", T.DoubleType()),
        T.StructField("search_intent", T.StringType()),
        T.StructField("query_category", T.StringType()),
        T.StructField("search_query_masked", T.StringType()),
        T.StructField("revenue_estimate_usd", T.DoubleType()),
        T.StructField("search_quality_score", T.DoubleType()),
    ]
)
DATE_PARTS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType()),
    ]
)
PARTITIONED_EVENT_LOG = T.StructType(EVENT_LOG.fields + DATE_PARTS.fields)

# Source table from which the event log is derived when no log files exist.
RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

GEO_ATTRS = ["country", "region", "language"]
SYSTEM_ATTRS = ["device_type", "browser_name", "os_name"]
QUERY_ATTRS = ["search_query_masked", "search_intent", "query_category"]

DIM_GEOGRAPHY = ["geo_key", *GEO_ATTRS]
DIM_SYSTEMS = ["system_key", *SYSTEM_ATTRS, "browser_version"]
DIM_QUERIES = [
    "query_key",
    *QUERY_ATTRS,
    "is_navigational",
    "is_informational",
    "is_transactional",
    "query_length_words",
]
DIM_USERS = [
    "user_key",
    "user_id_masked",
    "gender",
    "age",
    "signup_channel",
    "signup_timestamp",
    "user_segment",
    "record_start_timestamp",
    "record_end_timestamp",
    "is_current_record",
]
FACT = [
    "event_id",
    "event_timestamp",
    "user_key",
    "query_key",
    "system_key",
    "geo_key",
    "session_id",
    "position",
    "clicks",
    "impressions",
    "latency_ms",
    "page_speed_score",
    "bounce_rate",
    "pogo_stick_flag",
    "reformulation_flag",
    "dwell_time_sec",
    "revenue_estimate_usd",
    "search_quality_score",
]

USER_FEATURES = ["user_7d_ctr", "user_30d_avg_dwell_time", "user_pogo_sticking_count"]
QUERY_FEATURES = ["query_avg_ctr", "query_95p_latency_ms", "query_reformulation_rate"]
REQUEST_FEATURES = ["latency_ms", "page_speed_score", "bounce_rate", "position"]
FEATURES = USER_FEATURES + QUERY_FEATURES + REQUEST_FEATURES
LABEL = "search_quality_score"
OUTLIER_FEATURES = ["latency_ms", "bounce_rate", "user_7d_ctr"]

# --- fixed values: allowed sets, bounds, defaults and thresholds -----------------
COUNTRIES = ["United States", "Japan", "United Kingdom", "Germany"]
DEVICES = ["Mobile", "Desktop", "Tablet"]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge"]
OPERATING_SYSTEMS = ["Android", "iOS", "Windows", "macOS", "Linux"]
INTENTS = ["Commercial", "Informational", "Navigational"]
CATEGORIES = ["Tech", "Finance", "Health", "Navigational", "Informational"]
GENDERS = ["Male", "Female", "Non-binary"]
SIGNUP_CHANNELS = ["Organic", "Paid Search", "Social", "Referral", "Email"]
USER_SEGMENTS = ["Heavy", "Medium", "Light"]
SIGNUP_BASE = "2026-01-01 00:00:00"
SIGNUP_SPREAD_DAYS = 150
BROWSER_VERSION = "1.0.0"

COLD_START = {
    "user_7d_ctr": 0.0,
    "user_30d_avg_dwell_time": 0.0,
    "user_pogo_sticking_count": 0,
    "query_avg_ctr": 0.0,
    "query_95p_latency_ms": 100.0,
    "query_reformulation_rate": 0.0,
}
FEATURE_TTL_DAYS = 365
SESSION_GAP_MINUTES = 30
POGO_RETURN_SECONDS = 5
ZSCORE_LIMIT = 3.0
PSI_LIMIT = 0.25
KS_P_LIMIT = 0.05
VIF_LIMIT = 5.0
FRESHNESS_HOURS = 30
P99_LATENCY_LIMIT_MS = 1500.0
KPI_TARGETS = {
    "avg_quality_score": (">", 85.0),
    "avg_dwell_time_sec": (">", 45.0),
    "ctr_at_rank1": (">", 0.35),
    "pogo_stick_rate": ("<", 0.05),
    "reformulation_rate": ("<", 0.12),
}
