"""Small hand-checkable inputs."""

from datetime import datetime

from serpscope import schema as S


def event_rows(spark):
    """Two complete events that pass every check."""
    data = [
        (
            "evt_1", datetime(2026, 7, 15, 12), "usr_abc", "sess_1", "United States",
            "California", "en", "Mobile", "Chrome", "Android", 1, 1, 1, "Snippet", 120.5, 85.0,
            0.15, 0, 0, 45.2, 65.0, "Commercial", "Tech", "python tutorial", 0.15, 92.0,
        ),
        (
            "evt_2", datetime(2026, 7, 15, 13), "usr_xyz", "sess_2", "Japan", "Osaka", "ja",
            "Desktop", "Safari", "macOS", 3, 0, 1, "Images", 95.0, 92.0, 0.45, 0, 1, 0.0, 0.0,
            "Informational", "Finance", "stock prices", 0.0, 78.5,
        ),
    ]
    return spark.createDataFrame(data, S.EVENT_LOG)


def feature_rows(spark):
    data = [
        ("evt_1", datetime(2026, 7, 15, 12), "usr_01", "search text", "Informational", "Tech",
         1, 1, 60.0, 0, 0, 100.0),
        ("evt_2", datetime(2026, 7, 15, 12, 30), "usr_01", "search text", "Informational",
         "Tech", 0, 1, 30.0, 1, 1, 150.0),
        ("evt_3", datetime(2026, 7, 15, 13), "usr_02", "other query", "Commercial", "Finance",
         1, 1, 15.0, 0, 0, 200.0),
    ]
    return spark.createDataFrame(
        data,
        "event_id string, timestamp timestamp_ntz, user_id_masked string, "
        "search_query_masked string, search_intent string, query_category string, clicks int, "
        "impressions int, dwell_time_sec double, pogo_stick_flag int, reformulation_flag int, "
        "latency_ms double",
    )
