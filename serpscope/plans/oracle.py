"""Independent SQL statements of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

LOG = """
raw AS (
  SELECT *, CAST(concat('0x', substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) AS h,
         CAST(props ->> '$.k' AS INTEGER) AS k
  FROM events
),
unscored AS (
  SELECT
    'evt_' || lpad(CAST(event_id AS VARCHAR), 16, '0') AS event_id,
    ts AS "timestamp",
    'usr_' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS user_id_masked,
    'sess_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
    ['United States', 'Japan', 'United Kingdom', 'Germany'][h % 4 + 1] AS country,
    ['California', 'Texas', 'New York', 'Tokyo', 'Osaka', 'Kyoto',
     'Greater London', 'Scotland', 'Wales', 'Bavaria', 'Berlin', 'Hamburg']
      [(h % 4) * 3 + (h // 4) % 3 + 1] AS region,
    CASE WHEN (h // 20) % 10 = 0 THEN 'en'
         ELSE ['en', 'ja', 'en', 'de'][h % 4 + 1] END AS "language",
    CASE WHEN h % 20 < 11 THEN 'Mobile' WHEN h % 20 < 18 THEN 'Desktop'
         ELSE 'Tablet' END AS device_type,
    ['Chrome', 'Safari', 'Firefox', 'Edge'][(h // 20) % 4 + 1] AS browser_name,
    CASE WHEN h % 20 BETWEEN 11 AND 17
         THEN ['Windows', 'macOS', 'Linux'][(h // 4) % 3 + 1]
         ELSE ['Android', 'iOS'][(h // 4) % 2 + 1] END AS os_name,
    CAST(1 + (h // 7) % 10 AS INTEGER) AS position,
    CAST(event_type = 'click' AS INTEGER) AS clicks,
    1 AS impressions,
    ['Featured Snippet', 'Knowledge Graph', 'Local Pack'][(h // 20) % 3 + 1] AS serp_features,
    value AS latency_ms,
    CAST(100 - h % 101 AS DOUBLE) AS page_speed_score,
    CAST(h % 101 AS DOUBLE) / 100e0 AS bounce_rate,
    CAST(event_type = 'error' AS INTEGER) AS pogo_stick_flag,
    CAST(event_type = 'view' AS INTEGER) AS reformulation_flag,
    CASE WHEN event_type = 'click' THEN value ELSE 0e0 END AS dwell_time_sec,
    CASE WHEN event_type = 'click' THEN CAST((h // 20) % 101 AS DOUBLE) ELSE 0e0 END
      AS scroll_depth,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'Commercial'
         WHEN event_type = 'view' THEN 'Navigational' ELSE 'Informational' END AS search_intent,
    ['Tech', 'Finance', 'Health', 'Navigational', 'Informational'][k % 5 + 1] AS query_category,
    'query ' || CAST(k AS VARCHAR) AS search_query_masked,
    CASE WHEN event_type = 'click' THEN value / 100e0 ELSE 0e0 END AS revenue_estimate_usd
  FROM raw
),
log AS (
  SELECT *,
    round(greatest(0e0, least(100e0, 100e0 - position * 2.2e0 - reformulation_flag * 12e0
      - pogo_stick_flag * 18e0
      - (CASE WHEN latency_ms > 150e0 THEN 8e0 * ln(latency_ms / 150e0) ELSE 0e0 END)
        * (CASE WHEN search_intent = 'Commercial' THEN 1.8e0 ELSE 1e0 END))), 2)
      AS search_quality_score
  FROM unscored
)"""

_GEO_KEY = "md5(country || '_' || region || '_' || language)"
_SYS_KEY = "md5(device_type || '_' || browser_name || '_' || os_name)"
_QRY_KEY = "md5(search_query_masked || '_' || search_intent || '_' || query_category)"

FEATURES = f""",
uf AS (
  SELECT user_id_masked, CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) AS event_timestamp,
    CAST(sum(clicks) / (CASE WHEN sum(impressions) = 0 THEN 1 ELSE sum(impressions) END)
      AS FLOAT) AS user_7d_ctr,
    CAST(avg(dwell_time_sec) AS FLOAT) AS user_30d_avg_dwell_time,
    CAST(sum(pogo_stick_flag) AS BIGINT) AS user_pogo_sticking_count
  FROM log GROUP BY 1, 2
),
qf AS (
  SELECT {_QRY_KEY} AS query_key,
    CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) AS event_timestamp,
    CAST(sum(clicks) / (CASE WHEN sum(impressions) = 0 THEN 1 ELSE sum(impressions) END)
      AS FLOAT) AS query_avg_ctr,
    CAST(quantile_cont(latency_ms, 0.95) AS FLOAT) AS query_95p_latency_ms,
    CAST(avg(reformulation_flag) AS FLOAT) AS query_reformulation_rate
  FROM log GROUP BY 1, 2
)"""

FACT = f""",
fact AS (
  SELECT event_id, "timestamp" AS event_timestamp, md5(user_id_masked) AS user_key,
    {_QRY_KEY} AS query_key, {_SYS_KEY} AS system_key, {_GEO_KEY} AS geo_key,
    session_id, position, clicks, impressions, latency_ms, page_speed_score, bounce_rate,
    pogo_stick_flag, reformulation_flag, dwell_time_sec, revenue_estimate_usd,
    search_quality_score
  FROM log
)"""

DIMS = f""",
dim_geography AS (
  SELECT DISTINCT {_GEO_KEY} AS geo_key, country, region, language FROM log
),
dim_systems AS (
  SELECT DISTINCT {_SYS_KEY} AS system_key, device_type, browser_name, os_name,
    '1.0.0' AS browser_version FROM log
),
dim_queries AS (
  SELECT DISTINCT {_QRY_KEY} AS query_key, search_query_masked, search_intent, query_category,
    CAST(search_intent = 'Navigational' AS INTEGER) AS is_navigational,
    CAST(search_intent = 'Informational' AS INTEGER) AS is_informational,
    CAST(search_intent = 'Commercial' AS INTEGER) AS is_transactional,
    CAST(len(string_split_regex(trim(search_query_masked), '\\s+')) AS INTEGER)
      AS query_length_words
  FROM log
),
users_hashed AS (
  SELECT user_id_masked,
    CAST(concat('0x', substr(md5(user_id_masked), 1, 8)) AS BIGINT) AS b
  FROM (SELECT DISTINCT user_id_masked FROM log)
),
dim_users AS (
  SELECT md5(user_id_masked) AS user_key, user_id_masked,
    ['Male', 'Female', 'Non-binary'][b % 3 + 1] AS gender,
    CAST(b % 50 + 18 AS INTEGER) AS age,
    ['Organic', 'Paid Search', 'Social', 'Referral', 'Email'][b % 5 + 1] AS signup_channel,
    TIMESTAMP '2026-01-01' + to_days(CAST(b % 150 AS INTEGER)) AS signup_timestamp,
    ['Heavy', 'Medium', 'Light'][b % 3 + 1] AS user_segment,
    TIMESTAMP '2026-01-01' + to_days(CAST(b % 150 AS INTEGER)) AS record_start_timestamp,
    CAST(NULL AS TIMESTAMP) AS record_end_timestamp,
    1 AS is_current_record
  FROM users_hashed
)"""


def on_log(body: str, *more: str) -> str:
    return "WITH" + LOG + "".join(more) + "\n" + body


CHECKS_SQL = [
    ("event_id", "not_null", "event_id IS NULL"),
    ("timestamp", "not_null", '"timestamp" IS NULL'),
    ("user_id_masked", "not_null", "user_id_masked IS NULL"),
    ("session_id", "not_null", "session_id IS NULL"),
    (
        "country",
        "in_set",
        "country NOT IN ('United States', 'Japan', 'United Kingdom', 'Germany')",
    ),
    ("device_type", "in_set", "device_type NOT IN ('Mobile', 'Desktop', 'Tablet')"),
    (
        "search_intent",
        "in_set",
        "search_intent NOT IN ('Commercial', 'Informational', 'Navigational')",
    ),
    ("clicks", "in_set", "clicks NOT IN (0, 1)"),
    ("impressions", "in_set", "impressions NOT IN (1)"),
    ("position", "between", "position NOT BETWEEN 1 AND 10"),
    ("latency_ms", "between", "latency_ms NOT BETWEEN 0 AND 15000"),
    ("page_speed_score", "between", "page_speed_score NOT BETWEEN 0 AND 100"),
    ("bounce_rate", "between", "bounce_rate NOT BETWEEN 0 AND 1"),
    ("search_quality_score", "between", "search_quality_score NOT BETWEEN 0 AND 100"),
]


def _checks(
    source: str = "log",
    kinds: tuple = ("not_null", "in_set", "between"),
    listed: list[tuple] = CHECKS_SQL,
) -> str:
    parts = []
    for column, kind, broken in listed:
        if kind not in kinds:
            continue
        base = "count(*)" if kind == "not_null" else f'count("{column}")'
        parts.append(
            f"SELECT '{column}' AS column_name, '{kind}' AS check_type, "
            f"count(*) AS element_count, "
            f'count(*) - count("{column}") AS missing_count, '
            f"count(*) FILTER (WHERE {broken}) AS unexpected_count, "
            f"round(CASE WHEN {base} = 0 THEN 0e0 ELSE "
            f"count(*) FILTER (WHERE {broken}) * 100e0 / {base} END, 6) AS unexpected_percent, "
            f"count(*) FILTER (WHERE {broken}) = 0 AS success FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def _describe(source: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count({c}) AS value_count, "
        f"round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, "
        f"round(min(CAST({c} AS DOUBLE)), 6) AS min, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, "
        f"round(max(CAST({c} AS DOUBLE)), 6) AS max FROM {source}"
        for c in columns
    )


_USER_COLS = "user_7d_ctr, user_30d_avg_dwell_time, user_pogo_sticking_count"
_QUERY_COLS = "query_avg_ctr, query_95p_latency_ms, query_reformulation_rate"
_REQUEST_COLS = "latency_ms, page_speed_score, bounce_rate, position"

MATRIX = f""",
entity AS (
  SELECT event_id, user_id_masked, {_QRY_KEY} AS query_key, "timestamp" AS event_timestamp,
    {_REQUEST_COLS}, search_quality_score FROM log
),
with_user AS (
  SELECT e.*, {", ".join("u." + c for c in _USER_COLS.split(", "))}
  FROM entity e ASOF LEFT JOIN uf u
    ON e.user_id_masked = u.user_id_masked AND e.event_timestamp >= u.event_timestamp
),
with_query AS (
  SELECT e.*, {", ".join("q." + c for c in _QUERY_COLS.split(", "))}
  FROM with_user e ASOF LEFT JOIN qf q
    ON e.query_key = q.query_key AND e.event_timestamp >= q.event_timestamp
),
matrix AS (
  SELECT event_id, {_USER_COLS}, {_QUERY_COLS}, {_REQUEST_COLS}, search_quality_score
  FROM with_query
  WHERE user_7d_ctr IS NOT NULL AND query_avg_ctr IS NOT NULL
)"""

_SUMS = (
    "count(*) AS events, sum(clicks) AS clicks, sum(impressions) AS impressions, "
    "round(sum(latency_ms), 6) AS latency_sum, round(sum(search_quality_score), 6) AS score_sum, "
    "sum(pogo_stick_flag) AS pogo_sticks, sum(reformulation_flag) AS reformulations, "
    "round(sum(revenue_estimate_usd), 6) AS revenue_sum"
)
_RATES = (
    "round(sum(clicks) / CAST(greatest(1, sum(impressions)) AS DOUBLE), 6) AS ctr, "
    "round(round(sum(latency_ms), 6) / count(*), 6) AS avg_latency_ms, "
    "round(round(sum(search_quality_score), 6) / count(*), 6) AS avg_quality_score, "
    "round(sum(pogo_stick_flag) / CAST(count(*) AS DOUBLE), 6) AS pogo_stick_rate, "
    "round(sum(reformulation_flag) / CAST(count(*) AS DOUBLE), 6) AS reformulation_rate"
)
_SESSIONS = """,
gaps AS (
  SELECT *, CASE WHEN lag("timestamp") OVER w IS NULL
      OR "timestamp" - lag("timestamp") OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens
  FROM log WINDOW w AS (PARTITION BY user_id_masked ORDER BY "timestamp", event_id)
),
sessions AS (
  SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id_masked ORDER BY "timestamp", event_id
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_seq
  FROM gaps
)"""

# Fixed dates used by the registered queries on the sample period (January 2024).
CUT = "2024-01-16 00:00:00"
AS_OF = "2024-01-20 12:00:00"
FRESH_AS_OF = "2024-02-01 12:00:00"
#: The day at which the second of two runs begins, and which reports they keep.
KEPT_DAY = "2024-01-21"
KEPT = {
    "daily_volume": "daily_volume",
    "score_histogram": "score_histogram",
    "daily_metrics_mart": "daily_mart",
    "segment_metrics": "segments",
    "rolling_7d_30d": "rolling",
    "kpi_change_24h": "score_change",
}
WATERMARK_CUT = "2024-01-21 06:00:00"
INCIDENT_DAY = "2024-01-15"

_HOURS = "date_trunc('hour', \"timestamp\") AS hour"


def _dups(table: str, key: str) -> str:
    return f"SELECT {key}, count(*) AS occurrences FROM {table} GROUP BY 1 HAVING count(*) > 1"


def _rolling() -> str:
    columns = []
    for n in (7, 30):
        over = (
            "OVER (PARTITION BY user_id_masked ORDER BY day RANGE BETWEEN "
            f"INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW)"
        )
        for name, top, bottom in [
            ("ctr", "clicks", "impressions"),
            ("latency_ms", "latency_sum", "events"),
            ("pogo_rate", "pogo_sticks", "events"),
            ("reformulation_rate", "reformulations", "events"),
        ]:
            columns.append(
                f"round(round(CAST(sum({top}) {over} AS DOUBLE), 6) / "
                f"CAST(greatest(1, sum({bottom}) {over}) AS DOUBLE), 6) AS {name}_roll_{n}d"
            )
    return (
        f'SELECT user_id_masked, day, {", ".join(columns)} FROM (SELECT user_id_masked, '
        f'CAST("timestamp" AS DATE) AS day, {_SUMS} FROM log GROUP BY 1, 2)'
    )


_PSI_COLUMNS = [
    "latency_ms",
    "page_speed_score",
    "bounce_rate",
    "position",
    "search_quality_score",
]


def _long() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT CASE WHEN \"timestamp\" >= TIMESTAMP '{CUT}' THEN 'current' ELSE 'baseline' END "
        f"AS period, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM log"
        for c in _PSI_COLUMNS
    )


PSI = f""",
longform AS ({_long()}),
edges AS (
  SELECT feature, min(value) AS lo, max(value) AS hi FROM longform
  WHERE period = 'baseline' GROUP BY 1
),
binned AS (
  SELECT l.feature, l.period,
    greatest(0, least(9, CAST(floor((value - lo) / ((hi - lo) / 10)) AS INTEGER))) AS bin
  FROM longform l JOIN edges e ON l.feature = e.feature
),
shares AS (
  SELECT feature,
    greatest(1e-6, CAST(b AS DOUBLE) / sum(b) OVER (PARTITION BY feature)) AS p,
    greatest(1e-6, CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY feature)) AS q
  FROM (SELECT feature, bin, count(*) FILTER (WHERE period = 'baseline') AS b,
          count(*) FILTER (WHERE period = 'current') AS c FROM binned GROUP BY 1, 2)
),
psi AS (
  SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM shares GROUP BY 1
)"""

KS = """,
vc AS (
  SELECT feature, value, count(*) FILTER (WHERE period = 'baseline') AS b,
    count(*) FILTER (WHERE period = 'current') AS c FROM longform GROUP BY 1, 2
),
cums AS (
  SELECT feature, sum(b) OVER w AS ub, sum(c) OVER w AS uc,
    sum(b) OVER (PARTITION BY feature) AS nb, sum(c) OVER (PARTITION BY feature) AS nc
  FROM vc WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)
),
dist AS (
  SELECT feature, max(abs(CAST(ub AS DOUBLE) / CAST(nb AS DOUBLE)
      - CAST(uc AS DOUBLE) / CAST(nc AS DOUBLE))) AS d,
    CAST(max(nb) AS DOUBLE) * CAST(max(nc) AS DOUBLE)
      / (CAST(max(nb) AS DOUBLE) + CAST(max(nc) AS DOUBLE)) AS n
  FROM cums GROUP BY 1
),
ks AS (
  SELECT feature, d, CASE WHEN d * sqrt(n) < 0.2e0 THEN 1e0 ELSE
    greatest(0e0, least(1e0, 2 * list_sum(list_transform(range(1, 101), lambda k:
      (CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END) * exp(-2e0 * k * k * d * d * n))))) END AS p
  FROM dist
)"""

SCD2 = """,
profiles AS (
  SELECT user_id_masked, gender, age, signup_channel, signup_timestamp, user_segment,
    CAST(concat('0x', substr(md5(user_id_masked), 1, 8)) AS BIGINT) AS b FROM dim_users
),
versions AS (
  SELECT user_id_masked, gender, age, signup_channel, signup_timestamp, user_segment,
    TIMESTAMP '2023-01-01' AS record_start_timestamp,
    CASE WHEN b % 3 = 0 THEN TIMESTAMP '2024-01-16' END AS record_end_timestamp,
    CASE WHEN b % 3 = 0 THEN 0 ELSE 1 END AS is_current_record
  FROM profiles
  UNION ALL
  SELECT user_id_masked, gender, age, signup_channel, signup_timestamp, 'Light',
    TIMESTAMP '2024-01-16', NULL, 1
  FROM profiles WHERE b % 3 = 0
)"""

_ALERTS = """,
overall AS (
  SELECT hour, 1 - score / avg(score) OVER (ORDER BY hour RANGE BETWEEN
      INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS fall, p99
  FROM (SELECT date_trunc('hour', "timestamp") AS hour,
          round(sum(search_quality_score), 6) / count(*) AS score,
          quantile_cont(latency_ms, 0.99) AS p99 FROM log GROUP BY 1)
),
seg AS (
  SELECT country, device_type, hour, 1 - score / avg(score) OVER (
      PARTITION BY country, device_type ORDER BY hour
      RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS fall
  FROM (SELECT country, device_type, date_trunc('hour', "timestamp") AS hour,
          round(sum(search_quality_score), 6) / count(*) AS score FROM log GROUP BY 1, 2, 3)
),
islands AS (
  SELECT *, epoch_us(hour) // 3600000000
      - row_number() OVER (PARTITION BY country, device_type ORDER BY hour) AS island
  FROM seg WHERE fall > 0.02
)"""

_LINEUP = """,
target AS (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id)
    AS session_event_sequence
  FROM fact WHERE event_timestamp <= TIMESTAMP '2024-01-21 06:00:00'
),
fresh AS (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id)
    AS session_event_sequence
  FROM fact WHERE event_timestamp > (SELECT max(event_timestamp) FROM target)
)"""

_STAR_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS {{count}}{{extra_{t}}} FROM {s}"
    for t, s in [
        ("dim_geography", "dim_geography"),
        ("dim_systems", "dim_systems"),
        ("dim_queries", "dim_queries"),
        ("dim_users", "dim_users"),
        ("fct_search_events", "fact"),
    ]
)


def _star_counts(count: str, keys: bool = False) -> str:
    sample = {
        "dim_geography": "geo_key",
        "dim_systems": "system_key",
        "dim_queries": "query_key",
        "dim_users": "user_key",
        "fct_search_events": "event_id",
    }
    extra = {
        f"extra_{t}": f", min({k}) AS sample_key" if keys else "" for t, k in sample.items()
    }
    return _STAR_COUNTS.format(count=count, **extra)


_REQUESTS = f""",
cut_uf AS (SELECT * FROM uf WHERE event_timestamp <= TIMESTAMP '2024-01-15'),
cut_qf AS (SELECT * FROM qf WHERE event_timestamp <= TIMESTAMP '2024-01-15'),
ulast AS (
  SELECT user_id_masked, {", ".join(f"arg_max({c}, event_timestamp) AS {c}" for c in _USER_COLS.split(", "))}
  FROM cut_uf GROUP BY 1
),
qlast AS (
  SELECT query_key, {", ".join(f"arg_max({c}, event_timestamp) AS {c}" for c in _QUERY_COLS.split(", "))}
  FROM cut_qf GROUP BY 1
),
looked AS (
  SELECT e.event_id, e.user_id_masked, e.query_key, {_USER_COLS}, {_QUERY_COLS}
  FROM (SELECT event_id, user_id_masked, {_QRY_KEY} AS query_key FROM log) e
  LEFT JOIN ulast u ON e.user_id_masked = u.user_id_masked
  LEFT JOIN qlast q ON e.query_key = q.query_key
)"""


def statements() -> dict[str, str]:
    log_cols = 'SELECT * FROM log'
    sql: dict[str, str] = {}

    # sources and sinks
    sql["scan_events"] = on_log(log_cols)
    sql["scan_pruned"] = on_log('SELECT event_id, "timestamp", latency_ms FROM log')
    sql["write_date_partitioned"] = on_log(
        "SELECT year(\"timestamp\") AS year, strftime(\"timestamp\", '%m') AS month, "
        "strftime(\"timestamp\", '%d') AS day, count(*) AS row_count, "
        "round(sum(latency_ms), 6) AS latency_sum FROM log GROUP BY 1, 2, 3"
    ).replace("SELECT year(", "SELECT CAST(year(").replace(
        "\"timestamp\") AS year,", "\"timestamp\") AS INTEGER) AS year,"
    )
    sql["write_feature_table"] = on_log("SELECT * FROM uf", FEATURES)
    sql["load_warehouse_counts"] = on_log(_star_counts("loaded_rows"), FACT, DIMS)
    sql["dry_run_summary"] = on_log(_star_counts("row_count", keys=True), FACT, DIMS)
    sql["fact_month_partitions"] = on_log(
        "SELECT strftime(event_timestamp, '%Y-%m') AS event_month, count(*) AS row_count "
        "FROM fact GROUP BY 1",
        FACT,
    )
    sql["load_all_or_nothing"] = on_log(_star_counts("loaded_rows"), FACT, DIMS)
    sql["full_refresh"] = on_log(_star_counts("loaded_rows"), FACT, DIMS)
    sql["dq_report_sink"] = on_log(_checks())

    # staging and core
    sql["stg_search_events"] = on_log("SELECT * FROM fact", FACT)
    sql["stg_users"] = on_log("SELECT * FROM dim_users", DIMS)
    sql["stg_queries"] = on_log(
        "SELECT * REPLACE (lower(trim(search_query_masked)) AS search_query_masked) "
        "FROM dim_queries",
        DIMS,
    )
    sql["stg_systems"] = on_log("SELECT * FROM dim_systems", DIMS)
    sql["stg_geography"] = on_log("SELECT * FROM dim_geography", DIMS)
    sql["core_dim_passthrough"] = on_log("SELECT * FROM dim_geography", DIMS)
    lagged = (
        "SELECT e.event_id, "
        + ", ".join(
            f"CASE WHEN e.event_timestamp - u.event_timestamp <= INTERVAL 3 DAY THEN u.{c} END "
            f"AS {c}"
            for c in _USER_COLS.split(", ")
        )
        + " FROM entity e ASOF LEFT JOIN uf u ON e.user_id_masked = u.user_id_masked "
        "AND e.event_timestamp >= u.event_timestamp + INTERVAL 1 DAY"
    )
    sql["asof_leak_free"] = on_log(lagged, FEATURES, MATRIX)
    sql["drop_incomplete_rows"] = on_log(
        f"SELECT * FROM ({lagged}) WHERE user_7d_ctr IS NOT NULL", FEATURES, MATRIX
    )
    sql["core_dim_systems"] = sql["stg_systems"]
    sql["core_dim_queries"] = sql["stg_queries"]
    sql["core_dim_users"] = sql["stg_users"]
    sql["sample_n"] = on_log(
        "SELECT event_id, latency_ms FROM log ORDER BY md5('42' || event_id), event_id LIMIT 5000"
    )
    sql["normalize_naive_ts"] = on_log(
        'SELECT event_id, date_trunc(\'second\', "timestamp") - INTERVAL 9 HOUR '
        "AS event_timestamp FROM log"
    )
    sql["rename_reorder"] = on_log("SELECT * FROM fact", FACT)
    sql["constant_columns"] = on_log(
        "SELECT user_id_masked, record_end_timestamp, is_current_record FROM dim_users", DIMS
    )
    sql["feature_vector"] = on_log(
        "SELECT event_id, "
        + ", ".join(
            f"CAST({c} AS FLOAT) AS {c}"
            for c in f"{_USER_COLS}, {_QUERY_COLS}, {_REQUEST_COLS}".split(", ")
        )
        + " FROM matrix",
        FEATURES,
        MATRIX,
    )
    sql["request_validation"] = on_log(
        "SELECT event_id, CASE WHEN length(user_id_masked) >= 1 AND "
        "length(search_query_masked) >= 1 AND latency_ms - 100 >= 0 AND "
        "page_speed_score BETWEEN 0 AND 100 AND bounce_rate BETWEEN 0 AND 1 AND position >= 1 "
        "THEN 'valid' ELSE 'rejected' END AS status FROM log"
    )

    # joins
    sql["fact_geo_key"] = on_log(f"SELECT event_id, {_GEO_KEY} AS geo_key FROM log")
    sql["fact_system_key"] = on_log(f"SELECT event_id, {_SYS_KEY} AS system_key FROM log")
    sql["fact_query_key"] = on_log(f"SELECT event_id, {_QRY_KEY} AS query_key FROM log")
    sql["fact_user_key"] = on_log("SELECT event_id, md5(user_id_masked) AS user_key FROM log")
    sql["build_fact"] = on_log("SELECT * FROM fact", FACT)
    sql["build_fact_in_place"] = on_log("SELECT * FROM fact", FACT)
    sql["join_agg_with_quantile"] = on_log(
        "SELECT a.query_key, a.day, a.clicks, a.impressions, b.p95 FROM "
        f'(SELECT {_QRY_KEY} AS query_key, CAST("timestamp" AS DATE) AS day, '
        "CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(impressions) AS BIGINT) AS impressions "
        "FROM log GROUP BY 1, 2) a JOIN "
        f'(SELECT {_QRY_KEY} AS query_key, CAST("timestamp" AS DATE) AS day, '
        "round(quantile_cont(latency_ms, 0.95), 6) AS p95 FROM log GROUP BY 1, 2) b "
        "ON a.query_key = b.query_key AND a.day = b.day"
    )
    sql["asof_user_features"] = on_log(
        f"SELECT event_id, {_USER_COLS} FROM with_user", FEATURES, MATRIX
    )
    sql["asof_query_features"] = on_log(
        f"SELECT e.event_id, {_QUERY_COLS} FROM entity e ASOF LEFT JOIN qf q "
        "ON e.query_key = q.query_key AND e.event_timestamp >= q.event_timestamp",
        FEATURES,
        MATRIX,
    )
    sql["training_matrix"] = on_log("SELECT * FROM matrix", FEATURES, MATRIX)
    sql["training_matrix_weighted"] = on_log(
        "SELECT m.*, n.multiplicity FROM matrix m JOIN (SELECT event_id, count(*) OVER (PARTITION "
        "BY user_id_masked, query_key, date_trunc('hour', event_timestamp)) AS multiplicity "
        "FROM entity) n ON m.event_id = n.event_id",
        FEATURES,
        MATRIX,
    )
    sql["online_lookup"] = on_log("SELECT * FROM looked", FEATURES, _REQUESTS)
    sql["online_lookup_clustered"] = sql["online_lookup"]
    sql["cold_start_defaults"] = on_log(
        "SELECT event_id, user_id_masked, query_key, "
        + ", ".join(
            f"coalesce({c}, {d}) AS {c}"
            for c, d in [
                ("user_7d_ctr", 0),
                ("user_30d_avg_dwell_time", 0),
                ("user_pogo_sticking_count", 0),
                ("query_avg_ctr", 0),
                ("query_95p_latency_ms", 100),
                ("query_reformulation_rate", 0),
            ]
        )
        + " FROM looked",
        FEATURES,
        _REQUESTS,
    )
    for key, dim in [
        ("geo_key", "dim_geography"),
        ("system_key", "dim_systems"),
        ("query_key", "dim_queries"),
        ("user_key", "dim_users"),
    ]:
        # The dimension under test lacks the members first seen from the cut on.
        sql[f"fk_orphans_{key.removesuffix('_key')}"] = on_log(
            f"SELECT event_id, {key} FROM fact WHERE {key} NOT IN "
            f"(SELECT {key} FROM fact WHERE event_timestamp < TIMESTAMP '2024-01-02')",
            FACT,
        )
        sql[f"unique_key_{dim}"] = on_log(_dups(dim, key), DIMS)
    sql["unique_key_fct_search_events"] = on_log(_dups("fact", "event_id"), FACT)
    sql["unique_key_sessions"] = on_log(_dups("fact", "session_id"), FACT)
    sql["relationships"] = on_log(
        "\nUNION ALL\n".join(
            f"SELECT '{k}' AS key_name, count(*) AS orphan_count FROM fact "
            f"WHERE {k} NOT IN (SELECT {k} FROM {d})"
            for k, d in [
                ("geo_key", "dim_geography"),
                ("system_key", "dim_systems"),
                ("query_key", "dim_queries"),
                ("user_key", "dim_users"),
            ]
        ),
        FACT,
        DIMS,
    )
    sql["not_null_keys"] = on_log(
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, '{k}' AS key_name, count(*) - count({k}) AS null_count "
            f"FROM {s}"
            for t, s, k in [
                ("dim_geography", "dim_geography", "geo_key"),
                ("dim_systems", "dim_systems", "system_key"),
                ("dim_queries", "dim_queries", "query_key"),
                ("dim_users", "dim_users", "user_key"),
                ("fct_search_events", "fact", "event_id"),
                ("fct_search_events", "fact", "user_key"),
                ("fct_search_events", "fact", "query_key"),
                ("fct_search_events", "fact", "system_key"),
                ("fct_search_events", "fact", "geo_key"),
            ]
        ),
        FACT,
        DIMS,
    )

    # aggregates
    sql["user_daily_features"] = on_log("SELECT * FROM uf", FEATURES)
    sql["query_daily_features"] = on_log("SELECT * FROM qf", FEATURES)
    sql["exact_quantile"] = on_log(
        "SELECT country, round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms "
        "FROM log GROUP BY 1"
    )
    sql["safe_ctr"] = on_log(
        "SELECT user_id_masked, round(CASE WHEN i = 0 THEN c ELSE c / i END, 6) AS ctr FROM "
        "(SELECT user_id_masked, CAST(sum(CASE WHEN position = 1 THEN clicks ELSE 0 END) AS "
        "DOUBLE) AS c, sum(CASE WHEN position = 1 THEN impressions ELSE 0 END) AS i "
        "FROM log GROUP BY 1)"
    )
    sql["kpi_overview"] = on_log(
        "SELECT count(*) AS total_queries, round(avg(search_quality_score), 6) AS "
        "avg_quality_score, round(avg(latency_ms), 6) AS avg_latency_ms, "
        "round(avg(bounce_rate), 6) AS avg_bounce_rate FROM log"
    )
    sql["daily_volume"] = on_log(
        "SELECT CAST(d.day AS DATE) AS day, count(x.event_id) AS volume FROM "
        '(SELECT unnest(generate_series(min(CAST("timestamp" AS DATE)), '
        'max(CAST("timestamp" AS DATE)), INTERVAL 1 DAY)) AS day FROM log) d LEFT JOIN '
        'log x ON CAST(x."timestamp" AS DATE) = d.day GROUP BY 1'
    )
    sql["score_histogram"] = on_log(
        "SELECT bin, bin * 2e0 AS bin_start, count(*) AS row_count FROM (SELECT "
        "greatest(0, least(49, CAST(floor(search_quality_score / 2e0) AS INTEGER))) AS bin "
        "FROM log) GROUP BY 1"
    )
    sql["describe_user_features"] = on_log(
        _describe("uf", _USER_COLS.split(", ")), FEATURES
    )
    sql["describe_query_features"] = on_log(
        _describe("qf", _QUERY_COLS.split(", ")), FEATURES
    )
    sql["dim_distinct"] = on_log(
        "SELECT DISTINCT device_type, browser_name, os_name FROM log"
    )
    for name, table, key, cols in [
        ("latest_user_snapshot", "uf", "user_id_masked", _USER_COLS),
        ("latest_query_snapshot", "qf", "query_key", _QUERY_COLS),
    ]:
        sql[name] = on_log(
            f"SELECT {key}, max(event_timestamp) AS event_timestamp, "
            + ", ".join(f"arg_max({c}, event_timestamp) AS {c}" for c in cols.split(", "))
            + f" FROM {table} WHERE event_timestamp <= TIMESTAMP '{AS_OF}' GROUP BY 1",
            FEATURES,
        )
    sql["high_watermark"] = on_log(
        "SELECT max(event_timestamp) AS high_watermark FROM fact", FACT
    )
    stats = (
        "count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS "
        "successful_expectations, count(*) FILTER (WHERE NOT success) AS "
        "unsuccessful_expectations, round(count(*) FILTER (WHERE success) * 100e0 / count(*), 6) "
        "AS success_percent"
    )
    sql["dq_statistics"] = on_log(f"SELECT {stats} FROM ({_checks()})")
    sql["dq_summary"] = on_log(
        "SELECT bool_and(success) AS validation_success, max(element_count) AS "
        f"total_records_validated, {stats} FROM ({_checks()})"
    )
    sql["dimension_cardinalities"] = on_log(
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS dimension, count(*) AS members FROM {t}"
            for t in ["dim_geography", "dim_systems", "dim_queries", "dim_users"]
        ),
        DIMS,
    )
    sql["entity_snapshot_count"] = on_log(
        "SELECT 'user_features' AS feature_table, count(*) AS snapshots FROM uf UNION ALL "
        "SELECT 'query_features', count(*) FROM qf",
        FEATURES,
    )
    sql["session_event_sequence"] = on_log(
        "SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, "
        "event_id) AS session_event_sequence FROM fact",
        FACT,
    )
    sql["first_n"] = on_log(
        "SELECT * FROM uf ORDER BY user_id_masked, event_timestamp LIMIT 100", FEATURES
    )
    sql["union_daily_batches"] = on_log(
        'SELECT event_id, "timestamp", latency_ms FROM log'
    )

    # scalars
    sql["surrogate_key"] = on_log(
        "SELECT event_id, md5(coalesce(nullif(country, 'Japan'), 'None') || '_' || region) "
        "AS place_key FROM log"
    )
    sql["user_key"] = on_log(
        "SELECT DISTINCT user_id_masked, md5(user_id_masked) AS user_key FROM log"
    )
    sql["hash_bucket"] = on_log(
        "SELECT event_id, CAST(concat('0x', substr(md5(event_id), 1, 8)) AS BIGINT) AS bucket "
        "FROM log"
    )
    sql["derived_user_profile"] = on_log(
        "SELECT user_id_masked, gender, age, signup_channel, signup_timestamp, user_segment "
        "FROM dim_users",
        DIMS,
    )
    sql["query_word_count"] = (
        "SELECT doc_id, CAST(len(list_filter(string_split_regex(text, "
        "'[\\s\\x0B\\x1C-\\x1F\\x85\\pZ]+'), lambda x: x <> '')) "
        "AS INTEGER) AS words FROM documents"
    )
    sql["intent_flags"] = on_log(
        "SELECT event_id, CAST(search_intent = 'Navigational' AS INTEGER) AS is_navigational, "
        "CAST(search_intent = 'Informational' AS INTEGER) AS is_informational, "
        "CAST(search_intent = 'Commercial' AS INTEGER) AS is_transactional FROM log"
    )
    sql["normalize_text"] = (
        "SELECT conv_id, turn, md5(lower(trim(text))) AS text_md5 FROM conversations"
    )
    sql["event_date"] = on_log(
        'SELECT event_id, CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) AS event_day FROM log'
    )
    sql["date_parts"] = (
        "SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year, "
        "strftime(l_shipdate, '%m') AS month, strftime(l_shipdate, '%d') AS day FROM lineitem"
    )
    sql["clip_score"] = (
        "SELECT c_custkey, greatest(0e0, least(100e0, c_acctbal / 50e0)) AS clipped FROM customer"
    )
    sql["quality_score"] = on_log("SELECT event_id, search_quality_score FROM log")
    sql["quality_score_flat"] = on_log(
        "SELECT event_id, round(greatest(0e0, least(100e0, 100e0 - position * 2.2e0 "
        "- reformulation_flag * 12e0 - pogo_stick_flag * 18e0 - CASE WHEN latency_ms > 150e0 "
        "THEN 8e0 * ln(latency_ms / 150e0) ELSE 0e0 END)), 2) AS search_quality_score FROM log"
    )
    sql["round_metrics"] = on_log(
        "SELECT event_id, round(latency_ms, 2) AS latency_ms, round(page_speed_score, 1) AS "
        "page_speed_score, round(bounce_rate, 4) AS bounce_rate, round(dwell_time_sec, 2) AS "
        "dwell_time_sec, round(scroll_depth, 1) AS scroll_depth, "
        "round(revenue_estimate_usd, 4) AS revenue_estimate_usd, "
        "round(search_quality_score, 2) AS search_quality_score FROM log"
    )
    sql["no_click_zeroing"] = on_log(
        "SELECT event_id, CASE WHEN clicks = 0 THEN 0e0 ELSE latency_ms END AS dwell_time_sec "
        "FROM log"
    )
    sql["score_gauge_band"] = on_log(
        "SELECT event_id, CASE WHEN search_quality_score < 50 THEN 'red' WHEN "
        "search_quality_score < 75 THEN 'amber' ELSE 'green' END AS band FROM log"
    )
    sql["score_bucket"] = on_log(
        "SELECT event_id, CASE WHEN search_quality_score >= 90 THEN 'Excellent' WHEN "
        "search_quality_score >= 75 THEN 'Good' WHEN search_quality_score >= 50 THEN 'Fair' "
        "ELSE 'Poor' END AS bucket FROM log"
    )
    sql["mask_pii"] = on_log(
        "SELECT event_id, sha256('pepper' || user_id_masked) AS user_hash FROM log"
    )

    # data quality
    sql["expect_not_null"] = on_log(_checks(kinds=("not_null",)))
    sql["expect_in_set"] = on_log(_checks(kinds=("in_set",)))
    sql["expect_between"] = on_log(_checks(kinds=("between",)))
    sql["validate_events"] = on_log(_checks())
    damaged = (
        ",\ndamaged AS (SELECT * REPLACE (nullif(country, 'Japan') AS country, "
        "CASE WHEN position > 8 THEN 11 ELSE position END AS position, "
        "latency_ms - 100e0 AS latency_ms) FROM log)"
    )
    sql["validation_failures"] = on_log(
        "SELECT column_name, check_type, unexpected_count FROM "
        f"({_checks('damaged')}) WHERE NOT success",
        damaged,
    )
    broken = " OR ".join(f"coalesce({b}, false)" for _, _, b in CHECKS_SQL)
    sql["dq_gate"] = on_log(f"SELECT * FROM damaged WHERE NOT ({broken})", damaged)
    rules = [
        ("position_range", "position BETWEEN 1 AND 10"),
        ("clicks_binary", "clicks IN (0, 1)"),
        ("impressions_one", "impressions = 1"),
        ("latency_nonnegative", "latency_ms >= 0"),
        ("page_speed_range", "page_speed_score BETWEEN 0 AND 100"),
        ("bounce_range", "bounce_rate BETWEEN 0 AND 1"),
        ("pogo_binary", "pogo_stick_flag IN (0, 1)"),
        ("reformulation_binary", "reformulation_flag IN (0, 1)"),
        ("dwell_nonnegative", "dwell_time_sec >= 0"),
        ("revenue_nonnegative", "revenue_estimate_usd >= 0"),
        ("score_range", "search_quality_score BETWEEN 0 AND 100"),
    ]
    sql["check_constraints"] = on_log(
        "\nUNION ALL\n".join(
            f"SELECT '{n}' AS constraint_name, "
            f"count(*) FILTER (WHERE NOT coalesce({r}, false)) AS violations FROM damaged"
            for n, r in rules
        ),
        damaged,
    )
    sql["check_dim_constraints"] = on_log(
        "SELECT 'navigational_binary' AS constraint_name, count(*) FILTER (WHERE "
        "is_navigational NOT IN (0, 1)) AS violations FROM dim_queries UNION ALL "
        "SELECT 'informational_binary', count(*) FILTER (WHERE is_informational NOT IN (0, 1)) "
        "FROM dim_queries UNION ALL SELECT 'transactional_binary', count(*) FILTER (WHERE "
        "is_transactional NOT IN (0, 1)) FROM dim_queries UNION ALL SELECT "
        "'query_length_positive', count(*) FILTER (WHERE query_length_words <= 0) FROM "
        "dim_queries UNION ALL SELECT 'current_binary', count(*) FILTER (WHERE "
        "is_current_record NOT IN (0, 1)) FROM dim_users",
        DIMS,
    )

    # dimensional model
    for name in ["dim_geography", "dim_systems", "dim_queries", "dim_users"]:
        sql[name] = on_log(f"SELECT * FROM {name}", DIMS)
    sql["fct_search_events"] = sql["session_event_sequence"]
    sql["incremental_fact"] = on_log(
        "SELECT * FROM target UNION ALL SELECT * FROM fresh", FACT, _LINEUP
    )
    sql["load_incremental"] = sql["incremental_fact"]
    moved = _LINEUP + """,
moved AS (
  SELECT * REPLACE (event_timestamp + INTERVAL 60 DAY AS event_timestamp)
    FROM fact WHERE event_timestamp <= TIMESTAMP '2024-01-21 06:00:00'
    AND CAST(concat('0x', substr(md5(event_id), 1, 8)) AS BIGINT) % 7 = 0
    AND event_timestamp + INTERVAL 60 DAY > (SELECT max(event_timestamp) FROM target)
)"""
    sql["load_incremental_moved"] = on_log(
        "SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM moved) UNION ALL "
        "SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) "
        "AS session_event_sequence FROM moved",
        FACT,
        moved,
    )
    sql["load_incremental_days"] = on_log(
        "SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS row_count, "
        "max(event_timestamp) AS newest FROM fact GROUP BY 1",
        FACT,
    )
    sql["incremental_continue"] = on_log(
        "SELECT f.event_id, f.session_id, f.session_event_sequence + coalesce(t.n, 0) AS "
        "session_event_sequence FROM fresh f LEFT JOIN (SELECT session_id, "
        "max(session_event_sequence) AS n FROM target GROUP BY 1) t USING (session_id)",
        FACT,
        _LINEUP,
    )
    sql["late_rows_dropped"] = on_log(
        "SELECT count(*) AS late_rows FROM fact WHERE event_timestamp IS NULL OR "
        "event_timestamp <= (SELECT max(event_timestamp) FROM target)",
        FACT,
        _LINEUP,
    )
    sql["current_users"] = on_log(
        "SELECT * FROM dim_users WHERE is_current_record = 1", DIMS
    )
    sql["train_test_split"] = on_log(
        "SELECT event_id, CASE WHEN CAST(concat('0x', substr(md5(event_id), 1, 8)) AS BIGINT) "
        "% 100 < 80 THEN 'train' ELSE 'test' END AS split FROM log"
    )
    sql["regression_metrics"] = on_log(
        "SELECT round(avg(abs(y - p)), 6) AS mae, round(1 - sum((y - p) * (y - p)) / "
        "(sum(y * y) - sum(y) * sum(y) / count(*)), 6) AS r2, count(*) AS row_count FROM "
        "(SELECT search_quality_score AS y, 100e0 - 2.2e0 * position AS p FROM log)"
    )

    # reports and monitoring
    sql["sessionize"] = on_log(
        "SELECT event_id, user_id_masked, \"timestamp\", session_seq FROM sessions", _SESSIONS
    )
    sql["session_metrics"] = on_log(
        "SELECT user_id_masked, session_seq, count(*) AS events, CAST(sum(clicks) AS BIGINT) AS "
        'clicks, epoch_us(max("timestamp")) - epoch_us(min("timestamp")) AS duration_us, '
        "CAST(count(*) = 1 AS INTEGER) AS bounced, round(avg(reformulation_flag), 6) AS "
        "reformulation_rate FROM sessions GROUP BY 1, 2",
        _SESSIONS,
    )
    sql["derive_pogo_reformulation"] = on_log(
        'SELECT event_id, coalesce(CAST(clicks = 1 AND lead("timestamp") OVER w - "timestamp" '
        "< INTERVAL 5 SECOND AS INTEGER), 0) AS pogo_derived, "
        'coalesce(CAST("timestamp" - lag("timestamp") OVER w <= INTERVAL 30 MINUTE AND '
        "search_query_masked <> lag(search_query_masked) OVER w AS INTEGER), 0) AS "
        "reformulation_derived FROM log WINDOW w AS "
        '(PARTITION BY user_id_masked ORDER BY "timestamp", event_id)'
    )
    sql["rolling_7d_30d"] = on_log(_rolling())
    dims = "country, device_type, browser_name, os_name, search_intent"
    sql["segment_metrics"] = on_log(
        f"SELECT {dims}, grouping_id({dims}) AS grouping_set, count(*) AS events, {_RATES} "
        f"FROM log GROUP BY CUBE ({dims})"
    )
    sql["daily_metrics_mart"] = on_log(
        f'SELECT CAST("timestamp" AS DATE) AS day, {dims}, count(*) AS events, '
        f"CAST(sum(clicks) AS BIGINT) AS clicks, {_RATES} FROM log GROUP BY 1, 2, 3, 4, 5, 6"
    )
    sql["latency_percentiles"] = on_log(
        "SELECT device_type, browser_name, "
        + ", ".join(
            f"round(quantile_cont(latency_ms, {q}), 6) AS {n}"
            for n, q in [("p50", 0.5), ("p90", 0.9), ("p99", 0.99)]
        )
        + " FROM log GROUP BY 1, 2"
    )
    sql["ctr_at_rank1"] = on_log(
        "SELECT position, CAST(sum(impressions) AS BIGINT) AS impressions, "
        "round(sum(clicks) / CAST(sum(impressions) AS DOUBLE), 6) AS ctr FROM log GROUP BY 1"
    )
    kpis = [
        ("avg_quality_score", "avg(search_quality_score)", ">", "85e0"),
        ("avg_dwell_time_sec", "avg(dwell_time_sec)", ">", "45e0"),
        (
            "ctr_at_rank1",
            "sum(clicks) FILTER (WHERE position = 1) / CAST(sum(impressions) FILTER "
            "(WHERE position = 1) AS DOUBLE)",
            ">",
            "0.35e0",
        ),
        ("pogo_stick_rate", "avg(pogo_stick_flag)", "<", "0.05e0"),
        ("reformulation_rate", "avg(reformulation_flag)", "<", "0.12e0"),
    ]
    sql["input_kpis"] = on_log(
        "\nUNION ALL\n".join(
            f"SELECT '{n}' AS metric, round({e}, 6) AS value, {t} AS target, {e} {s} {t} AS met "
            "FROM log"
            for n, e, s, t in kpis
        )
    )
    sql["kpi_change_24h"] = on_log(
        "SELECT day, round(s, 6) AS avg_quality_score, round(s - p, 6) AS change_24h, "
        "round(r, 6) AS revenue, round(r * (greatest(0e0, p - s) / p), 6) AS revenue_at_risk "
        "FROM (SELECT day, s, r, max(s) OVER (ORDER BY day RANGE BETWEEN INTERVAL 1 DAY PRECEDING "
        "AND INTERVAL 1 DAY PRECEDING) AS p FROM (SELECT "
        'CAST("timestamp" AS DATE) AS day, round(sum(search_quality_score), 6) / count(*) AS s, '
        "round(sum(revenue_estimate_usd), 6) AS r FROM log GROUP BY 1))"
    ).replace("round(r * (greatest(0e0, p - s) / p), 6)",
              "round(CASE WHEN p IS NOT NULL THEN r * (greatest(0e0, p - s) / p) END, 6)")
    sql["latency_ctr_correlation"] = on_log(
        "SELECT country, device_type, count(*) AS events, "
        "round(corr(latency_ms, CAST(clicks AS DOUBLE)), 6) AS latency_click_corr "
        "FROM log GROUP BY 1, 2"
    )
    sql["zscore_anomalies"] = on_log(
        "SELECT country, device_type, hour, round(x, 6) AS avg_latency_ms, "
        "round(z, 6) AS zscore, coalesce(abs(z) >= 3, false) AS is_anomaly FROM (SELECT *, "
        "CASE WHEN n >= 12 AND sd > 0 THEN (x - m) / sd END AS z FROM (SELECT *, "
        "count(x) OVER w AS n, avg(x) OVER w AS m, stddev_samp(x) OVER w AS sd FROM "
        f"(SELECT country, device_type, {_HOURS}, round(sum(latency_ms), 6) / count(*) AS x FROM log "
        "GROUP BY 1, 2, 3) WINDOW w AS (PARTITION BY country, device_type ORDER BY hour RANGE "
        "BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING)))"
    )
    sql["seasonal_baseline"] = on_log(
        "SELECT hour, round(x, 6) AS avg_latency_ms, round(b, 6) AS seasonal_latency_ms, "
        "round(x / b, 6) AS seasonal_factor FROM (SELECT hour, x, avg(x) OVER (PARTITION BY "
        "dayofweek(hour), hour(hour)) AS b FROM (SELECT "
        f"{_HOURS}, round(sum(latency_ms), 6) / count(*) AS x FROM log GROUP BY 1))"
    )
    sql["alert_levels"] = on_log(
        "SELECT 'global' AS scope, hour, round(fall, 6) AS score_drop, 1 AS alert_level "
        "FROM overall WHERE fall > 0.05 OR p99 > 1500 UNION ALL "
        "SELECT country || '/' || device_type, hour, round(fall, 6), CASE WHEN count(*) OVER "
        "(PARTITION BY country, device_type, island) > 2 THEN 2 ELSE 3 END FROM islands",
        _ALERTS,
    )
    sql["drift_psi"] = on_log(
        "SELECT feature, round(psi, 6) AS psi, psi > 0.25 AS drifted FROM psi", PSI
    )
    sql["dimension_cardinalities_sketched"] = on_log(
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS dimension, count(*) AS members, true AS within_error FROM {t}"
            for t in ["dim_geography", "dim_systems", "dim_queries", "dim_users"]
        ),
        DIMS,
    )
    sql["drift_ks_sketched"] = on_log(
        "SELECT feature, round(d, 6) AS ks_distance, true AS within_error FROM ks",
        PSI,
        KS,
    )
    sql["drift_ks"] = on_log(
        "SELECT feature, round(d, 6) AS ks_distance, round(p, 6) AS p_value, p < 0.05 AS drifted "
        "FROM ks",
        PSI,
        KS,
    )
    sql["retrain_trigger"] = on_log(
        "SELECT n AS drifted_features, s AS score_shifted, n > 5 OR s AS retrain FROM "
        "(SELECT (SELECT count(*) FROM psi WHERE psi > 0.25) AS n, (SELECT bool_or(feature = "
        "'search_quality_score' AND p < 0.05) FROM ks) AS s)",
        PSI,
        KS,
    )
    arms = (
        ",\narms AS (SELECT *, CASE WHEN CAST(concat('0x', substr(md5('exp1' || "
        "user_id_masked), 1, 8)) AS BIGINT) % 2 = 0 THEN 'control' ELSE 'treatment' END AS arm "
        "FROM log)"
    )
    sql["experiment_srm"] = on_log(
        "SELECT c AS control_users, t AS treatment_users, round(chi, 6) AS chi_square, "
        "chi > 3.841 AS mismatch FROM (SELECT *, CAST((c - t) * (c - t) AS DOUBLE) / (c + t) AS "
        "chi FROM (SELECT count(DISTINCT user_id_masked) FILTER (WHERE arm = 'control') AS c, "
        "count(DISTINCT user_id_masked) FILTER (WHERE arm = 'treatment') AS t FROM arms))",
        arms,
    )
    sql["experiment_lift"] = on_log(
        "SELECT round(xc / nc, 6) AS control_ctr, round(xt / nt, 6) AS treatment_ctr, "
        "round((xt / nt) / (xc / nc) - 1, 6) AS lift, round((xt / nt - xc / nc) / "
        "sqrt((xc + xt) / (nc + nt) * (1 - (xc + xt) / (nc + nt)) * (1e0 / nc + 1e0 / nt)), 6) "
        "AS z_value FROM (SELECT CAST(sum(clicks) FILTER (WHERE arm = 'control') AS DOUBLE) AS "
        "xc, CAST(sum(impressions) FILTER (WHERE arm = 'control') AS DOUBLE) AS nc, "
        "CAST(sum(clicks) FILTER (WHERE arm = 'treatment') AS DOUBLE) AS xt, "
        "CAST(sum(impressions) FILTER (WHERE arm = 'treatment') AS DOUBLE) AS nt FROM arms)",
        arms,
    )
    sql["freshness_check"] = on_log(
        'SELECT max("timestamp") AS newest_event, round((epoch_us(TIMESTAMP '
        f"'{FRESH_AS_OF}') - epoch_us(max(\"timestamp\"))) / 3.6e9, 6) AS hours_old, "
        f"(epoch_us(TIMESTAMP '{FRESH_AS_OF}') - epoch_us(max(\"timestamp\"))) / 3.6e9 > 30 "
        "AS stale FROM log"
    )
    hit = f"CAST(\"timestamp\" AS DATE) = DATE '{INCIDENT_DAY}'"
    sql["incident_segment_delta"] = on_log(
        "\nUNION ALL\n".join(
            f"SELECT '{m}' AS metric, round(avg({m}) FILTER (WHERE NOT {hit}), 6) AS usual, "
            f"round(avg({m}) FILTER (WHERE {hit}), 6) AS incident, "
            f"round(avg({m}) FILTER (WHERE {hit}) - avg({m}) FILTER (WHERE NOT {hit}), 6) "
            "AS delta FROM log WHERE country = 'United States' AND device_type = 'Mobile' "
            'AND hour("timestamp") BETWEEN 12 AND 15'
            for m in [
                "latency_ms",
                "page_speed_score",
                "bounce_rate",
                "clicks",
                "pogo_stick_flag",
            ]
        )
    )
    sql["chronological_split"] = on_log(
        "SELECT event_id, CASE WHEN epoch_us(\"timestamp\") <= (SELECT quantile_cont("
        'CAST(epoch_us("timestamp") AS DOUBLE), 0.8) FROM log) THEN \'train\' ELSE \'test\' END '
        "AS split FROM log"
    )
    sql["chronological_folds"] = on_log(
        "SELECT event_id, "
        + " + ".join(
            "CAST(epoch_us(\"timestamp\") > (SELECT quantile_cont(CAST(epoch_us(\"timestamp\") "
            f"AS DOUBLE), {i}e0 / 6) FROM log) AS INTEGER)"
            for i in range(1, 6)
        )
        + " AS block FROM log"
    )
    sql["scd2_merge"] = on_log(
        "SELECT md5(user_id_masked) AS user_key, md5(user_id_masked || '_' || "
        "strftime(record_start_timestamp, '%Y-%m-%d %H:%M:%S')) AS version_key, * FROM versions",
        DIMS,
        SCD2,
    )
    sql["outlier_tree_samples"] = on_log(
        "SELECT tree, event_id FROM (SELECT tree, event_id, row_number() OVER (PARTITION BY tree "
        "ORDER BY ((high * ((tree * 1103515245 + 12345) % 1073741824 * 2 + 1) + "
        "(tree * 22695477 + 97) % 2147483648) % 2147483648) * 2147483648 + low, event_id) AS n FROM "
        "(SELECT event_id, CAST('0x' || substr(md5('42/' || event_id), 1, 8) AS BIGINT) % 2147483648 "
        "AS high, CAST('0x' || substr(md5('42/' || event_id), 9, 8) AS BIGINT) % 2147483648 AS low "
        "FROM log WHERE latency_ms IS NOT NULL AND page_speed_score IS NOT NULL AND bounce_rate IS "
        "NOT NULL), (SELECT CAST(unnest(range(10)) AS BIGINT) AS tree)) WHERE n <= 256"
    ).replace("SELECT tree, event_id FROM (SELECT tree,", "SELECT CAST(tree AS INTEGER) AS tree, event_id FROM (SELECT tree,")
    sql["overlong_text"] = on_log(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, 64 AS declared, count(*) FILTER (WHERE length({c}) > 64) "
            "AS overlong FROM fact"
            for c in ["event_id", "user_key", "query_key", "system_key", "geo_key", "session_id"]
        ),
        FACT,
    )
    sql["scd2_orphans"] = on_log(
        "SELECT count(*) AS orphans FROM fact WHERE user_key NOT IN "
        "(SELECT md5(user_id_masked) FROM versions)",
        FACT,
        DIMS,
        SCD2,
    )
    sql["scd2_untouched"] = on_log(
        "SELECT user_id_masked, user_key FROM dim_users d WHERE (SELECT count(*) FROM versions v "
        "WHERE v.user_id_masked = d.user_id_masked) = 1",
        DIMS,
        SCD2,
    )
    sql["scd2_asof_lookup"] = on_log(
        "SELECT l.event_id, v.user_segment, v.record_start_timestamp FROM log l LEFT JOIN "
        'versions v ON l.user_id_masked = v.user_id_masked AND l."timestamp" >= '
        'v.record_start_timestamp AND l."timestamp" < coalesce(v.record_end_timestamp, '
        "TIMESTAMP '9999-01-01')",
        DIMS,
        SCD2,
    )
    sql["sample_feature_pairing"] = on_log(
        "SELECT * FROM matrix ORDER BY md5('42' || event_id), event_id LIMIT 100",
        FEATURES,
        MATRIX,
    )

    # relational tables
    line_checks = [
        ("l_orderkey", "not_null", "l_orderkey IS NULL"),
        ("l_shipdate", "not_null", "l_shipdate IS NULL"),
        ("l_returnflag", "in_set", "l_returnflag NOT IN ('A', 'N', 'R')"),
        ("l_linestatus", "in_set", "l_linestatus NOT IN ('F')"),
        ("l_quantity", "between", "l_quantity NOT BETWEEN 1 AND 40"),
        ("l_discount", "between", "l_discount NOT BETWEEN 0 AND 0.1e0"),
    ]
    sql["lineitem_checks"] = _checks("lineitem", listed=line_checks)
    sql["lineitem_duplicate_keys"] = (
        "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem "
        "GROUP BY 1, 2 HAVING count(*) > 1"
    )
    sql["lineitem_sequence"] = (
        "SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, row_number() OVER "
        "(PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) "
        "AS step FROM lineitem"
    )
    sql["lineitem_percentiles"] = (
        "SELECT l_returnflag, l_linestatus, count(*) AS row_count, "
        "round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, "
        "round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem GROUP BY 1, 2"
    )
    sql["lineitem_describe"] = _describe(
        "lineitem", ["l_quantity", "l_extendedprice", "l_discount"]
    )
    sql["lineitem_price_histogram"] = (
        "SELECT bin, bin * 5000e0 AS bin_start, count(*) AS row_count FROM (SELECT greatest(0, "
        "least(19, CAST(floor(l_extendedprice / 5000e0) AS INTEGER))) AS bin FROM lineitem) "
        "GROUP BY 1"
    )
    sql["orders_daily_volume"] = (
        "SELECT CAST(d.day AS DATE) AS day, count(o.o_orderkey) AS volume FROM (SELECT "
        "unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), "
        "INTERVAL 1 DAY)) AS day FROM orders) d LEFT JOIN orders o ON "
        "CAST(o.o_orderdate AS DATE) = d.day GROUP BY 1"
    )
    sql["customers_without_orders"] = (
        "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN "
        "(SELECT o_custkey FROM orders)"
    )
    sql["orders_segment_key"] = (
        "SELECT o_orderkey, md5(c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR)) AS "
        "segment_key FROM orders LEFT JOIN customer ON o_custkey = c_custkey"
    )
    sql["orders_asof_previous_day"] = (
        "WITH days AS (SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, "
        "count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_orderkey, "
        "CASE WHEN o_orderdate - day <= INTERVAL 365 DAY THEN n END AS orders_that_day, "
        "CASE WHEN o_orderdate - day <= INTERVAL 365 DAY THEN day END AS previous_day "
        "FROM orders o ASOF LEFT JOIN days d ON o.o_custkey = d.o_custkey AND "
        "o.o_orderdate >= d.day + INTERVAL 1 DAY"
    )

    sql["attribution_additivity"] = on_log("SELECT event_id, true AS adds_up FROM log")

    # reports from tables that two runs keep
    for name in KEPT:
        sql[f"kept_{name}"] = sql[name]

    # the paths of hot groups, forced
    for name in ["exact_quantile", "latency_percentiles", "query_daily_features"]:
        sql[f"{name}_narrowed"] = sql[name]
    for name in ["sessionize", "training_matrix", "drift_ks"]:
        sql[f"{name}_chunked"] = sql[name]

    # streams, each with its closing marker
    sql["stream_ingest_fact"] = on_log("SELECT * FROM fact", FACT)
    sql["stream_tumbling_quality"] = on_log(
        "SELECT date_trunc('hour', \"timestamp\") AS window_start, device_type, count(*) AS "
        "events, CAST(sum(clicks) AS BIGINT) AS clicks, round(round(sum(latency_ms), 6) / "
        "count(*), 6) AS avg_latency_ms, round(round(sum(search_quality_score), 6) / count(*), 6) "
        "AS avg_quality_score FROM log GROUP BY 1, 2"
    )
    sql["stream_sessions"] = on_log(
        "SELECT * FROM (SELECT user_id_masked, min(\"timestamp\") AS session_start, "
        "max(\"timestamp\") + INTERVAL 30 MINUTE AS session_end, count(*) AS events, "
        "CAST(sum(clicks) AS BIGINT) AS clicks FROM sessions GROUP BY user_id_masked, "
        "session_seq)",
        _SESSIONS,
    )
    return sql
