"""Report tables: overview, trends, distributions, segments and sessions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import scalars as X
from serpscope.operators.ordered import HOT_ROWS, over_order
from serpscope.operators.quantiles import MAP_ROWS, group_quantiles

SEGMENTS = ["country", "device_type", "browser_name", "os_name", "search_intent"]


def kpi_overview(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.round(F.avg("search_quality_score"), 6).alias("avg_quality_score"),
        F.round(F.avg("latency_ms"), 6).alias("avg_latency_ms"),
        F.round(F.avg("bounce_rate"), 6).alias("avg_bounce_rate"),
    )


def daily_volume(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows per calendar day; days without rows appear with 0."""
    return with_empty_days(log.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("_n")))


def with_empty_days(counts: DataFrame) -> DataFrame:
    """Counts `_n` per day as volumes of all calendar days in between."""
    days = counts.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("day")
    )
    return days.join(counts, "day", "left").select(
        "day", F.coalesce("_n", F.lit(0)).alias("volume")
    )


def histogram_bin(column: str, low: float, high: float, bins: int) -> Column:
    """Number of a value's bin; values at or beyond the ends fall into the outer ones."""
    width = (high - low) / bins
    slot = F.floor((F.col(column) - F.lit(float(low))) / F.lit(width))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), slot)).cast("int")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Fixed-width counts."""
    width = (high - low) / bins
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(histogram_bin(column, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("bin", (F.lit(float(low)) + F.col("bin") * width).alias("bin_start"), "row_count")
    )


def describe_exact(df: DataFrame, columns: list[str], hot_rows: int = MAP_ROWS) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per numeric column."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    long = df.select(F.inline(pairs))
    stats = group_quantiles(
        long,
        ["column_name"],
        "value",
        {"p25": 0.25, "p50": 0.5, "p75": 0.75},
        {
            "non_null": F.count("value"),
            "mean": F.avg("value"),
            "std": F.stddev_samp("value"),
            "min": F.min("value"),
            "max": F.max("value"),
        },
        hot_rows,
        costly=True,
    )
    order = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return stats.select(
        "column_name",
        F.col("non_null").alias("value_count"),
        *[F.round(F.col(c), 6).alias(c) for c in order],
    )


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Reproducible exact-size sample: the n smallest salted hashes.

    Only rows with a hash below a bound just above n / rows are sorted, so no task gathers n rows
    of every partition. Should too few lie below it, all rows are sorted.
    """
    rank = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    share = (n + 6 * math.sqrt(n) + 10) / max(1, df.count())
    if share < 1:
        few = df.where(rank < f"{math.ceil(share * (1 << 32)):08x}")
        if few.limit(n).count() == n:
            df = few
    return df.orderBy(rank, key).limit(n)


def first_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


# --- sessions -----------------------------------------------------------------------


def _gap_flag(previous: str, ts: str, gap_minutes: int) -> Column:
    gap = F.make_dt_interval(mins=F.lit(gap_minutes))
    opens = F.col(previous).isNull() | (F.col(ts) - F.col(previous) > gap)
    return F.when(opens, 1).otherwise(0)


def sessionize(
    df: DataFrame,
    user: str = "user_id_masked",
    ts: str = "timestamp",
    tiebreak: str = "event_id",
    gap_minutes: int = S.SESSION_GAP_MINUTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number each user's sessions: a new one starts after more than the gap of inactivity."""
    return over_order(
        df,
        [user],
        [ts, tiebreak],
        lambda s: s.lag(ts, "_prev")
        .assign(_opens=_gap_flag("_prev", ts, gap_minutes))
        .running_sum("_opens", "session_seq"),
        hot_rows,
    ).drop("_prev", "_opens")


def session_metrics(sessions: DataFrame, user: str = "user_id_masked", ts: str = "timestamp"):
    """Size, duration, bounce and reformulation per session."""
    events = F.count(F.lit(1))
    return sessions.groupBy(user, "session_seq").agg(
        events.alias("events"),
        F.sum("clicks").alias("clicks"),
        (F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp")))
        .alias("duration_us"),
        (events == 1).cast("int").alias("bounced"),
        F.round(F.avg("reformulation_flag"), 6).alias("reformulation_rate"),
    )


def derive_flags(
    log: DataFrame,
    gap_minutes: int = S.SESSION_GAP_MINUTES,
    return_seconds: int = S.POGO_RETURN_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pogo-sticking (back on the results within seconds of a click) and reformulation (query
    text changed within the session), from the order of a user's events."""
    rows = log.select("event_id", "user_id_masked", "timestamp", "search_query_masked", "clicks")
    ordered = over_order(
        rows,
        ["user_id_masked"],
        ["timestamp", "event_id"],
        lambda s: s.lag("timestamp", "_prev_ts")
        .lag("search_query_masked", "_prev_query")
        .lead("timestamp", "_next_ts"),
        hot_rows,
    )
    quick = F.col("_next_ts") - F.col("timestamp") < F.make_dt_interval(
        secs=F.lit(return_seconds)
    )
    same_session = F.col("timestamp") - F.col("_prev_ts") <= F.make_dt_interval(
        mins=F.lit(gap_minutes)
    )
    changed = F.col("search_query_masked") != F.col("_prev_query")
    return ordered.select(
        "event_id",
        F.coalesce(((F.col("clicks") == 1) & quick).cast("int"), F.lit(0)).alias("pogo_derived"),
        F.coalesce((same_session & changed).cast("int"), F.lit(0)).alias(
            "reformulation_derived"
        ),
    )


# --- marts and segments ---------------------------------------------------------------

COUNTED = ["events", "clicks", "impressions", "pogo_sticks", "reformulations"]
SUMMED = ["latency_sum", "score_sum", "revenue_sum"]


def mart(log: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Additive metrics per key combination; every rate below divides sums of these. Decimal
    sums are snapped to 6 places, so they do not depend on the order of addition."""
    return log.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("clicks").alias("clicks"),
        F.sum("impressions").alias("impressions"),
        F.sum("pogo_stick_flag").alias("pogo_sticks"),
        F.sum("reformulation_flag").alias("reformulations"),
        F.round(F.sum("latency_ms"), 6).alias("latency_sum"),
        F.round(F.sum("search_quality_score"), 6).alias("score_sum"),
        F.round(F.sum("revenue_estimate_usd"), 6).alias("revenue_sum"),
    )


def merge_sums() -> list[Column]:
    return [F.sum(n).alias(n) for n in COUNTED] + [
        F.round(F.sum(n), 6).alias(n) for n in SUMMED
    ]


def _rates() -> list[Column]:
    return [
        F.round(X.safe_ratio(F.col("clicks"), F.col("impressions")), 6).alias("ctr"),
        F.round(F.col("latency_sum") / F.col("events"), 6).alias("avg_latency_ms"),
        F.round(F.col("score_sum") / F.col("events"), 6).alias("avg_quality_score"),
        F.round(F.col("pogo_sticks") / F.col("events"), 6).alias("pogo_stick_rate"),
        F.round(F.col("reformulations") / F.col("events"), 6).alias("reformulation_rate"),
    ]


def daily_mart(log: DataFrame) -> DataFrame:
    return daily_rates(mart(log, {"day": F.to_date("timestamp"), **{c: F.col(c) for c in SEGMENTS}}))


def daily_rates(finest: DataFrame) -> DataFrame:
    """Rates from sums per day and segment."""
    return finest.select("day", *SEGMENTS, "events", "clicks", *_rates())


def segment_metrics(log: DataFrame, dimensions: list[str] | None = None) -> DataFrame:
    """Cube over the segment dimensions; the cube expands the pre-aggregated finest level, so
    its cost follows the number of segments and not the number of rows."""
    dims = dimensions or SEGMENTS
    return cube_metrics(mart(log, {c: F.col(c) for c in dims}), dims)


def cube_metrics(finest: DataFrame, dims: list[str]) -> DataFrame:
    """Rates of all combinations from sums at the finest level."""
    cubed = finest.cube(*dims).agg(F.grouping_id().alias("grouping_set"), *merge_sums())
    return cubed.select(
        *dims, F.col("grouping_set").cast("bigint").alias("grouping_set"), "events", *_rates()
    )


def rolling_metrics(
    log: DataFrame, key: str = "user_id_masked", windows: tuple[int, ...] = (7, 30)
) -> DataFrame:
    """Rolling rates per key over calendar days, as sum over sum of the daily table. A key has
    at most one row per day when the window runs."""
    return rolling_rates(mart(log, {key: F.col(key), "day": F.to_date("timestamp")}), key, windows)


def rolling_rates(
    daily: DataFrame, key: str = "user_id_masked", windows: tuple[int, ...] = (7, 30)
) -> DataFrame:
    """Rolling rates from sums per key and day."""
    columns = []
    for n in windows:
        frame = f"INTERVAL '{n - 1}' DAY"
        over = (
            f"OVER (PARTITION BY {key} ORDER BY day "
            f"RANGE BETWEEN {frame} PRECEDING AND CURRENT ROW)"
        )
        ratio = {
            "ctr": ("clicks", "impressions"),
            "latency_ms": ("latency_sum", "events"),
            "pogo_rate": ("pogo_sticks", "events"),
            "reformulation_rate": ("reformulations", "events"),
        }
        for name, (top, bottom) in ratio.items():
            columns.append(
                F.expr(
                    f"round(round(sum({top}) {over}, 6) / greatest(1, sum({bottom}) {over}), 6)"
                ).alias(f"{name}_roll_{n}d")
            )
    return daily.select(key, "day", *columns)


def latency_percentiles(
    log: DataFrame, keys: list[str] | None = None, hot_rows: int = MAP_ROWS
) -> DataFrame:
    keys = keys or ["device_type", "browser_name"]
    result = group_quantiles(
        log.select(*keys, "latency_ms"),
        keys,
        "latency_ms",
        {"p50": 0.5, "p90": 0.9, "p99": 0.99},
        hot_rows=hot_rows,
    )
    return result.select(*keys, *[F.round(c, 6).alias(c) for c in ["p50", "p90", "p99"]])


def input_kpis(log: DataFrame) -> DataFrame:
    """Headline inputs against their targets, one row per metric."""
    top = F.col("position") == 1
    values = log.agg(
        F.avg("search_quality_score").alias("avg_quality_score"),
        F.avg("dwell_time_sec").alias("avg_dwell_time_sec"),
        (F.sum(F.when(top, F.col("clicks"))) / F.sum(F.when(top, F.col("impressions")))).alias(
            "ctr_at_rank1"
        ),
        F.avg("pogo_stick_flag").alias("pogo_stick_rate"),
        F.avg("reformulation_flag").alias("reformulation_rate"),
    )
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.round(F.col(name), 6).alias("value"),
            F.lit(target).alias("target"),
            (F.col(name) > target if side == ">" else F.col(name) < target).alias("met"),
        )
        for name, (side, target) in S.KPI_TARGETS.items()
    ]
    return values.select(F.inline(F.array(*rows)))


def ctr_at_rank(log: DataFrame) -> DataFrame:
    return log.groupBy("position").agg(
        F.sum("impressions").alias("impressions"),
        F.round(F.sum("clicks") / F.sum("impressions"), 6).alias("ctr"),
    )


def kpi_change(log: DataFrame) -> DataFrame:
    """Daily score against that of the calendar day before, and the revenue exposed to the drop.
    After a day without events there is no change."""
    return change_by_day(mart(log, {"day": F.to_date("timestamp")}))


def change_by_day(daily: DataFrame) -> DataFrame:
    """Changes from sums per day."""
    # One row per day: the single-partition window runs over the calendar only.
    by_day = Window.orderBy("day")
    score = F.col("score_sum") / F.col("events")
    follows = F.lag("day").over(by_day) == F.date_sub("day", 1)
    previous = F.when(follows, F.lag("_score").over(by_day))
    change = F.col("_score") - F.col("_prev")
    drop = F.greatest(F.lit(0.0), -change) / F.col("_prev")
    return (
        daily.withColumn("_score", score)
        .withColumn("_prev", previous)
        .select(
            "day",
            F.round("_score", 6).alias("avg_quality_score"),
            F.round(change, 6).alias("change_24h"),
            F.round(F.col("revenue_sum"), 6).alias("revenue"),
            F.round(F.col("revenue_sum") * drop, 6).alias("revenue_at_risk"),
        )
    )


def latency_ctr_correlation(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["country", "device_type"]
    return log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.round(F.corr("latency_ms", F.col("clicks").cast("double")), 6).alias(
            "latency_click_corr"
        ),
    )
