"""Daily entity features and their latest snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.functions import scalars as X
from serpscope.operators.quantiles import MAP_ROWS, group_quantiles


def _total(column: str) -> Column:
    """Sum that is 0 when every value is missing."""
    return F.coalesce(F.sum(column), F.lit(0))


def user_daily_features(log: DataFrame) -> DataFrame:
    """Per user and day: ctr, mean dwell, pogo-stick count. Map-side combined. Events without
    user or time belong to no snapshot."""
    known = log.where(F.col("user_id_masked").isNotNull() & F.col("timestamp").isNotNull())
    daily = known.groupBy("user_id_masked", F.to_date("timestamp").alias("_day")).agg(
        _total("clicks").alias("_clicks"),
        _total("impressions").alias("_imps"),
        F.avg("dwell_time_sec").alias("_dwell"),
        _total("pogo_stick_flag").alias("_pogo"),
    )
    return daily.select(
        "user_id_masked",
        F.col("_day").cast("timestamp_ntz").alias("event_timestamp"),
        X.safe_ratio(F.col("_clicks"), F.col("_imps")).cast("float").alias("user_7d_ctr"),
        F.col("_dwell").cast("float").alias("user_30d_avg_dwell_time"),
        F.col("_pogo").cast("bigint").alias("user_pogo_sticking_count"),
    )


def query_daily_features(log: DataFrame, hot_rows: int = MAP_ROWS) -> DataFrame:
    """Per query and day: ctr, exact p95 latency, reformulation rate, in one aggregation."""
    keyed = log.where(F.col("timestamp").isNotNull()).select(
        K.query_key().alias("query_key"),
        F.to_date("timestamp").alias("_day"),
        "clicks",
        "impressions",
        "latency_ms",
        "reformulation_flag",
    )
    daily = group_quantiles(
        keyed,
        ["query_key", "_day"],
        "latency_ms",
        {"_p95": 0.95},
        {
            "_clicks": _total("clicks"),
            "_imps": _total("impressions"),
            "_reform": F.avg("reformulation_flag"),
        },
        hot_rows,
    )
    return daily.select(
        "query_key",
        F.col("_day").cast("timestamp_ntz").alias("event_timestamp"),
        X.safe_ratio(F.col("_clicks"), F.col("_imps")).cast("float").alias("query_avg_ctr"),
        F.col("_p95").cast("float").alias("query_95p_latency_ms"),
        F.col("_reform").cast("float").alias("query_reformulation_rate"),
    )


def latest_snapshot(
    features: DataFrame,
    key: str,
    as_of: str | None = None,
    ttl_days: int = S.FEATURE_TTL_DAYS,
    ts: str = "event_timestamp",
) -> DataFrame:
    """Newest row per entity at the cut-off, dropped once older than the TTL.

    Snapshots are unique per entity and time. Every column is picked by the same comparison, so
    the values belong to one row, and plain numeric buffers keep this a hash aggregation.
    """
    if as_of is not None:
        cut = F.lit(as_of).cast("timestamp_ntz")
        features = features.where(
            (F.col(ts) <= cut) & (F.col(ts) >= cut - F.make_dt_interval(days=F.lit(ttl_days)))
        )
    values = [c for c in features.columns if c not in (key, ts)]
    return features.groupBy(key).agg(
        F.max(ts).alias(ts), *[F.max_by(c, ts).alias(c) for c in values]
    )


def fold_latest(latest: DataFrame, new_rows: DataFrame, key: str) -> DataFrame:
    """Incremental form: fold newly computed rows into the previous latest table."""
    return latest_snapshot(latest.unionByName(new_rows), key)


def snapshot_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per feature table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("snapshots")).select(
            F.lit(name).alias("feature_table"), "snapshots"
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
