"""From log and feature tables to the model matrix, and batch feature serving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.functions import scalars as X
from serpscope.operators.features import latest_snapshot
from serpscope.operators.joins import asof_join, fill_cold, lookup_latest
from serpscope.operators.ordered import HOT_ROWS


def entity_rows(log: DataFrame) -> DataFrame:
    """One row per event: entity keys, time, request-time columns and label."""
    return log.select(
        "event_id",
        "user_id_masked",
        K.query_key().alias("query_key"),
        F.col("timestamp").alias("event_timestamp"),
        *S.REQUEST_FEATURES,
        S.LABEL,
    )


def with_features(
    entities: DataFrame,
    user_features: DataFrame,
    query_features: DataFrame,
    ttl_days: int = S.FEATURE_TTL_DAYS,
    lag_days: int = 0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Both views joined point-in-time: one pass per entity."""
    options = {
        "ttl_days": ttl_days,
        "lag_days": lag_days,
        "right_unique": True,
        "tie": ["event_id"],
        "hot_rows": hot_rows,
    }
    df = asof_join(
        entities,
        user_features,
        "user_id_masked",
        "event_timestamp",
        "event_timestamp",
        S.USER_FEATURES,
        **options,
    )
    return asof_join(
        df,
        query_features,
        "query_key",
        "event_timestamp",
        "event_timestamp",
        S.QUERY_FEATURES,
        costly=True,
        **options,
    )


def training_matrix(
    log: DataFrame, user_features: DataFrame, query_features: DataFrame, **options
) -> DataFrame:
    """Ten features and the label per event. The request-time columns travel through the
    point-in-time joins, so they need no second join. Rows with any null are dropped."""
    df = with_features(entity_rows(log), user_features, query_features, **options)
    return df.select("event_id", *S.FEATURES, S.LABEL).na.drop("any")


def training_matrix_weighted(
    log: DataFrame,
    user_features: DataFrame,
    query_features: DataFrame,
    precision: str = "hour",
    **options,
) -> DataFrame:
    """Matrix with the multiplicity each row has when the request columns are merged back on
    (user, query, time) and several events share that key: features are the same for the whole
    key, so a group of n events stands for n times each of its rows. The count replaces the
    n x n pairs."""
    keys = ["user_id_masked", "query_key", "_slot"]
    slot = F.date_trunc(precision, F.col("event_timestamp").cast("timestamp"))
    counts = (
        entity_rows(log)
        .withColumn("_slot", slot)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("multiplicity"))
    )
    df = with_features(entity_rows(log), user_features, query_features, **options)
    weighted = df.withColumn("_slot", slot).join(counts, keys)
    return weighted.select("event_id", *S.FEATURES, S.LABEL, "multiplicity").na.drop("any")


def feature_columns(df: DataFrame, *keep: str) -> DataFrame:
    """The ten model inputs in contract order, as 32-bit floats."""
    return df.select(*keep, *[F.col(c).cast("float").alias(c) for c in S.FEATURES])


def train_test_split(df: DataFrame, key: str = "event_id", train_percent: int = 80) -> DataFrame:
    """Split by id hash: stable under any partitioning and rerun."""
    bucket = K.hash_bucket(F.col(key)) % 100
    return df.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))


def serve_features(
    requests: DataFrame,
    user_features: DataFrame,
    query_features: DataFrame,
    as_of: str | None = None,
) -> DataFrame:
    """Latest features for a request table, with cold-start defaults."""
    users = latest_snapshot(user_features, "user_id_masked", as_of)
    queries = latest_snapshot(query_features, "query_key", as_of)
    return fill_cold(lookup_latest(requests, users, queries))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MAE and R2 in one aggregation."""
    y = F.col(label)
    error = y - F.col(prediction)
    n = F.count(F.lit(1))
    return df.agg(
        F.round(F.avg(F.abs(error)), 6).alias("mae"),
        F.round(1 - F.sum(error * error) / (F.var_pop(y) * n), 6).alias("r2"),
        n.alias("row_count"),
    )


def clipped(df: DataFrame, prediction: str) -> DataFrame:
    return df.withColumn(prediction, X.clip(F.col(prediction), 0.0, 100.0))
