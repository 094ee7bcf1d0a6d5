"""Key lookups, point-in-time joins and referential checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators.ordered import HOT_ROWS, join_keys, over_order


def attach_key(fact: DataFrame, dim: DataFrame, on: list[str], key: str) -> DataFrame:
    """Left lookup of a surrogate key; null attributes match null attributes.

    No broadcast hint: adaptive execution broadcasts the dimension when its measured size is
    small and otherwise splits skewed fact partitions.
    """
    return join_keys(fact, dim.select(*on, key), on, "left")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null key has no dimension member."""
    return fact.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_ts: str,
    right_ts: str,
    columns: list[str],
    ttl_days: int = S.FEATURE_TTL_DAYS,
    lag_days: int = 0,
    right_unique: bool = False,
    matched_ts: str | None = None,
    tie: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
    costly: bool = False,
) -> DataFrame:
    """For each left row the newest right row of the same key at or before its time, not older
    than the TTL; every left row is kept.

    Both sides are merged into one time line per key and scanned once: one shuffle, one sort,
    linear in rows. ``tie`` names the columns that tell left rows apart (all by default); name
    a narrow one to keep unused columns out of the scan. ``lag_days`` delays the right side, so that a snapshot built from a whole
    day is not visible to that same day's events.
    """
    if not right_unique:
        right = right.groupBy(on, right_ts).agg(F.max(F.struct(*columns)).alias("_v"))
        right = right.select(on, right_ts, *[F.col(f"_v.{c}").alias(c) for c in columns])
    # A null key identifies nobody: such left rows stay, unmatched.
    snapshots = right.where(F.col(on).isNotNull()).select(
        F.col(on),
        (F.col(right_ts) + F.make_dt_interval(days=F.lit(lag_days))).alias("_t"),
        F.lit(0).alias("_side"),
        F.lit(0).cast("bigint").alias("_tie"),
        F.struct(F.col(right_ts).alias("ts"), *columns).alias("_seen"),
    )
    # Left rows tied in time may sit in any order; the hash lets ties spread over chunks.
    events = left.select(
        "*",
        F.col(left_ts).alias("_t"),
        F.lit(1).alias("_side"),
        F.xxhash64(*(tie or left.columns)).alias("_tie"),
    )
    timeline = events.unionByName(snapshots, allowMissingColumns=True)
    scanned = over_order(
        timeline,
        [on],
        ["_t", "_side", "_tie"],
        lambda s: s.last_known("_seen", "_match"),
        hot_rows,
        costly,
    ).where(F.col("_side") == 1)
    fresh = F.col(left_ts) - F.col("_match.ts") <= F.make_dt_interval(days=F.lit(ttl_days))
    found = [F.when(fresh, F.col(f"_match.{c}")).alias(c) for c in columns]
    if matched_ts:
        found.append(F.when(fresh, F.col("_match.ts")).alias(matched_ts))
    return scanned.select(*left.columns, *found)


def lookup_latest(
    requests: DataFrame, user_latest: DataFrame, query_latest: DataFrame
) -> DataFrame:
    """Latest user and query features for a table of requests, null when unknown."""
    return requests.join(
        user_latest.select("user_id_masked", *S.USER_FEATURES), "user_id_masked", "left"
    ).join(query_latest.select("query_key", *S.QUERY_FEATURES), "query_key", "left")


def fill_cold(df: DataFrame) -> DataFrame:
    """Cold-start defaults for feature misses."""
    return df.fillna(S.COLD_START)
