"""Dimensional model: four dimensions, the fact and its lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.functions import scalars as X
from serpscope.operators.joins import attach_key
from serpscope.operators.ordered import HOT_ROWS, over_order


def dim_distinct(log: DataFrame, columns: list[str]) -> DataFrame:
    return log.select(*columns).distinct()


def dim_geography(log: DataFrame) -> DataFrame:
    members = dim_distinct(log, S.GEO_ATTRS)
    return members.withColumn("geo_key", K.surrogate_key(*S.GEO_ATTRS)).select(*S.DIM_GEOGRAPHY)


def dim_systems(log: DataFrame) -> DataFrame:
    members = dim_distinct(log, S.SYSTEM_ATTRS)
    return members.withColumns(
        {
            "system_key": K.surrogate_key(*S.SYSTEM_ATTRS),
            "browser_version": F.lit(S.BROWSER_VERSION),
        }
    ).select(*S.DIM_SYSTEMS)


def dim_queries(log: DataFrame) -> DataFrame:
    intent = F.col("search_intent")
    members = dim_distinct(log, S.QUERY_ATTRS)
    return members.withColumns(
        {
            "query_key": K.query_key(),
            "is_navigational": X.intent_flag(intent, "Navigational"),
            "is_informational": X.intent_flag(intent, "Informational"),
            "is_transactional": X.intent_flag(intent, "Commercial"),
            "query_length_words": X.word_count(F.col("search_query_masked")),
        }
    ).select(*S.DIM_QUERIES)


def dim_users(log: DataFrame) -> DataFrame:
    """One open version per user, with the profile derived from the id hash."""
    members = dim_distinct(log, ["user_id_masked"])
    profile = members.withColumn("_h", K.hash_bucket(F.col("user_id_masked"))).withColumns(
        {"user_key": K.user_key(), **K.profile_columns(F.col("_h"))}
    )
    return profile.withColumns(
        {
            "record_start_timestamp": F.col("signup_timestamp"),
            "record_end_timestamp": F.lit(None).cast("timestamp_ntz"),
            "is_current_record": F.lit(1),
        }
    ).select(*S.DIM_USERS)


def current_users(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current_record") == 1)


def conform_fact(df: DataFrame) -> DataFrame:
    """Rename the time column and put the columns in table order."""
    return df.withColumnRenamed("timestamp", "event_timestamp").select(*S.FACT)


def fact_with_keys(log: DataFrame) -> DataFrame:
    """Fact whose keys are computed in place: they are pure functions of the row, so no join
    and no shuffle is needed. The default way to build the fact."""
    return conform_fact(
        log.withColumns(
            {
                "geo_key": K.surrogate_key(*S.GEO_ATTRS),
                "system_key": K.surrogate_key(*S.SYSTEM_ATTRS),
                "query_key": K.query_key(),
                "user_key": K.user_key(),
            }
        )
    )


def fact_by_lookup(
    log: DataFrame,
    geography: DataFrame,
    systems: DataFrame,
    queries: DataFrame,
    users: DataFrame,
) -> DataFrame:
    """Fact whose keys come from four left lookups, for dimensions that already exist."""
    df = attach_key(log, geography, S.GEO_ATTRS, "geo_key")
    df = attach_key(df, systems, S.SYSTEM_ATTRS, "system_key")
    df = attach_key(df, queries, S.QUERY_ATTRS, "query_key")
    df = attach_key(df, users, ["user_id_masked"], "user_key")
    return conform_fact(df)


def add_sequence(
    fact: DataFrame,
    session: str = "session_id",
    ts: str = "event_timestamp",
    tiebreak: str = "event_id",
    out: str = "session_event_sequence",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Step number within the session."""
    return over_order(fact, [session], [ts, tiebreak], lambda s: s.row_number(out), hot_rows)


def core_dim(staged: DataFrame, columns: list[str]) -> DataFrame:
    return staged.select(*columns)


def build_star(log: DataFrame) -> dict[str, DataFrame]:
    """All five tables, lazily; the fact comes last."""
    return {
        "dim_geography": dim_geography(log),
        "dim_systems": dim_systems(log),
        "dim_queries": dim_queries(log),
        "dim_users": dim_users(log),
        "fct_search_events": fact_with_keys(log),
    }
