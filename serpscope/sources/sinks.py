"""Writers: partitioned logs, feature tables, the warehouse load and reports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from serpscope.functions import scalars as X

PARTITION_PARTS = ["year", "month", "day"]
LOAD_ORDER = ["dim_geography", "dim_systems", "dim_queries", "dim_users", "fct_search_events"]


def balanced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Few, even files per partition value; a very large value is split over several tasks."""
    return df.hint("rebalance", *columns)


def write_date_partitioned(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Snappy Parquet under year/month/day folders, replacing the target."""
    parts = df.withColumns(X.date_parts(F.col(ts)))
    (
        balanced(parts, PARTITION_PARTS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .partitionBy(*PARTITION_PARTS)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def with_event_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn("event_month", F.date_format("event_timestamp", "yyyy-MM"))


def with_event_date(fact: DataFrame) -> DataFrame:
    return fact.withColumn("event_date", F.to_date("event_timestamp"))


def write_fact(fact: DataFrame, path: str, partition: str = "event_month") -> None:
    """Fact under one folder per month (or day); new periods need no declaration."""
    add = {"event_month": with_event_month, "event_date": with_event_date}[partition]
    (
        balanced(add(fact), [partition])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition)
        .parquet(path)
    )


def load_star(star: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Write every table, the fact last, counting rows in the writing pass."""
    counts = {}
    for table in LOAD_ORDER:
        seen = Observation(table)
        counted = star[table].observe(seen, F.count(F.lit(1)).alias("rows"))
        if table == "fct_search_events":
            write_fact(counted, f"{root}/{table}")
        else:
            write_table(counted, f"{root}/{table}")
        counts[table] = seen.get["rows"]
    return counts


def counts_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(
        [(t, n) for t, n in counts.items()], "table_name string, loaded_rows long"
    )


def publish(star: dict[str, DataFrame], root: str, version: int) -> dict[str, int]:
    """All tables or none: load into a folder of its own, then append one pointer row.

    A failed load leaves the pointer, and so every reader, on the version before. The folder's
    name is unique, so that two loads at a time cannot overwrite each other.
    """
    spark = star[LOAD_ORDER[0]].sparkSession
    folder = f"version-{version}-{uuid.uuid4().hex}"
    counts = load_star(star, f"{root}/{folder}")
    pointer = spark.createDataFrame([(version, folder)], "version long, folder string")
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/_published")
    return counts


def current_version(spark: SparkSession, root: str) -> int | None:
    try:
        return spark.read.parquet(f"{root}/_published").agg(F.max("version")).first()[0]
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    published = spark.read.parquet(f"{root}/_published")
    newest = published.agg(F.max(F.struct("version", "folder")).alias("newest")).first()["newest"]
    return spark.read.parquet(f"{root}/{newest['folder']}/{table}")


def full_refresh(star: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Rebuild every table from scratch as the next published version."""
    spark = star[LOAD_ORDER[0]].sparkSession
    return publish(star, root, (current_version(spark, root) or 0) + 1)


SAMPLE_KEYS = {
    "dim_geography": "geo_key",
    "dim_systems": "system_key",
    "dim_queries": "query_key",
    "dim_users": "user_key",
    "fct_search_events": "event_id",
}


def dry_run(star: dict[str, DataFrame]) -> DataFrame:
    """Rows and a sample key per table, without writing."""
    parts = [
        star[t]
        .agg(F.count(F.lit(1)).alias("row_count"), F.min(key).alias("sample_key"))
        .select(F.lit(t).alias("table_name"), "row_count", "sample_key")
        for t, key in SAMPLE_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def write_report(results: DataFrame, path: str) -> None:
    """Check results as JSON; one row per check, so one file."""
    results.coalesce(1).write.mode("overwrite").json(path)
