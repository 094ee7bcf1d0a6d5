"""Report tables kept up to date by days: a run reads the days that came, not all history.

Two additive tables hold what the reports divide: sums per day and segment, per hour and per user,
and counts per score bin. A day that is loaded again replaces its own rows, so a run can be repeated.
Every report is computed from them; a report over all history costs a scan of a few numbers a day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators import kpi as R
from serpscope.sources.sinks import balanced

DAY = "day"
BINS = 50


def _binned(log: DataFrame) -> DataFrame:
    """Counts per day and bin of the score."""
    daily = log.where(F.col(S.LABEL).isNotNull()).withColumn(DAY, F.to_date("timestamp"))
    return daily.groupBy(DAY, R.histogram_bin(S.LABEL, 0.0, 100.0, BINS).alias("bin")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _summed(*keys: str) -> Callable[[DataFrame], DataFrame]:
    def build(log: DataFrame) -> DataFrame:
        return R.mart(log, {DAY: F.to_date("timestamp"), **{k: F.col(k) for k in keys}})

    return build


#: What is kept, each with one row per day and key.
TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "segments": _summed(*R.SEGMENTS),
    "users": _summed("user_id_masked"),
    "scores": _binned,
}


def update(log: DataFrame, root: str) -> None:
    """Fold the days of `log` in: each must be whole, and replaces what was kept of that day."""
    for name, build in TABLES.items():
        (
            balanced(build(log), [DAY])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(f"{root}/{name}")
        )


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A kept table, its day as a date."""
    kept = spark.read.parquet(f"{root}/{name}")
    return kept.withColumn(DAY, F.col(DAY).cast("date"))


def _merged(kept: DataFrame, *keys: str) -> DataFrame:
    return kept.groupBy(*keys).agg(*R.merge_sums())


def daily_volume(spark: SparkSession, root: str) -> DataFrame:
    counts = _merged(read(spark, root, "segments"), DAY).select(DAY, F.col("events").alias("_n"))
    return R.with_empty_days(counts.where(F.col(DAY).isNotNull()))


def daily_mart(spark: SparkSession, root: str) -> DataFrame:
    return R.daily_rates(read(spark, root, "segments"))


def segment_metrics(spark: SparkSession, root: str) -> DataFrame:
    return R.cube_metrics(_merged(read(spark, root, "segments"), *R.SEGMENTS), R.SEGMENTS)


def rolling_metrics(spark: SparkSession, root: str) -> DataFrame:
    return R.rolling_rates(read(spark, root, "users"))


def kpi_change(spark: SparkSession, root: str) -> DataFrame:
    return R.change_by_day(_merged(read(spark, root, "segments"), DAY))


def score_histogram(spark: SparkSession, root: str) -> DataFrame:
    counts = read(spark, root, "scores").groupBy("bin").agg(F.sum("row_count").alias("row_count"))
    start: Column = F.lit(0.0) + F.col("bin") * (100.0 / BINS)
    return counts.select("bin", start.alias("bin_start"), "row_count")


REPORTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_volume": daily_volume,
    "score_histogram": score_histogram,
    "daily_mart": daily_mart,
    "segments": segment_metrics,
    "rolling": rolling_metrics,
    "score_change": kpi_change,
}
