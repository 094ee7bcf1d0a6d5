"""Per-day sketches that merge: distinct members of dimensions, and distributions of features.

A day is read once, when its sketches are written; every later question merges stored sketches, a
few kilobytes per day and column, and reads no events. A day that is loaded again replaces its own
sketches. The exact forms stay where they are (`dimension_cardinalities`, `drift_ks`).

Errors, as the sketch library states them:

* HyperLogLog with 2**LG_K registers: relative standard error 1.04 / sqrt(2**LG_K) = 0.0081.
* KLL with parameter K: ranks are off by at most RANK_ERROR with confidence 0.99. A distribution
  function is taken from the values at GRID + 1 even ranks: the share of them up to a value is the
  function there, rounded down to a multiple of 1 / GRID. Both samples are rounded alike, and
  between those values neither share changes, so the largest difference of the shares is off from
  the two-sample distance by at most DISTANCE_ERROR = 2 * RANK_ERROR + 1 / GRID.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.operators.monitor import DRIFT_COLUMNS, kolmogorov_p

LG_K = 14
MEMBER_ERROR = 1.04 / (1 << LG_K) ** 0.5
K_RANKS = 2000
#: For K_RANKS, by the library's formula 2.296 / K ** 0.9021.
RANK_ERROR = 2.296 / K_RANKS**0.9021
GRID = 400
DISTANCE_ERROR = 2 * RANK_ERROR + 1 / GRID

#: What a member of each dimension is told by.
MEMBERS = {
    "dim_geography": lambda: K.surrogate_key(*S.GEO_ATTRS),
    "dim_queries": K.query_key,
    "dim_systems": lambda: K.surrogate_key(*S.SYSTEM_ATTRS),
    "dim_users": K.user_key,
}

SKETCHES = "event_date date, kind string, name string, sketch binary"


def day_sketches(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per day and sketch, from one pass over the log."""
    columns = columns or DRIFT_COLUMNS
    members = [F.hll_sketch_agg(key(), LG_K).alias(f"members/{d}") for d, key in MEMBERS.items()]
    values = [F.kll_sketch_agg_double(F.col(c).cast("double"), K_RANKS).alias(f"values/{c}") for c in columns]
    names = [f"members/{d}" for d in MEMBERS] + [f"values/{c}" for c in columns]
    daily = log.groupBy(F.to_date("timestamp").alias("event_date")).agg(*members, *values)
    rows = [
        F.struct(
            F.lit(n.split("/")[0]).alias("kind"), F.lit(n.split("/")[1]).alias("name"), F.col(f"`{n}`").alias("sketch")
        )
        for n in names
    ]
    return daily.select("event_date", F.inline(F.array(*rows)))


def write_sketches(log: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Write the sketches of the days that the log has; other days keep theirs."""
    (
        day_sketches(log, columns)
        .repartition("event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def read_sketches(spark, path: str) -> DataFrame:
    return spark.read.schema(SKETCHES).parquet(path)


def merged_members(sketches: DataFrame) -> DataFrame:
    """Estimated distinct members of each dimension over the days given."""
    merged = sketches.where("kind = 'members'").groupBy(F.col("name").alias("dimension"))
    return merged.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def merged_values(sketches: DataFrame) -> DataFrame:
    """One distribution sketch per feature over the days given."""
    merged = sketches.where("kind = 'values'").groupBy(F.col("name").alias("feature"))
    return merged.agg(F.kll_merge_agg_double("sketch", K_RANKS).alias("sketch"))


def _share(values: str, x: Column) -> Column:
    """Of the even ranks, the share whose value is at most x."""
    return (F.size(F.filter(values, lambda v: v <= x)) - 1) / F.lit(float(GRID))


def sketched_ks(
    baseline: DataFrame, current: DataFrame, p_limit: float = S.KS_P_LIMIT
) -> DataFrame:
    """Two-sample distance per feature from the sketches of two sets of days, off by at most
    DISTANCE_ERROR (confidence 0.99 for each distribution). Neither period's events are read."""
    ranks = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])

    def side(sketches: DataFrame, name: str) -> DataFrame:
        return merged_values(sketches).select(
            "feature",
            F.kll_sketch_get_quantile_double("sketch", ranks).alias(name),
            F.kll_sketch_get_n_double("sketch").cast("double").alias(f"n_{name}"),
        )

    both = side(baseline, "_base").join(side(current, "_now"), "feature")
    points = F.array_distinct(F.concat("_base", "_now"))
    gaps = F.transform(points, lambda x: F.abs(_share("_base", x) - _share("_now", x)))
    n = F.col("n__base") * F.col("n__now") / (F.col("n__base") + F.col("n__now"))
    return (
        both.withColumn("_d", F.array_max(gaps))
        .select("feature", F.col("_d").alias("ks_distance"), kolmogorov_p(F.col("_d"), n).alias("p_value"))
        .withColumn("drifted", F.col("p_value") < p_limit)
    )
