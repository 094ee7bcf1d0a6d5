"""Exact linear-interpolated quantiles, also for groups too large for one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serpscope.operators.ordered import join_keys, split_hot
from serpscope.session import materialize

#: Rows of a group up to which its values are kept in one map of the built-in aggregate.
MAP_ROWS = 1_000_000
#: Bits by which an interval of values is narrowed in a round, and the number of rounds.
BITS = 16
ROUNDS = 64 // BITS


@F.pandas_udf(T.LongType())
def _code(value: pd.Series) -> pd.Series:
    """64-bit integers in the order of the doubles; NaN comes last, as in Spark."""
    x = value.to_numpy(dtype=np.float64) + 0.0
    bits = np.where(np.isnan(x), np.nan, x).view(np.int64)
    return pd.Series(bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF)))


@F.pandas_udf(T.DoubleType())
def _value(code: pd.Series) -> pd.Series:
    bits = code.to_numpy(dtype=np.int64)
    return pd.Series((bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64))


def narrowed_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]
) -> DataFrame:
    """Quantiles by narrowing intervals of values, with counts alone.

    A double is an ordered 64-bit code. Each round counts the values by the next bits of their code,
    within the intervals that hold a rank that is asked for, and keeps the interval with that rank;
    after four rounds an interval is one value. Rows are written once and read once a round; a round
    shuffles at most 2**16 counts per interval and task. No group is gathered or sorted, and no
    task's memory grows with a group.
    """
    coded = df.where(F.col(value).isNotNull()).select(
        *keys, _code(F.col(value).cast("double")).alias("_code")
    )
    coded = materialize(coded, "value-codes")
    wanted = None
    for number in range(ROUNDS):
        shift = 64 - BITS * (number + 1)
        counted = coded.withColumn("_next", F.shiftright("_code", shift))
        group = [*keys, "_next"]
        if wanted is not None:
            counted = counted.withColumn("_prefix", F.shiftright("_code", shift + BITS))
            inside = wanted.select(*keys, "_prefix").distinct()
            counted = join_keys(counted, inside, [*keys, "_prefix"], "left_semi")
            group.insert(len(keys), "_prefix")
        counted = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("_c"))
        # At most 2**BITS rows meet.
        parent = group[:-1]
        upto = Window.partitionBy(*parent).orderBy("_next")
        counted = counted.withColumn("_upto", F.sum("_c").over(upto))
        if wanted is None:
            counted = materialize(counted, "value-counts")
            ranks = counted.groupBy(*keys).agg(F.sum("_c").alias("_n"))
            places = [(F.col("_n") - 1) * F.lit(float(q)) for q in quantiles.values()]
            ends = F.array_distinct(F.array(*[f(p) for p in places for f in (F.floor, F.ceil)]))
            wanted = ranks.withColumn("_rank", F.explode(ends)).withColumn("_below", F.lit(0))
        found = join_keys(wanted, counted, parent, "inner")
        before = F.col("_below") + F.col("_upto") - F.col("_c")
        found = found.where((before <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + F.col("_upto")))
        wanted = materialize(
            found.select(
                *keys, "_n", "_rank", before.cast("long").alias("_below"), F.col("_next").alias("_prefix")
            ),
            "value-ranks",
        )
    valued = wanted.withColumn("_v", _value("_prefix"))
    picked, final = [], []
    for name, q in quantiles.items():
        place = (F.col("_n") - 1) * F.lit(float(q))
        low, high = F.floor(place), F.ceil(place)
        picked += [
            F.max(F.when(F.col("_rank") == low, F.col("_v"))).alias(f"_lo_{name}"),
            F.max(F.when(F.col("_rank") == high, F.col("_v"))).alias(f"_hi_{name}"),
            F.max(place - low).alias(f"_f_{name}"),
        ]
        lo, hi, f = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_f_{name}")
        final.append(F.when(lo == hi, lo).otherwise((1 - f) * lo + f * hi).alias(name))
    return valued.groupBy(*keys).agg(*picked).select(*keys, *final)


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    quantiles: dict[str, float],
    aggregates: dict[str, Column] | None = None,
    hot_rows: int = MAP_ROWS,
    accuracy: int | None = None,
    costly: bool = False,
) -> DataFrame:
    """Ordinary aggregates plus exact quantiles of one column, one row per key.

    Groups up to ``hot_rows`` use the built-in exact ``percentile`` in the same hash aggregation
    as the other aggregates; larger groups are narrowed down. ``costly`` marks an input with
    shuffles of its own, which is then computed and written once. With ``accuracy`` set, quantiles
    are approximate (rank error 1 / accuracy) and need a single pass for any group size.
    """
    extra = [c.alias(n) for n, c in (aggregates or {}).items()]
    if accuracy is not None:
        rough = [F.percentile_approx(value, q, accuracy).alias(n) for n, q in quantiles.items()]
        return df.groupBy(*keys).agg(*extra, *rough)
    cold, hot, _ = split_hot(df, keys, hot_rows, costly)
    # One value map per group serves all quantiles.
    built_in = F.percentile(value, [float(q) for q in quantiles.values()]).alias("_q")
    grouped = cold.groupBy(*keys).agg(*extra, built_in)
    named = [F.col("_q")[i].alias(n) for i, n in enumerate(quantiles)]
    result = grouped.select(*keys, *(aggregates or {}), *named)
    if hot is None:
        return result
    ranked = narrowed_quantiles(hot, keys, value, quantiles)
    if extra:
        grouped = hot.groupBy(*keys).agg(*extra)
        ranked = join_keys(grouped, ranked, keys, "left", bounded=True)
    return result.unionByName(ranked.select(*result.columns))
