"""Ordered per-key computations that stay parallel when one key holds most of the rows.

Ordinary keys use one shuffle and one window sort. Keys above ``hot_rows`` are taken out and
range-partitioned by (key, order), so a hot key spreads over many chunks; every chunk computes
locally and receives a carry (row count, running sum, last value) from the chunks before it.

Chunks hold about hot_rows rows each. Where that is less than a task is worth its start for, a task
holds several chunks, cut off its sorted rows: tasks and files go by the rows, not by hot_rows.

Size bounds of what is broadcast: with n rows, at most n / hot_rows keys are hot, so hot key tables
stay below n / hot_rows rows. Only a chunk's first key has earlier chunks, so carry tables have at
most a row per chunk: 200,000 narrow rows for 10^12 rows at the default setting. Either table is
joined by a shuffle when a small hot_rows makes it larger than BROADCAST_ROWS.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serpscope.session import materialize

HOT_ROWS = 5_000_000
CHUNK = "_chunk"


def join_keys(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, bounded: bool = False
) -> DataFrame:
    """Equi-join on same-named keys where null matches null; keeps the left key columns.

    ``bounded`` says that the right side is small by construction and may be broadcast.
    """
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    if bounded:
        renamed = F.broadcast(renamed)
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting; larger tables are left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, as a small table, or None when there are none.

    At most rows / hot_rows keys qualify, whatever the data looks like.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    # Written first, so that the input is counted once.
    hot = materialize(counted, "hot-keys")
    return None if hot.isEmpty() else hot


def split_hot(
    df: DataFrame, keys: list[str], hot_rows: int, costly: bool = False
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys, hot key table).

    A split reads the input twice; a ``costly`` input is computed once and written before keys are
    counted.
    """
    if costly:
        df = materialize(df, "split")
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df, None, None
    names = hot.select(*keys)
    bounded = hot.count() <= BROADCAST_ROWS
    return (
        join_keys(df, names, keys, "left_anti", bounded),
        join_keys(df, names, keys, "left_semi", bounded),
        hot,
    )


class Ordered:
    """One slice of a table, ready for ordered computations within its keys."""

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        chunked: bool,
        bounded: bool = True,
    ):
        self.df = df
        self.keys = keys
        self.order = order
        self.chunked = chunked
        # Whether one row per chunk may be broadcast.
        self.bounded = bounded
        parts = [CHUNK, *keys] if chunked else keys
        self.window = Window.partitionBy(*parts).orderBy(*order)
        self.running = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def _with(self, df: DataFrame) -> Ordered:
        return Ordered(df, self.keys, self.order, self.chunked, self.bounded)

    def _carried(self, df: DataFrame, tails: dict[str, Column], carries: dict) -> DataFrame:
        """Join what the earlier chunks of the same key hand over."""
        tail = df.groupBy(CHUNK, *self.keys).agg(*[c.alias(n) for n, c in tails.items()])
        before = (
            Window.partitionBy(*self.keys)
            .orderBy(CHUNK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = tail.select(
            CHUNK, *self.keys, *[build(before).alias(n) for n, build in carries.items()]
        )
        return self._joined(df, carry, list(carries))

    def _joined(self, df: DataFrame, carry: DataFrame, names: list[str]) -> DataFrame:
        """A chunk without a carry needs no row: a left join gives null as well."""
        some = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names])
        return join_keys(df, carry.where(some), [CHUNK, *self.keys], "left", self.bounded)

    def _last_value(self, value: Column) -> Column:
        order = F.struct(*self.order)
        return F.max_by(value, F.when(value.isNotNull(), order))

    def row_number(self, out: str) -> Ordered:
        df = self.df.withColumn(out, F.row_number().over(self.window).cast("bigint"))
        if self.chunked:
            df = self._carried(
                df,
                {"_carry": F.count(F.lit(1))},
                {"_carry": lambda w: F.sum("_carry").over(w)},
            )
            df = df.withColumn(out, F.col(out) + F.coalesce("_carry", F.lit(0))).drop("_carry")
        return self._with(df)

    def running_sum(self, value: str, out: str) -> Ordered:
        df = self.df.withColumn(out, F.sum(value).over(self.running))
        if self.chunked:
            df = self._carried(
                df, {"_carry": F.sum(value)}, {"_carry": lambda w: F.sum("_carry").over(w)}
            )
            total = F.coalesce(F.col(out), F.lit(0)) + F.coalesce("_carry", F.lit(0))
            empty = F.col(out).isNull() & F.col("_carry").isNull()
            df = df.withColumn(out, F.when(~empty, total)).drop("_carry")
        return self._with(df)

    def last_known(self, value: str, out: str) -> Ordered:
        """Newest non-null value at or before each row."""
        df = self.df.withColumn(out, F.last(value, ignorenulls=True).over(self.running))
        if self.chunked:
            df = self._carried(
                df,
                {"_carry": self._last_value(F.col(value))},
                {"_carry": lambda w: F.last("_carry", ignorenulls=True).over(w)},
            )
            df = df.withColumn(out, F.coalesce(out, "_carry")).drop("_carry")
        return self._with(df)

    def lag(self, value: str, out: str) -> Ordered:
        """Value of the row before, null on the first row of a key."""
        df = self.df.withColumn(out, F.lag(value).over(self.window))
        if self.chunked:
            order = F.struct(*self.order)
            df = df.withColumn("_chunk_first", F.row_number().over(self.window) == 1)
            df = self._carried(
                df,
                {"_carry": F.max_by(F.struct(F.col(value).alias("v")), order)},
                {"_carry": lambda w: F.last("_carry").over(w)},
            )
            df = df.withColumn(
                out, F.when(F.col("_chunk_first"), F.col("_carry.v")).otherwise(F.col(out))
            ).drop("_carry", "_chunk_first")
        return self._with(df)

    def lead(self, value: str, out: str) -> Ordered:
        """Value of the row after, null on the last row of a key."""
        df = self.df.withColumn(out, F.lead(value).over(self.window))
        if self.chunked:
            order = F.struct(*self.order)
            # The end of the chunk is found by looking one row ahead for any row at all.
            df = df.withColumn("_chunk_end", F.lead(F.lit(1)).over(self.window).isNull())
            head = df.groupBy(CHUNK, *self.keys).agg(
                F.min_by(F.struct(F.col(value).alias("v")), order).alias("_carry")
            )
            after = Window.partitionBy(*self.keys).orderBy(CHUNK)
            head = head.withColumn("_carry", F.lead("_carry").over(after))
            df = self._joined(df, head, ["_carry"])
            df = df.withColumn(
                out, F.when(F.col("_chunk_end"), F.col("_carry.v")).otherwise(F.col(out))
            ).drop("_carry", "_chunk_end")
        return self._with(df)

    def assign(self, **columns: Column) -> Ordered:
        return self._with(self.df.withColumns(columns))


#: Rows for which a task and its file are worth their start, and tasks that fewer rows may have.
TASK_ROWS = 100_000
FEW_TASKS = 64


def range_chunks(
    hot: DataFrame, keys: list[str], order: list[str], total: int, rows: int
) -> DataFrame:
    """Contiguous chunks of (key, order), frozen in a written table so all readers agree."""
    chunks = max(2, -(-total // rows))
    tasks = min(chunks, max(FEW_TASKS, -(-total // TASK_ROWS)))
    ranged = hot.repartitionByRange(tasks, *keys, *order)
    if tasks == chunks:
        chunk = F.spark_partition_id().cast("bigint")
    else:
        # Places in the sorted rows of a task, each task's above those of the task before; a chunk
        # is named by its first place.
        ranged = ranged.sortWithinPartitions(*keys, *order)
        place = F.monotonically_increasing_id()
        chunk = place - place.bitwiseAND((1 << 33) - 1) % rows
    return materialize(ranged.withColumn(CHUNK, chunk), "chunks")


def over_order(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    build: Callable[[Ordered], Ordered],
    hot_rows: int = HOT_ROWS,
    costly: bool = False,
) -> DataFrame:
    """Run ``build`` within each key in the given order.

    ``order`` must be total for results that depend on ties, and should end in a column that
    differs between rows, so that even rows tied on the rest can be split over chunks.
    ``costly`` marks an input with shuffles of its own, see ``split_hot``.
    """
    cold, hot, counts = split_hot(df, keys, hot_rows, costly)
    result = build(Ordered(cold, keys, order, chunked=False)).df
    if hot is None:
        return result
    total = counts.agg(F.sum("_n")).first()[0]
    chunks = range_chunks(hot, keys, order, total, hot_rows)
    bounded = total // hot_rows <= BROADCAST_ROWS
    scanned = build(Ordered(chunks, keys, order, True, bounded)).df.drop(CHUNK)
    return result.unionByName(scanned)
