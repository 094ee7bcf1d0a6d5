"""Structured Streaming counterparts of the load, the hourly metrics and the sessions.

Windows and sessions are written once the watermark has closed them. What is still open when a source
ends stays in the state until a closing marker moves the watermark past it: a row without an event,
read from a folder that is part of the stream. So all results come out of the stream itself, each
once, and an event that the watermark has dropped as late is in none of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from serpscope import schema as S
from serpscope.operators.kpi import mart
from serpscope.operators.star import fact_with_keys
from serpscope.session import STATE_STORE
from serpscope.sources.log import derive_log


def stream_log(spark: SparkSession, folder: str, pattern: str = "events.parquet") -> DataFrame:
    """The event log as a stream of files."""
    raw = (
        spark.readStream.schema(S.RAW_EVENTS)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )
    return derive_log(raw)


#: Times from here on are closing markers, not events.
CLOSING = "9000-01-01 00:00:00"
MARKER = "event_time timestamp"


def with_watermark(
    df: DataFrame, delay: str, ts: str = "timestamp", path: str | None = None
) -> DataFrame:
    """Watermarks need a timestamp with zone; log times are UTC. ``path`` is that of the stream's
    results, whose closing markers then move the watermark like events."""
    timed = df.withColumn("event_time", F.col(ts).cast("timestamp"))
    if path is None:
        return timed.withWatermark("event_time", delay)
    spark = df.sparkSession
    # The folder has to be there before the first marker is.
    spark.createDataFrame([], MARKER).write.mode("append").parquet(f"{path}/closing")
    markers = spark.readStream.schema(MARKER).parquet(f"{path}/closing")
    marked = timed.unionByName(markers, allowMissingColumns=True)
    # By event time, so that the filter stays above the watermark, which sees the markers.
    return marked.withWatermark("event_time", delay).where(F.col("event_time") < F.lit(CLOSING))


def close(spark: SparkSession, path: str) -> None:
    """Leave a marker after which nothing is open: the next run of the stream writes the rest.

    All events after it are late. A source that goes on has to go on in a new stream.
    """
    marker = spark.sql("SELECT timestamp '9999-01-01 00:00:00' AS event_time")
    marker.coalesce(1).write.mode("append").parquet(f"{path}/closing")


def run_available(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Process what is there and stop; exactly once through the sink's log and checkpoint."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    stream = writer.start()
    stream.awaitTermination()


def ingest_fact(log: DataFrame, path: str, delay: str = "2 hours") -> None:
    """Streaming load: repeated event ids within the delay are dropped."""
    unique = with_watermark(log, delay).dropDuplicatesWithinWatermark(["event_id"])
    fact = fact_with_keys(unique).withColumn("event_date", F.to_date("event_timestamp"))
    run_available(fact, path, ["event_date"])


def quality_windows(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Metrics per device and window of ``event_time``, for a stream or a table."""
    return mart(
        events, {"window": F.window("event_time", width), "device_type": F.col("device_type")}
    ).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        "device_type",
        "events",
        "clicks",
        F.round(F.col("latency_sum") / F.col("events"), 6).alias("avg_latency_ms"),
        F.round(F.col("score_sum") / F.col("events"), 6).alias("avg_quality_score"),
    )


def tumbling_quality(
    log: DataFrame, path: str, width: str = "1 hour", delay: str = "2 hours"
) -> None:
    """Metrics per device and window, written once the window is closed by the watermark."""
    run_available(quality_windows(with_watermark(log, delay, path=path), width), path)


SESSION = "user_id_masked string, session_start long, session_end long, events long, clicks long"


class SessionChain(StatefulProcessor):
    """Joins the pieces of one user to sessions, and writes each when nothing can join it any more.

    A piece is what a user did within one window no wider than the gap, so it lies in one session,
    and a session is a chain of pieces. State is the sessions that are still open: a few rows,
    however many events they have. A run over a long past opens and closes many sessions of a user at
    once: what the watermark has closed by then is written without going through the state, and one
    timer stands for all that stay open.
    """

    def __init__(self, gap: timedelta, width: timedelta):
        self.gap, self.width = (t // timedelta(microseconds=1) for t in (gap, width))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Times are microseconds, which no time zone of a worker can shift.
        self.open = handle.getListState("open", "first long, last long, events long, clicks long")

    def _due(self, last: int) -> int:
        """When all pieces are in that may begin within the gap: the end of their window, in
        milliseconds."""
        return ((last + self.gap) // self.width + 1) * self.width // 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = ["first", "last", "events", "clicks"]
        pieces = [p for frame in rows for p in zip(*(frame[c].tolist() for c in columns))]
        before = [tuple(s) for s in self.open.get()]
        chained: list[tuple] = []
        for piece in sorted([*before, *pieces]):
            if chained and piece[0] - chained[-1][1] <= self.gap:
                one = chained.pop()
                last = max(one[1], piece[1])
                piece = (one[0], last, one[2] + piece[2], one[3] + piece[3])
            chained.append(piece)
        # All of a user's rows of a batch come in one call, and its timers expire after them.
        yield from self._write(key, before, chained, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sessions = [tuple(s) for s in self.open.get()]
        yield from self._write(key, None, sessions, timerValues.getCurrentWatermarkInMs())

    def _write(
        self, key, before: list[tuple] | None, sessions: list[tuple], now: int
    ) -> Iterator[pd.DataFrame]:
        """Writes what is due and keeps the rest, with one timer for the session that is due first.

        ``before`` is what the state had, or None when its timer has expired."""
        done = [s for s in sessions if self._due(s[1]) <= now]
        rest = [s for s in sessions if self._due(s[1]) > now]
        if rest:
            self.open.put(rest)
        elif before is None or before:
            self.open.clear()
        old = min((self._due(s[1]) for s in before or ()), default=None)
        new = min((self._due(s[1]) for s in rest), default=None)
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            if new is not None:
                self.handle.registerTimer(new)
        if done:
            first, last, events, clicks = (list(c) for c in zip(*done))
            yield pd.DataFrame(
                {
                    "user_id_masked": key[0],
                    "session_start": first,
                    "session_end": [t + self.gap for t in last],
                    "events": events,
                    "clicks": clicks,
                }
            )

    def close(self) -> None:
        pass


def sessions(events: DataFrame, gap_minutes: int = S.SESSION_GAP_MINUTES) -> DataFrame:
    """Sessions per user of a stream with a watermark.

    Events are first counted up per user and window of the gap's width, which combines them before
    the shuffle; only these pieces reach the state of a user.
    """
    gap = timedelta(minutes=gap_minutes)
    pieces = (
        events.groupBy("user_id_masked", F.window("event_time", f"{gap_minutes} minutes").alias("window"))
        .agg(
            F.unix_micros(F.min("event_time")).alias("first"),
            F.unix_micros(F.max("event_time")).alias("last"),
            F.count(F.lit(1)).alias("events"),
            F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"),
        )
        .select("user_id_masked", F.window_time("window").alias("piece_time"), "first", "last", "events", "clicks")
    )
    chained = pieces.groupBy("user_id_masked").transformWithStateInPandas(
        SessionChain(gap, gap), SESSION, "Append", "EventTime"
    )
    return chained.select(
        "user_id_masked",
        *[F.timestamp_micros(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")],
        "events",
        "clicks",
    )


def stream_sessions(
    log: DataFrame, path: str, gap_minutes: int = S.SESSION_GAP_MINUTES, delay: str = "2 hours"
) -> None:
    """Sessions per user, written once no further event can join them."""
    # States with timers need this store.
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    run_available(sessions(with_watermark(log, delay, path=path), gap_minutes), path)
