import random
from datetime import datetime, timedelta

import pandas as pd
from conftest import rows
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators import kpi as R
from serpscope.operators import star as D
from serpscope.session import scratch_path
from serpscope.sources import log as L
from serpscope.streaming import jobs as ST


def _raw(spark, data):
    return spark.createDataFrame(data, S.RAW_EVENTS)


def _event(i, ts, user=1):
    return (i, ts, user, "click", 10.0, '{"k": 1}')


def test_stream_load_equals_batch_load(spark, data, log):
    path = scratch_path(spark, "stream")
    ST.ingest_fact(ST.stream_log(spark, data), path)
    got = spark.read.parquet(f"{path}/data").select(*S.FACT)
    assert rows(got) == rows(D.fact_with_keys(log))


def test_stream_load_continues_and_drops_repeats(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    start = datetime(2024, 1, 1)
    first = [_event(i, start + timedelta(minutes=i)) for i in range(5)]
    _raw(spark, first).write.mode("append").parquet(source)
    ST.ingest_fact(ST.stream_log(spark, source, "*.parquet"), path)
    repeated = [first[4], _event(9, start + timedelta(minutes=9))]
    _raw(spark, repeated).write.mode("append").parquet(source)
    ST.ingest_fact(ST.stream_log(spark, source, "*.parquet"), path)
    got = spark.read.parquet(f"{path}/data")
    assert got.count() == 6 and got.select("event_id").distinct().count() == 6


def test_late_events_are_left_out_of_closed_windows(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    start = datetime(2024, 1, 1)
    _raw(spark, [_event(1, start), _event(2, start + timedelta(hours=9))]).write.parquet(source)
    ST.tumbling_quality(ST.stream_log(spark, source, "*.parquet"), path)
    _raw(spark, [_event(3, start), _event(4, start + timedelta(hours=20))]).write.mode(
        "append"
    ).parquet(source)
    ST.tumbling_quality(ST.stream_log(spark, source, "*.parquet"), path)
    got = spark.read.parquet(f"{path}/data").groupBy("window_start").agg(F.sum("events"))
    assert {r[0]: r[1] for r in got.collect()} == {start: 1, start + timedelta(hours=9): 1}


def _minutes(start, *minutes, first=0, user=1):
    return [_event(first + i, start + timedelta(minutes=m), user) for i, m in enumerate(minutes)]


def _sessions(spark, path):
    got = spark.read.parquet(f"{path}/data").orderBy("user_id_masked", "session_start").collect()
    return [((r.session_start - START).total_seconds() / 60, r.events) for r in got]


START = datetime(2024, 1, 1)


def _run(spark, source, path, rows=None):
    if rows:
        _raw(spark, rows).coalesce(1).write.mode("append").parquet(source)
    ST.stream_sessions(ST.stream_log(spark, source, "*.parquet"), path)


def test_sessions_close_by_watermark_and_by_marker(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    _run(spark, source, path, _minutes(START, 0, 20, 45, 200, 900))
    assert _sessions(spark, path) == [(0, 3), (200, 1)]
    # A marker closes what the source has left open; another one changes nothing.
    ST.close(spark, path)
    _run(spark, source, path)
    assert _sessions(spark, path) == [(0, 3), (200, 1), (900, 1)]
    ST.close(spark, path)
    _run(spark, source, path)
    assert len(_sessions(spark, path)) == 3


def test_late_events_join_open_sessions_and_never_written_ones(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    _run(spark, source, path, _minutes(START, 0, 50, 100))
    # Late, but within the delay: it joins two sessions that are still open.
    _run(spark, source, path, _minutes(START, 25, first=10))
    _run(spark, source, path, _minutes(START, 600, first=20))
    assert _sessions(spark, path) == [(0, 3), (100, 1)]
    # Too late: it would join the two that are written, and is left out as a whole.
    _run(spark, source, path, _minutes(START, 75, first=30))
    ST.close(spark, path)
    _run(spark, source, path)
    assert _sessions(spark, path) == [(0, 3), (100, 1), (600, 1)]


def test_exact_gaps_and_borders_of_windows(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    rows = _minutes(START, 0, 30, 60, 90.001, 120.002, 29.999, user=1)
    rows += _minutes(START, 59.5, 89.4, 60.5, 150, first=50, user=2)
    _run(spark, source, path, rows)
    ST.close(spark, path)
    _run(spark, source, path)
    assert [n for _, n in _sessions(spark, path)] == [4, 1, 1, 3, 1]


def test_a_hot_user_over_several_files_equals_the_batch_sessions(spark):
    draw = random.Random(4)
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    rows = []
    for i in range(900):
        minute = i * 2 + draw.choice([0, 0, 1, 9]) + (200 if i > 500 else 0)
        user = 1 if i % 3 == 0 else draw.randint(2, 40)
        rows.append(_event(i, START + timedelta(minutes=minute), user))
    for part in range(3):
        _run(spark, source, path, rows[part * 300 : part * 300 + 300])
    ST.close(spark, path)
    _run(spark, source, path)
    log = L.derive_log(spark.read.schema(S.RAW_EVENTS).parquet(source))
    numbered = R.sessionize(log).groupBy("user_id_masked", "session_seq")
    want = numbered.agg(
        F.min("timestamp").alias("start"), F.max("timestamp").alias("last"), F.count("*"), F.sum("clicks")
    ).drop("session_seq")
    got = spark.read.parquet(f"{path}/data").withColumn(
        "last", F.col("session_end") - F.expr("INTERVAL 30 MINUTES")
    )
    got = got.select("user_id_masked", "session_start", "last", "events", "clicks")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_all_windows_come_out_of_the_stream(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    for part, minutes in enumerate([(0, 61, 500), (501, 450, 640)]):
        _raw(spark, _minutes(START, *minutes, first=10 * part)).write.mode("append").parquet(source)
        ST.tumbling_quality(ST.stream_log(spark, source, "*.parquet"), path)
    ST.close(spark, path)
    ST.tumbling_quality(ST.stream_log(spark, source, "*.parquet"), path)
    got = spark.read.parquet(f"{path}/data").groupBy("window_start").agg(F.sum("events"))
    hours = {(r[0] - START).total_seconds() / 3600: r[1] for r in got.collect()}
    assert hours == {0: 1, 1: 1, 7: 1, 8: 2, 10: 1}


class _Handle:
    """State and timers of one user, counting the calls."""

    def __init__(self):
        self.rows, self.timers, self.calls = [], set(), 0

    def getListState(self, name, schema):
        return self

    def get(self):
        return iter(list(self.rows))

    def put(self, rows):
        self.calls += 1
        self.rows = list(rows)

    def clear(self):
        self.calls += 1
        self.rows = []

    def listTimers(self):
        return iter([(t,) for t in self.timers])

    def registerTimer(self, t):
        self.calls += 1
        self.timers.add(t)

    def deleteTimer(self, t):
        self.calls += 1
        self.timers.remove(t)


class _Times:
    def __init__(self, now):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: now


def test_a_long_past_of_a_user_takes_few_calls():
    """sessions used to have a timer each, with the whole state read and put at each."""
    minute, gap = 60_000_000, timedelta(minutes=30)
    draw = random.Random(9)
    for last_piece in (0, 1):
        handle, chain = _Handle(), ST.SessionChain(gap, gap)
        chain.init(handle)
        out, most, total, now = [], 0, [], 0
        for batch in range(4):
            # Two hundred windows, of which the last ones may still be open.
            windows = [batch * 300 + w for w in sorted(draw.sample(range(300), 200))]
            starts = [w * 30 * minute + draw.randrange(29) * minute for w in windows]
            pieces = [(t, t + draw.randrange(2) * minute, 2, 1) for t in starts]
            total += pieces
            now = ((windows[-1] - 40 * last_piece) * 30 * minute) // 1000
            frame = pd.DataFrame(pieces, columns=["first", "last", "events", "clicks"])
            out += chain.handleInputRows(("u",), iter([frame[:70], frame[70:]]), _Times(now))
            assert len(handle.timers) <= 1
            for t in [t for t in handle.timers if t <= now]:
                out += chain.handleExpiredTimer(("u",), _Times(now), _Times(t))
                handle.timers.discard(t)
            most, handle.calls = max(most, handle.calls), 0
        end = now + 10**9
        while due := [t for t in handle.timers if t <= end]:
            out += chain.handleExpiredTimer(("u",), _Times(end), _Times(due[0]))
            handle.timers.discard(due[0])
        assert most <= 3 and not handle.rows and not handle.timers
        want = []
        for first, last, events, clicks in sorted(total):
            if want and first - want[-1][1] <= 30 * minute:
                want[-1] = (want[-1][0], max(want[-1][1], last), want[-1][2] + events, want[-1][3] + clicks)
            else:
                want.append((first, last, events, clicks))
        got = [tuple(r)[1:] for frame in out for r in frame.itertuples(index=False)]
        assert sorted(got) == [(a, b + 30 * minute, n, c) for a, b, n, c in want]
