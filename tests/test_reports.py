from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from serpscope.functions import keys as K
from serpscope.functions import scalars as X
from serpscope.operators import kpi as R
from serpscope.operators import monitor as M


def one(spark, **values):
    return spark.createDataFrame([tuple(values.values())], list(values))


def test_daily_volume_fills_empty_days(spark):
    log = spark.createDataFrame(
        [(datetime(2026, 1, 1, 5),), (datetime(2026, 1, 4),), (datetime(2026, 1, 4, 1),)],
        "timestamp timestamp_ntz",
    )
    got = {r.day: r.volume for r in R.daily_volume(log).collect()}
    assert got == {
        date(2026, 1, 1): 1,
        date(2026, 1, 2): 0,
        date(2026, 1, 3): 0,
        date(2026, 1, 4): 2,
    }


def test_histogram_keeps_the_ends(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 1.9, 2.0, 99.9, 100.0]], "s double")
    got = {r.bin: r.row_count for r in R.histogram(df, "s", 0, 100, 50).collect()}
    assert got == {0: 2, 1: 1, 49: 2}


def test_describe_matches_pandas(log):
    got = {r.column_name: r for r in R.describe_exact(log, ["latency_ms", "position"]).collect()}
    want = log.select("latency_ms", "position").toPandas().describe()
    names = {"value_count": "count", "p25": "25%", "p50": "50%", "p75": "75%"}
    for column, row in got.items():
        for field in ["value_count", "mean", "std", "min", "p25", "p50", "p75", "max"]:
            assert row[field] == pytest.approx(want[column][names.get(field, field)], abs=1e-5)


def test_sample_is_exact_and_reproducible(log):
    one_way = R.sample_n(log.select("event_id").repartition(3), 100, 42, "event_id")
    other = R.sample_n(log.select("event_id"), 100, 42, "event_id")
    assert one_way.count() == 100 and rows(one_way) == rows(other)
    assert rows(R.sample_n(log.select("event_id"), 100, 7, "event_id")) != rows(other)


def _visits(spark, minutes):
    start = datetime(2026, 1, 1)
    return spark.createDataFrame(
        [(f"e{i}", "u", start + timedelta(minutes=m)) for i, m in enumerate(minutes)],
        "event_id string, user_id_masked string, timestamp timestamp_ntz",
    )


def test_exactly_the_gap_stays_in_the_session(spark):
    got = R.sessionize(_visits(spark, [0, 30, 60.01, 91])).orderBy("event_id").collect()
    assert [r.session_seq for r in got] == [1, 1, 2, 3]


def test_sessions_equal_session_window(log):
    # A session window ends one gap after its last event, exclusive of that instant.
    windows = log.groupBy(
        "user_id_masked", F.session_window(F.col("timestamp").cast("timestamp"), "30 minutes")
    ).count()
    sessions = R.sessionize(log).groupBy("user_id_masked", "session_seq").count()
    assert windows.count() == sessions.count()


def test_pogo_and_reformulation(spark):
    start = datetime(2026, 1, 1)
    rows_in = [
        ("a", "u", start, "x", 1),
        ("b", "u", start + timedelta(seconds=4), "x", 1),
        ("c", "u", start + timedelta(seconds=20), "y", 0),
        ("d", "u", start + timedelta(hours=2), "z", 1),
    ]
    log = spark.createDataFrame(
        rows_in,
        "event_id string, user_id_masked string, timestamp timestamp_ntz, "
        "search_query_masked string, clicks int",
    )
    got = {r.event_id: (r.pogo_derived, r.reformulation_derived)
           for r in R.derive_flags(log).collect()}
    assert got == {"a": (1, 0), "b": (0, 0), "c": (0, 1), "d": (0, 0)}


def test_cube_contains_every_level(log):
    cube = R.segment_metrics(log, ["country", "device_type"])
    total = cube.where("grouping_set = 3").collect()
    assert len(total) == 1 and total[0].events == log.count()
    assert cube.where("grouping_set = 1").agg(F.sum("events")).first()[0] == log.count()


def test_rolling_windows_are_sum_over_sum(log):
    got = R.rolling_metrics(log).where("day = '2024-01-20'").collect()
    last = log.where(F.to_date("timestamp").between("2024-01-14", "2024-01-20"))
    want = {
        r.user_id_masked: r.ctr
        for r in last.groupBy("user_id_masked")
        .agg((F.sum("clicks") / F.count("*")).alias("ctr"))
        .collect()
    }
    assert got and all(
        r.ctr_roll_7d == pytest.approx(want[r.user_id_masked], abs=1e-6) for r in got
    )


def test_ks_matches_brute_force(spark):
    draw = np.random.default_rng(1)
    a, b = draw.normal(size=300), draw.normal(loc=0.4, size=200)
    df = spark.createDataFrame(
        [("baseline", float(x)) for x in a] + [("current", float(x)) for x in b],
        "period string, x double",
    )
    got = M.drift_ks(df, ["x"]).first()
    points = np.concatenate([a, b])
    want = max(abs((a <= p).mean() - (b <= p).mean()) for p in points)
    assert got.ks_distance == pytest.approx(want, abs=1e-6)
    assert got.drifted and got.p_value < 0.05
    same = M.drift_ks(df.withColumn("x", F.lit(1.0)), ["x"]).first()
    assert same.ks_distance == 0 and same.p_value == 1 and not same.drifted


def test_psi_of_equal_and_shifted_periods(spark):
    same = [(p, float(i % 50)) for p in ("baseline", "current") for i in range(500)]
    df = spark.createDataFrame(same, "period string, x double")
    assert M.drift_psi(df, ["x"]).first().psi == 0
    moved = df.withColumn("x", F.when(F.col("period") == "current", 49.0).otherwise(F.col("x")))
    assert M.drift_psi(moved, ["x"]).first().drifted
    for gone in ("period = 'current'", "period = 'baseline'", "false"):
        row = M.drift_psi(moved.where(gone), ["x"]).first()
        assert (row.feature, row.psi, row.drifted) == ("x", None, None)


def _hours(spark, scores, latency=100.0):
    start = datetime(2026, 1, 1)
    data = [
        (start + timedelta(hours=i), "US", "Mobile", 1, 1, latency, 0, 0, 0.0, float(s))
        for i, s in enumerate(scores)
    ]
    return spark.createDataFrame(
        data,
        "timestamp timestamp_ntz, country string, device_type string, clicks int, "
        "impressions int, latency_ms double, pogo_stick_flag int, reformulation_flag int, "
        "revenue_estimate_usd double, search_quality_score double",
    )


def test_alert_levels(spark):
    steady = [90.0] * 24
    got = M.alert_levels(_hours(spark, steady + [80.0, 90.0])).collect()
    assert {(r.scope, r.alert_level) for r in got} == {("global", 1), ("US/Mobile", 3)}
    long = M.alert_levels(_hours(spark, steady + [87.0] * 4)).collect()
    assert {(r.scope, r.alert_level) for r in long} == {("US/Mobile", 2)}
    slow = M.alert_levels(_hours(spark, steady, latency=2000.0)).collect()
    assert len(slow) == 24 and {r.alert_level for r in slow} == {1}


def test_zscore_flags_a_jump(spark):
    log = _hours(spark, [90.0] * 40)
    wave = F.lit(100.0) + F.hour("timestamp") % 3
    jump = F.col("timestamp") == F.lit(datetime(2026, 1, 2, 12)).cast("timestamp_ntz")
    log = log.withColumn("latency_ms", F.when(jump, 400.0).otherwise(wave))
    flagged = M.zscore_anomalies(log).where("is_anomaly").collect()
    assert [r.hour for r in flagged] == [datetime(2026, 1, 2, 12)]


def test_chronological_split_never_leaks(log):
    split = M.chronological_split(log.select("event_id", "timestamp"))
    ends = {r.split: (r.lo, r.hi, r.n) for r in split.groupBy("split").agg(
        F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.count("*").alias("n")
    ).collect()}
    assert ends["train"][1] < ends["test"][0]
    assert ends["test"][2] / log.count() == pytest.approx(0.2, abs=0.02)


def test_scalars(spark):
    words = [("", 0), ("  ", 0), (" a  b\tc ", 3), ("one", 1), (None, 1),
             ("a\u00a0b\u3000c", 3), ("\u2003x\x1fy\u0085", 2)]
    assert all(n == len(t.split()) for t, n in words if t is not None)
    df = spark.createDataFrame(words, "t string, n int")
    assert all(r.n == r.w for r in df.withColumn("w", X.word_count(F.col("t"))).collect())
    score = one(
        spark, position=1, reformulation_flag=0, pogo_stick_flag=1, latency_ms=300.0,
        search_intent="Commercial",
    )
    want = 100 - 2.2 - 18 - 8 * np.log(2) * 1.8
    assert score.select(X.quality_score()).first()[0] == round(want, 2)
    flat = 100 - 2.2 - 18 - 8 * np.log(2)
    assert score.select(X.quality_score(False)).first()[0] == round(flat, 2)
    bands = spark.createDataFrame([(s,) for s in [49.99, 50.0, 75.0, 90.0]], "s double")
    assert [tuple(r) for r in bands.select(
        X.gauge_band(F.col("s")), X.score_bucket(F.col("s"))
    ).collect()] == [
        ("red", "Poor"), ("amber", "Fair"), ("green", "Good"), ("green", "Excellent"),
    ]
    ratio = one(spark, a=3, b=0).select(X.safe_ratio(F.col("a"), F.col("b"))).first()[0]
    assert ratio == 3.0


def test_masking_hides_and_is_salted(log):
    masked = log.select(
        "user_id_masked", K.mask_pii(F.col("user_id_masked"), "s1").alias("m"),
        K.mask_pii(F.col("user_id_masked"), "s2").alias("o"),
    ).distinct()
    found = masked.collect()
    assert len({r.m for r in found}) == len(found) and all(r.m != r.o for r in found)
    assert all(len(r.m) == 64 for r in found)


def test_log_properties(log):
    bad = log.where(
        ~F.col("clicks").isin(0, 1)
        | (F.col("impressions") != 1)
        | ~F.col("position").between(1, 10)
        | ~F.col("search_quality_score").between(0, 100)
        | ((F.col("clicks") == 0) & ((F.col("dwell_time_sec") > 0) | (F.col("scroll_depth") > 0)))
    )
    assert bad.count() == 0
    pairs = {(r.country, r.language) for r in log.select("country", "language").distinct().collect()}
    assert {lang for c, lang in pairs if c == "Japan"} <= {"ja", "en"}
    assert {lang for c, lang in pairs if c == "Germany"} <= {"de", "en"}
