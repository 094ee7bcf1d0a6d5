"""Hot-key paths must equal the plain windows, and both must equal brute force."""

import math
import random
from bisect import bisect_right
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators import features as FT
from serpscope.operators import joins as J
from serpscope.operators import kpi as R
from serpscope.operators import monitor as M
from serpscope.operators import ordered as O
from serpscope.operators import star as D
from serpscope.operators import quantiles as Q
from serpscope.operators.ordered import CHUNK, over_order, range_chunks
from serpscope.operators.quantiles import group_quantiles, narrowed_quantiles
from serpscope.plans import training as T
from serpscope.session import materialize

HOT = 40


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with half of the rows, many of them tied in time, plus null keys."""
    draw = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 2 else draw.choice(["a", "b", "c", None])
        ts = datetime(2024, 1, 1) + timedelta(hours=draw.randrange(30))
        data.append((key, ts, i, draw.choice([None, draw.randrange(100)])))
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, id int, v int").repartition(5)


def everything(s):
    return (
        s.row_number("rn")
        .running_sum("v", "total")
        .last_known("v", "seen")
        .lag("v", "before")
        .lead("v", "after")
    )


def test_hot_keys_match_plain_windows(skewed):
    plain = over_order(skewed, ["k"], ["ts", "id"], everything, hot_rows=10_000)
    split = over_order(skewed, ["k"], ["ts", "id"], everything, hot_rows=HOT)
    assert CHUNK not in split.columns
    assert rows(plain) == rows(split)


def test_ordered_matches_brute_force(skewed):
    split = over_order(skewed, ["k"], ["ts", "id"], everything, hot_rows=HOT).collect()
    groups = {}
    for r in split:
        groups.setdefault(r.k, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (r.ts, r.id))
        total, seen = None, None
        for i, r in enumerate(members):
            if r.v is not None:
                total, seen = (total or 0) + r.v, r.v
            assert (r.rn, r.total, r.seen) == (i + 1, total, seen)
            assert r.before == (members[i - 1].v if i else None)
            assert r.after == (members[i + 1].v if i + 1 < len(members) else None)


def test_hot_key_spreads_over_chunks(skewed):
    hot = skewed.where("k = 'hot'")
    chunks = range_chunks(hot, ["k"], ["ts", "id"], 450, HOT)
    sizes = [r[1] for r in chunks.groupBy(CHUNK).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 4 * HOT


def test_narrowing_is_exact_for_any_doubles(spark):
    draw = random.Random(7)
    odd = [0.0, -0.0, 5e-324, -5e-324, 1.0, 1.0 + 2**-52, -1e308, 1e308, float("inf"), float("-inf")]
    data = [("odd", v) for v in odd] + [("same", 2.5)] * 40 + [("one", -3.0), (None, 7.0), ("none", None)]
    data += [("many", draw.gauss(0, 1) * 10 ** draw.randint(-9, 9)) for _ in range(3000)]
    data += [("ties", float(draw.randint(-3, 3))) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    asked = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q95": 0.95, "q1": 1.0}
    got = {r.k: tuple(r)[1:] for r in narrowed_quantiles(df, ["k"], "v", asked).collect()}
    by = {}
    for k, v in data:
        if v is not None:
            by.setdefault(k, []).append(v)
    assert got.keys() == by.keys()
    for k, values in by.items():
        values.sort()
        for name, found in zip(asked, got[k]):
            place = (len(values) - 1) * asked[name]
            low, high = values[math.floor(place)], values[math.ceil(place)]
            want = low if low == high else (1 - place % 1) * low + place % 1 * high
            assert found == want or abs(found - want) <= 1e-12 * abs(want)


def test_narrowing_reads_its_input_a_fixed_number_of_times(spark, monkeypatch):
    written = []

    def counted(df, name):
        written.append(name)
        return materialize(df, name)

    monkeypatch.setattr(Q, "materialize", counted)
    for n in (10, 5000):
        written.clear()
        df = spark.range(n).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
        row = narrowed_quantiles(df, ["k"], "v", {"p50": 0.5}).first()
        assert row.p50 == (n - 1) / 2
        assert written.count("value-codes") == 1 and written.count("value-ranks") == Q.ROUNDS


@pytest.mark.parametrize("hot_rows", [HOT, 10_000, 0])
def test_quantiles_match_percentile(skewed, hot_rows):
    got = group_quantiles(
        skewed,
        ["k"],
        "v",
        {"p50": 0.5, "p95": 0.95},
        {"n": F.count("v"), "total": F.sum("v")},
        hot_rows,
    )
    want = skewed.groupBy("k").agg(
        F.round(F.percentile("v", 0.5), 9).alias("p50"),
        F.round(F.percentile("v", 0.95), 9).alias("p95"),
        F.count("v").alias("n"),
        F.sum("v").alias("total"),
    )
    got = got.withColumns({c: F.round(c, 9) for c in ["p50", "p95"]})
    assert rows(got) == rows(want)


def test_approximate_quantiles_are_close(skewed):
    got = group_quantiles(skewed, ["k"], "v", {"p50": 0.5}, accuracy=1000).collect()
    want = {r.k: r.p for r in skewed.groupBy("k").agg(F.percentile("v", 0.5).alias("p")).collect()}
    assert all(abs(r.p50 - want[r.k]) <= 3 for r in got)


def _snapshots(spark):
    draw = random.Random(3)
    data, used = [], set()
    for _ in range(120):
        key = draw.choice(["hot", "a", "b"])
        ts = datetime(2024, 1, 1) + timedelta(hours=draw.randrange(30))
        if (key, ts) not in used:
            used.add((key, ts))
            data.append((key, ts, draw.random()))
    return spark.createDataFrame(data, "k string, fts timestamp_ntz, x double"), data


@pytest.mark.parametrize("hot_rows", [HOT, 10_000])
@pytest.mark.parametrize("lag_days", [0, 1])
def test_asof_matches_brute_force(spark, skewed, hot_rows, lag_days):
    features, data = _snapshots(spark)
    ttl = 0 if lag_days == 0 else 1
    got = J.asof_join(
        skewed, features, "k", "ts", "fts", ["x"], ttl, lag_days, tie=["id"], hot_rows=hot_rows
    ).collect()
    lines = {}
    for k, t, x in sorted(data):
        lines.setdefault(k, []).append((t, x))
    assert len(got) == 900
    for r in got:
        want = None
        line = lines.get(r.k, [])
        i = bisect_right([t + timedelta(days=lag_days) for t, _ in line], r.ts)
        if i and r.ts - line[i - 1][0] <= timedelta(days=ttl):
            want = line[i - 1][1]
        assert r.x == want


def test_asof_includes_exact_time_and_ttl_edge(spark):
    left = spark.createDataFrame(
        [("u", datetime(2024, 1, 1)), ("u", datetime(2024, 1, 11)), ("u", datetime(2024, 1, 12))],
        "k string, ts timestamp_ntz",
    )
    right = spark.createDataFrame(
        [("u", datetime(2024, 1, 1), 1.0)], "k string, fts timestamp_ntz, x double"
    )
    got = J.asof_join(left, right, "k", "ts", "fts", ["x"], ttl_days=10, matched_ts="at")
    assert [r.x for r in got.orderBy("ts").collect()] == [1.0, 1.0, None]


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, datetime(2024, 1, 2))], "k string, ts timestamp_ntz")
    right = spark.createDataFrame(
        [(None, datetime(2024, 1, 1), 1.0)], "k string, fts timestamp_ntz, x double"
    )
    for unique in (True, False):
        got = J.asof_join(left, right, "k", "ts", "fts", ["x"], right_unique=unique).collect()
        assert [r.x for r in got] == [None]


def test_asof_repeated_snapshots_give_one_row(spark):
    left = spark.createDataFrame([("u", datetime(2024, 1, 2))], "k string, ts timestamp_ntz")
    right = spark.createDataFrame(
        [("u", datetime(2024, 1, 1), 1.0), ("u", datetime(2024, 1, 1), 2.0)],
        "k string, fts timestamp_ntz, x double",
    )
    assert [r.x for r in J.asof_join(left, right, "k", "ts", "fts", ["x"]).collect()] == [2.0]


def test_operators_agree_under_skew(log):
    fact = D.fact_with_keys(log)
    assert rows(D.add_sequence(fact, hot_rows=8)) == rows(D.add_sequence(fact))
    narrow = log.select("event_id", "user_id_masked", "timestamp")
    assert rows(R.sessionize(narrow, hot_rows=60)) == rows(R.sessionize(narrow))
    assert rows(R.derive_flags(log, hot_rows=60)) == rows(R.derive_flags(log))
    assert rows(R.latency_percentiles(log, hot_rows=200)) == rows(R.latency_percentiles(log))
    assert rows(R.describe_exact(log, ["latency_ms", "position"], hot_rows=300)) == rows(
        R.describe_exact(log, ["latency_ms", "position"])
    )
    periods = M.split_periods(log, "2024-01-16 00:00:00")
    assert rows(M.drift_ks(periods, hot_rows=300)) == rows(M.drift_ks(periods))
    assert rows(M.chronological_folds(narrow, hot_rows=300)) == rows(
        M.chronological_folds(narrow)
    )


def test_training_matrix_agrees_under_skew(log):
    uf, qf = FT.user_daily_features(log), FT.query_daily_features(log)
    plain = T.training_matrix(log, uf, qf)
    assert rows(T.training_matrix(log, uf, qf, hot_rows=30)) == rows(plain)
    assert plain.columns == ["event_id", *S.FEATURES, S.LABEL]


def test_query_features_agree_under_skew(log):
    assert rows(FT.query_daily_features(log, hot_rows=2)) == rows(FT.query_daily_features(log))


def test_many_small_chunks_take_few_tasks(spark):
    """chunks of a few rows stay, but a task and its file hold many of them."""
    table = spark.range(20_000).select(
        (F.col("id") % 300).alias("k"), F.hash("id").alias("ts"), "id", (F.col("id") % 7).alias("v")
    )
    chunks = range_chunks(table, ["k"], ["ts", "id"], 20_000, 10)
    assert len(chunks.inputFiles()) <= O.FEW_TASKS
    by = {}
    for r in chunks.collect():
        by.setdefault(r[CHUNK], []).append((r.k, r.ts, r.id))
    assert len(by) >= 2000 and max(map(len, by.values())) == 10
    # Chunks follow each other in the order of the rows.
    ends = [(min(by[c]), max(by[c])) for c in sorted(by)]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    plain = over_order(table, ["k"], ["ts", "id"], everything, hot_rows=10_000)
    assert rows(over_order(table, ["k"], ["ts", "id"], everything, hot_rows=10)) == rows(plain)


def test_only_continued_chunks_get_a_carry(spark, monkeypatch):
    """keys that lie within a chunk hand nothing over, and keys are counted in one pass."""
    joined, passes = [], spark.sparkContext.accumulator(0)
    join = O.join_keys

    def counted(left, right, keys, how, bounded=False):
        if CHUNK in keys:
            joined.append((right.count(), bounded))
        return join(left, right, keys, how, bounded)

    monkeypatch.setattr(O, "join_keys", counted)
    # 50 rows a key, 200 a chunk: of about 205 pieces only those behind a border have a carry.
    table = spark.range(10_000).select(F.floor(F.col("id") / 50).alias("k"), F.col("id").alias("ts"))
    chunks = range_chunks(table, ["k"], ["ts"], 10_000, 200)
    number = chunks.select(CHUNK).distinct().count()
    s = O.Ordered(chunks, ["k"], ["ts"], chunked=True)
    s.row_number("rn").last_known("ts", "seen").lag("ts", "before").lead("ts", "after")
    assert len(joined) == 4 and all(n < number and b for n, b in joined)
    joined.clear()
    O.Ordered(chunks, ["k"], ["ts"], chunked=True, bounded=False).row_number("rn")
    assert [b for _, b in joined] == [False]

    @F.udf("long")
    def seen(k):
        passes.add(1)
        return k

    assert O.hot_keys(table.select(seen("k").alias("k")), ["k"], 49).count() == 200
    assert passes.value == 10_000
