import pytest
from conftest import rows
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators import incremental as I
from serpscope.operators import kpi as R
from serpscope.operators import quality as Q
from serpscope.operators import star as D
from serpscope.plans import daily, marts
from serpscope.session import scratch_path
from serpscope.sources import log as L
from serpscope.sources import sinks as W


@pytest.fixture(scope="module")
def stored(spark, log):
    path = scratch_path(spark, "log")
    W.write_date_partitioned(log, path)
    return path


def test_daily_run(spark, log, stored):
    root = scratch_path(spark, "daily")
    store = daily.run_daily(spark, stored, root, "1", maxIter=3, maxDepth=3)
    fact = W.read_published(spark, store.path("warehouse"), "fct_search_events")
    assert fact.count() == log.count() and "session_event_sequence" in fact.columns
    scores = store.read(spark, "scores")
    assert scores.count() == log.count()
    ends = scores.agg(F.min("prediction"), F.max("prediction")).first()
    assert 0 <= ends[0] <= ends[1] <= 100
    # The cut comes from the training rows, so a batch may have more or fewer than a tenth.
    assert store.read(spark, "models/outlier_cuts/1").count() == 1
    assert 0 < scores.where("is_anomaly").count() < 0.5 * log.count()
    assert scores.where("is_anomaly <> (anomaly_score < 0)").count() == 0
    assert {r[0] for r in scores.select("status").distinct().collect()} == {"scored"}
    assert store.read(spark, "reports/overview").first().total_queries == log.count()
    again = daily.train(
        L.scan_events(spark, stored), store, "2", maxIter=1, maxDepth=1
    )
    assert {r.version: r.status for r in again.collect()} == {"1": "active", "2": "shadow"}


def test_failed_check_stops_the_run(spark, log):
    path = scratch_path(spark, "log")
    W.write_date_partitioned(log.withColumn("position", F.lit(99)), path)
    root = scratch_path(spark, "daily")
    with pytest.raises(Q.ValidationFailed):
        daily.run_daily(spark, path, root, "1")
    assert spark.read.json(f"{root}/reports/checks").where("not success").count() == 1
    assert W.current_version(spark, f"{root}/warehouse") is None


def _plan(df):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("bounds", [("2024-01-10 06:00:00", "2024-01-12 18:00:00"),
                                    ("2024-01-25 00:00:00", None), (None, "2024-01-02 00:00:00")])
def test_time_slice_prunes_folders(spark, log, stored, bounds):
    start, end = bounds
    got = L.time_slice(L.scan_events(spark, stored), start, end)
    assert "PartitionFilters: [isnotnull(" in _plan(got)
    plain = L.time_slice(log, start, end)
    assert rows(got.select(*S.EVENT_LOG.fieldNames())) == rows(plain) and plain.count() > 0


@pytest.mark.parametrize("partition", ["event_month", "event_date"])
def test_fact_slices_prune_too(spark, log, partition):
    path = scratch_path(spark, "fact")
    fact = D.fact_with_keys(log)
    W.write_fact(fact, path, partition)
    bounds = "2024-01-10 06:00:00", "2024-01-12 18:00:00"
    got = L.time_slice(spark.read.parquet(path), *bounds, ts="event_timestamp")
    assert any("PartitionFilters" in x and partition in x for x in _plan(got).splitlines())
    assert rows(got.select(*S.FACT)) == rows(L.time_slice(fact, *bounds, ts="event_timestamp"))


def test_watermark_reads_the_newest_day_only(spark, log):
    path = scratch_path(spark, "fact")
    fact = D.fact_with_keys(log)
    W.write_fact(fact, path, "event_date")
    assert I.watermark_value(spark.read.parquet(path)) == I.watermark_value(fact)
    assert I.watermark_value(spark.read.parquet(path).where("false")) is None


def test_checks_read_needed_columns_only(spark, stored):
    plan = _plan(Q.validate_events(L.scan_events(spark, stored)))
    schema = [x for x in plan.splitlines() if "ReadSchema" in x]
    assert len(schema) == 1 and "serp_features" not in schema[0]


def test_two_runs_keep_what_one_would(spark, log, stored):
    """The second run replaces the days it gets, reads their folders only, and can be repeated."""
    scanned = L.scan_events(spark, stored)
    whole, parts = scratch_path(spark, "marts"), scratch_path(spark, "marts")
    marts.update(scanned, whole)
    marts.update(L.time_slice(scanned, None, "2024-01-20 12:00:00"), parts)
    last = L.time_slice(scanned, "2024-01-20 00:00:00")
    assert "PartitionFilters: [isnotnull(" in _plan(last)
    for _ in range(2):
        marts.update(last, parts)
        for build in marts.REPORTS.values():
            assert rows(build(spark, parts)) == rows(build(spark, whole))
    assert rows(marts.daily_mart(spark, whole)) == rows(R.daily_mart(log))
