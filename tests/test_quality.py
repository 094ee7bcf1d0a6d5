import json
from pathlib import Path

import pytest
from fixtures import event_rows
from pyspark.sql import functions as F

from serpscope.operators import quality as Q
from serpscope.operators import star as D
from serpscope.session import scratch_path
from serpscope.sources.sinks import write_report


def test_good_events_pass_all_14_checks(spark):
    results = Q.validate_events(event_rows(spark))
    assert results.count() == 14
    assert results.where(~F.col("success")).count() == 0
    Q.dq_gate(results)
    summary = Q.dq_summary(results).first().asDict()
    assert summary == {
        "validation_success": True,
        "total_records_validated": 2,
        "evaluated_expectations": 14,
        "successful_expectations": 14,
        "unsuccessful_expectations": 0,
        "success_percent": 100.0,
    }


def _bad(spark):
    return event_rows(spark).withColumns(
        {
            "position": F.lit(11),
            "country": F.when(F.col("country") == "Japan", "Atlantis"),
            "session_id": F.when(F.col("event_id") == "evt_1", F.col("session_id")),
        }
    )


def test_failures_are_counted(spark):
    found = {
        (r.column_name, r.check_type): r.unexpected_count
        for r in Q.validation_failures(Q.validate_events(_bad(spark))).collect()
    }
    assert found == {
        ("position", "between"): 2,
        ("country", "in_set"): 1,
        ("session_id", "not_null"): 1,
    }
    country = Q.validate_events(_bad(spark)).where("column_name = 'country'").first()
    # Shares are taken of the present values.
    assert (country.missing_count, country.unexpected_percent) == (1, 100.0)
    with pytest.raises(Q.ValidationFailed, match="position between 2"):
        Q.dq_gate(Q.validate_events(_bad(spark)))


def test_one_scan_equals_separate_counts(log):
    damaged = log.withColumn("latency_ms", F.col("latency_ms") - 100)
    got = {(r.column_name, r.check_type): r for r in Q.validate_events(damaged).collect()}
    for check in Q.EVENT_CHECKS:
        row = got[check.column, check.kind]
        assert row.unexpected_count == damaged.where(check.unexpected()).count()


def test_quarantine_splits_all_rows(spark):
    bad = _bad(spark).unionByName(event_rows(spark))
    assert Q.valid_rows(bad).count() == 2
    assert Q.quarantined_rows(bad).count() == 2


def test_empty_input(spark):
    results = Q.validate_events(event_rows(spark).where("false"))
    assert results.count() == 14 and results.where("success").count() == 14


def test_constraints_and_keys(spark):
    fact = D.fact_with_keys(event_rows(spark))
    clean = Q.constraint_violations(fact, Q.fact_constraints()).collect()
    assert len(clean) == 11 and all(r.violations == 0 for r in clean)
    broken = fact.withColumn("clicks", F.lit(None).cast("int"))
    counts = Q.constraint_violations(broken, Q.fact_constraints()).collect()
    assert {r.constraint_name: r.violations for r in counts}["clicks_binary"] == 2
    doubled = fact.unionByName(fact)
    assert {r.occurrences for r in Q.duplicate_keys(doubled, ["event_id"]).collect()} == {2}


def test_report_is_json(spark):
    path = scratch_path(spark, "report")
    write_report(Q.validate_events(event_rows(spark)), path)
    files = list(Path(path).glob("*.json"))
    lines = [json.loads(x) for f in files for x in f.read_text().splitlines()]
    assert len(lines) == 14 and all(x["success"] for x in lines)


def test_requests(spark):
    good = ("u", "q", "Commercial", "Tech", 10.0, 50.0, 0.5, 1)
    bad = [
        ("", *good[1:]),
        (*good[:4], -1.0, *good[5:]),
        (*good[:5], 101.0, *good[6:]),
        (*good[:7], 0),
        (None, *good[1:]),
    ]
    frame = spark.createDataFrame(
        [good, *bad],
        "user_id_masked string, search_query string, search_intent string, query_category "
        "string, latency_ms double, page_speed_score double, bounce_rate double, position int",
    )
    ok, rejected = Q.valid_requests(frame)
    assert (ok.count(), rejected.count()) == (1, 5)
