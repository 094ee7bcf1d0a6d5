from datetime import datetime
from hashlib import md5

import pytest
from fixtures import feature_rows
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators import features as FT
from serpscope.operators.joins import fill_cold, lookup_latest
from serpscope.plans import training as T

MIDNIGHT = datetime(2026, 7, 15)


def test_user_features(spark):
    got = FT.user_daily_features(feature_rows(spark))
    assert dict(got.dtypes) == {
        "user_id_masked": "string",
        "event_timestamp": "timestamp_ntz",
        "user_7d_ctr": "float",
        "user_30d_avg_dwell_time": "float",
        "user_pogo_sticking_count": "bigint",
    }
    assert sorted(map(tuple, got.collect())) == [
        ("usr_01", MIDNIGHT, 0.5, 45.0, 1),
        ("usr_02", MIDNIGHT, 1.0, 15.0, 0),
    ]


def test_query_features(spark):
    got = FT.query_daily_features(feature_rows(spark))
    assert [t for _, t in got.dtypes[2:]] == ["float", "float", "float"]
    by_key = {r.query_key: tuple(r)[1:] for r in got.collect()}
    first = md5(b"search text_Informational_Tech").hexdigest()
    second = md5(b"other query_Commercial_Finance").hexdigest()
    assert by_key == {first: (MIDNIGHT, 0.5, 147.5, 0.5), second: (MIDNIGHT, 1.0, 200.0, 0.0)}


def test_zero_impressions_count_as_one(spark):
    rows = feature_rows(spark).withColumn("impressions", F.lit(0))
    got = {r.user_id_masked: r.user_7d_ctr for r in FT.user_daily_features(rows).collect()}
    assert got == {"usr_01": 1.0, "usr_02": 1.0}


def test_missing_values(spark):
    rows = feature_rows(spark)
    nobody = rows.withColumn("user_id_masked", F.lit(None).cast("string"))
    assert FT.user_daily_features(nobody.unionByName(rows)).count() == 2
    assert FT.query_daily_features(nobody).count() == 2
    unknown = rows.withColumn("clicks", F.lit(None).cast("int"))
    assert {r.user_7d_ctr for r in FT.user_daily_features(unknown).collect()} == {0.0}


def _history(spark):
    days = [(1, 0.1), (3, 0.3), (5, 0.5)]
    return spark.createDataFrame(
        [("u", datetime(2026, 1, d), x) for d, x in days],
        "user_id_masked string, event_timestamp timestamp_ntz, x double",
    )


@pytest.mark.parametrize(
    "as_of, ttl, want",
    [
        (None, 365, 0.5),
        ("2026-01-04 00:00:00", 365, 0.3),
        ("2026-01-03 00:00:00", 365, 0.3),
        ("2026-01-15 00:00:00", 10, 0.5),
        ("2026-01-16 00:00:00", 10, None),
    ],
)
def test_latest_snapshot(spark, as_of, ttl, want):
    got = FT.latest_snapshot(_history(spark), "user_id_masked", as_of, ttl).collect()
    assert [r.x for r in got] == ([] if want is None else [want])


def test_fold_latest_equals_full_recompute(spark):
    history = _history(spark)
    cut = F.lit("2026-01-04").cast("timestamp_ntz")
    old = FT.latest_snapshot(history.where(F.col("event_timestamp") < cut), "user_id_masked")
    new = history.where(F.col("event_timestamp") >= cut)
    folded = FT.fold_latest(old, new, "user_id_masked").collect()
    assert folded == FT.latest_snapshot(history, "user_id_masked").collect()


def test_cold_start_defaults(spark):
    events = feature_rows(spark)
    users = FT.latest_snapshot(FT.user_daily_features(events), "user_id_masked")
    queries = FT.latest_snapshot(FT.query_daily_features(events), "query_key")
    requests = spark.createDataFrame(
        [("usr_01", "unknown"), ("usr_99", "unknown")], "user_id_masked string, query_key string"
    )
    got = {
        r.user_id_masked: [r[c] for c in S.USER_FEATURES + S.QUERY_FEATURES]
        for r in fill_cold(lookup_latest(requests, users, queries)).collect()
    }
    assert got["usr_01"] == [0.5, 45.0, 1, 0.0, 100.0, 0.0]
    assert got["usr_99"] == [0.0, 0.0, 0, 0.0, 100.0, 0.0]


def test_split_is_stable_under_repartitioning(log):
    ids = log.select("event_id")
    one = T.train_test_split(ids.repartition(1)).collect()
    many = T.train_test_split(ids.repartition(7)).collect()
    assert sorted(one) == sorted(many)
    share = sum(r.split == "train" for r in one) / len(one)
    assert 0.75 < share < 0.85


def test_multiplicity_counts_the_pairs_of_a_merge(log):
    uf, qf = FT.user_daily_features(log), FT.query_daily_features(log)
    hour = F.date_trunc("hour", F.col("event_timestamp").cast("timestamp")).alias("hour")
    side = T.entity_rows(log).select("user_id_masked", "query_key", hour)
    merged = side.join(side, ["user_id_masked", "query_key", "hour"]).count()
    weighted = T.training_matrix_weighted(log, uf, qf)
    assert weighted.agg(F.sum("multiplicity")).first()[0] == merged
    assert weighted.count() == log.count()
