from pyspark.sql import functions as F

from serpscope.operators import monitor as M
from serpscope.operators import sketches as K
from serpscope.operators import star as D
from serpscope.session import scratch_path


def test_merged_days_estimate_members(spark, log):
    sketches = K.day_sketches(log).persist()
    got = {r.dimension: r.estimate for r in K.merged_members(sketches).collect()}
    star = D.build_star(log)
    for name, estimate in got.items():
        exact = star[name].count()
        assert abs(estimate - exact) <= max(1, 4 * K.MEMBER_ERROR * exact)
    # Days merge in any grouping.
    weeks = sketches.where("kind = 'members'").groupBy("name", F.weekofyear("event_date").alias("week"))
    weeks = weeks.agg(F.hll_union_agg("sketch").alias("sketch")).withColumn("kind", F.lit("members"))
    assert {r.dimension: r.estimate for r in K.merged_members(weeks).collect()} == got


def test_many_members_stay_within_the_error(spark):
    ids = spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("k"), F.col("id") % 9)
    days = ids.groupBy("(id % 9)").agg(F.hll_sketch_agg("k", K.LG_K).alias("sketch"))
    days = days.select(F.lit("members").alias("kind"), F.lit("d").alias("name"), "sketch")
    assert abs(K.merged_members(days).first().estimate - 200_000) < 4 * K.MEMBER_ERROR * 200_000


def test_a_day_replaces_its_own_sketches(spark, log):
    path = scratch_path(spark, "sketches")
    K.write_sketches(log, path)
    days = K.read_sketches(spark, path).count()
    again = log.where("timestamp < '2024-01-02'").limit(3)
    K.write_sketches(again, path)
    kept = K.read_sketches(spark, path)
    assert kept.count() == days
    one = kept.where("event_date = '2024-01-01' and name = 'latency_ms'")
    assert one.select(F.kll_sketch_get_n_double("sketch")).first()[0] == 3


def test_distance_is_within_its_bound(spark):
    """Long baseline in days, shifted and discrete features, against the exact distance."""
    n = 120_000
    values = spark.range(n).select(
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(id % 40)").alias("timestamp"),
        (F.randn(1) * (1 + (F.col("id") % 40 >= 30).cast("int") * 0.3)).alias("smooth"),
        F.floor(F.rand(2) * 4 + (F.col("id") % 40 >= 30).cast("int") * F.rand(4)).alias("steps"),
    )
    columns = ["smooth", "steps"]
    pairs = [F.kll_sketch_agg_double(F.col(c).cast("double"), K.K_RANKS).alias(c) for c in columns]
    daily = values.groupBy(F.to_date("timestamp").alias("event_date")).agg(*pairs)
    rows = [F.struct(F.lit("values").alias("kind"), F.lit(c).alias("name"), F.col(c).alias("sketch")) for c in columns]
    days = daily.select("event_date", F.inline(F.array(*rows)))
    recent = F.col("event_date") >= "2024-01-31"
    rough = {r.feature: r for r in K.sketched_ks(days.where(~recent), days.where(recent)).collect()}
    exact = M.drift_ks(M.split_periods(values, "2024-01-31"), columns)
    for r in exact.collect():
        assert abs(rough[r.feature].ks_distance - r.ks_distance) <= K.DISTANCE_ERROR
        assert r.ks_distance > 0.02 and rough[r.feature].drifted == r.drifted


def test_empty_log(spark, log):
    assert K.merged_members(K.day_sketches(log.where("false"))).count() == 0
