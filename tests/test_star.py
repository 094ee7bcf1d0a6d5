from datetime import datetime
from hashlib import md5

import pytest
from conftest import rows
from fixtures import event_rows
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators import incremental as I
from serpscope.operators import quality as Q
from serpscope.operators import staging as G
from serpscope.operators import star as D
from serpscope.operators.joins import attach_key, orphans
from serpscope.session import scratch_path
from serpscope.sources import log as L
from serpscope.sources import sinks as W
from serpscope.sources import versioned as V


def test_two_events_give_two_rows_everywhere(spark):
    star = D.build_star(event_rows(spark))
    assert list(star)[-1] == "fct_search_events"
    assert {t: df.count() for t, df in star.items()} == dict.fromkeys(star, 2)
    assert star["fct_search_events"].columns == S.FACT


def test_keys_are_md5_of_joined_columns(spark):
    got = {r.country: r.geo_key for r in D.dim_geography(event_rows(spark)).collect()}
    assert got["Japan"] == md5(b"Japan_Osaka_ja").hexdigest()
    assert len(set(got.values())) == 2 and all(len(k) == 32 for k in got.values())


def test_lookup_path_equals_in_place_keys(log):
    dims = D.dim_geography(log), D.dim_systems(log), D.dim_queries(log), D.dim_users(log)
    assert rows(D.fact_by_lookup(log, *dims)) == rows(D.fact_with_keys(log))


def test_null_attributes_still_find_their_key(spark):
    log = event_rows(spark).withColumn("region", F.lit(None).cast("string"))
    dim = D.dim_geography(log)
    got = attach_key(log, dim, S.GEO_ATTRS, "geo_key").where(F.col("geo_key").isNull())
    assert got.count() == 0
    keys = {r.country: r.geo_key for r in dim.collect()}
    assert keys["Japan"] == md5(b"Japan_None_ja").hexdigest()


def test_user_profile_is_reproducible(spark):
    user = D.dim_users(event_rows(spark)).where("user_id_masked = 'usr_abc'").first()
    h = int(md5(b"usr_abc").hexdigest()[:8], 16)
    assert user.age == h % 50 + 18
    assert user.gender == S.GENDERS[h % 3]
    assert user.signup_channel == S.SIGNUP_CHANNELS[h % 5]
    assert user.user_segment == S.USER_SEGMENTS[h % 3]
    assert (user.signup_timestamp - datetime(2026, 1, 1)).days == h % 150
    assert user.record_end_timestamp is None and user.is_current_record == 1


def test_staging_trims_and_renames(spark):
    star = D.build_star(event_rows(spark))
    queries = star["dim_queries"].withColumn("search_query_masked", F.lit("  Python TUTORIAL "))
    assert G.stg_queries(queries).first().search_query_masked == "python tutorial"
    users = star["dim_users"].withColumn("gender", F.lit("x" * 20))
    assert G.stg_users(users).first().gender == "x" * 20
    counts = {r.column_name: r.overlong for r in G.overlong_values(users).collect()}
    assert counts["gender"] == users.count() and counts["user_segment"] == 0
    geo = star["dim_geography"].withColumnRenamed("language", "primary_language")
    assert G.stg_geography(geo).columns == S.DIM_GEOGRAPHY


def test_orphans(spark):
    star = D.build_star(event_rows(spark))
    fact = star["fct_search_events"]
    some = star["dim_geography"].where("country = 'Japan'")
    assert [r.event_id for r in orphans(fact, some, "geo_key").collect()] == ["evt_1"]
    assert all(r.orphan_count == 0 for r in Q.relationship_counts(star).collect())
    broken = {**star, "dim_geography": some}
    counts = {r.key_name: r.orphan_count for r in Q.relationship_counts(broken).collect()}
    assert counts["geo_key"] == 1


# --- incremental load ------------------------------------------------------------------------


def _staged(log):
    return D.fact_with_keys(log)


def test_incremental_equals_rebuild_when_sessions_end_between_loads(log):
    fact = _staged(log)
    cut = F.lit("2024-01-21 00:00:00").cast("timestamp_ntz")  # sessions are daily
    before = D.add_sequence(fact.where(F.col("event_timestamp") < cut))
    assert rows(I.incremental_fact(fact, before)) == rows(D.add_sequence(fact))


def test_sequences_continue_over_loads(log):
    fact = _staged(log)
    cut = F.lit("2024-01-20 13:00:00").cast("timestamp_ntz")
    before = D.add_sequence(fact.where(F.col("event_timestamp") < cut))
    assert rows(I.incremental_fact(fact, before, continue_sequences=True)) == rows(
        D.add_sequence(fact)
    )


def test_late_rows_are_skipped_unless_looked_back(log):
    fact = _staged(log)
    cut = F.lit("2024-01-20 13:00:00").cast("timestamp_ntz")
    before = D.add_sequence(fact.where(F.col("event_timestamp") < cut))
    missing = before.orderBy(F.desc("event_timestamp")).limit(3).collect()[-1].event_id
    target = before.where(F.col("event_id") != missing)
    loaded = I.incremental_fact(fact, target)
    assert loaded.count() == fact.count() - 1
    assert I.late_rows(fact, target).where(F.col("event_id") == missing).count() == 1
    assert I.incremental_fact(fact, target, lookback_hours=48).count() == fact.count()


def test_load_into_empty_target(log):
    fact = _staged(log)
    empty = D.add_sequence(fact).where("false")
    assert I.incremental_fact(fact, empty).count() == fact.count()


CUT = "2024-01-20 13:00:00"


def _table(spark, fact):
    """A versioned table with the rows before CUT."""
    before = D.add_sequence(fact.where(F.col("event_timestamp") < F.lit(CUT).cast("timestamp_ntz")))
    table = V.VersionedTable(spark, scratch_path(spark, "fact"), before.schema)
    table.commit(0, table.write(before))
    return table, before


def test_versioned_upsert(spark, log):
    fact = _staged(log)
    table, before = _table(spark, fact)
    assert I.load_incremental(fact, table) == 2
    loaded = table.read().drop("event_date")
    assert rows(loaded) == rows(I.incremental_fact(fact, before).select(*loaded.columns))
    # Nothing new: no version. The first one is still there.
    assert I.load_incremental(fact, table) == 2
    assert table.read(1).count() == before.count()
    # An existing event arrives again with a later time: it moves, and is not doubled.
    moved = loaded.orderBy("event_timestamp").limit(1).select(*S.FACT)
    later = F.lit("2024-02-03 00:00:00").cast("timestamp_ntz")
    listed = table.folders()
    I.load_incremental(moved.withColumn("event_timestamp", later), table)
    again = table.read()
    assert again.count() == fact.count()
    assert again.where("event_date = '2024-02-03'").count() == 1
    assert Q.duplicate_keys(again, ["event_id"]).count() == 0
    # One folder was written anew, all others are listed as they were.
    assert len(set(listed) - set(table.folders())) == 1


@pytest.mark.parametrize("few", [0, 1000])
def test_ids_are_found_by_filters_or_join(spark, log, monkeypatch, few):
    fact = _staged(log)
    table, before = _table(spark, fact)
    monkeypatch.setattr(I, "LOOKUP_IDS", few)
    some = fact.where("event_id like '%7'").withColumn(
        "event_timestamp", F.col("event_timestamp") + F.make_dt_interval(days=F.lit(90))
    )
    I.load_incremental(some, table, continue_sequences=True)
    got = table.read().drop("event_date")
    want = I.incremental_fact(some, before)
    assert rows(got.select(*S.FACT)) == rows(want.select(*S.FACT))


def test_upsert_that_empties_a_day(spark, log):
    fact = _staged(log).limit(1)
    before = D.add_sequence(fact)
    table = V.VersionedTable(spark, scratch_path(spark, "fact"), before.schema)
    table.commit(0, table.write(before))
    later = F.lit("2024-02-03 00:00:00").cast("timestamp_ntz")
    I.load_incremental(fact.withColumn("event_timestamp", later), table)
    got = table.read().collect()
    assert len(got) == 1 and str(got[0].event_date) == "2024-02-03"
    assert [f.day for f in table.folders()] == ["2024-02-03"]
    assert str(table.read(1).first().event_date) != "2024-02-03"


@pytest.mark.parametrize("step", ["read_folders", "write", "_days", "commit"])
def test_a_broken_load_leaves_the_old_version(spark, log, monkeypatch, step):
    fact = _staged(log)
    table, before = _table(spark, fact)

    def broken(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(table, step, broken)
        with pytest.raises(OSError, match="lost"):
            I.load_incremental(fact, table)
    assert table.version() == 1 and rows(table.read().drop("event_date")) == rows(before)
    # The same load, run again, gives the whole result.
    I.load_incremental(fact, table)
    assert table.read().count() == fact.count()


def test_one_of_two_loads_at_a_time_is_refused(spark, log):
    fact = _staged(log)
    table, before = _table(spark, fact)
    first, second = table.write(before.limit(5)), table.write(before.limit(7))
    table.commit(1, [*table.folders(), *first])
    with pytest.raises(V.Conflict):
        table.commit(1, [*table.folders(), *second])
    assert table.read().count() == before.count() + 5


def test_rows_without_time_and_empty_tables(spark, log):
    fact = _staged(log)
    table = V.VersionedTable(spark, scratch_path(spark, "fact"), D.add_sequence(fact).schema)
    assert table.version() == 0 and table.read().count() == 0
    assert I.load_incremental(fact.where("false"), table) == 0
    timeless = fact.limit(3).withColumn("event_timestamp", F.lit(None).cast("timestamp_ntz"))
    assert I.load_incremental(timeless.unionByName(fact.where("event_id like '%1'")), table) == 1
    assert table.read().where("event_timestamp is null").count() == 3
    assert table.newest([f for f in table.folders() if f.day is None]) is None


def test_id_lookup_skips_row_groups(spark, log):
    fact = _staged(log)
    table, before = _table(spark, fact)
    folders = table.folders()

    def scanned(ids):
        found = table.find(ids, folders)
        n = len(found.collect())
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return n, scan.metrics().apply("numOutputRows").value()

    assert len(folders) > 10
    ids = [r.event_id for r in before.orderBy(F.md5("event_id")).limit(2).collect()]
    found, read = scanned(ids)
    assert found == 2 and read < before.count() / 4
    # Ids between others of a file, so that only its Bloom filter can rule them out.
    assert scanned([i + "x" for i in ids]) == (0, 0)


# --- user versions ---------------------------------------------------------------------------------


def test_scd2_merge_and_lookup(spark):
    dim = D.dim_users(event_rows(spark))
    when = datetime(2026, 7, 16)
    old = {r.user_id_masked: r for r in dim.collect()}
    changes = [
        ("usr_abc", when, "Female", 77, "Email", old["usr_abc"].signup_timestamp, "Heavy"),
        ("usr_xyz", when, *[old["usr_xyz"][c] for c in I.VERSIONED]),
        ("usr_new", when, "Male", 30, "Social", when, "Light"),
    ]
    frame = spark.createDataFrame(
        changes,
        "user_id_masked string, changed_at timestamp_ntz, gender string, age int, "
        "signup_channel string, signup_timestamp timestamp_ntz, user_segment string",
    )
    merged = I.scd2_merge(dim, frame)
    by_user = {}
    for r in merged.orderBy("record_start_timestamp").collect():
        by_user.setdefault(r.user_id_masked, []).append(r)
    closed, opened = by_user["usr_abc"]
    assert (closed.is_current_record, closed.record_end_timestamp) == (0, when)
    assert (opened.is_current_record, opened.age, opened.record_end_timestamp) == (1, 77, None)
    assert len(by_user["usr_xyz"]) == 1 and by_user["usr_xyz"][0].is_current_record == 1
    assert len(by_user["usr_new"]) == 1
    assert Q.duplicate_keys(merged, ["version_key"]).count() == 0
    assert all(len({r.user_key for r in versions}) == 1 for versions in by_user.values())
    # A second merge keeps history.
    assert I.scd2_merge(merged, frame).count() == merged.count()

    events = spark.createDataFrame(
        [("a", "usr_abc", datetime(2026, 7, 15)), ("b", "usr_abc", when), ("c", "nobody", when)],
        "event_id string, user_id_masked string, timestamp timestamp_ntz",
    )
    found = I.scd2_asof_lookup(events, merged, "timestamp", ["age"])
    ages = {r.event_id: r.age for r in found.collect()}
    assert ages == {"a": old["usr_abc"].age, "b": 77, "c": None}


# --- sources and sinks --------------------------------------------------------------------------------


def test_partitioned_log_round_trip(spark, log):
    path = scratch_path(spark, "log")
    W.write_date_partitioned(log, path)
    back = L.scan_events(spark, path)
    assert len(back.columns) == 29
    assert rows(back.select(*S.EVENT_LOG.fieldNames())) == rows(log)
    assert {r.month for r in back.select("month").distinct().collect()} == {"01"}
    W.write_date_partitioned(log.where("clicks = 1"), path)
    assert L.scan_events(spark, path).count() == log.where("clicks = 1").count()


def test_missing_paths(spark):
    path = scratch_path(spark, "nowhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        L.scan_events(spark, path)
    empty = L.scan_pruned(spark, path, ["event_id"], S.EVENT_LOG)
    assert empty.columns == ["event_id"] and empty.count() == 0


def test_failed_publish_leaves_the_version_before(spark):
    root = scratch_path(spark, "published")
    star = D.build_star(event_rows(spark))
    assert W.current_version(spark, root) is None
    assert W.publish(star, root, 1)["fct_search_events"] == 2
    bad = F.raise_error(F.lit("broken row")).cast("string")
    fact = star["fct_search_events"].withColumn("event_id", bad)
    with pytest.raises(Exception, match="broken row"):
        W.publish({**star, "fct_search_events": fact}, root, 2)
    assert W.current_version(spark, root) == 1
    assert W.read_published(spark, root, "dim_users").count() == 2
    W.full_refresh(star, root)
    assert W.current_version(spark, root) == 2
