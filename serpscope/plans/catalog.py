"""Registered queries: every operator run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.functions import scalars as X
from serpscope.models import attribution as A
from serpscope.models import forest as OF
from serpscope.models import quality as QM
from serpscope.models import screening as VIF
from serpscope.operators import features as FT
from serpscope.operators import incremental as I
from serpscope.operators import joins as J
from serpscope.operators import kpi as R
from serpscope.operators import monitor as M
from serpscope.operators import quality as Q
from serpscope.operators import sketches as SK
from serpscope.operators import staging as G
from serpscope.operators import star as D
from serpscope.operators.ordered import over_order
from serpscope.operators.quantiles import group_quantiles
from serpscope.plans import marts as MT
from serpscope.plans import oracle as O
from serpscope.plans import training as T
from serpscope.plans.daily import requests_of
from serpscope.session import materialize, scratch_path
from serpscope.sources import clustered as CL
from serpscope.sources import log as L
from serpscope.sources import sinks as W
from serpscope.sources import versioned as V
from serpscope.streaming import jobs as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def on_log(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, data: build(L.load_log(spark, data))


def on_star(name: str, build: Callable[[dict[str, DataFrame]], DataFrame]) -> None:
    QUERIES[name] = lambda spark, data: build(D.build_star(L.load_log(spark, data)))


def on_features(
    name: str,
    build: Callable[[DataFrame, DataFrame | None, DataFrame | None], DataFrame],
    uses: tuple[str, ...] = ("user", "query"),
) -> None:
    """Only the feature tables that are used are built: building one may run jobs."""

    def run(spark: SparkSession, data: str) -> DataFrame:
        log = L.load_log(spark, data)
        users = FT.user_daily_features(log) if "user" in uses else None
        queries = FT.query_daily_features(log) if "query" in uses else None
        return build(log, users, queries)

    QUERIES[name] = run


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data}/{name}.parquet")


# --- sources and sinks --------------------------------------------------------------------


@query("scan_events")
def _(spark, data):
    path = scratch_path(spark, "log")
    W.write_date_partitioned(L.load_log(spark, data), path)
    return L.scan_events(spark, path).select(*S.EVENT_LOG.fieldNames())


@query("scan_pruned")
def _(spark, data):
    path = scratch_path(spark, "log")
    W.write_date_partitioned(L.load_log(spark, data), path)
    return L.scan_pruned(spark, path, ["event_id", "timestamp", "latency_ms"], S.EVENT_LOG)


@query("write_date_partitioned")
def _(spark, data):
    path = scratch_path(spark, "log")
    W.write_date_partitioned(L.load_log(spark, data), path)
    return (
        L.scan_events(spark, path)
        .groupBy("year", "month", "day")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.round(F.sum("latency_ms"), 6).alias("latency_sum"),
        )
    )


@query("write_feature_table")
def _(spark, data):
    path = scratch_path(spark, "user-features")
    features = FT.user_daily_features(L.load_log(spark, data))
    W.write_table(features, path)
    return spark.read.schema(features.schema).parquet(path)


@query("load_warehouse_counts")
def _(spark, data):
    star = D.build_star(L.load_log(spark, data))
    return W.counts_frame(spark, W.load_star(star, scratch_path(spark, "warehouse")))


def _published_counts(spark: SparkSession, root: str) -> DataFrame:
    parts = [
        W.read_published(spark, root, t)
        .agg(F.count(F.lit(1)).alias("loaded_rows"))
        .select(F.lit(t).alias("table_name"), "loaded_rows")
        for t in W.LOAD_ORDER
    ]
    return reduce(DataFrame.unionByName, parts)


@query("load_all_or_nothing")
def _(spark, data):
    root = scratch_path(spark, "published")
    star = D.build_star(L.load_log(spark, data))
    W.publish(star, root, 1)
    # The second load fails while writing its fact; readers stay on the first.
    broken = F.raise_error(F.lit("load failed")).cast("string")
    bad = {**star, "fct_search_events": star["fct_search_events"].withColumn("event_id", broken)}
    try:
        W.publish(bad, root, 2)
    except Exception as error:
        if "load failed" not in str(error):
            raise
    return _published_counts(spark, root)


@query("full_refresh")
def _(spark, data):
    root = scratch_path(spark, "published")
    star = D.build_star(L.load_log(spark, data))
    W.full_refresh(star, root)
    W.full_refresh(star, root)
    return _published_counts(spark, root)


on_star("dry_run_summary", W.dry_run)


@query("fact_month_partitions")
def _(spark, data):
    path = scratch_path(spark, "fact")
    W.write_fact(D.fact_with_keys(L.load_log(spark, data)), path)
    months = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return (
        months.parquet(path)
        .groupBy(F.col("event_month").cast("string").alias("event_month"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query("dq_report_sink")
def _(spark, data):
    path = scratch_path(spark, "report")
    results = Q.validate_events(L.load_log(spark, data))
    W.write_report(results, path)
    return spark.read.schema(results.schema).json(path)


# --- projections, filters, casts --------------------------------------------------------------

on_star("stg_search_events", lambda s: G.stg_search_events(s["fct_search_events"]))
on_star("stg_users", lambda s: G.stg_users(s["dim_users"]))
on_star("stg_queries", lambda s: G.stg_queries(s["dim_queries"]))
on_star("stg_systems", lambda s: G.stg_systems(s["dim_systems"]))
on_star(
    "stg_geography",
    lambda s: G.stg_geography(
        s["dim_geography"].withColumnRenamed("language", "primary_language")
    ),
)
on_star(
    "core_dim_passthrough",
    lambda s: D.core_dim(G.stg_geography(s["dim_geography"]), S.DIM_GEOGRAPHY),
)
on_star(
    "core_dim_systems", lambda s: D.core_dim(G.stg_systems(s["dim_systems"]), S.DIM_SYSTEMS)
)
on_star(
    "core_dim_queries", lambda s: D.core_dim(G.stg_queries(s["dim_queries"]), S.DIM_QUERIES)
)
on_star("core_dim_users", lambda s: D.core_dim(G.stg_users(s["dim_users"]), S.DIM_USERS))
on_log("sample_n", lambda log: R.sample_n(log.select("event_id", "latency_ms"), 5000, 42, "event_id"))


@query("normalize_naive_ts")
def _(spark, data):
    # The log time written as text with the offset of Tokyo.
    stamped = L.load_log(spark, data).select(
        "event_id",
        F.concat(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("+09:00")).alias("at"),
    )
    return stamped.select("event_id", X.naive_utc(F.col("at")).alias("event_timestamp"))


on_log(
    "rename_reorder",
    lambda log: D.conform_fact(
        log.withColumns(
            {
                "user_key": K.user_key(),
                "query_key": K.query_key(),
                "system_key": K.surrogate_key(*S.SYSTEM_ATTRS),
                "geo_key": K.surrogate_key(*S.GEO_ATTRS),
            }
        )
    ),
)
on_star(
    "constant_columns",
    lambda s: s["dim_users"].select(
        "user_id_masked", "record_end_timestamp", "is_current_record"
    ),
)
on_features(
    "feature_vector",
    lambda log, uf, qf: T.feature_columns(T.training_matrix(log, uf, qf), "event_id"),
)


@query("request_validation")
def _(spark, data):
    requests = L.load_log(spark, data).select(
        "event_id",
        "user_id_masked",
        F.col("search_query_masked").alias("search_query"),
        "search_intent",
        "query_category",
        (F.col("latency_ms") - 100).alias("latency_ms"),
        "page_speed_score",
        "bounce_rate",
        "position",
    )
    ok, rejected = Q.valid_requests(requests)
    return ok.select("event_id", F.lit("valid").alias("status")).unionByName(
        rejected.select("event_id", F.lit("rejected").alias("status"))
    )


# --- joins ------------------------------------------------------------------------------------


def _lookup(dim, on: list[str], key: str) -> Callable[[DataFrame], DataFrame]:
    return lambda log: J.attach_key(log.select("event_id", *on), dim(log), on, key).select(
        "event_id", key
    )


on_log("fact_geo_key", _lookup(D.dim_geography, S.GEO_ATTRS, "geo_key"))
on_log("fact_system_key", _lookup(D.dim_systems, S.SYSTEM_ATTRS, "system_key"))
on_log("fact_query_key", _lookup(D.dim_queries, S.QUERY_ATTRS, "query_key"))
on_log("fact_user_key", _lookup(D.dim_users, ["user_id_masked"], "user_key"))
on_log(
    "build_fact",
    lambda log: D.fact_by_lookup(
        log, D.dim_geography(log), D.dim_systems(log), D.dim_queries(log), D.dim_users(log)
    ),
)
on_log("build_fact_in_place", D.fact_with_keys)
on_log(
    "join_agg_with_quantile",
    lambda log: group_quantiles(
        log.select(
            K.query_key().alias("query_key"),
            F.to_date("timestamp").alias("day"),
            "clicks",
            "impressions",
            "latency_ms",
        ),
        ["query_key", "day"],
        "latency_ms",
        {"p95": 0.95},
        {"clicks": F.sum("clicks"), "impressions": F.sum("impressions")},
    ).withColumn("p95", F.round("p95", 6)),
)


def _asof(log, features, on, columns, **options) -> DataFrame:
    rows = T.entity_rows(log).select("event_id", on, "event_timestamp")
    return J.asof_join(
        rows,
        features,
        on,
        "event_timestamp",
        "event_timestamp",
        columns,
        right_unique=True,
        tie=["event_id"],
        **options,
    ).select("event_id", *columns)


on_features(
    "asof_user_features", lambda log, uf, qf: _asof(log, uf, "user_id_masked", S.USER_FEATURES),
    uses=("user",),
)
on_features(
    "asof_query_features", lambda log, uf, qf: _asof(log, qf, "query_key", S.QUERY_FEATURES),
    uses=("query",),
)


def _leak_free(log, uf, qf) -> DataFrame:
    return _asof(log, uf, "user_id_masked", S.USER_FEATURES, ttl_days=3, lag_days=1)


on_features("asof_leak_free", _leak_free)
on_features("drop_incomplete_rows", lambda log, uf, qf: _leak_free(log, uf, qf).na.drop("any"))
on_features("training_matrix", T.training_matrix)
on_features("training_matrix_weighted", T.training_matrix_weighted)


def _looked_up(log, uf, qf) -> DataFrame:
    requests = T.entity_rows(log).select("event_id", "user_id_masked", "query_key")
    users = FT.latest_snapshot(uf, "user_id_masked", "2024-01-15 00:00:00")
    queries = FT.latest_snapshot(qf, "query_key", "2024-01-15 00:00:00")
    return J.lookup_latest(requests, users, queries)


on_features("online_lookup", _looked_up)
@query("online_lookup_clustered")
def _(spark, data):
    """The look-up against stored latest tables, clustered by key."""
    log = L.load_log(spark, data)
    found = T.entity_rows(log).select("event_id", "user_id_masked", "query_key")
    for key, features, columns in [
        ("user_id_masked", FT.user_daily_features(log), S.USER_FEATURES),
        ("query_key", FT.query_daily_features(log), S.QUERY_FEATURES),
    ]:
        latest, path = FT.latest_snapshot(features, key, "2024-01-15 00:00:00"), scratch_path(spark, "latest")
        CL.write_clustered(latest, path, key)
        found = CL.lookup_clustered(found, path, latest.schema, key, columns)
    return found


on_features("cold_start_defaults", lambda log, uf, qf: J.fill_cold(_looked_up(log, uf, qf)))


def _late_members(key: str) -> Callable[[dict[str, DataFrame]], DataFrame]:
    """Fact rows whose member was first seen after the dimension was last loaded."""

    def build(star: dict[str, DataFrame]) -> DataFrame:
        fact = star["fct_search_events"].select("event_id", "event_timestamp", key)
        loaded = fact.where(F.col("event_timestamp") < F.lit("2024-01-02").cast("timestamp_ntz"))
        return J.orphans(fact, loaded.select(key).distinct(), key).select("event_id", key)

    return build


for _key in ["geo_key", "system_key", "query_key", "user_key"]:
    on_star(f"fk_orphans_{_key.removesuffix('_key')}", _late_members(_key))


# --- aggregates -----------------------------------------------------------------------------------

on_log("user_daily_features", FT.user_daily_features)
on_log("query_daily_features", FT.query_daily_features)
on_log(
    "exact_quantile",
    lambda log: group_quantiles(
        log.select("country", "latency_ms"), ["country"], "latency_ms", {"_p": 0.95}
    ).select("country", F.round("_p", 6).alias("p95_latency_ms")),
)


def _rank1_ctr(log: DataFrame) -> DataFrame:
    top = F.col("position") == 1
    sums = log.groupBy("user_id_masked").agg(
        F.sum(F.when(top, F.col("clicks")).otherwise(0)).alias("_c"),
        F.sum(F.when(top, F.col("impressions")).otherwise(0)).alias("_i"),
    )
    return sums.select(
        "user_id_masked", F.round(X.safe_ratio(F.col("_c"), F.col("_i")), 6).alias("ctr")
    )


on_log("safe_ctr", _rank1_ctr)
on_log("kpi_overview", R.kpi_overview)
on_log("daily_volume", R.daily_volume)
on_log("score_histogram", lambda log: R.histogram(log, S.LABEL, 0.0, 100.0, 50))
on_features(
    "describe_user_features", lambda log, uf, qf: R.describe_exact(uf, S.USER_FEATURES),
    uses=("user",),
)
on_features(
    "describe_query_features", lambda log, uf, qf: R.describe_exact(qf, S.QUERY_FEATURES),
    uses=("query",),
)
on_log("dim_distinct", lambda log: D.dim_distinct(log, S.SYSTEM_ATTRS))
on_features(
    "latest_user_snapshot", lambda log, uf, qf: FT.latest_snapshot(uf, "user_id_masked", O.AS_OF),
    uses=("user",),
)
on_features(
    "latest_query_snapshot", lambda log, uf, qf: FT.latest_snapshot(qf, "query_key", O.AS_OF),
    uses=("query",),
)
on_star("high_watermark", lambda s: I.high_watermark(s["fct_search_events"]))
on_log("dq_statistics", lambda log: Q.dq_statistics(Q.validate_events(log)))
on_log("dq_summary", lambda log: Q.dq_summary(Q.validate_events(log)))


def _cardinalities(star: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("members")).select(
            F.lit(name).alias("dimension"), "members"
        )
        for name, df in star.items()
        if name.startswith("dim_")
    ]
    return reduce(DataFrame.unionByName, parts)


on_star("dimension_cardinalities", _cardinalities)
on_features(
    "entity_snapshot_count",
    lambda log, uf, qf: FT.snapshot_counts({"user_features": uf, "query_features": qf}),
)
on_star("session_event_sequence", lambda s: D.add_sequence(s["fct_search_events"]))
on_features(
    "first_n", lambda log, uf, qf: R.first_n(uf, ["user_id_masked", "event_timestamp"], 100),
    uses=("user",),
)


@query("union_daily_batches")
def _(spark, data):
    path = scratch_path(spark, "log")
    W.write_date_partitioned(L.load_log(spark, data), path)
    log = L.scan_events(spark, path)
    # One row for each calendar day that has events.
    days = log.select("year", "month", "day").distinct().orderBy("year", "month", "day").collect()
    batches = [log.where(reduce(lambda a, b: a & b, [F.col(c) == d[c] for c in d.asDict()])) for d in days]
    return L.union_daily(batches).select("event_id", "timestamp", "latency_ms")


@query("dimension_cardinalities_sketched")
def _(spark, data):
    """Members by stored sketches of all days, beside the exact number."""
    log, path = L.load_log(spark, data), scratch_path(spark, "sketches")
    SK.write_sketches(log, path)
    exact = _cardinalities(D.build_star(log))
    both = exact.join(SK.merged_members(SK.read_sketches(spark, path)), "dimension")
    error = F.abs(F.col("estimate") - F.col("members"))
    limit = F.greatest(F.lit(1.0), 4 * SK.MEMBER_ERROR * F.col("members"))
    return both.select("dimension", "members", (error <= limit).alias("within_error"))


@query("drift_ks_sketched")
def _(spark, data):
    """Distances by stored sketches of the two periods' days, beside the exact ones."""
    log, path = L.load_log(spark, data), scratch_path(spark, "sketches")
    SK.write_sketches(log, path)
    days = SK.read_sketches(spark, path)
    recent = F.col("event_date") >= F.to_date(F.lit(O.CUT))
    rough = SK.sketched_ks(days.where(~recent), days.where(recent))
    exact = M.drift_ks(M.split_periods(log, O.CUT))
    error = F.abs(F.col("_d") - F.col("ks_distance"))
    return exact.join(rough.select("feature", F.col("ks_distance").alias("_d")), "feature").select(
        "feature", "ks_distance", (error <= SK.DISTANCE_ERROR).alias("within_error")
    )


# The paths of hot groups, forced on every group.
on_log(
    "exact_quantile_narrowed",
    lambda log: group_quantiles(
        log.select("country", "latency_ms"), ["country"], "latency_ms", {"_p": 0.95}, hot_rows=0
    ).select("country", F.round("_p", 6).alias("p95_latency_ms")),
)
on_log("latency_percentiles_narrowed", lambda log: R.latency_percentiles(log, hot_rows=0))
on_log("query_daily_features_narrowed", lambda log: FT.query_daily_features(log, hot_rows=0))
on_log(
    "sessionize_chunked",
    lambda log: R.sessionize(log.select("event_id", "user_id_masked", "timestamp"), hot_rows=20),
)
on_features(
    "training_matrix_chunked", lambda log, uf, qf: T.training_matrix(log, uf, qf, hot_rows=50)
)
on_log("drift_ks_chunked", lambda log: M.drift_ks(M.split_periods(log, O.CUT), hot_rows=50))


# --- scalars ----------------------------------------------------------------------------------------

on_log(
    "surrogate_key",
    lambda log: log.withColumn(
        "country", F.when(F.col("country") != "Japan", F.col("country"))
    ).select("event_id", K.surrogate_key("country", "region").alias("place_key")),
)
on_log(
    "user_key",
    lambda log: log.select("user_id_masked").distinct().withColumn("user_key", K.user_key()),
)
on_log(
    "hash_bucket",
    lambda log: log.select("event_id", K.hash_bucket(F.col("event_id")).alias("bucket")),
)
on_star(
    "derived_user_profile",
    lambda s: s["dim_users"].select(
        "user_id_masked", "gender", "age", "signup_channel", "signup_timestamp", "user_segment"
    ),
)
QUERIES["query_word_count"] = lambda spark, data: table(spark, data, "documents").select(
    "doc_id", X.word_count(F.col("text")).alias("words")
)
on_log(
    "intent_flags",
    lambda log: log.select(
        "event_id",
        X.intent_flag(F.col("search_intent"), "Navigational").alias("is_navigational"),
        X.intent_flag(F.col("search_intent"), "Informational").alias("is_informational"),
        X.intent_flag(F.col("search_intent"), "Commercial").alias("is_transactional"),
    ),
)
QUERIES["normalize_text"] = lambda spark, data: table(spark, data, "conversations").select(
    "conv_id", "turn", F.md5(X.normalize_text(F.col("text"))).alias("text_md5")
)
on_log(
    "event_date",
    lambda log: log.select("event_id", X.event_day(F.col("timestamp")).alias("event_day")),
)
QUERIES["date_parts"] = lambda spark, data: table(spark, data, "lineitem").select(
    "l_orderkey",
    "l_linenumber",
    *[c.alias(n) for n, c in X.date_parts(F.col("l_shipdate")).items()],
)
QUERIES["clip_score"] = lambda spark, data: table(spark, data, "customer").select(
    "c_custkey", X.clip(F.col("c_acctbal") / F.lit(50.0), 0.0, 100.0).alias("clipped")
)
on_log("quality_score", lambda log: log.select("event_id", S.LABEL))
on_log(
    "quality_score_flat",
    lambda log: log.select("event_id", X.quality_score(False).alias(S.LABEL)),
)
on_log(
    "round_metrics",
    lambda log: log.select(
        "event_id", *[c.alias(n) for n, c in X.rounded_metrics(log.columns).items()]
    ),
)
on_log(
    "no_click_zeroing",
    lambda log: log.select(
        "event_id", X.zero_without_click(F.col("latency_ms")).alias("dwell_time_sec")
    ),
)
on_log(
    "score_gauge_band",
    lambda log: log.select("event_id", X.gauge_band(F.col(S.LABEL)).alias("band")),
)
on_log(
    "score_bucket",
    lambda log: log.select("event_id", X.score_bucket(F.col(S.LABEL)).alias("bucket")),
)
on_log(
    "mask_pii",
    lambda log: log.select(
        "event_id", K.mask_pii(F.col("user_id_masked"), "pepper").alias("user_hash")
    ),
)


# --- data quality -----------------------------------------------------------------------------------


def _only(kind: str) -> Callable[[DataFrame], DataFrame]:
    return lambda log: Q.run_checks(log, [c for c in Q.EVENT_CHECKS if c.kind == kind])


on_log("expect_not_null", _only("not_null"))
on_log("expect_in_set", _only("in_set"))
on_log("expect_between", _only("between"))
on_log("validate_events", Q.validate_events)


def _damaged(log: DataFrame) -> DataFrame:
    """The log with some values out of bounds, to show what the checks report."""
    return log.withColumns(
        {
            "country": F.when(F.col("country") != "Japan", F.col("country")),
            "position": F.when(F.col("position") > 8, 11).otherwise(F.col("position")),
            "latency_ms": F.col("latency_ms") - F.lit(100.0),
        }
    )


on_log(
    "validation_failures", lambda log: Q.validation_failures(Q.validate_events(_damaged(log)))
)
on_log("dq_gate", lambda log: Q.valid_rows(_damaged(log)))
on_log(
    "check_constraints",
    lambda log: Q.constraint_violations(_damaged(log), Q.fact_constraints()),
)
on_star(
    "check_dim_constraints",
    lambda s: Q.constraint_violations(s["dim_queries"], Q.query_constraints()).unionByName(
        Q.constraint_violations(s["dim_users"], Q.user_constraints())
    ),
)
for _table, _key in W.SAMPLE_KEYS.items():
    on_star(f"unique_key_{_table}", lambda s, t=_table, k=_key: Q.duplicate_keys(s[t], [k]))
on_star(
    "unique_key_sessions", lambda s: Q.duplicate_keys(s["fct_search_events"], ["session_id"])
)
on_star("relationships", Q.relationship_counts)


def _null_keys(star: dict[str, DataFrame]) -> DataFrame:
    keys = {t: [k] for t, k in W.SAMPLE_KEYS.items()}
    keys["fct_search_events"] += ["user_key", "query_key", "system_key", "geo_key"]
    return reduce(
        DataFrame.unionByName, [Q.null_key_counts(star[t], t, k) for t, k in keys.items()]
    )


on_star("not_null_keys", _null_keys)


# --- dimensional model and incremental load ------------------------------------------------------------

for _table in ["dim_geography", "dim_systems", "dim_queries", "dim_users"]:
    on_star(_table, lambda s, t=_table: s[t])
on_star(
    "fct_search_events",
    lambda s: D.add_sequence(G.stg_search_events(s["fct_search_events"])),
)


def _loaded_before(fact: DataFrame) -> DataFrame:
    """The fact as it stood after an earlier load."""
    cut = F.lit(O.WATERMARK_CUT).cast("timestamp_ntz")
    return D.add_sequence(fact.where(F.col("event_timestamp") <= cut))


on_star(
    "incremental_fact",
    lambda s: I.incremental_fact(
        s["fct_search_events"], _loaded_before(s["fct_search_events"])
    ),
)


def _versioned(spark: SparkSession, fact: DataFrame) -> V.VersionedTable:
    """A table that an earlier load has filled."""
    before = _loaded_before(fact)
    table = V.VersionedTable(spark, scratch_path(spark, "versions"), before.schema)
    table.commit(0, table.write(before))
    return table


@query("load_incremental")
def _(spark, data):
    fact = D.fact_with_keys(L.load_log(spark, data))
    table = _versioned(spark, fact)
    I.load_incremental(fact, table)
    return table.read().drop("event_date")


@query("load_incremental_moved")
def _(spark, data):
    """A load in which a part of the loaded events comes again with a later time."""
    fact = D.fact_with_keys(L.load_log(spark, data))
    table = _versioned(spark, fact)
    again = fact.where(
        (F.col("event_timestamp") <= F.lit(O.WATERMARK_CUT).cast("timestamp_ntz"))
        & (K.hash_bucket(F.col("event_id")) % 7 == 0)
    )
    later = F.col("event_timestamp") + F.make_dt_interval(days=F.lit(60))
    I.load_incremental(again.withColumn("event_timestamp", later), table)
    return table.read().drop("event_date")


@query("load_incremental_days")
def _(spark, data):
    """Rows and newest time of each day as the table's own list has them after a load."""
    fact = D.fact_with_keys(L.load_log(spark, data))
    table = _versioned(spark, fact)
    I.load_incremental(fact, table)
    days = [(f.day, f.rows, f.newest) for f in table.folders()]
    listed = spark.createDataFrame(days, "event_date string, n long, newest string")
    return listed.groupBy(F.to_date("event_date").alias("event_date")).agg(
        F.sum("n").alias("row_count"), F.max(F.col("newest").cast("timestamp_ntz")).alias("newest")
    )


on_star(
    "incremental_continue",
    lambda s: I.incremental_slice(
        s["fct_search_events"],
        _loaded_before(s["fct_search_events"]),
        continue_sequences=True,
    ).select("event_id", "session_id", "session_event_sequence"),
)
on_star(
    "late_rows_dropped",
    lambda s: I.late_rows(
        s["fct_search_events"], _loaded_before(s["fct_search_events"])
    ).agg(F.count(F.lit(1)).alias("late_rows")),
)
on_star("current_users", lambda s: D.current_users(s["dim_users"]))


def _versions(star: dict[str, DataFrame]) -> DataFrame:
    """Users known since 2023, a third of whom change segment on 16 January."""
    start = F.lit("2023-01-01").cast("timestamp_ntz")
    dim = star["dim_users"].withColumn("record_start_timestamp", start)
    bucket = K.hash_bucket(F.col("user_id_masked"))
    changes = dim.select(
        "user_id_masked",
        F.lit(O.CUT).cast("timestamp_ntz").alias("changed_at"),
        *[c for c in I.VERSIONED if c != "user_segment"],
        F.when(bucket % 3 == 0, "Light").otherwise(F.col("user_segment")).alias("user_segment"),
    )
    return I.scd2_merge(dim, changes)


on_star("scd2_merge", _versions)
on_star(
    "scd2_orphans",
    lambda s: s["fct_search_events"]
    .join(_versions(s), "user_key", "left_anti")
    .agg(F.count(F.lit(1)).alias("orphans")),
)


def _untouched(star: dict[str, DataFrame]) -> DataFrame:
    """Users with one version, under the key that the dimension gave them."""
    merged = _versions(star)
    single = merged.groupBy("user_id_masked").agg(F.count(F.lit(1)).alias("_n"), F.max("user_key").alias("_key"))
    same = star["dim_users"].join(single.where("_n = 1"), "user_id_masked")
    return same.where(F.col("user_key") == F.col("_key")).select("user_id_masked", "user_key")


on_star("scd2_untouched", _untouched)
on_star("overlong_text", lambda s: G.overlong_values(G.stg_search_events(s["fct_search_events"])))
QUERIES["scd2_asof_lookup"] = lambda spark, data: I.scd2_asof_lookup(
    L.load_log(spark, data).select("event_id", "user_id_masked", "timestamp"),
    _versions(D.build_star(L.load_log(spark, data))),
    "timestamp",
    ["user_segment", "record_start_timestamp"],
).select("event_id", "user_segment", "record_start_timestamp")


# --- reports and monitoring ---------------------------------------------------------------------------

on_log(
    "train_test_split",
    lambda log: T.train_test_split(log.select("event_id")),
)
on_log(
    "regression_metrics",
    lambda log: T.regression_metrics(
        log.withColumn("guess", F.lit(100.0) - F.lit(2.2) * F.col("position")), S.LABEL, "guess"
    ),
)
on_log(
    "sessionize",
    lambda log: R.sessionize(log.select("event_id", "user_id_masked", "timestamp")),
)
on_log("session_metrics", lambda log: R.session_metrics(R.sessionize(log)))
on_log("derive_pogo_reformulation", R.derive_flags)
on_log("rolling_7d_30d", R.rolling_metrics)
on_log("segment_metrics", R.segment_metrics)
on_log("daily_metrics_mart", R.daily_mart)
on_log("latency_percentiles", R.latency_percentiles)


def _two_runs(report: str) -> Query:
    """A report from tables that two runs keep: all but the last days, then the last ten, of which
    the first is loaded again."""

    def run(spark: SparkSession, data: str) -> DataFrame:
        log, root = L.load_log(spark, data), scratch_path(spark, "marts")
        day = F.to_date("timestamp")
        MT.update(log.where(day <= F.lit(O.KEPT_DAY)), root)
        MT.update(log.where(day >= F.lit(O.KEPT_DAY)), root)
        return MT.REPORTS[report](spark, root)

    return run


for _name, _report in O.KEPT.items():
    QUERIES[f"kept_{_name}"] = _two_runs(_report)
on_log("ctr_at_rank1", R.ctr_at_rank)
on_log("input_kpis", R.input_kpis)
on_log("kpi_change_24h", R.kpi_change)
on_log("latency_ctr_correlation", R.latency_ctr_correlation)
on_log("zscore_anomalies", M.zscore_anomalies)
on_log("seasonal_baseline", M.seasonal_baseline)
on_log("alert_levels", M.alert_levels)
on_log("drift_psi", lambda log: M.drift_psi(M.split_periods(log, O.CUT)))
on_log("drift_ks", lambda log: M.drift_ks(M.split_periods(log, O.CUT)))


def _retrain(log: DataFrame) -> DataFrame:
    periods = M.split_periods(log, O.CUT)
    return M.retrain_trigger(M.drift_psi(periods), M.drift_ks(periods))


on_log("retrain_trigger", _retrain)
on_log("experiment_srm", lambda log: M.experiment_srm(M.assign_arm(log)))
on_log("experiment_lift", lambda log: M.experiment_lift(M.assign_arm(log)))
on_log("freshness_check", lambda log: M.freshness_check(log, O.FRESH_AS_OF))
on_log(
    "incident_segment_delta",
    lambda log: M.incident_segment_delta(log, O.INCIDENT_DAY, "United States", "Mobile"),
)
on_log(
    "chronological_split",
    lambda log: M.chronological_split(log.select("event_id", "timestamp")).select(
        "event_id", "split"
    ),
)
on_log(
    "chronological_folds",
    lambda log: M.chronological_folds(log.select("event_id", "timestamp")).select(
        "event_id", "block"
    ),
)


# --- the same operators on the larger relational tables ---------------------------------------------------

LINE_CHECKS = [
    Q.Check("l_orderkey", "not_null"),
    Q.Check("l_shipdate", "not_null"),
    Q.Check("l_returnflag", "in_set", ("A", "N", "R")),
    Q.Check("l_linestatus", "in_set", ("F",)),
    Q.Check("l_quantity", "between", (1.0, 40.0)),
    Q.Check("l_discount", "between", (0.0, 0.1)),
]


def on_table(name: str, source: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, data: build(table(spark, data, source))


on_table("lineitem_checks", "lineitem", lambda df: Q.run_checks(df, LINE_CHECKS))
on_table(
    "lineitem_duplicate_keys",
    "lineitem",
    lambda df: Q.duplicate_keys(df, ["l_orderkey", "l_linenumber"]),
)
on_table(
    "lineitem_sequence",
    "lineitem",
    lambda df: over_order(
        df.select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"),
        ["l_suppkey"],
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
        lambda s: s.row_number("step"),
    ),
)
on_table(
    "lineitem_percentiles",
    "lineitem",
    lambda df: group_quantiles(
        df,
        ["l_returnflag", "l_linestatus"],
        "l_extendedprice",
        {"p50": 0.5, "p95": 0.95},
        {"row_count": F.count(F.lit(1))},
    ).withColumns({c: F.round(c, 6) for c in ["p50", "p95"]}),
)
on_table(
    "lineitem_describe",
    "lineitem",
    lambda df: R.describe_exact(df, ["l_quantity", "l_extendedprice", "l_discount"]),
)
on_table(
    "lineitem_price_histogram",
    "lineitem",
    lambda df: R.histogram(df, "l_extendedprice", 0.0, 100000.0, 20),
)
on_table("orders_daily_volume", "orders", lambda df: R.daily_volume(df, "o_orderdate"))


@query("customers_without_orders")
def _(spark, data):
    customers = table(spark, data, "customer").select("c_custkey", "c_name")
    orders = table(spark, data, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.orphans(customers, orders, "c_custkey")


@query("orders_segment_key")
def _(spark, data):
    customers = table(spark, data, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        K.surrogate_key("c_mktsegment", "c_nationkey").alias("segment_key"),
    )
    orders = table(spark, data, "orders").select("o_orderkey", "o_custkey")
    return J.attach_key(orders, customers, ["o_custkey"], "segment_key").select(
        "o_orderkey", "segment_key"
    )


@query("orders_asof_previous_day")
def _(spark, data):
    """For each order the customer's latest earlier purchase day within a year."""
    orders = table(spark, data, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    days = orders.groupBy("o_custkey", X.event_day(F.col("o_orderdate")).alias("day")).agg(
        F.count(F.lit(1)).alias("orders_that_day")
    )
    return J.asof_join(
        orders,
        days,
        "o_custkey",
        "o_orderdate",
        "day",
        ["orders_that_day"],
        lag_days=1,
        right_unique=True,
        tie=["o_orderkey"],
        matched_ts="previous_day",
    ).select("o_orderkey", "orders_that_day", "previous_day")


# --- models --------------------------------------------------------------------------------------------

_trained: dict[tuple, tuple] = {}
_vectors: dict[tuple, DataFrame] = {}


def _state(spark: SparkSession, data: str) -> tuple:
    """What the input's files are, so that a model is not kept for others."""
    files = sorted(table(spark, data, "events").inputFiles())
    paths = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    states = [p.getFileSystem(conf).getFileStatus(p) for p in map(paths, files)]
    return tuple((f, s.getLen(), s.getModificationTime()) for f, s in zip(files, states))


def _key(spark: SparkSession, data: str) -> tuple:
    return (spark.sparkContext.applicationId, _state(spark, data))


def _quality(spark: SparkSession, data: str):
    """(model, training matrix with split), trained once per session and input."""
    key = _key(spark, data)
    if key not in _trained:
        log = L.load_log(spark, data)
        matrix = T.training_matrix(
            log, FT.user_daily_features(log), FT.query_daily_features(log)
        )
        split = materialize(T.train_test_split(matrix), "matrix")
        _vectors[key] = QM.training_vectors(split.where(F.col("split") == "train"))
        model = QM.train_quality_model(_vectors[key])
        _trained[key] = (model, split)
    return _trained[key]


on_features(
    "sample_feature_pairing",
    lambda log, uf, qf: R.sample_n(T.training_matrix(log, uf, qf), 100, 42, "event_id"),
)


@query("train_quality_model")
def _(spark, data):
    model, split = _quality(spark, data)
    return QM.holdout_metrics(model, split.where(F.col("split") == "test"))


@query("tune_quality_model")
def _(spark, data):
    _, split = _quality(spark, data)
    train = split.where(F.col("split") == "train")
    return QM.tune_quality_model(train)[1]


@query("score_batch")
def _(spark, data):
    model, _ = _quality(spark, data)
    log = L.load_log(spark, data)
    ok, rejected = Q.valid_requests(requests_of(log))
    keyed = ok.withColumn(
        "query_key", K.surrogate_key("search_query", "search_intent", "query_category")
    )
    served = T.serve_features(
        keyed, FT.user_daily_features(log), FT.query_daily_features(log), O.AS_OF
    )
    scored = QM.predict(model, served).withColumn("status", F.lit("scored"))
    refused = rejected.withColumn("status", F.lit("rejected"))
    return scored.unionByName(refused, allowMissingColumns=True).select(
        "event_id",
        "query_key",
        F.round("prediction", 6).alias("predicted_search_quality_score"),
        "status",
    )


def _attributions(spark: SparkSession, data: str) -> DataFrame:
    model, split = _quality(spark, data)
    return A.feature_attribution(model, split, "event_id")


QUERIES["feature_attribution"] = _attributions


@query("attribution_additivity")
def _(spark, data):
    model, split = _quality(spark, data)
    raw = model.transform(QM.assemble(split)).select("event_id", "prediction")
    total = F.col("base_value")
    for name in S.FEATURES:
        total = total + F.col(f"phi_{name}")
    parts = _attributions(spark, data).select("event_id", total.alias("_total"))
    return raw.join(parts, "event_id").select(
        "event_id", (F.abs(F.col("_total") - F.col("prediction")) < 1e-6).alias("adds_up")
    )


QUERIES["importance_ranking"] = lambda spark, data: A.importance_ranking(
    _attributions(spark, data)
)
QUERIES["top_importances"] = lambda spark, data: A.importance_ranking(
    _attributions(spark, data)
).limit(3)


@query("train_outlier_model")
def _(spark, data):
    return OF.train_outlier_model(_quality(spark, data)[1])


@query("outlier_tree_samples")
def _(spark, data):
    """Which events each of ten trees is grown from."""
    columns = ["latency_ms", "page_speed_score", "bounce_rate"]
    log = L.load_log(spark, data)
    return OF.tree_samples(log, columns, "event_id", 10, 256, 42).select(
        "tree", F.col("_id").alias("event_id")
    )


@query("score_outliers")
def _(spark, data):
    _, split = _quality(spark, data)
    forest = materialize(OF.train_outlier_model(split), "forest")
    cut = OF.training_cut(forest, split)
    return OF.score_outliers(forest, split, offset=cut).select(
        "event_id", F.round("anomaly_score", 6).alias("anomaly_score"), "label", "is_anomaly"
    )


def _record(spark: SparkSession, data: str, version: str, model) -> DataFrame:
    split = _quality(spark, data)[1]
    metrics = QM.holdout_metrics(model, split.where(F.col("split") == "test"))
    ranking = A.importance_ranking(A.feature_attribution(model, split, "event_id"))
    at = f"2024-02-0{version} 00:00:00"
    return QM.model_record(spark, "quality", version, metrics, ranking, recorded_at=at)


@query("model_record")
def _(spark, data):
    path = scratch_path(spark, "model-records")
    W.write_table(_record(spark, data, "1", _quality(spark, data)[0]), path, "append")
    return spark.read.parquet(path)


@query("promote_if_better")
def _(spark, data):
    model, _ = _quality(spark, data)
    path = scratch_path(spark, "model-records")
    W.write_table(_record(spark, data, "1", model), path, "append")
    # The rows the active model has learned from, assembled once for both.
    train = _vectors[_key(spark, data)]
    challenger = QM.train_quality_model(train, maxDepth=3, stepSize=0.05)
    W.write_table(_record(spark, data, "2", challenger), path, "append")
    return QM.promote_if_better(spark.read.parquet(path))


@query("segment_outliers")
def _(spark, data):
    keys = ["country", "device_type", "browser_name"]
    log = L.load_log(spark, data)
    segments = R.mart(
        log, {"day": F.to_date("timestamp"), **{k: F.col(k) for k in keys}}
    ).select(
        F.concat_ws("/", F.col("day").cast("string"), *keys).alias("segment_day"),
        (F.col("latency_sum") / F.col("events")).alias("avg_latency_ms"),
        (F.col("clicks") / F.col("impressions")).alias("avg_ctr"),
        (F.col("pogo_sticks") / F.col("events")).alias("avg_pogo_stick_rate"),
    )
    columns = ["avg_latency_ms", "avg_ctr", "avg_pogo_stick_rate"]
    forest = materialize(
        OF.train_outlier_model(segments, columns, key="segment_day"), "forest"
    )
    cut = OF.training_cut(forest, segments, columns)
    return OF.score_outliers(forest, segments, columns, offset=cut).select(
        "segment_day", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly"
    )


@query("collinearity_vif")
def _(spark, data):
    return VIF.collinearity_vif(_quality(spark, data)[1])


# --- streams ---------------------------------------------------------------------------------------------


@query("stream_ingest_fact")
def _(spark, data):
    path = scratch_path(spark, "stream-fact")
    ST.ingest_fact(ST.stream_log(spark, data), path)
    return spark.read.parquet(f"{path}/data").select(*S.FACT)


def _closed(spark: SparkSession, data: str, job: Callable, name: str) -> DataFrame:
    """All that a stream writes, from its start to after its closing marker."""
    path = scratch_path(spark, name)
    job(ST.stream_log(spark, data), path)
    ST.close(spark, path)
    job(ST.stream_log(spark, data), path)
    return spark.read.parquet(f"{path}/data")


@query("stream_tumbling_quality")
def _(spark, data):
    return _closed(spark, data, ST.tumbling_quality, "stream-hours")


@query("stream_sessions")
def _(spark, data):
    return _closed(spark, data, ST.stream_sessions, "stream-sessions")
